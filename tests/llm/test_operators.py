"""Each operator against SQL or a brute-force version, on small tables with every awkward case."""

import hashlib
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
from check import compare, connect
from millrace.llm import byte_bpe, classifier, exact_dedup, licenses, mixing, ngram_join, quality_rules, recompression, suffix_dedup, token_files
from millrace.llm.components import components
from millrace.session import work_dir

WORD = r"[^\x20\x09-\x0D]+"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _id string, _text string, n string, cid string, gid string"
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def texts():
    """Ties, copies, repeats, empty and long texts, odd spaces, other scripts."""
    r = random.Random(5)
    vocabulary = ["".join(r.choice("abcdeéñß") for _ in range(r.randint(1, 9))) for _ in range(300)]
    say = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    passage, base = say(80), say(120)
    out = ["", None, " \n\t ", "one", "one", "One  ", "a b c", "A B\x0bc", "x " * 700, "na" * 900, "é" * 300, passage, passage + " end", base]
    out += [say(20) + " " + passage + "\n" + say(15) for _ in range(6)]
    out += [base.replace(" ", "  ", 3), base + "\n"] + [" ".join(w if i != k else "other" for i, w in enumerate(base.split())) for k in (3, 60, 119)]
    out += [say(40) + "\r\n" + "the same line here\n" * 8, say(3000) + passage, "abc\x00def\x1c ghi\x85j 🙂 <|endoftext|> it's I'LL", "word " * 60 + say(60)]
    out += ["MIT License\n\nCopyright (c) 2020 Somebody\n\n" + licenses.MIT, say(10) + "\nReleased under the MIT Licence\nAll rights reserved."]
    return out + [say(r.randint(1, 200)) for _ in range(25)]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, None if i % 7 == 0 else "en", "src0" if i % 3 == 0 else f"src{i}", None, "x", "y", "z", "c", "g") for i, t in enumerate(texts())]
    return spark.createDataFrame([rows[i] for i in random.Random(1).sample(range(len(rows)), len(rows))], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def rows():
    return [(i, t or "") for i, t in enumerate(texts())]


@pytest.fixture(scope="module")
def ids_missing(spark):
    """Rows that repeat, an id with two texts, and rows without an id."""
    long = " ".join(f"w{i}" for i in range(90))
    data = [(1, long), (1, long), (1, "another text"), (None, long), (None, None), (2, long + " tail"), (None, "another text"), (0, "short")]
    return spark.createDataFrame([(i, t, None, None, None, "", "", "", "", "") for i, t in data], SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def result(df, *columns):
    return {r[0]: tuple(r)[1:] for r in df.select("doc_id", *columns).collect()}


def repeats(units, size, join):
    """Removed places by the definition: units of each document, by ascending id."""
    first, out = {}, {}
    for i, u in units:
        for p in range(len(u) - size + 1):
            first.setdefault(tuple(u[p : p + size]), i)
    for i, u in units:
        gone = set()
        for p in range(len(u) - size + 1):
            if first[tuple(u[p : p + size])] < i:
                gone.update(range(p, p + size))
        kept = join([x for p, x in enumerate(u) if p not in gone])
        out[i] = (len(u), gone, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("name", ["op4_exact_dedup", "op7_quality_rules", "op8_license_scan"])
def test_queries_match_sql(spark, sf, name):
    n, problem = compare(entry.queries()[name](spark, sf), connect(sf), entry.oracle_sql()[name])
    assert problem is None and n > 0


def test_every_operator_has_a_query():
    assert {n.split("_")[0] for n in entry.queries() if re.match(r"op\d+_", n)} == {f"op{i}" for i in range(1, 14)}
    assert "pipeline" in entry.queries()


def test_token_files(spark, odd, rows, nothing, ids_missing):
    path = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    got = result(token_files.checksums(token_files.write_and_read(odd, path, 1)), "start", "n_tokens", "ids_crc32")
    start = 0
    for i, text in rows:
        ids = [*t.encode(text, add_special_tokens=False).ids, 1]
        assert got[i] == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert token_files.checksums(token_files.write_and_read(nothing, path, 1)).isEmpty()
    assert token_files.checksums(token_files.write_and_read(ids_missing, path, 1)).count() == 8
    alphabet = "aBé\n\t  's1.,🙂ßжÉµ<|>\x1c\x85́"
    e, r = token_files.WordEncoder(path), random.Random(2)
    many = ["İstanbul ΟΔΟΣ", "", *["".join(r.choice(alphabet) for _ in range(40)) for _ in range(500)]]
    assert e.encode_all(many) == [t.encode(x, add_special_tokens=False).ids for x in many]


def test_plain_texts_are_split_together():
    """Plain texts and others, in any order, with spaces and line ends at their ends."""
    path = public_tokenizers.path("word_bpe_49k.json")
    t, e, r = Tokenizer.from_file(path), token_files.WordEncoder(path), random.Random(5)
    plain = ["", " ", "a ", "\n b", *["".join(r.choice("aB \t\n\r1.,ÀÿßÞ-_") for _ in range(30)) for _ in range(300)]]
    other = ["it's", "<|endoftext|>", "É", *["".join(r.choice("a 's1×🙂É\n") for _ in range(30)) for _ in range(300)]]
    mixed = [*plain, *other]
    r.shuffle(mixed)
    for texts in (plain, other, mixed, []):
        want = [t.encode(x, add_special_tokens=False).ids for x in texts]
        ids, size = e.encode_flat(pa.array(texts, pa.string()))
        assert ids.tolist() == [i for x in want for i in x] and size.tolist() == [len(x) for x in want]


def test_texts_of_other_tokenizer_files():
    """A file with another splitter takes the library's own path."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    t, e = Tokenizer.from_file(path), token_files.WordEncoder(path)
    texts = ["", "Plain words, 42 of them.", "it's  two\nlines", "ßÉ 🙂 <|endoftext|>"]
    assert not e.known and token_files.WordEncoder(public_tokenizers.path("word_bpe_49k.json")).known
    assert e.encode_all(texts) == [t.encode(x, add_special_tokens=False).ids for x in texts]


def test_token_files_are_pruned_and_ordered(spark, odd):
    to = work_dir(spark, "tokens-test")
    token_files.write_tokens(odd, to, public_tokenizers.path("word_bpe_49k.json"), 1, files=4)
    read = token_files.read_tokens(spark, to)
    ranges = sorted((r.lo, r.hi) for r in read.groupBy(F.input_file_name()).agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).collect())
    assert len(ranges) > 1 and all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))
    plan = read.where("doc_id = 7")._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,7)]" in plan
    assert read.where("doc_id = 7").count() == 1


def test_classifier(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    train = classifier.grade_labels(labels).where("pmod(xxhash64(doc_id, 3), 3) > 0")
    model = classifier.train(docs, train, 3)
    assert (np.diff(model.thresholds) > 0).all()
    held = classifier.grade_labels(labels).where("pmod(xxhash64(doc_id, 3), 3) = 0")
    shares = classifier.score(docs, model).join(held, "doc_id").groupBy("grade").agg(F.avg((F.col("tails")[1] >= 0.3).cast("int")).alias("kept")).collect()
    kept = {r.grade: r.kept for r in shares}
    assert kept[2] > 0.95 and kept[1] < 0.4
    assert classifier.select(docs, model).columns == docs.columns


def test_classifier_odd_cases(spark, odd, nothing, ids_missing):
    labels = spark.createDataFrame([(0, 1, 0), (1, None, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    assert classifier.classify(odd, labels).count() == odd.count()
    assert classifier.classify(nothing, labels).isEmpty()
    assert classifier.classify(ids_missing, labels.limit(0)).count() == 8


def test_classifier_orders_grades():
    r = np.random.default_rng(0)
    grades = r.integers(0, 4, 400)
    rows = [np.unique(np.append(r.integers(100, 5000, 30), np.arange(g * 5, g * 5 + 5))).astype(np.int32) for g in grades]
    m = classifier.fit(rows, grades, 4)
    expected = np.array([m.tails(float(m.weights[x].sum())).sum() for x in rows])
    means = [expected[grades == g].mean() for g in range(4)]
    assert means == sorted(means) and (np.abs(expected - grades) < 1).mean() > 0.9


def test_raking_meets_targets(spark):
    r = random.Random(3)
    cells = [(s, g, t, r.randint(50, 500), 1) for s in "abc" for g in "xy" for t in "mn"]
    df = spark.createDataFrame(cells, "source string, lang string, topic string, tokens long, docs long")
    targets = {"source": {"a": 0.5, "b": 0.3, "c": 0.2}, "lang": {"x": 0.7}, "topic": {"m": 0.4, "n": 0.6}}
    raked = mixing.calibrate(mixing.rake(df, targets), 0.3).collect()
    total = sum(r.tokens for r in raked)
    for dim, shares in targets.items():
        for k, share in shares.items():
            assert sum(r.tokens * r.weight for r in raked if r[dim] == k) / total == pytest.approx(share, abs=1e-3)
    assert sum(r.tokens * r.probability for r in raked) / total == pytest.approx(0.3, abs=0.01)
    # the same rounds in plain loops
    w = {c[:3]: 1.0 for c in cells}
    full = {**targets, "lang": {"x": 0.7, "y": 0.3}}
    for _ in range(100):
        for d, shares in enumerate(full.values()):
            for k, share in shares.items():
                now = sum(c[3] * w[c[:3]] for c in cells if c[d] == k)
                for c in cells:
                    if c[d] == k:
                        w[c[:3]] *= share * total / now
    assert all(r.weight == pytest.approx(w[r.source, r.lang, r.topic], rel=1e-2) for r in raked)


def test_rounds_over_few_cells_are_planned_once(spark, monkeypatch):
    seen, keep = {}, mixing.pin
    ask = lambda: (spark.conf.get("spark.sql.adaptive.enabled"), spark.conf.get("spark.sql.shuffle.partitions"))
    monkeypatch.setattr(mixing, "pin", lambda df, label: seen.setdefault(label, set()).add(ask()) or keep(df, label))
    before = ask()
    docs = spark.createDataFrame([(i, "stand strand quest" if i % 3 else "reach church", "en" if i % 2 else "de", f"src{i % 4}") for i in range(24)], "doc_id long, text string, lang string, source string")
    few = mixing.plan(docs.coalesce(1))
    assert before == ask() == ("true", "4") and {a for a, _ in seen["raked"]} == {"false"}
    monkeypatch.setattr(mixing, "FEW_CELLS", 0)
    seen.clear()
    many = mixing.plan(docs.coalesce(1))
    assert seen["raked"] == {before}
    show = lambda df: sorted((r.source, r.lang, r.topic, r.tokens, round(r.weight, 9), round(r.probability, 9)) for r in df.collect())
    assert show(few) == show(many) != []


def test_mixing_odd_cases(spark, odd, nothing, ids_missing):
    mixed = mixing.sample(odd, mixing.plan(odd))
    assert mixed.count() == odd.count()
    assert mixed.where("_probability < 0 or _probability > 1").isEmpty()
    assert mixing.sample(nothing, mixing.plan(nothing)).isEmpty()
    assert mixing.sample(ids_missing, mixing.plan(ids_missing)).count() == 8


def test_exact_dedup(odd, rows, nothing, ids_missing):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t), []).append((-len(t), i))
    want = {i: (min(g)[1], len(g), min(g)[1] == i, hashlib.sha256(k.encode()).hexdigest()) for k, g in groups.items() for _, i in g}
    for salts in (1, 16):
        assert result(exact_dedup.exact_dedup(odd, salts=salts), "keep_id", "group_size", "kept", "text_sha256") == want
    assert exact_dedup.exact_dedup(nothing).isEmpty()
    got = sorted((repr(r.doc_id), repr(r.keep_id), r.group_size, r.kept) for r in exact_dedup.exact_dedup(ids_missing).collect())
    assert got == sorted(
        [("0", "0", 1, True), ("1", "1", 3, True), ("1", "1", 3, True), ("None", "1", 3, False), ("1", "1", 2, True), ("None", "1", 2, False)]
        + [("2", "2", 1, True), ("None", "None", 1, True)]
    )


def test_suffix_dedup(odd, rows, nothing, ids_missing):
    want = {}
    for i, (n, gone, sha) in repeats([(i, t.encode()) for i, t in rows], 50, bytes).items():
        want[i] = (n, len(gone), sum(p - 1 not in gone for p in gone), sha)
    assert sum(w[1] for w in want.values()) > 1000
    assert result(suffix_dedup.remove_repeats(odd), "n_bytes", "n_removed", "n_spans", "kept_sha256") == want
    assert suffix_dedup.remove_repeats(nothing).isEmpty()
    got = sorted((repr(r.doc_id), r.n_bytes, r.n_removed) for r in suffix_dedup.remove_repeats(ids_missing, with_text=False).collect())
    long = len(" ".join(f"w{i}" for i in range(90)))
    assert got == sorted([("1", long, 0), ("1", long, 0), ("1", 12, 0), ("None", long, long), ("None", 0, 0), ("2", long + 5, long), ("None", 12, 0), ("0", 5, 0)])


def test_a_bucket_sends_a_context_once(monkeypatch):
    """However many rows of a bucket hold a text, what goes to the parts does not grow."""
    pa = __import__("pyarrow")
    monkeypatch.setattr(suffix_dedup, "read_bits", lambda answers, names, parts: np.ones(len(names), bool))
    r = random.Random(8)
    text = "".join(r.choice("abcdefgh ") for _ in range(900))
    bucket = lambda ids: suffix_dedup.ordered(pa.table({"_id": ids, "_no_id": [False] * len(ids), "_text": [text] * len(ids)}))
    sent = {}
    for ids in ([3], [3] * 4 + list(range(4, 300))):
        found = suffix_dedup._contexts(bucket(ids), None, 1)
        sent[len(ids)], spans, alike = suffix_dedup.combined(found)
        assert len(sent[len(ids)]) + len(spans) + len(alike) == len(found)
    one, many = sent.values()
    assert len(one) == len(many) > 20 and set(many["id"].tolist()) == {3}
    assert len(alike) == 3 * len(one) and len(spans) == 296 * len(one)


def test_suffix_dedup_of_a_hot_text(spark, monkeypatch):
    """Copies of one text in many buckets, some under one id, and passages that repeat inside of a text."""
    monkeypatch.setattr(suffix_dedup, "buckets_for", lambda n: 3)
    r = random.Random(3)
    say = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    hot, passage = say(400), say(130)
    data = [(i, hot) for i in range(5, 60)] + [(100 + i, passage[i:] + say(30) + passage + hot[60 : 200 + i]) for i in range(20)]
    data += [(2, passage + "x" + passage + "y" + hot[:100] + hot[:100]), (3, say(50) + passage[7:])]
    df = spark.createDataFrame(data + [(2, data[-2][1])], "doc_id long, text string")
    want = repeats([(i, t.encode()) for i, t in sorted(data)], 50, bytes)
    for row in suffix_dedup.remove_repeats(df).collect():
        n, gone, sha = want[row.doc_id]
        assert (row.n_bytes, row.n_removed, row.kept_sha256) == (n, len(gone), sha)


def test_suffixes_of_a_part_are_sorted_some_at_a_time(monkeypatch):
    """Two texts alike but for a byte here and there: the memory does not follow the number of suffixes."""
    monkeypatch.setattr(suffix_dedup, "read_bits", lambda answers, names, parts: np.ones(len(names), bool))
    r = random.Random(11)
    a = "".join(r.choice("abcdefgh ") for _ in range(150_000))
    b = list(a)
    for i in range(0, len(b), 90):
        b[i + r.randrange(90) if i + 90 < len(b) else i] = "#"
    texts = [a, "".join(b)]
    t = suffix_dedup.ordered(pa.table({"_id": [0, 1], "_no_id": [False] * 2, "_text": texts}))
    records = suffix_dedup._contexts(t, None, 1)
    tracemalloc.start()
    at, start, length = suffix_dedup.repeated_spans(records)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 80 << 20
    assert set(records["row"][at].tolist()) == {1}
    gone = set()
    for begin, n in zip((records["start"][at] + start).tolist(), length.tolist()):
        gone.update(range(begin, begin + n))
    assert gone == repeats([(i, x.encode()) for i, x in enumerate(texts)], 50, bytes)[1][1] and len(gone) > 20_000
    # names with more suffixes than that come by the distance to their anchor
    monkeypatch.setattr(suffix_dedup, "SUFFIXES", 20)
    again = suffix_dedup.repeated_spans(records)
    assert sorted(zip(*(x.tolist() for x in again))) == sorted(zip(at.tolist(), start.tolist(), length.tolist()))


def test_a_part_is_unpacked_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "buckets_for", lambda n: 3)
    monkeypatch.setattr(suffix_dedup, "RECORDS", 10)
    r = random.Random(12)
    say = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    passages = [say(r.randrange(40, 200)) for _ in range(12)]
    data = [(i, "".join(r.choice(passages) + say(9) for _ in range(6))) for i in range(30)]
    want = repeats([(i, t.encode()) for i, t in data], 50, bytes)
    for row in suffix_dedup.remove_repeats(spark.createDataFrame(data, "doc_id long, text string")).collect():
        assert (row.n_removed, row.kept_sha256) == (len(want[row.doc_id][1]), want[row.doc_id][2])


def test_long_texts_are_cut_into_segments(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CHUNK", 128)
    r = random.Random(4)
    a = bytes(r.choice(b"abcdefgh ") for _ in range(3000)).decode()
    t = suffix_dedup.ordered(__import__("pyarrow").table({"_id": [0], "_no_id": [False], "_text": [a]}))
    names = suffix_dedup._names(t)[0]
    monkeypatch.setattr(suffix_dedup, "CHUNK", 1 << 20)
    assert set(names.tolist()) == set(suffix_dedup._names(t)[0].tolist())


def test_interval_tree():
    lcp = np.array([0, 5, 7, 7, 3, 0, 6, 6])
    assert sorted(suffix_dedup.intervals(lcp, 3)) == sorted([(7, 1, 3), (5, 0, 3), (3, 0, 4), (6, 5, 7)])
    assert suffix_dedup.intervals(lcp, 8) == []


def test_byte_bpe(odd, rows, nothing, ids_missing):
    e = byte_bpe.encoder(RANKS, public_tokenizers.PATTERN)
    reference = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=e.vocabulary.ranks, special_tokens={})
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = {}
    for i, t in rows:
        ids = reference.encode_ordinary(t)
        want[i] = (len(ids), sha(",".join(map(str, ids)).encode()), sha(t.encode()))
    assert result(byte_bpe.round_trip(odd, RANKS, public_tokenizers.PATTERN), "n_tokens", "ids_sha256", "decoded_sha256") == want
    assert {k: len(v[0]) for k, v in result(byte_bpe.encode(odd, RANKS, public_tokenizers.PATTERN), "ids").items()} == {k: v[0] for k, v in want.items()}
    assert byte_bpe.round_trip(nothing, RANKS, public_tokenizers.PATTERN).isEmpty()
    assert byte_bpe.encode(ids_missing, RANKS, public_tokenizers.PATTERN).count() == 8
    r = random.Random(6)
    many = ["".join(r.choice("ab é\n\t  's1.,🙂ßж\x1c\x85") for _ in range(r.randint(0, 60))) for _ in range(2000)]
    many += ["".join(r.choice("abcnt ") for _ in range(60)) for _ in range(2000)] + ["abab" * 500, "a" * 5000]
    ids, at = e.encode_all(many)
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [reference.encode_ordinary(t) for t in many]


def test_rank_queue():
    q = byte_bpe.RankQueue(5000)
    for rank in (4097, 3, 64, 3, 4999):
        q.push(rank, np.array([rank]))
    assert [(r, len(p)) for r, p in iter(q.pop, None)] == [(3, 2), (64, 1), (4097, 1), (4999, 1)]


def test_quality_rules(odd, rows, nothing, ids_missing):
    led = quality_rules.ledger(odd)
    got = result(led, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    for i, t in rows:
        w = re.findall(WORD, t)
        lines = [x for x in t.split("\n") if re.search(WORD, x)]
        count = Counter(tuple(w[p : p + 8]) for p in range(len(w) - 7))
        covered = {q for p in range(len(w) - 7) if count[tuple(w[p : p + 8])] > 1 for q in range(p, p + 8)}
        assert got[i] == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))
    bits = {r.doc_id: r.fail_bits for r in led.collect()}
    for r in quality_rules.ablations(led).collect():
        mask = quality_rules.mask_of(quality_rules.POLICIES[r.policy])
        bit = quality_rules.mask_of((r.rule,))
        assert r.rejected == sum(bool(b & bit) for b in bits.values())
        assert r.rejected_alone == sum(b & mask == bit for b in bits.values())
    assert quality_rules.ledger(nothing).isEmpty() and quality_rules.ledger(ids_missing).count() == 8


def test_license_scan(odd, rows, nothing, ids_missing):
    got = result(licenses.scan_licenses(odd), "license", "notices")
    whole = next(i for i, t in rows if t.startswith("MIT License"))
    lines = next(i for i, t in rows if t.endswith("All rights reserved."))
    assert got[whole][0] == "MIT"
    assert got[lines] == (None, ["MIT", "all-rights-reserved"])
    assert sum(v[0] is not None for v in got.values()) == 1 and len(got) == len(rows)
    assert licenses.scan_licenses(nothing).isEmpty() and licenses.scan_licenses(ids_missing).count() == 8


BSD = """Copyright (c) 2021, Jane Doe

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""


def test_licenses_that_the_documents_do_not_hold(spark):
    full = {n: next(t for k, t in licenses.KNOWN if k == n and len(t) > 5000) for n in ("Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "CC0-1.0")}
    data = [(n, t.upper().replace("\n", "  \n")) for n, t in full.items()] + [("BSD-2-Clause", BSD), (None, "some words\n" + BSD)]
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(data)], "doc_id long, text string")
    assert {i: v[0] for i, v in result(licenses.scan_licenses(df), "license").items()} == {i: n for i, (n, _) in enumerate(data)}
    code = "# SPDX-License-Identifier: MPL-2.0\nx = 1\n// Licensed under the BSD 3-Clause License.\nLicensed under CC BY-SA 4.0."
    df = spark.createDataFrame([(0, code), (1, ""), (2, "SPDX-License-Identifier")], "doc_id long, text string")
    got = result(licenses.scan_licenses(df), "license", "notices")
    assert got == {0: (None, ["BSD-3-Clause", "CC-BY-SA-4.0", "MPL-2.0"]), 1: (None, []), 2: (None, [])}


def brute_components(rows, size=5, percent=80):
    low = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
    sets = {}
    for i, t in rows:
        w = re.findall(WORD, t.translate(low))
        sets[i] = {tuple(w[p : p + size]) for p in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())
    root = {i: i for i in sets}
    changed = True
    pairs = [(i, j) for i in sets for j in sets if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    while changed:
        changed = False
        for i, j in pairs:
            if root[i] != root[j]:
                root[i] = root[j] = min(root[i], root[j])
                changed = True
    return {i: (len(s), root[i]) for i, s in sets.items()}


def test_ngram_join(odd, rows, nothing, ids_missing):
    for limits in ((4, 85), (5, 80)):
        got = ngram_join.near_duplicates(odd, size=limits[0], percent=limits[1])
        assert result(got, "n_shingles", "component_id") == brute_components(rows, *limits)
    assert ngram_join.near_duplicates(nothing).isEmpty()
    got = sorted((repr(r.doc_id), r.n_shingles, repr(r.component_id)) for r in ngram_join.near_duplicates(ids_missing, size=4, percent=85).collect())
    assert got == sorted([("1", 87, "1")] * 2 + [("1", 1, "1"), ("None", 87, "1"), ("None", 0, "None"), ("2", 88, "1"), ("None", 1, "1"), ("0", 1, "0")])


def test_ngram_join_of_many_near_copies(spark):
    """A cluster whose members are linked in chains, and strangers that share a passage."""
    r = random.Random(9)
    base, passage = [f"b{i}" for i in range(150)], " ".join(f"p{i}" for i in range(40))
    data = []
    for i in range(120):
        w = list(base)
        for k in r.sample(range(150), r.randint(0, 6)):
            w[k] = f"x{r.randint(0, 500)}"
        data.append((i, " ".join(w)))
    data += [(200 + i, passage + " " + " ".join(f"u{r.randint(0, 9999)}" for _ in range(r.randint(5, 40)))) for i in range(60)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    assert result(ngram_join.near_duplicates(df), "n_shingles", "component_id") == brute_components(data)


def test_ngram_join_meets_a_pair_once(spark, monkeypatch):
    """Texts of one family about the limit share many lists and are not all linked by neighbours."""
    r = random.Random(4)
    data = []
    for i in range(150):
        w = [f"b{k}" for k in range(200)]
        for k in r.sample(range(200), r.randint(2, 6)):
            w[k] = f"x{i}_{k}"
        data.append((i, " ".join(w)))
    across, made = ngram_join.JaccardJoin._across, []
    monkeypatch.setattr(ngram_join.JaccardJoin, "_across", lambda *a: made.append(across(*a)) or made[-1])
    df = spark.createDataFrame(data, "doc_id long, text string")
    assert result(ngram_join.near_duplicates(df, size=4, percent=85), "n_shingles", "component_id") == brute_components(data, 4, 85)
    assert made[0].count() == made[0].distinct().count() > 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 101), (102, 101), (7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 102: 100}


def test_components_of_few_links_are_planned_once(spark, monkeypatch):
    import importlib

    module, seen = importlib.import_module("millrace.llm.components"), {}
    keep = module.pin
    ask = lambda: (spark.conf.get("spark.sql.adaptive.enabled"), spark.conf.get("spark.sql.shuffle.partitions"))
    monkeypatch.setattr(module, "pin", lambda df, label: seen.setdefault(label, set()).add(ask()) or keep(df, label))
    before = ask()
    hub = [(7, i) for i in range(8, 40)]
    links = spark.createDataFrame([*hub, (7, 3), (50, 51), (51, 51), (52, 51), (60, 60)], "a long, b long")
    few = sorted(map(tuple, components(links).collect()))
    assert before == ask() == ("true", "4") and {a for a, _ in seen["edges"]} == {"false"}
    monkeypatch.setattr(module, "FEW_LINKS", 0)
    seen.clear()
    assert sorted(map(tuple, components(links).collect())) == few and seen["edges"] == {before}
    assert few == sorted([(i, 3) for i in [3, *range(7, 40)]] + [(i, 50) for i in (50, 51, 52)])
    with pytest.raises(RuntimeError):
        components(links, rounds=1)
    assert ask() == before


def test_substring_dedup(odd, rows, nothing, ids_missing):
    want = {}
    for i, (n, gone, sha) in repeats([(i, re.findall(WORD, t)) for i, t in rows], 50, lambda w: " ".join(w).encode()).items():
        want[i] = (n, len(gone), sha)
    assert sum(w[1] for w in want.values()) > 300
    assert result(recompression.remove_repeats(odd), "n_words", "n_removed", "kept_sha256") == want
    assert recompression.remove_repeats(nothing).isEmpty()
    got = sorted((repr(r.doc_id), r.n_words, r.n_removed) for r in recompression.remove_repeats(ids_missing, with_text=False).collect())
    assert got == sorted([("1", 90, 0), ("1", 90, 0), ("1", 2, 0), ("None", 90, 90), ("None", 0, 0), ("2", 91, 90), ("None", 2, 0), ("0", 1, 0)])


def test_symbols_agree_inside_equal_windows():
    r = np.random.default_rng(8)
    window = r.integers(0, 40, 50).astype(np.uint64)
    seen = set()
    for _ in range(20):
        left, right = r.integers(0, 30, 2)
        words = np.concatenate([r.integers(0, 40, left), window, r.integers(0, 40, right)]).astype(np.uint64)
        symbol, start = recompression.symbols(words, np.zeros(len(words), np.int64))
        at = np.searchsorted(start, left + np.arange(recompression.EDGE, 50 - recompression.EDGE), side="right") - 1
        seen.add(tuple(symbol[at].tolist()))
    assert len(seen) == 1
