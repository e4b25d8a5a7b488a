"""Whitening, decontamination and collocations against brute force, SQL and awkward tables."""

import hashlib
import math
import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as entry
from check import compare, connect
from millrace.llm import collocations as c13
from millrace.llm import positional_index as p12
from millrace.llm import whitening as w11

DOCS = "doc_id long, text string, lang string, n long, item string, _k1 string, w1 string, term string, pos string"
ITEMS = "item_id long, text string, item string, words string, n string"
VECTORS = "vec_id long, embedding array<double>, n string, component string, _id string, _v string"


@pytest.mark.parametrize("name", ["op12_decontamination", "op13_collocations"])
def test_queries_match_sql(spark, sf, name):
    n, problem = compare(entry.queries()[name](spark, sf), connect(sf), entry.oracle_sql()[name])
    assert problem is None and n > 0


# whitening


def symmetric(values):
    """An orthogonal similarity of a diagonal matrix, beyond double precision."""
    q = np.linalg.qr(np.random.default_rng(3).normal(size=(len(values), len(values))))[0].astype(np.longdouble)
    for _ in range(3):
        q = q @ (1.5 * np.eye(len(q), dtype=np.longdouble) - 0.5 * (q.T @ q))
    a = (q * np.array(values, np.longdouble)) @ q.T
    return (a + a.T) / 2


@pytest.mark.parametrize(
    "values",
    [
        np.linspace(60, 150, 48),
        [1] * 20 + list(range(2, 10)),
        [1, 1 + 1e-9, 1 + 1e-9 + 1e-13, 1 + 3e-13, 2, 2, 2 + 1e-12, 5],
        [1 + 10.0**-k for k in range(3, 9)] + [1, 3],
        100 + np.arange(40) * 1e-6,
        [0] * 10 + [1, 2, 3],
        [1e-12, 1e-6, 1, 1e3],
        [5.0],
    ],
)
def test_refinement_passes_double_precision(values):
    a = symmetric(values)
    value, vectors = w11.refine(a)
    top = float(max(values))
    assert np.abs(a @ vectors - vectors * value).max() < 2e-17 * max(top, 1) * len(a) ** 0.5
    assert np.abs(vectors.T @ vectors - np.eye(len(a))).max() < 1e-17
    assert np.abs(value - np.sort(np.array(values, np.longdouble))[::-1]).max() < 1e-17 * max(top, 1) * len(a) ** 0.5


def expected(vectors):
    x = np.floor(64 * np.array(vectors, float)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(0)
    c = x - s / n
    value, comp = np.linalg.eigh(c.T @ c / n)
    value, comp = value[::-1], comp[:, ::-1]
    keep = value > value.sum() * len(value) * 1e-15
    return n, ((n * x - s) ** 2).sum(1), c @ comp[:, keep] / np.sqrt(value[keep]), value[keep] / value.sum()


def whitened(df):
    rows = df.collect()
    return {(r.vec_id, r.component): r for r in rows}, rows


@pytest.fixture(scope="module")
def vectors():
    r = np.random.default_rng(7)
    return (r.normal(size=(300, 40)) @ np.diag(np.linspace(0.2, 2, 40))).round(3).tolist()


def test_whitening_by_brute_force(spark, vectors):
    odd = [(900, None), (901, [1.0] * 39 + [None]), (902, [float("nan")] * 40), (903, [float("inf")] + [0.0] * 39), (904, []), (905, [1.0, 2.0])]
    data = [(i, v, "x", "y", "z", "w") for i, v in [*enumerate(vectors), *odd]]
    random.Random(1).shuffle(data)
    got, rows = whitened(w11.whiten_embeddings(spark.createDataFrame(data, VECTORS).repartition(5)))
    n, deviation, want, share = expected(vectors)
    assert len(rows) == 300 * 32 and {r.vec_id for r in rows} == set(range(300))
    assert len({r.identity_error for r in rows}) == 1 and rows[0].identity_error < 1e-12
    for c in range(32):
        mine = np.array([got[i, c + 1].whitened for i in range(300)])
        assert np.abs(mine * np.sign((mine * want[:, c]).sum()) - want[:, c]).max() < 1e-9
        assert abs(got[0, c + 1].explained / share[c] - 1) < 1e-12
    assert all(r.n == n and r.deviation == deviation[r.vec_id] for r in rows)


def test_whitening_ties_and_small_tables(spark):
    frame = lambda d: spark.createDataFrame([(i, v, "x", "y", "z", "w") for i, v in d], VECTORS)
    assert w11.whiten_embeddings(frame([])).collect() == []
    assert w11.whiten_embeddings(frame([(1, [0.5, 0.25])] * 3)).collect() == []  # all equal: no variance
    flat = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [0.0, 0.0]), (2, [2.0, 0.0])]
    rows = w11.whiten_embeddings(frame(flat)).collect()
    assert [r.component for r in rows] == [1] * 4 and rows[0].explained == 1.0
    assert sorted(str(r.vec_id) for r in rows) == ["1", "1", "2", "None"]
    # equal eigenvalues: any two directions serve
    square = [(i, [float(a), float(b)]) for i, (a, b) in enumerate([(1, 0), (-1, 0), (0, 1), (0, -1)])]
    rows = w11.whiten_embeddings(frame(square)).collect()
    assert len(rows) == 8 and all(abs(r.explained - 0.5) < 1e-12 and r.identity_error < 1e-12 for r in rows)


def test_whitening_large_numbers_are_exact(spark):
    data = [(i, [float(v), 1.0 + (i == 2)]) for i, v in enumerate([0, 10**7, 3])]
    rows = w11.whiten_embeddings(spark.createDataFrame([(i, v, "", "", "", "") for i, v in data], VECTORS)).collect()
    xs = [[64 * int(v) + 10**6 for v in vector] for _, vector in data]
    s = [sum(c) for c in zip(*xs)]
    assert all(r.deviation == sum((3 * a - b) ** 2 for a, b in zip(xs[r.vec_id], s)) for r in rows)
    far = [(0, [1e300, 1.0]), (1, [0.0, 1.5]), (2, [0.0, 1.0])]
    rows = w11.whiten_embeddings(spark.createDataFrame([(i, v, "", "", "", "") for i, v in far], VECTORS)).collect()
    assert rows and all(r.deviation is None for r in rows)


# decontamination


def words(text):
    small = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", small) if w]


def leaks(docs, items):
    out = []
    for i, text in docs:
        own, hit, ids = words(text), set(), set()
        for item, t in items:
            w = words(t)
            n = min(10, len(w))
            for s in range(len(w) - n + 1 if w else 0):
                for p in range(len(own) - n + 1):
                    if own[p : p + n] == w[s : s + n]:
                        hit.update(range(p, p + n))
                        ids.add("" if item is None else str(item))
        out.append((i, len(own), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def corpus():
    r = random.Random(2)
    vocabulary = [f"w{i}" for i in range(60)] + ["Été", "the", "the", "the", "the", "x1"]
    say = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    long = [say(r.randint(10, 40)) for _ in range(6)]
    items = [(i, t) for i, t in enumerate(long)] + [(20, "the the the"), (21, "Été"), (22, ""), (23, None), (None, say(12)), (3, long[1]), (24, "a a a a a a a a a a a a"), (25, "missing word the"), (1, long[0])]
    docs = [(i, say(r.randint(0, 80))) for i in range(25)]
    for k in range(20):
        item = r.choice(long).split()
        a = r.randint(0, len(item) - 5)
        docs.append((100 + k, say(r.randint(0, 15)) + " , " + "-".join(item[a : a + r.randint(5, 25)]).upper().replace("É", "É") + "\n" + say(10)))
    docs += [(200, "a " * 30), (201, None), (202, ""), (203, long[0]), (203, long[0]), (None, long[2]), (None, None), (204, say(6000) + " " + long[4] + " " + say(3000)), (205, "the the the the THE"), (203, "other " + long[1])]
    return docs, items


def frames(spark, docs, items, lang=None):
    d = [(i, t, lang(k) if lang else "en", 1, "a", "b", "c", "d", "e") for k, (i, t) in enumerate(docs)]
    return spark.createDataFrame(d, DOCS).repartition(3), spark.createDataFrame([(i, t, "a", "b", "c") for i, t in items], ITEMS)


def test_decontamination_by_brute_force(spark):
    docs, items = corpus()
    got = p12.decontaminate(*frames(spark, docs, items)).collect()
    assert sorted(map(tuple, got), key=repr) == leaks(docs, items)


def test_decontamination_of_nothing(spark):
    docs, items = corpus()
    d, i = frames(spark, docs, items)
    assert p12.decontaminate(d.limit(0), i).collect() == []
    assert not any(r.contaminated for r in p12.decontaminate(d, i.limit(0)).collect())


def test_phrases_and_near_terms(spark):
    docs, items = corpus()
    d, i = frames(spark, docs, items)
    listed = p12.items_of(i)
    index = p12.build_index(d)
    assert index.count() == sum(len(words(t)) for _, t in docs)  # without terms every word is posted
    key = {}
    for r in d.select("doc_id", "text", *p12.keys("doc_id", "text")).collect():
        key[r._k1, r._k2] = words(r.text)
    for m in p12.phrase_matches(index, listed).collect():
        text = " ".join(key[m._k1, m._k2][m.start : m.start + m.length])
        assert any(text in " ".join(words(t)) for _, t in items)
    counts = Counter(w for _, t in docs for w in words(t))
    want = set()
    rare = {n: sorted(set(words(t)), key=lambda w: (counts[w], w))[:3] for n, (_, t) in enumerate(items) if words(t)}
    for k, own in key.items():
        at = defaultdict(list)
        for p, w in enumerate(own):
            at[w].append(p)
        for n, r in rare.items():
            for p in at[r[0]]:
                if all(any(abs(p - q) <= 20 for q in at[w]) for w in r[1:]):
                    want.add((k, " ".join(words(items[n][1])), p))
    named = {r.item: " ".join(r.words) for r in listed.collect()}
    got = [((m._k1, m._k2), named[m.item], m.start) for m in p12.proximity_matches(index, listed).collect()]
    assert set(got) == want and len(want) > 5


def test_decontamination_runs_natively(spark, sf):
    plan = entry.queries()["op12_decontamination"](spark, sf)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|CartesianProduct|NestedLoop", plan)


# collocations


def mined(docs, least=10, top=2000):
    f = defaultdict(Counter)
    for (_, text), lang in docs:
        small = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", small):
            w = re.findall(r"[^\x20\x09]+", piece)
            for n in (1, 2, 3):
                f[lang or "und"].update(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
    out = []
    for lang, c in f.items():
        n = sum(v for k, v in c.items() if len(k) == 1)
        kept = []
        for p, a in c.items():
            if len(p) < 2 or a < least:
                continue
            cuts = [(10**6 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            if len(p) == 2 and any(v >= least and 2 * v >= a and p in (q[:2], q[1:]) for q, v in c.items() if len(q) == 3):
                continue
            kept.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for rank, (s, a, p, l, r) in enumerate(sorted(kept)[:top], 1):  # noqa: E741
            out.append((lang, rank, p.decode(), -a, l, r, n, -s))
    return sorted(out)


def sentences():
    r = random.Random(4)
    vocabulary = ["the", "Of", "new", "york", "CITY", "été", "🙂", "a\x00b", "\x1f", "x" * 50, "naïve", "und"] + [f"v{i}" for i in range(8)]
    docs = []
    for i in range(120):
        parts = []
        for _ in range(r.randint(0, 12)):
            parts.append((" New york\tcity " if r.random() < 0.3 else " ").join(r.choice(vocabulary) for _ in range(r.randint(0, 9))))
        docs.append((i, r.choice([". ", "!", "\n", " ; ", "\x0b", ","]).join(parts)))
    docs += [(500, None), (501, ""), (502, " \t "), (None, "the of the of"), (503, "hot pair v1 " * 4000), (503, "hot pair v1 " * 40), (504, "." * 50), (505, "end")]
    return docs


LANGS = ["en", None, "und", "fr", "en"]


def test_collocations_by_brute_force(spark):
    docs = sentences()
    frame, _ = frames(spark, docs, [(1, "a")], lambda k: LANGS[k % 5])
    got = sorted(map(tuple, c13.collocations(frame).collect()))
    assert got == mined([(d, LANGS[k % 5]) for k, d in enumerate(docs)]) and len(got) > 100
    top = sorted(map(tuple, c13.collocations(frame, top=3).collect()))
    assert top == mined([(d, LANGS[k % 5]) for k, d in enumerate(docs)], top=3)
    assert c13.collocations(frame.limit(0)).collect() == [] and c13.collocations(frame.where("text is null")).collect() == []


def test_hot_pairs_meet_again(spark, monkeypatch):
    """With one part per few bytes and pairs dealt out by their third word the counts stay whole."""
    monkeypatch.setattr(c13, "PART_BYTES", 500)
    docs = [(i, "hot pair " + f"t{i % 7} . cold pair t{i % 3}") for i in range(200)]
    frame, _ = frames(spark, docs, [(1, "a")], lambda k: LANGS[k % 5])
    assert sorted(map(tuple, c13.collocations(frame).collect())) == mined([(d, LANGS[k % 5]) for k, d in enumerate(docs)])


def test_quicksort_counts_equal_prefixes():
    r = np.random.default_rng(5)
    keys = np.stack([r.integers(0, 3, 4000), r.integers(1, 9, 4000), r.integers(0, 30, 4000), np.zeros(4000, np.int64)])
    keys[3] = np.where(keys[2] > 0, r.integers(0, 9, 4000), 0)
    weights = r.integers(1, 4, 4000)
    want = Counter()
    for column, w in zip(keys.T.tolist(), weights.tolist()):
        for d in (2, 3, 4):
            if all(column[1:d]):
                want[tuple(column[:d])] += w
    got = {tuple(keys[:d, p].tolist()): n for d, p, n in c13.quicksort_counts(keys, weights, 10, 1) if d > 1}
    assert got == {k: n for k, n in want.items() if n >= 10}
    assert c13.quicksort_counts(keys[:, :0], weights[:0], 10) == []


def test_scores_are_exact_beyond_64_bits(spark):
    a, l, r = 10**11 + 7, 3 * 10**12 + 1, 10**12 + 39  # noqa: E741
    single = spark.createDataFrame([("en", "x", l), ("en", "y", r)], "lang string, word string, n long")
    pair = spark.createDataFrame([("en", "x", "y", None, a)], "lang string, w1 string, w2 string, w3 string, n long")
    assert c13.score_phrases(single, pair).first().score == math.floor(10**6 * a * a // (l * r))


# columns of any name, and bounds that hold


def test_stages_keep_columns_of_any_name(spark):
    import corpus_pipeline
    from millrace.llm import mixing

    names = ["_row", "_n", "_topic", "_draw", "_source", "_lang", "_weight", "_probability", "_sampled", "_doc", "_name"]
    data = [(i, f"the word number {i % 4} of a text that goes on for a while {i % 4}", "en", f"src{i % 2}", 9, *[f"{c}{i}" for c in names]) for i in range(12)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in names))
    for stage in (corpus_pipeline.deduplicate, corpus_pipeline.join_near, corpus_pipeline.mix):
        out = stage(spark, docs, "")
        assert out.columns == docs.columns
        kept = out.collect()
        assert kept and all(r[c] == f"{c}{r.doc_id}" for r in kept for c in names)
    sampled = mixing.sample(docs, mixing.plan(docs))
    assert {"_weight", "_probability", "_sampled", "_n", "doc_id", "_row"} <= set(sampled.columns) and sampled.count() == 12


def test_fit_rows_stay_within_their_bound(spark):
    from millrace.llm import classifier

    data = [(1, f"text {i}") for i in range(50)] + [(2, "other"), (3, None)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    grades = spark.createDataFrame([(1, 2), (2, 0), (3, 1)], "doc_id long, grade int")
    assert classifier.labelled_features(docs, grades, "doc_id", "text", 2).count() == 2
    assert classifier.labelled_features(docs, grades, "doc_id", "text", 9).count() == 3


def test_a_pair_survives_the_relief_of_long_lists():
    """Whatever two similar sets share: relieved of their longest lists they still meet on one."""
    from millrace.llm import ngram_join as n9

    r = np.random.default_rng(8)
    for _ in range(300):
        n = int(r.integers(1, 60))
        common = r.choice(200, n, replace=False)
        a, b = set(common.tolist()), set(common.tolist())
        for s in (a, b):
            for x in r.choice(common, int(r.integers(0, 1 + n // 8)), replace=False).tolist():
                s.discard(x)
            s.update((1000 + r.choice(500, int(r.integers(0, 1 + n // 8)), replace=False)).tolist())
        if not a or not b or 100 * len(a & b) < 85 * len(a | b):
            continue
        first, second = r.permutation(2000), r.permutation(2000)  # the order of prefixes, that of lengths
        kept = []
        for s in (a, b):
            m = np.array(len(s))
            listed = sorted(s, key=lambda x: first[x])[: int(n9.prefix_size(m) + n9.spare(m))]
            drop = int(n9.dropped(m))
            kept.append(set(sorted(listed, key=lambda x: second[x])[: len(listed) - drop]))
        assert kept[0] & kept[1]


def test_collocations_deal_in_small_blocks():
    """A task holds a few copies of a block's words, however large its batch of texts is."""
    r = np.random.default_rng(1)
    texts = [" ".join(f"w{x}" for x in row) for row in r.integers(0, 30_000, (1500, 1000)).tolist()]
    batch = pa.RecordBatch.from_pydict({"_lang": ["en"] * len(texts), "_text": texts})
    tracemalloc.start()
    sent = sum(b.num_rows for b in c13._dealt(16, np.zeros(0, np.uint64))(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sent and peak < 120 << 20, peak >> 20
