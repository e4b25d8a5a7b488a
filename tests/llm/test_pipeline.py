"""The pipeline's stages: what each keeps, and that its decisions take effect."""

import hashlib
import re

import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import byte_bpe, mixing
from millrace.session import pin
from test_operators import brute_components


def test_stages(spark, sf):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = pin(stage(spark, docs, "/root/testdata/sf0.01"), "stage")
        kept[name] = (before, docs)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
            assert docs.exceptAll(before).isEmpty() and 0 < docs.count() < before.count()
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    clean = labels.where("quality = 1 and toxic = 0").join(kept["quality classifier"][0], "doc_id")
    assert clean.join(kept["quality classifier"][1], "doc_id", "left_semi").count() >= 0.97 * clean.count()

    before, after = kept["exact dedup"]
    best = {}
    for r in before.collect():
        key = re.sub(r"[\x20\x09-\x0D]", "", r.text or "")
        best[key] = min(best.get(key, (0, 1 << 60)), (-len(r.text or ""), r.doc_id))
    assert {r.doc_id for r in after.collect()} == {i for _, i in best.values()}

    before, after = kept["n-gram Jaccard join"]
    roots = brute_components([(r.doc_id, r.text or "") for r in before.collect()])
    assert {r.doc_id for r in after.collect()} == {i for i, (_, root) in roots.items() if i == root}

    before, after = kept["mixing sources"]
    cells = mixing.plan(before)
    wanted = mixing.sample(before, cells).where(F.col("_draw") < F.col("_probability"))
    assert {r.doc_id for r in wanted.collect()} == {r.doc_id for r in after.collect()}

    before, after = kept["byte-level BPE"]
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    e = byte_bpe.encoder(path, public_tokenizers.PATTERN)
    reference = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=e.vocabulary.ranks, special_tokens={})
    got = {r.doc_id: r for r in after.collect()}
    for r in before.collect():
        ids = reference.encode_ordinary(r.text or "")
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def test_stages_survive_an_empty_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = pin(stage(spark, docs, sf), "stage")
    assert docs.isEmpty()


def test_dedup_stages_keep_one_row_of_a_group(spark, sf):
    """Rows that repeat, ids with several texts, and rows without an id."""
    long, other = " ".join(f"w{i}" for i in range(90)), " ".join(f"v{i}" for i in range(90))
    data = [(1, long)] * 3 + [(1, long.replace(" ", "  ", 2)), (1, other), (2, long + " tail"), (None, other + " tail"), (None, other + " end")]
    data += [(None, ""), (None, None), (None, "lone one"), (None, "lone one"), (3, other), (3, ""), (4, "lone two"), (4, "lone two")]
    docs = spark.createDataFrame([(i, t, "en", None if i == 4 else "src", len(t or "")) for i, t in data], "doc_id long, text string, lang string, source string, n_chars long")
    both = docs.unionAll(docs).repartition(3)
    show = lambda df: sorted((repr(r.doc_id), repr(r.text)) for r in df.collect())
    sure = lambda *rows: sorted((repr(i), repr(t)) for i, t in rows)

    exact = corpus_pipeline.deduplicate(spark, both, sf)
    assert exact.columns == docs.columns
    lone = [(None, "lone one"), (4, "lone two")]
    texts = [(1, long.replace(" ", "  ", 2)), (1, other), (2, long + " tail"), (None, other + " tail"), (None, other + " end")]
    assert show(exact) == sure(*texts, (3, ""), *lone)

    near = corpus_pipeline.join_near(spark, both, sf)
    assert near.columns == docs.columns
    got = show(near)
    of_long = [r for r in got if "w7" in r[1]]
    assert of_long in (sure((1, long)), sure((1, long.replace(" ", "  ", 2))))
    assert sorted(r for r in got if r not in of_long) == sure((1, other), (3, ""), (None, ""), (None, None), *lone)
