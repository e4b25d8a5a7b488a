"""The corpus pipeline: classify, deduplicate, join near copies, mix, encode.

Each stage takes (spark, docs, sf_dir); its result is written as Parquet and read again as the docs of the
next one. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import byte_bpe, classifier, exact_dedup, mixing, ngram_join
from millrace.session import pin, table


#: Near copies: words in a shingle, and the similarity in hundredths from which two documents are linked.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def _same(a, b):
    return a.eqNullSafe(b)


def _row(docs: DataFrame) -> str:
    """A column name that ``docs`` does not have."""
    name = "_row"
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    return name


def _named(docs: DataFrame) -> DataFrame:
    """``docs`` with a last column, a digest of all others: rows are equal when their names are."""
    texts = [F.col(c).cast("string") for c in docs.columns]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return docs.withColumn(_row(docs), F.sha2(F.concat(*parts), 256))


def _rows_of(docs: DataFrame, names: DataFrame) -> DataFrame:
    """The rows that ``names`` holds the name of, equal ones once. Map tasks combine equal rows before they meet."""
    row = _row(docs)
    once = _named(docs).groupBy(row).agg(*[F.first(c).alias(c) for c in docs.columns])
    return once.join(names.select(row), row, "left_semi").select(*docs.columns)


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that are probably of the best grade, see :func:`classifier.select` for NULL and empty texts."""
    model = classifier.train(docs, classifier.grade_labels(table(spark, sf_dir, "labels")), 3)
    return classifier.select(docs, model)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep exactly one row of each exact text.

    Of the rows with the id that stays, that is the one with the most code points, then the least digest of
    all columns; of rows equal in all columns, any. Repeated ids and NULL ids do not let copies through.
    """
    kept = exact_dedup.exact_dedup(docs).where("kept").select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha")).distinct()
    keyed = _named(docs).select("doc_id", F.sha2(exact_dedup.without_space(), 256).alias("_own"), F.col(_row(docs)).alias("_name"), F.length("text").alias("_chars"))
    best = keyed.groupBy("doc_id", "_own").agg(F.min(F.struct(-F.coalesce("_chars", F.lit(0)), "_name")).alias("_best"))
    winners = best.join(kept, _same(F.col("doc_id"), F.col("_id")) & (F.col("_own") == F.col("_sha")), "left_semi")
    return _rows_of(docs, winners.select(F.col("_best._name").alias(_row(docs))))


def join_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep exactly one row of each near-duplicate group: sets of five-word shingles with a similarity of 0.8 or more.

    That is the row with the least id, NULL after all others, then the least digest of all columns; of rows
    equal in all columns, any. A text without words is near to nothing: only rows equal to it go.
    """
    return _rows_of(docs, ngram_join.survivors(_named(docs), _row(docs), size=NEAR_WORDS, percent=NEAR_PERCENT))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep a sample whose token weights follow the targets; texts without words go, as :func:`mixing.sample` says."""
    return mixing.kept(docs, mixing.plan(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the token ids of each document and of what they decode to; NULL and empty texts have none."""
    import public_tokenizers

    return byte_bpe.round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality classifier", classify),
    ("exact dedup", deduplicate),
    ("n-gram Jaccard join", join_near),
    ("mixing sources", mix),
    ("byte-level BPE", encode),
]
#: Iterative fitting and BPE cannot be said in SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = pin(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
