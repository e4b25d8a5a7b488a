"""The registered queries of this package, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table
from . import byte_bpe as b6
from . import classifier as c2
from . import collocations as c13
from . import exact_dedup as e4
from . import licenses as l8
from . import mixing as m3
from . import ngram_join as n9
from . import positional_index as p12
from . import quality_rules as q7
from . import recompression as r10
from . import suffix_dedup as s5
from . import token_files as t1
from . import whitening as w11

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn

    return keep


@register("op1_token_files")
def token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    return t1.checksums(t1.write_and_read(docs, public_tokenizers.path("word_bpe_49k.json"), 1))


@register("op2_quality_classifier")
def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c2.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op3_mixing")
def mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    mixed = m3.sample(docs, m3.plan(docs))
    named = {"_source": "source", "_lang": "lang", "_topic": "topic", "_n": "n_tokens", "_weight": "weight", "_probability": "probability", "_sampled": "sampled"}
    return mixed.select("doc_id", *[F.col(a).alias(b) for a, b in named.items()])


@register("op4_exact_dedup", e4.ORACLE)
def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return e4.exact_dedup(table(spark, sf_dir, "documents"))


@register("op5_suffix_dedup")
def suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return s5.remove_repeats(table(spark, sf_dir, "documents"), with_text=False)


@register("op6_byte_bpe")
def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    return b6.round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


@register("op7_quality_rules", q7.ORACLE)
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    led = q7.ledger(table(spark, sf_dir, "documents"))
    judged = q7.apply_policy(led, q7.mask_of(q7.POLICIES["v1"]), "_base")
    judged = q7.apply_policy(judged, q7.mask_of(q7.POLICIES["v2"]))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", (~F.col("_base")).alias("base_failed"), "kept", "fail_bits"
    )


@register("op8_license_scan", l8.oracle())
def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return l8.scan_licenses(table(spark, sf_dir, "documents"))


@register("op9_ngram_join")
def ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return n9.near_duplicates(table(spark, sf_dir, "documents"), size=4, percent=85)


@register("op10_substring_dedup")
def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r10.remove_repeats(table(spark, sf_dir, "documents"), with_text=False)


@register("op11_whitening")
def whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return w11.whiten_embeddings(table(spark, sf_dir, "embeddings"))


@register("op12_decontamination", p12.ORACLE)
def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p12.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op13_collocations", c13.ORACLE)
def collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c13.collocations(table(spark, sf_dir, "documents"))
