"""Registered queries: a callable, the survey rows it covers, and its SQL twin."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..session import table
from ..streaming.runner import sized_state, state_partitions


@dataclass(frozen=True)
class Query:
    name: str
    covers: tuple[str, ...]
    run: Callable[[SparkSession, str], DataFrame]
    oracle: str | None


REGISTRY: dict[str, Query] = {}


class Tables:
    """Attribute access to the parquet tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)


def query(name: str, covers: str, oracle: str | None = None, streaming: bool = False):
    """Register ``fn(t: Tables) -> DataFrame`` under ``name``.

    A ``streaming`` query runs its streams inside ``fn``; their state is sized
    to the tables."""

    def register(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            if not streaming:
                return fn(Tables(spark, sf_dir))
            with sized_state(spark, state_partitions(spark, sf_dir)):
                return fn(Tables(spark, sf_dir))

        if name in REGISTRY:
            raise ValueError(f"query {name!r} is registered twice")
        REGISTRY[name] = Query(name, tuple(covers.split()), run, oracle)
        return fn

    return register
