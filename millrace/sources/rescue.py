"""JSON lines to typed columns without losing what does not fit."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

RESCUED = "_rescued_data"


def rescue_json(lines: DataFrame, schema: StructType | str, column: str = "value") -> DataFrame:
    """Columns of ``schema`` plus ``_rescued_data``.

    A value that does not fit its type is NULL and kept, as text, in a JSON
    object under its name; so are fields the schema does not know.  A line
    that is no JSON object is kept whole.  Rows with nothing to rescue have NULL.
    """
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    names = [f.name for f in schema.fields]
    others = [c for c in lines.columns if c != column]
    # a generated column: filters on the fields stay above it, so that a line is parsed once
    parsed = F.explode(F.array(F.from_json(column, "map<string,string>"))).alias("_m")
    raw = lines.select(*others, F.col(column).alias("_line"), parsed)

    def value(f):
        text = F.try_element_at("_m", F.lit(f.name))
        if f.dataType.typeName() in ("struct", "array", "map"):
            return F.from_json(text, f.dataType.simpleString())
        return text.try_cast(f.dataType)

    fields = F.explode(F.array(F.struct(*[value(f).alias(f"_v{i}") for i, f in enumerate(schema.fields)]))).alias("_f")
    typed = raw.select(*others, "_line", "_m", fields)
    # most lines have nothing to rescue: the entries are only walked when a field is unknown or misfits
    is_lost = [F.col(f"_f._v{i}").isNull() & F.try_element_at("_m", F.lit(n)).isNotNull() for i, n in enumerate(names)]
    known = sum((F.map_contains_key("_m", F.lit(n)).cast("int") for n in names), F.lit(0))
    misfit = F.array_compact(F.array(*[F.when(lost, n) for lost, n in zip(is_lost, names)]))
    some = (F.size("_m") > known) | reduce(lambda a, b: a | b, is_lost)
    lost = F.map_filter("_m", lambda k, v: ~k.isin(names) | F.array_contains(misfit, k))
    kept = F.when(F.col("_m").isNull(), F.col("_line")).when(some & (F.size(lost) > 0), F.to_json(lost))
    return typed.select(*others, *[F.col(f"_f._v{i}").alias(n) for i, n in enumerate(names)], kept.alias(RESCUED))
