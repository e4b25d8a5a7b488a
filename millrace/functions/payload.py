"""Classification of payload text, and of places: as Python functions and natively."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# The marker that decides the class, in order of precedence.
PAYLOAD_CLASSES = {"price": "transaction", "duration": "engagement"}
NO_DATA, OTHER = "no_data", "other"

# Places by coast; anything else is Central.
COASTS = {
    "East Coast": ["New York", "Philadelphia"],
    "West Coast": ["Los Angeles", "San Diego"],
}
NO_COAST = "Central"


def classify_payload_native(payload: Column) -> Column:
    """The class as a column expression: what a job should use."""
    out = F.lit(OTHER)
    for marker, label in reversed(PAYLOAD_CLASSES.items()):
        out = F.when(payload.contains(marker), label).otherwise(out)
    return F.when(payload.isNull() | (payload == ""), NO_DATA).otherwise(out)


def payload_class(text: str | None) -> str:
    if not text:
        return NO_DATA
    return next((label for marker, label in PAYLOAD_CLASSES.items() if marker in text), OTHER)


def classify_payload_udf():
    """The same as a row function, sent to Python in Arrow batches."""
    return F.udf(payload_class, "string", useArrow=True)


def categorize_udf(groups: dict[str, list[str]] = COASTS, default: str = NO_COAST):
    """Label of the group that holds a value, as a vectorised function."""
    labels = {v: label for label, values in groups.items() for v in values}

    @F.pandas_udf("string")
    def categorize(values: pd.Series) -> pd.Series:
        return values.map(labels).fillna(default)

    return categorize


def categorize_native(values: Column, groups: dict[str, list[str]] = COASTS, default: str = NO_COAST) -> Column:
    out = F.lit(default)
    for label, members in groups.items():
        out = F.when(values.isin(members), label).otherwise(out)
    return out
