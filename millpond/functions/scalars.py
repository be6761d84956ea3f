"""Column expressions: safe casts, dates, JSON fields, bands and lookups. All JVM-side."""

from __future__ import annotations

from collections.abc import Mapping

import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(value: Column | str) -> Column:
    """A text is a SQL expression; a Column stays as it is."""
    return F.expr(value) if isinstance(value, str) else value


def parse_amount(text: Column) -> Column:
    """'12,500.00' -> 12500.0; NULL where the text is not a number."""
    return F.regexp_replace(text, ",", "").try_cast("double")


def parse_date(text: Column, pattern: str) -> Column:
    """Date by pattern; NULL where the text does not fit, also under ANSI."""
    return F.try_to_timestamp(text, F.lit(pattern)).cast("date")


def parse_timestamp(text: Column) -> Column:
    """ISO timestamp; NULL where the text does not fit, also under ANSI."""
    return F.try_to_timestamp(text)


def json_field(payload: Column, path: str, type_name: str = "string") -> Column:
    """One JSON path as a typed value; NULL when missing or badly typed."""
    value = F.get_json_object(payload, path)
    return value if type_name == "string" else value.try_cast(type_name)


def band(value: Column, steps: list[tuple[float, str]], otherwise: str) -> Column:
    """Label of the first lower bound that ``value`` reaches, highest bound first."""
    label = F.lit(otherwise)
    for bound, name in sorted(steps):
        label = F.when(value >= F.lit(bound), F.lit(name)).otherwise(label)
    return label


def lookup(key: Column, mapping: Mapping[str, str], default: str) -> Column:
    """Dictionary lookup inside generated code."""
    pairs = [F.lit(part) for item in mapping.items() for part in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), F.lit(default))


def lookup_udf(mapping: Broadcast, default: str):
    """The same lookup as a Python function over a broadcast dictionary, Arrow-batched."""

    @F.pandas_udf("string")
    def find(keys: pd.Series) -> pd.Series:
        return keys.map(mapping.value).fillna(default)

    return find
