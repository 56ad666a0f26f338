"""Canonical text forms of nested values.

Maps cannot be sorted, grouped or de-duplicated in Spark and their text form
follows entry order, so anything that hashes or compares findings uses these
forms: map -> ``k=v;k=v`` with keys sorted, array -> sorted ``a,b``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def map_text(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    entries = F.array_sort(F.map_entries(c))
    return F.array_join(
        F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")


def array_text(c: Column | str, sep: str = ",") -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.array_join(F.array_sort(c), sep)


def flatten_for_compare(df: DataFrame) -> DataFrame:
    """Plain, order-free column types for comparison with a SQL oracle.

    timestamp -> timestamp_ntz (UTC wall clock), map -> sorted text,
    array -> sorted text, struct -> one ``<name>_<field>`` column per field.
    """
    out = []
    for f in df.schema.fields:
        out.extend(_flatten(F.col(f"`{f.name}`"), f.name, f.dataType))
    return df.select(*out)


def _flatten(c: Column, name: str, dt: T.DataType) -> list[Column]:
    if isinstance(dt, T.TimestampType):
        return [c.cast("timestamp_ntz").alias(name)]
    if isinstance(dt, T.MapType):
        return [map_text(c).alias(name)]
    if isinstance(dt, T.ArrayType):
        return [array_text(c.cast(T.ArrayType(T.StringType()))).alias(name)]
    if isinstance(dt, T.StructType):
        cols = []
        for sf in dt.fields:
            cols.extend(_flatten(c.getField(sf.name), f"{name}_{sf.name}", sf.dataType))
        return cols
    return [c.alias(name)]


JSON_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
                "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def json_text(c: Column) -> Column:
    """``to_json`` keeping microseconds (the default format keeps milliseconds)."""
    return F.to_json(c, JSON_OPTIONS)


def json_content(c: Column | str) -> Column:
    """A JSON object's top-level members as sorted ``name=value`` texts, numbers without
    exponents, so that two payloads compare by content."""
    c = F.col(c) if isinstance(c, str) else c

    def text(v: Column) -> Column:
        plain = F.rtrim(v.try_cast(T.DecimalType(38, 20)).cast("string"), F.lit("0"))
        return F.when(v.rlike(r"^-?[0-9]+\.[0-9]+E-[0-9]+$"), plain).otherwise(v)

    members = F.map_entries(F.from_json(c, "map<string,string>"))
    return F.array_join(F.array_sort(F.transform(
        F.filter(members, lambda e: e["value"].isNotNull()),
        lambda e: F.concat(e["key"], F.lit("="), text(e["value"])))), "||")
