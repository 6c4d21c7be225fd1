"""Fields of JSON records whose schema is their own, as Column expressions.

A record keeps its text (raw). Its map of field texts keeps number lexemes and tells an
absent key from an explicit null; its variant tells the JSON kind of a field.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def settled(df: DataFrame, **columns: Column) -> DataFrame:
    """df with further columns, each worked out once for a row.

    The optimizer puts a column's expression in place of its name wherever filters and
    other columns use it; a generator of one row stands in its way.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def opened(records: DataFrame) -> DataFrame:
    """records (ord, raw, ...) with _m and _v, what the functions here look at."""
    read = settled(records, _read=F.from_json("raw", "map<string,string>"), _v=F.try_parse_json("raw"))
    # of repeated keys the last one counts
    keys, entries = F.map_keys("_read"), F.map_entries("_read")
    single = F.map_from_arrays(F.array_distinct(keys), F.transform(F.array_distinct(keys), lambda k: F.element_at(F.filter(entries, lambda e: e["key"] == k), -1)["value"]))
    return settled(read, _m=F.when(F.size(F.array_distinct(keys)) < F.size(keys), single).otherwise(F.col("_read"))).drop("_read")


def text(key: str) -> Column:
    return F.try_element_at("_m", F.lit(key))


def has(key: str) -> Column:
    return F.coalesce(F.map_contains_key("_m", key), F.lit(False))


def kind(key: str) -> Column:
    """STRING, BIGINT, DECIMAL.., DOUBLE, BOOLEAN, ARRAY.., OBJECT.. or VOID; guessed from the text of a record with repeated keys."""
    told = F.schema_of_variant(F.try_variant_get("_v", f"$['{key}']", "variant"))
    value = text(key)
    guess = F.when(value.rlike(r"^\["), F.lit("ARRAY")).when(value.rlike(r"^\{"), F.lit("OBJECT")).when(value.isin("true", "false"), F.lit("BOOLEAN")).when(value.try_cast("double").isNotNull(), F.lit("DOUBLE")).otherwise(F.lit("STRING"))
    return F.when(value.isNull(), F.lit("VOID")).otherwise(F.coalesce(told, guess))


def missing(key: str, empty_list: bool = True) -> Column:
    """Absent, null, an empty string or (if empty_list) an empty list; 0 and false are there."""
    value = text(key)
    gone = value.isNull() | (value == "")
    return gone | ((value == "[]") & kind(key).startswith("ARRAY")) if empty_list else gone


def or_default(key: str, default: str | None) -> Column:
    """The field's text; the default only where the key is absent, not where it is null."""
    return F.when(has(key), text(key)).otherwise(F.lit(default))


def first_of(keys) -> Column:
    """struct(value, kind) of the first of the keys that isn't missing, or null."""
    return F.coalesce(*[F.when(~missing(k), F.struct(text(k).alias("value"), kind(k).alias("kind"))) for k in keys])


def listed(value: Column) -> Column:
    return F.from_json(value, "array<string>")
