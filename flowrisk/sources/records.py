"""Flows from Python records and from JSON payloads."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from flowrisk.schema import FLOW_SCHEMA


def from_records(spark: SparkSession, data, schema: T.StructType = FLOW_SCHEMA) -> DataFrame:
    """A DataFrame as it is, or one record or a list of records under ``schema``.

    Only schema fields that some record holds become columns.
    """
    if isinstance(data, DataFrame):
        return data
    if isinstance(data, Mapping):
        data = [data]
    if not isinstance(data, list) or not all(isinstance(r, Mapping) for r in data):
        raise TypeError(f"expected a DataFrame, a record or a list of records, not {type(data)}")
    held = {name for record in data for name in record}
    fields = [f for f in schema.fields if f.name in held] if data else schema.fields

    def value(record, field):
        v = record.get(field.name)
        if v is not None and isinstance(field.dataType, T.DoubleType):
            return float(v)
        if v is not None and isinstance(field.dataType, T.LongType):
            return int(v)
        return v

    rows = [tuple(value(r, f) for f in fields) for r in data]
    return spark.createDataFrame(rows, T.StructType(fields))


def _parsed(df: DataFrame, payload: str) -> DataFrame:
    """``df`` with ``_parts``: the payload's elements as variants, NULL where it is rejected as a whole.

    The text is parsed once. An object with the key ``flows`` must hold an array there; a
    bare array is its elements, any other object is one element.
    """
    first = F.substring(F.ltrim(F.col(payload)), 1, 1)
    whole = F.col("_json")
    has_flows = F.try_variant_get(whole, "$.flows", "variant").isNotNull()  # also where it is JSON's null
    inner = F.try_variant_get(whole, "$.flows", "array<variant>")
    parts = (
        F.when(first == "[", F.try_variant_get(whole, "$", "array<variant>"))
        .when((first == "{") & has_flows, inner)
        .when((first == "{") & whole.isNotNull(), F.array(whole))
    )
    return df.withColumn("_json", F.try_parse_json(F.col(payload))).withColumn("_parts", parts)


def _is_object(part):
    return F.schema_of_variant(part).startswith("OBJECT")


def from_payloads(df: DataFrame, payload: str, schema: T.StructType = FLOW_SCHEMA) -> DataFrame:
    """Rows of JSON payloads: an object with ``flows``, a bare array or one object.

    Keeps the other columns and adds ``position``, the flow's place in its payload from
    0. Payloads that hold no list of flows, and elements that are no object, give no
    rows; `rejected_payloads` counts both. A field that doesn't fit its type is NULL.
    """
    others = [c for c in df.columns if c != payload]
    fields = [F.try_variant_get("_part", f"$.{f.name}", _variant_type(f.dataType)).cast(f.dataType).alias(f.name) for f in schema]
    return (
        _parsed(df, payload)
        # The outer form keeps the optimizer from parsing again just to test for empty arrays.
        .select(*others, F.posexplode_outer("_parts").alias("position", "_part"))
        .filter(F.col("_part").isNotNull() & _is_object(F.col("_part")))
        .select(*others, "position", *fields)
    )


def _variant_type(kind: T.DataType) -> str:
    return kind.simpleString()


def rejected_payloads(df: DataFrame, payload: str) -> DataFrame:
    """One row: payloads seen and rejected as a whole, elements seen and rejected of the others."""
    parsed = _parsed(df, payload)
    elements = F.coalesce(F.size("_parts"), F.lit(0))
    good = F.size(F.filter("_parts", lambda p: p.isNotNull() & _is_object(p)))
    return parsed.agg(
        F.count(F.lit(1)).alias("payloads"), F.count_if(F.col("_parts").isNull()).alias("rejected"),
        F.coalesce(F.sum(F.when(F.col("_parts").isNotNull(), elements)), F.lit(0)).alias("elements"),
        F.coalesce(F.sum(F.when(F.col("_parts").isNotNull(), elements - good)), F.lit(0)).alias("rejected_elements"))
