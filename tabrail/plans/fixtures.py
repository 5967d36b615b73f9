"""Frames bound to the driver's tables (TESTDATA).

``charge``   lineitem x part x orders: 8 numeric features and a computed
             label in $100,000 (the reference's unit).
``ticks``    events as a scored result stream: id, actual and a stand-in
             prediction.
``requests`` scoring requests as JSON text built from lineitem, with
             absent fields, JSON nulls and text in numeric fields.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabrail.config import Settings

CHARGE_FEATURES = (
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_linenumber",
    "p_size",
    "p_retailprice",
    "o_totalprice",
)
# Low-cardinality features (50, 11 and 9 distinct values) for the exactly
# checkable single-split tree.
STUMP_FEATURES = ("l_quantity", "l_discount", "l_tax")

CHARGE = Settings(features=CHARGE_FEATURES, label="target", key=("row_key",))
STUMP = CHARGE.with_(features=STUMP_FEATURES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def row_key(*cols: str) -> Column:
    """Text key of integer columns joined by ':' (same text in DuckDB)."""
    return F.concat_ws(":", *[F.col(c).cast("bigint").cast("string") for c in cols])


def charge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem joined to part and orders; one row per lineitem row.

    Neither side is hinted: the planner broadcasts ``part``/``orders`` only
    while their estimated size stays under ``autoBroadcastJoinThreshold``
    and falls back to a sort-merge join beyond it.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    )
    part = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    joined = li.join(part, li.l_partkey == part.p_partkey).join(
        orders, li.l_orderkey == orders.o_orderkey
    )
    price = F.col("l_extendedprice")
    target = price * (F.lit(1) - F.col("l_discount")) * (F.lit(1) + F.col("l_tax")) / F.lit(100000)
    return joined.select(
        row_key("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity").alias("row_key"),
        *[F.col(c).cast("double").alias(c) for c in CHARGE_FEATURES],
        target.alias("target"),
    )


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as a result stream: id = event_id (increases with ts)."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "value", "props")
    k = F.get_json_object("props", "$.k").cast("int")
    return ev.select(
        F.col("event_id").alias("id"),
        "ts",
        k.alias("k"),
        F.col("value").alias("actual_price"),
        (F.lit(40.0) + k / F.lit(5)).alias("prediction"),
    )


def _json_number(c: str) -> Column:
    return F.col(c).cast("string")


def requests(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    """(request_id, body) with injected faults keyed on l_orderkey, from
    ``rows`` where a query has stored ``charge`` already:

    every 97th order omits ``l_tax``; every 101st sends ``l_discount`` as the
    text "n/a"; every 89th sends ``l_quantity`` as JSON null. Other rows carry
    all 8 features as JSON numbers; zero discounts and taxes occur naturally.
    """
    c = (charge(spark, sf_dir) if rows is None else rows).withColumn(
        "_ok", F.split("row_key", ":").getItem(0).cast("bigint")
    )
    parts = []
    for i, name in enumerate(CHARGE_FEATURES):
        sep = "" if i == 0 else ","
        value = _json_number(name)
        if name == "l_discount":
            value = F.when(F.col("_ok") % 101 == 0, F.lit('"n/a"')).otherwise(value)
        if name == "l_quantity":
            value = F.when(F.col("_ok") % 89 == 0, F.lit("null")).otherwise(value)
        field = F.concat(F.lit(f'{sep}"{name}":'), value)
        if name == "l_tax":
            field = F.when(F.col("_ok") % 97 == 0, F.lit("")).otherwise(field)
        parts.append(field)
    body = F.concat(F.lit("{"), *parts, F.lit("}"))
    return c.select(F.col("row_key").alias("request_id"), body.alias("body"))


def mixed_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(request_id, content_type, body) of several kinds, by l_orderkey mod 5:
    0 form fields; 1 JSON with text behind the object; 2 form fields with
    ``+``, ``%XX`` and a repeated name; 3 JSON sent as plain text; 4 JSON."""
    c = charge(spark, sf_dir).withColumn("_k", F.split("row_key", ":").getItem(0).cast("bigint") % 5)
    form = F.concat_ws("&", *[F.concat(F.lit(f"{n}="), _json_number(n)) for n in CHARGE_FEATURES])
    odd = F.concat(F.replace(F.replace(form, F.lit("l_quantity="), F.lit("l_quantity=+")), F.lit("."), F.lit("%2E")), F.lit("&l_tax=9"))
    json = F.concat(F.lit("{"), F.concat_ws(",", *[F.concat(F.lit(f'"{n}":'), _json_number(n)) for n in CHARGE_FEATURES]), F.lit("}"))
    k = F.col("_k")
    body = F.when(k == 0, form).when(k == 1, F.concat(json, F.lit(' {"l_tax":1}'))).when(k == 2, odd).otherwise(json)
    kind = (F.when(k.isin(0, 2), F.lit("application/x-www-form-urlencoded; charset=utf-8"))
            .when(k == 3, F.lit("text/plain")).otherwise(F.lit("application/json")))
    return c.select(F.col("row_key").alias("request_id"), kind.alias("content_type"), body.alias("body"))
