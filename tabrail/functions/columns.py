"""Projections and scalar expressions (C1-C11): built-in Spark functions
only, so everything stays inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabrail.config import LABEL_UNIT_DOLLARS, MONITOR_UNIT_FACTOR


def feature_columns(df: DataFrame, label: str = "target", exclude: Sequence[str] = ()) -> list[str]:
    """All columns except the label (and ``exclude``), in order."""
    skip = {label, *exclude}
    return [c for c in df.columns if c not in skip]


def assemble_vector(df: DataFrame, features: Sequence[str], out: str = "features",
                    handle_invalid: str = "error") -> DataFrame:
    """Features -> one ML vector; null/NaN raises by default."""
    return VectorAssembler(inputCols=list(features), outputCol=out,
                           handleInvalid=handle_invalid).transform(df)


def vector_columns(df: DataFrame, vec: str, names: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Expose a vector's elements as named double columns."""
    arr = vector_to_array(F.col(vec))
    return df.select(*keep, *[arr[i].alias(n) for i, n in enumerate(names)])


def stream_record_schema(features: Sequence[str], id_type: T.DataType = T.LongType(),
                         actual: str = "actual_price") -> T.StructType:
    """The input stream record: id, features, actual price (all nullable)."""
    return T.StructType(
        [T.StructField("id", id_type, True)]
        + [T.StructField(c, T.DoubleType(), True) for c in features]
        + [T.StructField(actual, T.DoubleType(), True)]
    )


def json_decode(df: DataFrame, schema: T.StructType, value: str = "value",
                keep: Sequence[str] = ()) -> DataFrame:
    """binary/text -> struct by a fixed schema -> flat columns. Text
    that is not JSON gives all-null fields; a wrong-typed field is null."""
    # As the rows of a generator: a filter on the columns stays above it, where
    # one on a projection is pushed below and parses the text once a column.
    parsed = F.from_json(F.col(value).cast("string"), schema)
    return df.select(*keep, F.inline_outer(F.array(parsed)))


def json_encode(df: DataFrame, out: str = "value", keep: Sequence[str] = (),
                carry: Sequence[str] = ()) -> DataFrame:
    """C4: whole row -> one JSON text. Null fields are written as null
    (Spark would drop them, which breaks readers that expect every key).
    ``keep`` columns stay outside the JSON; ``carry`` columns are encoded
    and also kept alongside."""
    cols = [c for c in df.columns if c not in keep]
    return df.select(
        *keep, *carry,
        F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).alias(out),
    )


def replay_record(df: DataFrame, features: Sequence[str], label: str = "target",
                  id_col: str = "id") -> DataFrame:
    """Id, features as double, label renamed to actual_price."""
    return df.select(
        F.col(id_col).cast("long").alias("id"),
        *[F.col(c).cast("double").alias(c) for c in features],
        F.col(label).cast("double").alias("actual_price"),
    )


def prediction_error(df: DataFrame, id_col: str = "id", actual: str = "actual_price",
                     prediction: str = "prediction", keep: Sequence[str | Column] = ()) -> DataFrame:
    """error = prediction - actual; error % relative to actual, null
    when actual is 0 (the reference fails there under ANSI mode). ``keep``
    columns follow."""
    err = F.col(prediction) - F.col(actual)
    return df.select(
        F.col(id_col).alias("id"),
        F.col(actual).alias("actual_price"),
        F.col(prediction).alias("predicted_price"),
        err.alias("error"),
        (F.try_divide(err, F.col(actual)) * F.lit(100)).alias("error_percentage"),
        *keep,
    )


def unit_convert(df: DataFrame) -> DataFrame:
    """Monitor units ($1,000)."""
    f = F.lit(MONITOR_UNIT_FACTOR)
    return df.select(
        "id",
        (F.col("actual_price") * f).alias("actual_k"),
        (F.col("predicted_price") * f).alias("predicted_k"),
        (F.abs("error") * f).alias("abs_error_k"),
    )


def round_half_even(x: Column | str, digits: int) -> Column:
    """Python's ``round(x, d)`` (and ``'%.df'``): half-even on the exact
    binary value of the double. Spark's ``round`` and Java's ``%.2f`` round
    half-up on the shortest decimal text instead (2.675 -> 2.68, where
    Python gives 2.67; 528.125 -> 528.13, where Python gives 528.12).

    The exact value of x * 10^d is p + err (Dekker's exact product), so
    the side of the .5 boundary is decided without rounding error.
    """
    x = F.col(x) if isinstance(x, str) else x
    scale = F.lit(float(10 ** digits))
    p = x * scale
    c = x * F.lit(134217729.0)  # 2^27 + 1: split x into 26-bit halves
    hi = c - (c - x)
    lo = x - hi
    err = (hi * scale - p) + lo * scale
    n = F.floor(p).cast("double")
    frac = p - n
    odd = F.abs(F.pmod(n, F.lit(2.0))) == F.lit(1.0)
    up = (
        F.when(frac > 0.5, F.lit(1.0))
        .when(frac < 0.5, F.lit(0.0))
        .when(err > 0, F.lit(1.0))
        .when(err < 0, F.lit(0.0))
        .when(odd, F.lit(1.0))
        .otherwise(F.lit(0.0))
    )
    special = F.isnan(x) | (F.abs(x) == F.lit(float("inf"))) | (F.abs(p) >= F.lit(2.0 ** 52))
    return F.when(special, x).otherwise((n + up) / scale)


def price_format(price: Column | str) -> list[Column]:
    """Price in $100,000 -> rounded price, dollars and '$1,234.56',
    rounded as the reference's Python response does (half-even, exact)."""
    p = F.col(price) if isinstance(price, str) else price
    usd = p * F.lit(LABEL_UNIT_DOLLARS)
    return [
        round_half_even(p, 4).alias("predicted_price"),
        round_half_even(usd, 2).alias("predicted_price_usd"),
        F.concat(F.lit("$"), F.format_number(round_half_even(usd, 2), 2)).alias("formatted_price"),
    ]


# Fixed value: the monitor's console line (ids width 4, prices 6.2 in $K,
# error percent 6.2).
RESULT_LINE = "ID: %4d | Actual: $%6.2fK | Predicted: $%6.2fK | Error: %6.2f%%"


def result_line(df: DataFrame) -> DataFrame:
    """One padded text line per result."""
    f = F.lit(MONITOR_UNIT_FACTOR)
    return df.select(
        "id",
        F.format_string(
            RESULT_LINE, F.col("id"), round_half_even(F.col("actual_price") * f, 2),
            round_half_even(F.col("predicted_price") * f, 2), round_half_even("error_percentage", 2),
        ).alias("line"),
    )


def replay_progress_line(df: DataFrame, total: int, first_feature: str) -> DataFrame:
    """C10: 'sent record i/n' with the first feature and the price in $K.
    ``total`` is the replayed row count (one scalar from an aggregate)."""
    f = F.lit(MONITOR_UNIT_FACTOR)
    return df.select(
        "id",
        F.format_string(
            f"sent record %d/%d | {first_feature}=%.2f | actual price=$%.2fK",
            F.col("id") + F.lit(1), F.lit(int(total)), round_half_even(first_feature, 2),
            round_half_even(F.col("actual_price") * f, 2),
        ).alias("line"),
    )


def schema_report(spark: SparkSession, df: DataFrame, counts: bool = False) -> DataFrame:
    """C11: (position, column, type) of a frame's schema; with ``counts`` also
    the number of values of each column (one scan, one row to the driver)."""
    held = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(df.columns)]).first() if counts and df.columns else ()
    rows = [(i, f.name, f.dataType.simpleString(), *held[i:i + 1]) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "position int, column string, type string" + ", values long" * bool(counts))
