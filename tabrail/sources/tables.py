"""Batch sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabrail.operators.split import head_n


def read_table(
    spark: SparkSession,
    path: str,
    header: bool = True,
    schema: T.StructType | str | None = None,
    fmt: str = "csv",
    errors: str = "fail",
) -> DataFrame:
    """A1: CSV (or any file format) with header. Without ``schema`` the
    types are inferred, which costs one extra pass over the files; give a
    schema at scale. A line that does not fit the schema (text in a number,
    too few or too many fields) ends the job (``errors="fail"``), is left out
    (``"drop"``), or keeps its fields that do fit, the others null, with its
    text in the column ``_corrupt_record`` (``"keep"``)."""
    modes = {"fail": "FAILFAST", "drop": "DROPMALFORMED", "keep": "PERMISSIVE"}
    if errors not in modes:
        raise ValueError(f"errors must be one of {sorted(modes)}")
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", header).option("mode", modes[errors])
        if schema is not None and errors == "keep":
            known = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
            schema = T.StructType([*known.fields, T.StructField("_corrupt_record", T.StringType())])
            reader = reader.option("columnNameOfCorruptRecord", "_corrupt_record")
        reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    elif schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def bad_lines(spark: SparkSession, path: str, schema: T.StructType | str, header: bool = True) -> DataFrame:
    """A1: the lines of a CSV table that do not fit the schema."""
    rows = read_table(spark, path, header, schema, errors="keep")
    return rows.where("_corrupt_record is not null").select(*rows.columns[:-1], F.col("_corrupt_record").alias("line"))


def feature_table(df: DataFrame, features: Sequence[str], label_expr, label: str = "target") -> DataFrame:
    """A2: labelled feature frame: features as double, then the label."""
    return df.select(*[F.col(c).cast("double").alias(c) for c in features],
                     F.col(label_expr).cast("double").alias(label) if isinstance(label_expr, str)
                     else label_expr.cast("double").alias(label))


def replay_scan(df: DataFrame, n: int | None, order: Sequence[str] = ("id",)) -> DataFrame:
    """A4: the replay table's first ``n`` rows in its order (None/0 = all)."""
    return head_n(df, n, list(order))


def frame_from_fields(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """A5 at scale: every feature cast to double (text, int, double in)."""
    return df.select(*keep, *[F.col(c).cast("double").alias(c) for c in features])


def rows_to_frame(
    spark: SparkSession,
    rows: Sequence[dict],
    features: Sequence[str],
    with_index: bool = False,
) -> DataFrame:
    """A5 at the API edge: list of dicts -> feature frame, values through
    Python ``float`` as the reference does (missing key -> KeyError)."""
    fields = ([T.StructField("_tr_idx", T.LongType(), False)] if with_index else []) + [
        T.StructField(c, T.DoubleType(), True) for c in features
    ]
    data = [
        ([i] if with_index else []) + [float(r[c]) for c in features]
        for i, r in enumerate(rows)
    ]
    return spark.createDataFrame(data, T.StructType(fields))


def result_schema(id_type: T.DataType = T.LongType()) -> T.StructType:
    """The scored-result record: id, actual, predicted, error, error %."""
    return T.StructType([
        T.StructField("id", id_type, True),
        T.StructField("actual_price", T.DoubleType(), True),
        T.StructField("predicted_price", T.DoubleType(), True),
        T.StructField("error", T.DoubleType(), True),
        T.StructField("error_percentage", T.DoubleType(), True),
    ])


def read_results(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A6 (batch): read a finished result sink of JSON ``value`` lines."""
    schema = schema or result_schema()
    return (
        spark.read.text(path)
        .select(F.from_json("value", schema).alias("r"))
        .select("r.*")
    )
