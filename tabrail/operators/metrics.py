"""Aggregations (F1-F8) and last-N windows (H2-H4).

All whole-table metrics are single ``agg`` calls: partial aggregation runs
map-side and only one row per task crosses the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabrail.config import MONITOR_UNIT_FACTOR
from tabrail.operators.positions import rolling_last_n, with_position
from tabrail.operators.quantiles import exact_quantiles, number, probes, sketch
from tabrail.operators.split import last_n

QUANTILES = (0.25, 0.5, 0.75)


# --- F1 ---------------------------------------------------------------------

def row_counts(df: DataFrame, part: str = "part", train: str = "train") -> DataFrame:
    """total rows and rows per part, one row, one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col(part) == F.lit(train)).alias("train"),
        F.count_if(F.col(part) != F.lit(train)).alias("test"),
    )


# --- F2 ---------------------------------------------------------------------

def describe(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """per numeric column count, mean, sample std, min, quartiles with
    linear interpolation (as pandas ``describe``), max. Nulls and NaN are
    ignored, as pandas does.

    One scan for the statistics and a sketch of each column, one that counts
    the values around the sketched quartiles, one that brings the few values
    between them (see ``operators.quantiles``; more scans only beyond some
    ten million rows). No row is sorted, stored or shuffled.
    """
    spark = df.sparkSession
    cols = list(cols or [f.name for f in df.schema.fields
                         if f.dataType.typeName() in ("double", "float", "integer", "long", "short", "byte", "decimal")])
    aggs = []
    for i, c in enumerate(cols):
        x = number(c)
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"mean{i}"), F.stddev_samp(x).alias(f"std{i}"),
                 F.min(x).alias(f"min{i}"), F.max(x).alias(f"max{i}"), sketch(x, probes(QUANTILES)).alias(f"q{i}")]
    # One row reaches the driver.
    st = df.agg(*aggs).first() if cols else None
    counts = {c: st[f"n{i}"] for i, c in enumerate(cols)}
    quantiles = exact_quantiles(df, counts, QUANTILES, {c: st[f"q{i}"] for i, c in enumerate(cols)})
    rows = [(i, c, st[f"n{i}"], st[f"mean{i}"], st[f"std{i}"], st[f"min{i}"], *[quantiles[c][q] for q in QUANTILES], st[f"max{i}"])
            for i, c in enumerate(cols)]
    return spark.createDataFrame(
        rows,
        "position int, column string, count long, mean double, std double, min double, "
        "p25 double, p50 double, p75 double, max double",
    )


# --- F3-F6 ------------------------------------------------------------------

def _err(label: str, prediction: str) -> Column:
    return F.col(prediction) - F.col(label)


def rmse_col(label: str = "target", prediction: str = "prediction") -> Column:
    return F.sqrt(F.avg(F.pow(_err(label, prediction), 2)))


def mae_col(label: str = "target", prediction: str = "prediction") -> Column:
    return F.avg(F.abs(_err(label, prediction)))


def r2_col(label: str = "target", prediction: str = "prediction") -> Column:
    # All terms over the rows that have both values.
    both = _err(label, prediction).isNotNull()
    sse = F.sum(F.pow(_err(label, prediction), 2))
    sst = F.var_pop(F.when(both, F.col(label))) * F.count_if(both)
    return F.lit(1.0) - F.try_divide(sse, sst)


def rmse(df: DataFrame, label: str = "target", prediction: str = "prediction") -> DataFrame:
    """F3"""
    return df.agg(rmse_col(label, prediction).alias("rmse"))


def mae(df: DataFrame, label: str = "target", prediction: str = "prediction") -> DataFrame:
    """F4"""
    return df.agg(mae_col(label, prediction).alias("mae"))


def r2(df: DataFrame, label: str = "target", prediction: str = "prediction") -> DataFrame:
    """1 - SSE/SST; null when the label is constant (SST = 0)."""
    return df.agg(r2_col(label, prediction).alias("r2"))


def regression_report(df: DataFrame, label: str = "target", prediction: str = "prediction") -> DataFrame:
    """rmse, mae and r2 in one pass (three evaluator runs in the
    reference), plus the count of scored rows: those with both values."""
    return df.agg(
        rmse_col(label, prediction).alias("rmse"),
        mae_col(label, prediction).alias("mae"),
        r2_col(label, prediction).alias("r2"),
        F.count_if(_err(label, prediction).isNotNull()).alias("n"),
    )


def report_text(report: DataFrame) -> DataFrame:
    """The printed report lines, 4 decimals, rounded as Python prints."""
    from tabrail.functions.columns import round_half_even

    return report.select(
        F.format_string("RMSE: %.4f", round_half_even("rmse", 4)).alias("rmse_line"),
        F.format_string("MAE:  %.4f", round_half_even("mae", 4)).alias("mae_line"),
        F.format_string("R2:   %.4f", round_half_even("r2", 4)).alias("r2_line"),
    )


# --- monitor: units, last N, rolling ------------------------------------------

def monitor_units(df: DataFrame, actual: str = "actual_price", predicted: str = "predicted_price",
                  error: str = "error") -> DataFrame:
    """$100,000 -> $1,000 for actual and predicted, |error| in $1,000."""
    f = F.lit(MONITOR_UNIT_FACTOR)
    return df.withColumns({
        "actual_k": F.col(actual) * f,
        "predicted_k": F.col(predicted) * f,
        "abs_error_k": F.abs(F.col(error)) * f,
    })


def monitor_series(results: DataFrame, n: int, order: str = "id") -> DataFrame:
    """H4 (with H2): chart rows for the newest ``n`` results: index 0..k-1
    in arrival order, actual / predicted / abs error in $1,000.

    ``last_n`` is a top-k: at most ``n`` rows reach the numbering window.
    """
    newest = last_n(results, n, order)
    idx = F.row_number().over(Window.orderBy(order)) - F.lit(1)
    return monitor_units(newest).select(
        idx.cast("long").alias("sample_index"),
        F.col(order),
        "actual_k", "predicted_k", "abs_error_k",
    )


def live_metrics(results: DataFrame, n: int, order: str = "id") -> DataFrame:
    """MAE and RMSE of |error| in $1,000 over the newest ``n`` results
    and the sample count; no row when there are no results."""
    newest = monitor_units(last_n(results, n, order))
    return newest.agg(*live_metrics_cols()).where(F.col("samples") > 0)


def live_metrics_cols() -> list[Column]:
    """The aggregates of F7 over rows in monitor units."""
    return [
        F.avg("abs_error_k").alias("mae_k"),
        F.sqrt(F.avg(F.pow("abs_error_k", 2))).alias("rmse_k"),
        F.count(F.lit(1)).alias("samples"),
    ]


def rolling_metrics(results: DataFrame, n: int, order: str = "id", block_rows: int = 1 << 20) -> DataFrame:
    """H3: the monitor's MAE / RMSE / sample count as of every arrival."""
    ranked = with_position(monitor_units(results), [order], name="_tr_seq")
    out = rolling_last_n(
        ranked,
        "_tr_seq",
        n,
        {
            "mae_k": F.avg("abs_error_k"),
            "_tr_ms": F.avg(F.pow("abs_error_k", 2)),
            "samples": F.count(F.lit(1)),
        },
        block_rows=block_rows,
    )
    return out.select(order, "mae_k", F.sqrt("_tr_ms").alias("rmse_k"), F.col("samples").cast("long"))
