"""Overviews, samples and layer comparison.

Layer comparison is made of distributed counts; no data row passes through the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart import schemas as S
from tripmart.functions.checks import quoted


def silver_overview(curated: DataFrame) -> DataFrame:
    """Rows, revenue, miles, mean distance and minutes, peak and night shares
    (a NULL flag counts as 0)."""
    return curated.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum("total_amount").alias("total_revenue"),
        F.sum("trip_distance").alias("total_miles"),
        F.avg("trip_distance").alias("avg_trip_distance"),
        F.avg("trip_minutes").alias("avg_trip_minutes"),
        F.avg(F.when(F.col("is_peak_hour"), 1).otherwise(0)).alias("peak_hour_pct"),
        F.avg(F.when(F.col("is_night"), 1).otherwise(0)).alias("night_trip_pct"),
    )


def silver_sample(curated: DataFrame, n: int = S.SAMPLE_ROWS) -> DataFrame:
    """First ``n`` trips by pick-up time (ties: ride id)."""
    return curated.orderBy("pickup_datetime", "ride_id").limit(n)


def weekly_summary_sorted(weekly: DataFrame) -> DataFrame:
    """Weekly summary in week-start order."""
    return weekly.orderBy("pickup_week_start", "pickup_week_id")


def layer_sample(df: DataFrame, order: Sequence[str], n: int = S.LAYER_SAMPLE_ROWS,
                 columns: Sequence[str] | None = None) -> DataFrame:
    """The first ``n`` rows of a layer in ``order`` (which should be total), optionally only some
    columns: the same rows on every run."""
    rows = df.orderBy(*order).limit(n)
    return rows.select(*columns) if columns else rows


def layer_row_counts(layers: Mapping[str, DataFrame]) -> DataFrame:
    """(layer, rows) for each named layer; each count is a distributed aggregate."""
    frames = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("layer"), "rows")
              for name, df in layers.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def layer_row_delta(before: DataFrame, after: DataFrame,
                    before_name: str = "before", after_name: str = "after") -> DataFrame:
    """Row counts of two layers and their difference (after - before)."""
    one, zero = F.lit(1), F.lit(0)
    both = (before.select(one.alias("b"), zero.alias("a"))
            .unionByName(after.select(zero.alias("b"), one.alias("a"))))
    return both.agg(F.coalesce(F.sum("b"), zero).cast("bigint").alias("rows_before"),
                    F.coalesce(F.sum("a"), zero).cast("bigint").alias("rows_after")).select(
        F.lit(before_name).alias("layer_before"), F.lit(after_name).alias("layer_after"),
        "rows_before", "rows_after",
        (F.col("rows_after") - F.col("rows_before")).alias("row_delta"))


def layer_schema(df: DataFrame) -> DataFrame:
    """(position, column, type, filled): a layer's columns and how many of its rows have a value,
    from one aggregate over the layer."""
    fields = df.schema.fields
    counts = df.agg(*[F.count(F.col(quoted(f.name))).alias(f"n{i}") for i, f in enumerate(fields)])
    rows = [F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column"),
                     F.lit(f.dataType.simpleString()).alias("type"), F.col(f"n{i}").alias("filled"))
            for i, f in enumerate(fields)]
    return counts.select(F.inline(F.array(*rows)))


def layer_column_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """(change, column, filled): columns ``added`` in ``after`` and ``removed`` from ``before``, with
    the rows of their layer that have a value."""
    new = [c for c in after.columns if c not in before.columns]
    old = [c for c in before.columns if c not in after.columns]
    parts = [layer_schema(df.select(*[F.col(quoted(c)) for c in names])).select(
                 F.lit(change).alias("change"), "column", "filled")
             for change, df, names in (("added", after, new), ("removed", before, old)) if names]
    if not parts:
        return layer_schema(before).select(F.lit("").alias("change"), "column", "filled").limit(0)
    return parts[0].unionByName(parts[1]) if len(parts) == 2 else parts[0]
