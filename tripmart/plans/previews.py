"""Reports over written layers: each function takes a layer's path and gives named frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripmart import schemas as S
from tripmart.operators import gold, inspect
from tripmart.sources import readers


def silver_preview(spark: SparkSession, silver_base: str) -> dict[str, DataFrame]:
    """Overview, first trips and weekly summary of a written silver layer; empty when it holds no row."""
    curated = readers.read_nonempty(spark, f"{silver_base}/{S.CURATED_DIR}")
    weekly = readers.read_nonempty(spark, f"{silver_base}/{S.WEEKLY_DIR}")
    if curated is None or weekly is None:
        return {}
    return {"overview": inspect.silver_overview(curated), "sample": inspect.silver_sample(curated),
            "weekly": inspect.weekly_summary_sorted(weekly)}


def gold_preview(spark: SparkSession, gold_path: str) -> dict[str, DataFrame]:
    """Overview, busiest week-boroughs and first KPI rows of written gold; empty when it holds no row.

    The week id is the partition column of written gold, so columns are put in KPI order first.
    """
    kpis = readers.read_nonempty(spark, gold_path)
    if kpis is None:
        return {}
    kpis = kpis.select(*S.KPI_ORDER)
    return {"overview": gold.kpi_overview(kpis), "top": gold.top_week_boroughs(kpis), "sample": gold.kpi_sample(kpis)}
