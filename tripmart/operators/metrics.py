"""Bronze metrics: row counts, NULL shares and per-check pass rates in ONE pass.

Every metric of a run is an aggregate expression over the flagged frame. They are
evaluated together by a single ``agg`` (partial aggregation per task, one tiny final
merge), which turns into a one-row frame; ``inline`` then unpivots that row into the
long metric table. The same expressions can also ride along a write through
``DataFrame.observe`` (see ``plans.jobs``), so the facts are scanned only once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart import schemas as S
from tripmart.functions.checks import quoted, zone_null_like
from tripmart.functions.logic import and_all, count_true
from tripmart.operators.bronze import check_columns, domain_check_columns

PARTS = ("counts", "nulls", "checks", "domain_range")

_TOTAL = "n__total"


def now_utc() -> datetime:
    """One run timestamp, taken once and used as a literal by every output of a run."""
    return datetime.now(timezone.utc)


def _ts(run_ts: datetime | None) -> Column:
    return F.lit(run_ts if run_ts is not None else now_utc()).cast("timestamp")


def _null_col(name: str) -> str:
    return f"n__null__{name}"


def _pass_col(name: str) -> str:
    return f"n__pass__{name}"


def _fail_col(name: str) -> str:
    return f"n__fail__{name}"


def _share(part: Column, total: Column) -> Column:
    """part / total as double; NULL for an empty table."""
    return F.when(total > 0, part / total)


def _spec_columns(df: DataFrame) -> list[str]:
    """Expected trip columns present in the frame (case-sensitive)."""
    return [c for c, _ in S.TRIP_SPEC if c in df.columns]


def _null_like_sql(name: str, dtype: T.DataType) -> str:
    c = quoted(name)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return f"{c} IS NULL OR isnan({c})"
    if isinstance(dtype, T.StringType):
        return f"{c} IS NULL OR length(trim({c})) = 0"
    return f"{c} IS NULL"


def _and_sql(names: Sequence[str]) -> str:
    return "(" + " AND ".join(quoted(n) for n in names) + ")" if names else "TRUE"


def trip_metric_aggregates(flagged: DataFrame, parts: Sequence[str] = PARTS) -> dict[str, Column]:
    """Aggregate expressions (by output name) for the requested metric parts.

    Null-likeness: NaN counts as NULL for float columns, blank text for strings.
    """
    checks = check_columns(flagged)
    sql: dict[str, str] = {_TOTAL: "count(1)"}
    if "counts" in parts:
        verdict = quoted(S.DQ_PASS) if S.DQ_PASS in flagged.columns else _and_sql(checks)
        sql[_pass_col("rows")] = f"count_if({verdict})"
        sql[_null_col("rows")] = f"count_if({verdict} IS NULL)"
    if "nulls" in parts:
        for c in _spec_columns(flagged):
            sql[_null_col(c)] = f"count_if({_null_like_sql(c, flagged.schema[c].dataType)})"
    if "checks" in parts:
        for c in checks:
            sql[_pass_col(c)] = f"count_if({quoted(c)})"
            sql[_fail_col(c)] = f"count_if(NOT {quoted(c)})"
    if "domain_range" in parts:
        sql[_pass_col("domain_range_all")] = f"count_if({_and_sql(domain_check_columns(flagged))})"
    return {name: F.expr(e) for name, e in sql.items()}


def named(aggs: dict[str, Column]) -> list[Column]:
    return [c.alias(n) for n, c in aggs.items()]


def _text(value: str) -> str:
    """SQL literal of a text."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _sql_rate(p: str, total: str) -> str:
    """Pass rate text, ``%.6f``; 1.0 when nothing was decided."""
    return (f"format_string('{S.PASS_RATE_FORMAT}', "
            f"CASE WHEN {total} = 0 THEN 1.0D ELSE {p} / {total} END)")


def _sql_row(metric: str, value: str = "NULL", p: str = "NULL", f: str = "NULL",
             rate: str = "NULL", category: str = "") -> str:
    return (f"{_text(metric)}, CAST({value} AS STRING), CAST({p} AS BIGINT), CAST({f} AS BIGINT), "
            f"CAST({rate} AS STRING), '{category}'")


def trip_metric_rows(totals: DataFrame, flagged_columns: Sequence[str],
                     parts: Sequence[str] = PARTS, run_ts: datetime | None = None) -> DataFrame:
    """Unpivot the one-row aggregate frame into the unified long metric table.

    ``flagged_columns`` are the columns of the flagged frame the totals came from.
    The unpivot is one ``stack`` expression. Output schema: ``schemas.METRIC_SCHEMA``.
    """
    total = quoted(_TOTAL)
    checks = [c for c in flagged_columns if c.startswith(S.CHECK_PREFIX)]
    rows: list[str] = []
    if "counts" in parts:
        passed, undecided = quoted(_pass_col("rows")), quoted(_null_col("rows"))
        rows += [
            _sql_row("row_count_total", total, category="counts"),
            _sql_row("row_count_pass", passed, category="counts"),
            _sql_row("row_count_reject", f"{total} - {passed}", category="counts"),
            _sql_row("row_count_indeterminate", undecided, category="counts"),
        ]
    if "nulls" in parts:
        for c in [c for c, _ in S.TRIP_SPEC if c in flagged_columns]:
            share = f"CASE WHEN {total} > 0 THEN {quoted(_null_col(c))} / {total} END"
            rows.append(_sql_row(f"null_pct_{c}", share, category="nulls"))
    if "checks" in parts:
        for c in checks:
            p, f = quoted(_pass_col(c)), quoted(_fail_col(c))
            category = "type" if c.endswith(S.TYPE_CHECK_SUFFIX) else "domain_range"
            rows.append(_sql_row(c, "NULL", p, f, _sql_rate(p, f"({p} + {f})"), category))
    if "domain_range" in parts:
        p = quoted(_pass_col("domain_range_all"))
        rows.append(_sql_row("domain_range_all", "NULL", p, f"{total} - {p}",
                             _sql_rate(p, total), "domain_range"))
    if not rows:
        return totals.sparkSession.createDataFrame([], S.METRIC_SCHEMA)
    names = ", ".join(f.name for f in S.METRIC_SCHEMA.fields if f.name != "run_ts")
    stacked = totals.selectExpr(f"stack({len(rows)}, {', '.join(rows)}) AS ({names})")
    return stacked.withColumn("run_ts", _ts(run_ts))


def trip_metrics(flagged: DataFrame, parts: Sequence[str] = PARTS,
                 run_ts: datetime | None = None) -> DataFrame:
    """All requested bronze trip metrics from one aggregate over the flagged trips."""
    totals = flagged.agg(*named(trip_metric_aggregates(flagged, parts)))
    return trip_metric_rows(totals, flagged.columns, parts, run_ts)


# ---------------------------------------------------------------------------
# Metrics across runs: counts as a state that adds up
# ---------------------------------------------------------------------------

STATE_SCHEMA = T.StructType([T.StructField("run_id", T.StringType()), T.StructField("name", T.StringType()),
                             T.StructField("n", T.LongType())])


def state_of(spark: SparkSession, run_id: str, aggs: Iterable[str], values: dict) -> DataFrame:
    """One run's counts as (run_id, name, n) rows: some 100 a run, whatever its size."""
    return spark.createDataFrame([(run_id, name, int(values.get(name) or 0)) for name in aggs], STATE_SCHEMA)


def merged_metrics(state: DataFrame, parts: Sequence[str] = PARTS, run_ts: datetime | None = None) -> DataFrame:
    """The long metric table of all runs together: counts add up, shares and rates follow from the sums.

    A column or check that only some runs had counts as absent from the others' rows, so its share is of all rows and its rate of
    the rows that decided it. A run id that occurs again (a replayed batch) replaces its earlier rows' counts: they are equal.
    """
    once = state.groupBy("run_id", "name").agg(F.max("n").alias("n"))
    names = sorted(r.name for r in once.select("name").distinct().collect())  # as many as there are metrics
    if not names:
        return state.sparkSession.createDataFrame([], S.METRIC_SCHEMA)
    totals = once.agg(*[F.coalesce(F.sum(F.when(F.col("name") == n, F.col("n"))), F.lit(0)).alias(n) for n in names])
    checks = [n.removeprefix(_pass_col("")) for n in names if n.startswith(_pass_col(S.CHECK_PREFIX))]
    columns = [c for c, _ in S.TRIP_SPEC if _null_col(c) in names]
    return trip_metric_rows(totals, [*columns, *checks], parts, run_ts)


# ---------------------------------------------------------------------------
# (metric, value, run_ts) tables: zone summary and plain NULL percentages
# ---------------------------------------------------------------------------

def empty_metrics(spark) -> DataFrame:
    """Typed, empty ``(metric, value, run_ts)`` frame."""
    return spark.createDataFrame([], S.SIMPLE_METRIC_SCHEMA)


def _simple_rows(agg_frame: DataFrame, rows: list[tuple[str, Column]],
                 run_ts: datetime | None) -> DataFrame:
    structs = [F.struct(F.lit(m).alias("metric"), v.cast("string").alias("value"))
               for m, v in rows]
    return agg_frame.select(F.inline(F.array(*structs))).withColumn("run_ts", _ts(run_ts))


def check_summary(checked: DataFrame, run_ts: datetime | None = None) -> DataFrame:
    """Total / pass / reject counts of a flagged frame (only the total if it has no flag).

    ``reject`` is total minus pass, so it also holds rows whose verdict is NULL.
    """
    checks = check_columns(checked)
    total = F.count(F.lit(1)).alias(_TOTAL)
    if not checks:
        return _simple_rows(checked.agg(total), [("row_count_total", F.col(_TOTAL))], run_ts)
    passed = count_true(and_all(F.col(c) for c in checks)).alias("n__pass")
    agg = checked.agg(total, passed)
    return _simple_rows(agg, [
        ("row_count_total", F.col(_TOTAL)),
        ("row_count_pass", F.col("n__pass")),
        ("row_count_reject", F.col(_TOTAL) - F.col("n__pass")),
    ], run_ts)


def null_percentages(df: DataFrame, columns: Iterable[str],
                     null_like: Callable[[Column, T.DataType], Column] = zone_null_like,
                     run_ts: datetime | None = None) -> DataFrame:
    """``null_pct_<col>`` for each present column, all from one aggregate."""
    present = [c for c in columns if c in df.columns]
    if not present:
        return empty_metrics(df.sparkSession)
    aggs = [F.count(F.lit(1)).alias(_TOTAL)]
    aggs += [F.count_if(null_like(F.col(c), df.schema[c].dataType)).alias(_null_col(c))
             for c in present]
    agg = df.agg(*aggs)
    return _simple_rows(agg, [(f"null_pct_{c}", _share(F.col(_null_col(c)), F.col(_TOTAL)))
                              for c in present], run_ts)


def zone_metrics(checked: DataFrame, run_ts: datetime | None = None) -> tuple[DataFrame, DataFrame]:
    """Zone job metrics: (check summary, NULL percentages of the four columns)."""
    return (check_summary(checked, run_ts),
            null_percentages(checked, S.ZONE_COLUMNS, zone_null_like, run_ts))


def unify(df: DataFrame, default_category: str) -> DataFrame:
    """Bring any metric frame to ``METRIC_SCHEMA``: typed NULLs for missing columns,
    ``default_category`` where the category is missing or blank, canonical order."""
    cols = []
    for field in S.METRIC_SCHEMA.fields:
        if field.name == "category":
            cat = F.col("category") if "category" in df.columns else F.lit(None)
            cols.append(F.when(cat.isNull() | (F.length(F.trim(cat)) == 0),
                               F.lit(default_category)).otherwise(cat).alias("category"))
        elif field.name in df.columns:
            cols.append(F.col(field.name).cast(field.dataType).alias(field.name))
        else:
            cols.append(F.lit(None).cast(field.dataType).alias(field.name))
    return df.select(*cols)
