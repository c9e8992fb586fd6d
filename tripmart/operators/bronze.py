"""Bronze layer: normalise raw rows, flag them with data-quality checks, split them.

Every check is a boolean ``chk_*`` column found by name prefix; ``dq_pass`` is their
AND with SQL three-valued logic. A NULL ``dq_pass`` (a check over NULL and no failing
check) is neither pass nor reject: those rows form a third, *undecided* output so no
row is lost. All checks of a frame are added in one projection.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart import schemas as S
from tripmart.functions.checks import quoted, trip_domain_checks, trip_type_checks, zone_checks
from tripmart.functions.logic import and_all
from tripmart.functions.text import blank_to_null


def check_columns(df: DataFrame) -> list[str]:
    """Names of the data-quality flags of a frame, in column order."""
    return [c for c in df.columns if c.startswith(S.CHECK_PREFIX)]


def type_check_columns(df: DataFrame) -> list[str]:
    return [c for c in check_columns(df) if c.endswith(S.TYPE_CHECK_SUFFIX)]


def domain_check_columns(df: DataFrame) -> list[str]:
    return [c for c in check_columns(df) if not c.endswith(S.TYPE_CHECK_SUFFIX)]


def normalize_blanks(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Trim the given text columns and turn blanks into NULL; absent columns are skipped."""
    present = [c for c in columns if c in df.columns]
    if not present:
        return df
    return df.withColumns({c: blank_to_null(F.col(quoted(c))).cast("string") for c in present})


def _positional(df: DataFrame) -> tuple[DataFrame, dict[str, str], bool]:
    """Give columns whose names differ only by case unique names (by position).

    Spark resolves names case-insensitively, so ``airport_fee`` next to
    ``Airport_fee`` is ambiguous; renaming by position keeps both addressable.
    """
    names = df.columns
    if len({n.lower() for n in names}) == len(names):
        return df, {n: n for n in names}, False
    internal = [f"__col{i}" for i in range(len(names))]
    return df.toDF(*internal), dict(zip(names, internal)), True


def _add_checks(df: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    original = df.columns
    work, alias, renamed = _positional(df)
    dtypes = {n: work.schema[alias[n]].dataType for n in original}

    def ident(n: str) -> str:
        return quoted(alias[n])

    checks: list[tuple[str, Column]] = []
    if "type" in kinds:
        checks += trip_type_checks(original, ident)
    if "domain" in kinds:
        checks += trip_domain_checks(dtypes, ident)
    names = [n for n, _ in checks]
    keep = [n for n in original if n not in names]
    out = work.select(*[F.col(quoted(alias[n])) for n in keep], *[e.alias(n) for n, e in checks])
    if renamed:
        out = out.toDF(*keep, *names)
    return out


def add_type_checks(df: DataFrame) -> DataFrame:
    """Add the 20 ``chk_<col>_type_ok`` flags (NULL or castable to the expected type)."""
    return _add_checks(df, ("type",))


def add_domain_checks(df: DataFrame) -> DataFrame:
    """Add the 11 domain / range flags (enumerations, signs, time order, duration)."""
    return _add_checks(df, ("domain",))


def add_trip_checks(df: DataFrame) -> DataFrame:
    """Add the 20 type flags and the 11 domain / range flags in one projection."""
    return _add_checks(df, ("type", "domain"))


def with_dq_pass(df: DataFrame) -> DataFrame:
    """``dq_pass`` = AND of every ``chk_*`` column (TRUE when there is none)."""
    return df.withColumn(S.DQ_PASS, and_all(F.col(c) for c in check_columns(df)))


def dq_status(dq_pass: Column | None = None) -> Column:
    """``pass`` / ``reject`` / ``indeterminate`` label of a flagged row."""
    if dq_pass is None:
        dq_pass = F.col(S.DQ_PASS)
    return (F.when(dq_pass, F.lit("pass"))
            .when(~dq_pass, F.lit("reject"))
            .otherwise(F.lit("indeterminate")))


def clean_trips(raw: DataFrame) -> DataFrame:
    """Light normalisation of raw trips (blank store-and-forward flag -> NULL)."""
    work, alias, renamed = _positional(raw)
    present = [alias[c] for c in S.TRIP_BLANK_COLUMNS if c in alias]
    out = normalize_blanks(work, present)
    return out.toDF(*raw.columns) if renamed else out


def one_airport_fee(df: DataFrame) -> DataFrame:
    """Both spellings of the airport fee become one ``airport_fee``, the first that is not NULL;
    with one spelling or none the frame is unchanged."""
    names = df.columns
    if not {"airport_fee", "Airport_fee"} <= set(names):
        return df
    inner = [f"__col{i}" for i in range(len(names))]
    both = F.coalesce(inner[names.index("airport_fee")], inner[names.index("Airport_fee")])
    kept = [(i, n) for i, n in enumerate(names) if n != "Airport_fee"]
    return df.toDF(*inner).select(*[both.alias(n) if n == "airport_fee" else F.col(inner[i]).alias(n) for i, n in kept])


def flag_trips(raw: DataFrame) -> DataFrame:
    """Raw trips -> cleaned columns + 31 ``chk_*`` flags + ``dq_pass``.

    The checks see both airport-fee spellings; the result has one, so it can be written.
    """
    return with_dq_pass(one_airport_fee(add_trip_checks(clean_trips(raw))))


class Split(NamedTuple):
    passed: DataFrame
    rejects: DataFrame
    indeterminate: DataFrame


def split_flagged(flagged: DataFrame) -> Split:
    """Pass rows lose the flags; rejected and indeterminate rows keep them."""
    checks = check_columns(flagged)
    dq = F.col(S.DQ_PASS)
    return Split(
        passed=flagged.filter(dq).drop(S.DQ_PASS, *checks),
        rejects=flagged.filter(~dq),
        indeterminate=flagged.filter(dq.isNull()),
    )


def normalize_zones(raw: DataFrame) -> DataFrame:
    """Trim the four zone columns; blanks become NULL."""
    return normalize_blanks(raw, S.ZONE_COLUMNS)


def add_zone_checks(df: DataFrame) -> DataFrame:
    return df.withColumns(dict(zone_checks(df.columns)))


def bronze_zones(raw: DataFrame) -> DataFrame:
    """Zone lookup with its four flags; failing rows are kept (flagged, not removed)."""
    return add_zone_checks(normalize_zones(raw))
