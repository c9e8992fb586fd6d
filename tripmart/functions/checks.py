"""Data-quality rules as Spark ``Column`` expressions.

A rule whose columns are missing from the frame is neutral (literal TRUE), so the
checks tolerate schema drift. Column presence is tested case-sensitively against
``df.columns``; ``ident`` maps a present name to its SQL identifier, which lets a caller
address columns whose names differ only by case. Each rule is one SQL expression.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart import schemas as S

Ident = Callable[[str], str]

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType)
_TIMES = (T.TimestampType, T.TimestampNTZType, T.DateType)


def quoted(name: str) -> str:
    """SQL identifier of a column name."""
    return "`" + name.replace("`", "``") + "`"


def _family_ok(dtype: T.DataType | None, sql_type: str) -> bool:
    if dtype is None:
        return False
    if sql_type in ("INT", "BIGINT", "DOUBLE"):
        return isinstance(dtype, _NUMERIC)
    if sql_type == "TIMESTAMP":
        return isinstance(dtype, _TIMES)
    return isinstance(dtype, T.StringType)


def as_type(ident: Ident, dtypes: Mapping[str, T.DataType], name: str, sql_type: str) -> str:
    """The column itself when it already has the wanted type family, else a
    ``try_cast`` (so text input gives NULL instead of an ANSI error)."""
    c = ident(name)
    return c if _family_ok(dtypes.get(name), sql_type) else f"try_cast({c} AS {sql_type})"


def _in(values: Sequence[object]) -> str:
    return "(" + ", ".join(repr(v) for v in values) + ")"


def trip_type_checks(columns: Sequence[str], ident: Ident = quoted) -> list[tuple[str, Column]]:
    """``chk_<col>_type_ok``: NULL, or castable to the expected type."""
    out = []
    for name, sql_type in S.TRIP_SPEC:
        chk = f"{S.CHECK_PREFIX}{name}{S.TYPE_CHECK_SUFFIX}"
        if name in columns:
            c = ident(name)
            out.append((chk, F.expr(f"{c} IS NULL OR try_cast({c} AS {sql_type}) IS NOT NULL")))
        else:
            out.append((chk, F.lit(True)))
    return out


def trip_domain_checks(dtypes: Mapping[str, T.DataType], ident: Ident = quoted
                       ) -> list[tuple[str, Column]]:
    """Business rules on enumerations, signs and times (``dtypes``: name -> type)."""
    spec = dict(S.TRIP_SPEC)
    spec["Airport_fee"] = "DOUBLE"

    def typed(name: str) -> str:
        return as_type(ident, dtypes, name, spec[name])

    def rule(chk: str, needs: Sequence[str], build: Callable[[], str]) -> tuple[str, Column]:
        present = all(n in dtypes for n in needs)
        return chk, (F.expr(build()) if present else F.lit(True))

    pickup, dropoff = "tpep_pickup_datetime", "tpep_dropoff_datetime"
    amounts = [f"{typed(c)} >= 0.0" for c in S.AMOUNT_COLUMNS if c in dtypes]
    return [
        rule("chk_VendorID_domain_ok", ["VendorID"],
             lambda: f"{typed('VendorID')} IN {_in(S.VALID_VENDORS)}"),
        rule("chk_passenger_count_ge1", ["passenger_count"],
             lambda: f"{typed('passenger_count')} >= 1"),
        rule("chk_trip_distance_ge0", ["trip_distance"],
             lambda: f"{typed('trip_distance')} >= 0.0"),
        rule("chk_RatecodeID_domain_ok", ["RatecodeID"],
             lambda: f"{typed('RatecodeID')} IN {_in(S.VALID_RATE_CODES)}"),
        rule("chk_store_and_fwd_flag_domain_ok", ["store_and_fwd_flag"],
             lambda: f"{ident('store_and_fwd_flag')} IS NULL OR "
                     f"upper({ident('store_and_fwd_flag')}) IN {_in(S.VALID_STORE_FLAGS)}"),
        rule("chk_PULocationID_pos", ["PULocationID"], lambda: f"{typed('PULocationID')} > 0"),
        rule("chk_DOLocationID_pos", ["DOLocationID"], lambda: f"{typed('DOLocationID')} > 0"),
        rule("chk_payment_type_domain_ok", ["payment_type"],
             lambda: f"{typed('payment_type')} IN {_in(S.VALID_PAYMENT_TYPES)}"),
        ("chk_amounts_nonneg_ok", F.expr(" AND ".join(amounts)) if amounts else F.lit(True)),
        rule("chk_times_order_ok", [pickup, dropoff],
             lambda: f"{typed(dropoff)} >= {typed(pickup)}"),
        rule("chk_duration_lt_24h", [pickup, dropoff],
             lambda: f"unix_timestamp({typed(dropoff)}) - unix_timestamp({typed(pickup)}) "
                     f"< {S.MAX_TRIP_SECONDS}"),
    ]


def zone_checks(columns: Sequence[str], ident: Ident = quoted) -> list[tuple[str, Column]]:
    """Zone lookup rules; the numeric id check fails on NULL as well."""
    rules: list[tuple[str, str, Callable[[str], str]]] = [
        ("chk_LocationID_numeric", "LocationID", lambda c: f"try_cast({c} AS INT) IS NOT NULL"),
        ("chk_Borough_not_null", "Borough", lambda c: f"{c} IS NOT NULL"),
        ("chk_Zone_not_null", "Zone", lambda c: f"{c} IS NOT NULL"),
        ("chk_service_zone_not_null", "service_zone", lambda c: f"{c} IS NOT NULL"),
    ]
    return [(chk, F.expr(build(ident(name))) if name in columns else F.lit(True))
            for chk, name, build in rules]


def zone_null_like(c: Column, dtype: T.DataType | None = None) -> Column:
    """NULL-like value of a zone column: NULL or the empty string."""
    return c.isNull() | (c == F.lit(""))
