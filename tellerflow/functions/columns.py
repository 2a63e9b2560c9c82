"""Built-in column expressions only; nothing here leaves the JVM."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sentinels of the data contract.
OPEN_END = dt.date(9999, 12, 31)
NEVER_TS = "1900-01-01 00:00:00"
NEVER_DAYS = 99999
NULL_KEY = "__NULL__"

MONEY = "decimal(18,2)"


def as_date(day: dt.date | str) -> dt.date:
    """Accept a date or YYYY-MM-DD text."""
    return day if isinstance(day, dt.date) else dt.datetime.strptime(day, "%Y-%m-%d").date()


def day_lit(day: dt.date | str) -> Column:
    return F.lit(as_date(day))


def ts_lit(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def money(value: Column) -> Column:
    """Missing means zero, two decimals, half up."""
    return F.round(F.coalesce(value, F.lit(0)), 2).cast(MONEY)


def flag(condition: Column) -> Column:
    """1 when the condition holds, 0 when it does not or is unknown."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def ladder(steps: Sequence[tuple[Column, object]], otherwise: object) -> Column:
    """First matching step wins."""
    column = None
    for condition, value in steps:
        column = F.when(condition, F.lit(value)) if column is None else column.when(condition, F.lit(value))
    return column.otherwise(F.lit(otherwise))


def in_window(date: Column, day: dt.date, days: int) -> Column:
    """Inclusive on both ends: days=30 covers 31 calendar days."""
    return date.between(F.lit(day - dt.timedelta(days=days)), F.lit(day))


def surrogate_key(keys: Sequence[str], day: dt.date | Column) -> Column:
    """Deterministic version key: the same business key and day always give the same value."""
    parts = [F.coalesce(F.col(k).cast("string"), F.lit(NULL_KEY)) for k in keys]
    start = day.cast("string") if isinstance(day, Column) else F.lit(day.isoformat())
    return F.sha2(F.concat_ws("|", *parts, start), 256)


# --- ladders -------------------------------------------------------------------------------------


def aum_bucket(aum: Column) -> Column:
    return ladder(
        [(aum >= 5_000_000_000, "VIP"), (aum >= 1_000_000_000, "PRIORITY"), (aum >= 100_000_000, "AFFLUENT")], "MASS"
    )


def age_group(age: Column) -> Column:
    bands = [(25, "18-24"), (35, "25-34"), (45, "35-44"), (55, "45-54"), (65, "55-64")]
    return ladder([(age.isNull(), "UNKNOWN")] + [(age < top, name) for top, name in bands], "65+")


def churn_risk(days: Column, never: Column) -> Column:
    return ladder([(never | (days > 90), "High"), (days > 60, "Medium"), (days > 30, "Low")], "Active")


def rfm_segment(active: Column, r: Column, f: Column, m: Column) -> Column:
    total = r + f + m
    return ladder(
        [
            (~active, "Lost"),
            ((r <= 2) & ((f >= 3) | (m >= 3)), "At Risk"),
            (total >= 13, "Champions"),
            (total >= 10, "Loyal Customers"),
            ((r >= 4) & (f <= 2), "New Customers"),
            (total >= 8, "Potential Loyalists"),
            (total == 3, "Lost"),
        ],
        "Hibernating",
    )


def years_365(birth: Column, day: dt.date) -> Column:
    """Age as whole blocks of 365 days, truncated."""
    return F.floor(F.datediff(F.lit(day), birth) / 365).cast("int")


# --- masks ---------------------------------------------------------------------------------------


def mask_name_full(name: Column) -> Column:
    words = F.split(name, " ")
    initial = lambda i: F.substring(F.element_at(words, i), 1, 1)
    head = F.element_at(words, 1)
    return (
        F.when(name.isNull(), F.lit(None).cast("string"))
        .when(F.size(words) == 1, F.concat(F.substring(name, 1, 1), F.lit("**")))
        .when(F.size(words) == 2, F.concat(head, F.lit(" "), initial(2), F.lit("**")))
        .otherwise(F.concat(head, F.lit(" "), initial(2), F.lit("** "), initial(-1), F.lit("**")))
    )


def mask_name_short(name: Column) -> Column:
    return F.concat(F.get(F.split(name, " "), F.lit(0)), F.lit(" **"))


def mask_phone(phone: Column) -> Column:
    return F.concat(F.substring(phone, 1, 3), F.lit("****"), F.substr(phone, F.lit(8)))


def mask_email(email: Column) -> Column:
    parts = F.split(email, "@")
    local = F.get(parts, F.lit(0))
    return F.concat(
        F.substring(local, 1, 1), F.lit("*****"), F.substring(local, -1, 1), F.lit("@"), F.get(parts, F.lit(1))
    )


def hash_national_id(value: Column, salt: str) -> Column:
    """Salted and deterministic, so two masked tables still join on it."""
    if not salt:
        raise ValueError("a salt is required to hash national ids")
    return F.sha2(F.concat(value, F.lit(salt)), 256)


def birth_decade(birth: Column, day: dt.date) -> Column:
    return (F.floor(F.datediff(F.lit(day), birth) / 3650) * 10).cast("int")
