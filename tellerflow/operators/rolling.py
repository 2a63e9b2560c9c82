"""Sums over sliding windows of days, carried from day to day.

A fact is added up once per day and key, as a *partial*. A *state* holds, per key,
the sums over every window that ends on its day. The state of a later day is the
state before, plus the partials of the days that enter a window, minus those of
the days that leave it: one union and one sum over rows that are already grouped.
So a daily run reads the new day of the fact and, for each window, one day of
partials; it never reads the windows themselves.

* Sums and counts are whole numbers or decimals, so taking off what was added
  leaves nothing behind. Values are counted beside their sum: a window whose
  values are all NULL, or that has none, gives NULL and not zero.
* A maximum cannot be taken off. But all windows end on the same day, so the
  latest event of any window that holds one is the latest of all, and only
  that is kept.
* Keys without an event in the longest window leave the state.
* A late change of past days adds the difference of their new and old partials.
  Only keys whose latest event was on such a day have it looked up again.

NULLs in keys are keys. Partials carry ``cob_dt``, the date of their events.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellerflow.functions.columns import in_window

DAY = "cob_dt"
LATEST = "latest"
_SUM = "decimal(38,2)"


@dataclass(frozen=True)
class Measure:
    """Counts the rows with a value, and adds the values up unless they are only marks; NULL values do not take part."""

    name: str
    value: Column
    windows: tuple[int, ...]
    mark: bool = False


@dataclass(frozen=True)
class Rolling:
    """Keys, measures and the event time of one fact's windows."""

    keys: tuple[str, ...]
    event: str
    measures: tuple[Measure, ...]

    @property
    def windows(self) -> list[int]:
        return sorted({w for m in self.measures for w in m.windows})

    @property
    def longest(self) -> int:
        return self.windows[-1]

    def partial_columns(self) -> list[str]:
        return [c for m in self.measures for c in ([f"n_{m.name}"] if m.mark else [f"n_{m.name}", f"s_{m.name}"])]

    def state_columns(self) -> list[tuple[str, str, int]]:
        """(state column, partial column it sums, window)."""
        windows = {m.name: m.windows for m in self.measures}
        return [(f"{c}_{w}", c, w) for c in self.partial_columns() for w in windows[c[2:]]]

    def partial_ddl(self, keys: str, event: str) -> str:
        return ", ".join([keys, *[f"{c} {_kind(c)}" for c in self.partial_columns()], f"{LATEST} {event}", f"{DAY} DATE"])

    def state_ddl(self, keys: str, event: str) -> str:
        return ", ".join([keys, *[f"{c} {_kind(c)}" for c, _, _ in self.state_columns()], f"{LATEST} {event}", f"{DAY} DATE"])


def _kind(column: str) -> str:
    return "BIGINT" if column.startswith("n_") else _SUM.upper()


def partials(fact: DataFrame, spec: Rolling) -> DataFrame:
    """One row per day and key; a hot key is as many rows as it has days."""
    out = []
    for m in spec.measures:
        out.append(F.count(m.value).alias(f"n_{m.name}"))
        if not m.mark:
            out.append(F.coalesce(F.sum(m.value), F.lit(0)).cast(_SUM).alias(f"s_{m.name}"))
    return fact.groupBy(DAY, *spec.keys).agg(*out, F.max(spec.event).alias(LATEST)).select(*spec.keys, *spec.partial_columns(), LATEST, DAY)


def _summed(rows: DataFrame, spec: Rolling, day: dt.date) -> DataFrame:
    """Add up rows of the state's shape; keys without an event in the longest window go."""
    sums = [F.sum(c).cast("bigint" if c.startswith("n_") else _SUM).alias(c) for c, _, _ in spec.state_columns()]
    held = reduce(lambda a, b: a | b, [F.col(c) > 0 for c, p, w in spec.state_columns() if w == spec.longest and p.startswith("n_")])
    found = rows.groupBy(*spec.keys).agg(*sums, F.max(LATEST).alias(LATEST)).where(held)
    return found.withColumn(DAY, F.lit(day))


def _weighted(rows: DataFrame, spec: Rolling, weight: dict[int, Column], latest: Column) -> DataFrame:
    """Partials in the state's shape, each window's columns times its weight of -1, 0 or 1."""
    columns = [(F.col(p) * weight[w]).cast("bigint" if c.startswith("n_") else _SUM).alias(c) for c, p, w in spec.state_columns()]
    return rows.select(*spec.keys, *columns, latest.alias(LATEST))


def _inside(day: dt.date, window: int) -> Column:
    return in_window(F.col(DAY), day, window).cast("int")


def state_of(parts: DataFrame, spec: Rolling, day: dt.date) -> DataFrame:
    """The state of a day from all partials of its longest window."""
    rows = parts.where(in_window(F.col(DAY), day, spec.longest))
    return _summed(_weighted(rows, spec, {w: _inside(day, w) for w in spec.windows}, F.col(LATEST)), spec, day)


def moving_days(spec: Rolling, before: dt.date, day: dt.date) -> Column:
    """The days that enter or leave a window between two days: what a step reads of the partials."""
    back = lambda d, n: F.lit(d - dt.timedelta(days=n))
    leaving = [F.col(DAY).between(back(before, w), back(day, w + 1)) for w in spec.windows]
    return reduce(lambda a, b: a | b, leaving, F.col(DAY).between(back(before, -1), F.lit(day)))


def advance(state: DataFrame, parts: DataFrame, spec: Rolling, before: dt.date, day: dt.date) -> DataFrame:
    """The state of ``day`` from that of the earlier day ``before``."""
    if before >= day:
        raise ValueError(f"a state of {before} cannot move on to {day}")
    rows = parts.where(moving_days(spec, before, day))
    weight = {w: _inside(day, w) - _inside(before, w) for w in spec.windows}
    entering = F.when(F.col(DAY) > F.lit(before), F.col(LATEST))
    return _summed(state.drop(DAY).unionByName(_weighted(rows, spec, weight, entering)), spec, day)


def correct(state: DataFrame, old: DataFrame, new: DataFrame, parts: DataFrame, spec: Rolling, days: Sequence[dt.date], day: dt.date) -> DataFrame:
    """The state of ``day`` after past ``days`` were loaded again.

    ``old`` and ``new`` are those days' partials before and after, ``parts`` all partials after.
    """
    weight = {w: _inside(day, w) for w in spec.windows}
    taken = {w: -c for w, c in weight.items()}
    nothing, inside = F.lit(None), F.when(_inside(day, spec.longest) == 1, F.col(LATEST))
    kept = state.withColumn("_lost", F.col(LATEST).cast("date").isin(list(days)))
    lost = kept.where("_lost").select(*[F.col(k).alias(f"_{k}") for k in spec.keys])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in spec.keys])
    again = parts.where(in_window(F.col(DAY), day, spec.longest)).join(lost, same, "left_semi")
    none = {w: F.lit(0) for w in spec.windows}
    rows = kept.withColumn(LATEST, F.when(~F.col("_lost"), F.col(LATEST))).drop("_lost", DAY)
    changes = [
        _weighted(old, spec, taken, nothing.cast(state.schema[LATEST].dataType)),
        _weighted(new, spec, weight, inside),
        _weighted(again, spec, none, F.col(LATEST)),
    ]
    return _summed(reduce(DataFrame.unionByName, changes, rows), spec, day)
