"""Slowly changing dimensions as pure transformations of frames.

A version row carries effective_from, effective_to, is_current and a
deterministic surrogate key. A history is a function of the previous history,
one full snapshot and the processing date; nothing is merged in place.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tellerflow.functions.columns import OPEN_END, surrogate_key

FROM, TO, CURRENT = "effective_from", "effective_to", "is_current"


@dataclass(frozen=True)
class Dimension:
    """Business key, tracked attributes and surrogate key of one versioned dimension."""

    name: str
    keys: tuple[str, ...]
    tracked: tuple[str, ...]
    sk: str
    detect_deletes: bool = True
    full_snapshot: bool = True

    @property
    def metadata(self) -> tuple[str, str, str, str]:
        return (FROM, TO, CURRENT, self.sk)

    def validate(self) -> "Dimension":
        if not self.keys or not self.tracked or not self.sk:
            raise ValueError(f"{self.name}: business key, tracked columns and surrogate key are required")
        if set(self.keys) & set(self.tracked):
            raise ValueError(f"{self.name}: a business key cannot be tracked")
        if self.detect_deletes and not self.full_snapshot:
            raise ValueError(f"{self.name}: delete detection needs a full snapshot")
        return self


# Which attributes make a new version; last_updated never does.
DIMENSIONS = {
    "branch": Dimension(
        "dim_branch",
        ("branch_code",),
        ("branch_name", "region", "city", "district", "address", "manager_name", "open_date", "status"),
        "branch_sk",
    ),
    "product": Dimension(
        "dim_product",
        ("product_code",),
        ("product_name", "product_group", "product_type", "currency", "is_active", "launch_date"),
        "product_sk",
    ),
    "customer": Dimension(
        "dim_customer",
        ("customer_id",),
        (
            "cccd", "full_name", "gender", "date_of_birth", "phone", "email", "address", "city", "district",
            "customer_segment", "kyc_status", "branch_code", "register_date", "is_active",
        ),
        "customer_sk",
    ),
    "account": Dimension(
        "dim_account",
        ("account_id",),
        (
            "account_no", "customer_id", "product_code", "branch_code", "account_type", "currency", "balance",
            "open_date", "close_date", "status",
        ),
        "account_sk",
    ),
}


def _any(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def _day_before(day: dt.date) -> dt.date:
    return day - dt.timedelta(days=1)


def open_versions(snapshot: DataFrame, spec: Dimension, day: dt.date) -> DataFrame:
    """Every snapshot row as a version open from the processing date (the first load of a dimension)."""
    return snapshot.withColumns(
        {FROM: F.lit(day), TO: F.lit(OPEN_END), CURRENT: F.lit(1), spec.sk: surrogate_key(spec.keys, day)}
    )


# --- guards --------------------------------------------------------------------------------------


def key_problems(snapshot: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Business keys that are NULL or occur more than once, with their row counts."""
    null_key = _any([F.col(k).isNull() for k in keys])
    return (
        snapshot.groupBy(*keys)
        .agg(F.count("*").alias("row_count"))
        .withColumn("problem", F.when(null_key, "null_key").when(F.col("row_count") > 1, "duplicate_key"))
        .where(F.col("problem").isNotNull())
    )


def source_problems(snapshot: DataFrame, spec: Dimension) -> DataFrame:
    return key_problems(snapshot, spec.keys)


def guard_keys(snapshot: DataFrame, keys: Sequence[str], name: str) -> None:
    """Raise when a business key is NULL or not unique; five of them are named."""
    samples = [row.asDict() for row in key_problems(snapshot, keys).limit(5).collect()]
    if samples:
        kinds = sorted({s["problem"].replace("_", " business ") for s in samples})
        raise ValueError(f"{name}: {', '.join(kinds)}, for example {samples}")


def guard_columns(stored: Sequence[str], snapshot: Sequence[str], name: str) -> None:
    """Raise when a snapshot and the stored table differ in their columns: none may be lost, or left empty, silently."""
    missing, unexpected = sorted(set(stored) - set(snapshot)), sorted(set(snapshot) - set(stored))
    if missing or unexpected or len(snapshot) != len(set(snapshot)):
        raise ValueError(f"{name}: source columns differ from the stored table's: missing {missing}, unexpected {unexpected}, all {list(snapshot)}")


def guard_source(snapshot: DataFrame, spec: Dimension) -> None:
    """Raise before anything is written when a snapshot cannot become versions."""
    columns = snapshot.columns
    if len(columns) != len(set(columns)):
        raise ValueError(f"{spec.name}: duplicate column names {columns}")
    missing = sorted((set(spec.keys) | set(spec.tracked)) - set(columns))
    if missing:
        raise ValueError(f"{spec.name}: missing columns {missing}")
    leaked = sorted(set(columns) & set(spec.metadata))
    if leaked:
        raise ValueError(f"{spec.name}: the source must not provide {leaked}")
    guard_keys(snapshot, spec.keys, spec.name)


def backdated_rows(history: DataFrame, day: dt.date) -> DataFrame:
    """How many versions start after the processing date, and the latest start among versions not over by then."""
    return history.where(F.col(TO) >= F.lit(day)).agg(
        F.count_if(F.col(FROM) > F.lit(day)).alias("later_versions"), F.max(FROM).alias("latest_effective_from")
    )


def guard_backdated(history: DataFrame, spec: Dimension, day: dt.date) -> None:
    found = backdated_rows(history, day).first()
    if found.later_versions:
        raise ValueError(f"{spec.name}: {day} is earlier than existing versions up to {found.latest_effective_from}")


# --- recovery ------------------------------------------------------------------------------------


def recover(history: DataFrame, spec: Dimension, day: dt.date) -> DataFrame:
    """Undo an earlier attempt of the same day: drop its versions and reopen what they closed.

    Versions of the attempt are known by their deterministic key, so a rerun and
    a run that stopped half-way are healed in the same way. A version that is
    still open is preferred to a closed copy of itself, which a run interrupted
    between two partition writes leaves behind.
    """
    yesterday = F.lit(_day_before(day))
    own = (F.col(FROM) == F.lit(day)) & (F.col(spec.sk) == surrogate_key(spec.keys, day))
    rest = history.where(~own)
    just_closed = (F.col(CURRENT) == 0) & (F.col(TO) == yesterday) & (F.col(FROM) < F.lit(day))
    still_open = rest.where(F.col(CURRENT) == 1).select(spec.sk)
    run_keys = history.where(own).select(*spec.keys).distinct().withColumn("_rerun", F.lit(True))
    closed = (
        rest.where(just_closed)
        .join(still_open, spec.sk, "left_anti")
        .join(run_keys, list(spec.keys), "left")
        .withColumns(
            {
                TO: F.when(F.col("_rerun"), F.lit(OPEN_END)).otherwise(F.col(TO)),
                CURRENT: F.when(F.col("_rerun"), F.lit(1)).otherwise(F.col(CURRENT)),
            }
        )
        .select(*history.columns)
    )
    return rest.where(~just_closed).unionByName(closed)


# --- classification and application --------------------------------------------------------------


def classify(current: DataFrame, snapshot: DataFrame, spec: Dimension) -> DataFrame:
    """Current versions and snapshot rows side by side with their change kind.

    One full outer join on the unique business key. Columns: keys, ``change``
    in new / changed / unchanged / deleted, structs ``old`` and ``new``.
    Comparison is NULL-safe per column and looks at tracked columns only.
    """
    old = current.select(*spec.keys, F.struct(*current.columns).alias("old"))
    new = snapshot.select(*spec.keys, F.struct(*snapshot.columns).alias("new"))
    both = old.join(new, list(spec.keys), "full_outer")
    differs = _any([~F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")) for c in spec.tracked])
    change = (
        F.when(F.col("old").isNull(), "new")
        .when(F.col("new").isNull(), "deleted")
        .when(differs, "changed")
        .otherwise("unchanged")
    )
    return both.select(*spec.keys, change.alias("change"), "old", "new")


def apply_snapshot(history: DataFrame, snapshot: DataFrame, spec: Dimension, day: dt.date) -> DataFrame:
    """The history after one full snapshot, in one lazy plan.

    Only current rows meet the snapshot; closed versions pass through. Each
    joined row yields its old version (kept or closed) and, where needed, the
    new one.
    """
    guard_columns([c for c in history.columns if c not in spec.metadata], snapshot.columns, spec.name)
    healed = recover(history, spec, day)
    touched, passed = healed.where(F.col(CURRENT) == 1), healed.where(F.col(CURRENT) == 0)
    return passed.unionByName(next_current(touched, snapshot, spec, day, history.columns))


def next_current(current: DataFrame, snapshot: DataFrame, spec: Dimension, day: dt.date, columns: list[str]) -> DataFrame:
    """Versions that come out of the current rows: kept, closed yesterday, and opened today."""
    pairs = classify(current, snapshot, spec)
    types = {f.name: f.dataType for f in current.schema}

    def version(side: str, start: Column, stop: Column, is_current: Column, sk: Column) -> Column:
        values = {FROM: start, TO: stop, CURRENT: is_current, spec.sk: sk}
        return F.struct(*[values.get(c, F.col(f"{side}.{c}")).cast(types[c]).alias(c) for c in columns])

    closes = (F.col("change") == "changed") & (F.col(f"old.{FROM}") < F.lit(day))
    if spec.detect_deletes:
        closes = closes | ((F.col("change") == "deleted") & (F.col(f"old.{FROM}") < F.lit(day)))
    kept = version(
        "old",
        F.col(f"old.{FROM}"),
        F.when(closes, F.lit(_day_before(day))).otherwise(F.col(f"old.{TO}")),
        F.when(closes, F.lit(0)).otherwise(F.col(f"old.{CURRENT}")),
        F.col(f"old.{spec.sk}"),
    )
    opened = version("new", F.lit(day), F.lit(OPEN_END), F.lit(1), surrogate_key(spec.keys, day))
    versions = (
        F.when(F.col("change") == "new", F.array(opened))
        .when(F.col("change") == "changed", F.array(kept, opened))
        .otherwise(F.array(kept))
    )
    return pairs.select(F.explode(versions).alias("v")).select("v.*")


def scd1_upsert(target: DataFrame, snapshot: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Current-state table: snapshot rows win, keys missing from the snapshot stay.

    Refuses a snapshot with other columns than the table, or with NULL or repeated keys.
    """
    guard_columns(target.columns, snapshot.columns, "current-state table")
    guard_keys(snapshot, keys, "current-state table")
    return snapshot.select(*target.columns).unionByName(target.join(snapshot.select(*keys), list(keys), "left_anti"))


def day_slice(history: DataFrame, day: dt.date) -> DataFrame:
    """The versions a day can change: open ones, and those an attempt of the same day has closed. Two partitions of a
    stored history, so everything derived from this slice prunes the older past."""
    return history.where(F.col(TO).isin(_day_before(day), OPEN_END))


# --- checks --------------------------------------------------------------------------------------


def ordered_ranges(history: DataFrame, spec: Dimension) -> DataFrame:
    """Distinct validity ranges of each key with the end of the range before.

    Rows are first grouped by key and range with a map-side combine, so the
    window sees at most one row per key and distinct range, and a key gets at
    most one version per processing date.
    """
    by_key = Window.partitionBy(*spec.keys).orderBy(FROM, TO)
    return (
        history.groupBy(*spec.keys, FROM, TO)
        .agg(F.count("*").alias("copies"))
        .withColumn("previous_to", F.lag(TO).over(by_key))
    )


def overlap_count() -> Column:
    """Versions of ordered_ranges that start on or before the end of the version before."""
    against_previous = F.coalesce((F.col(FROM) <= F.col("previous_to")).cast("long"), F.lit(0))
    against_copies = F.when(F.col(FROM) <= F.col(TO), F.col("copies") - 1).otherwise(F.lit(0))
    return F.coalesce(F.sum(against_previous + against_copies), F.lit(0))


def history_violations(history: DataFrame, spec: Dimension) -> DataFrame:
    """One row with the number of violations of each history rule; all zero for a sound history."""
    open_end = F.lit(OPEN_END)
    nulls = _any([F.col(c).isNull() for c in (*spec.keys, *spec.metadata)])
    current, stop = F.col(CURRENT), F.col(TO)
    rows = history.agg(
        F.count_if(nulls).alias("null_metadata"),
        F.count_if(~current.isin(0, 1)).alias("invalid_flag"),
        F.count_if(F.col(FROM) > stop).alias("inverted_range"),
        F.count_if(((current == 1) & (stop != open_end)) | ((current == 0) & (stop == open_end))).alias("sentinel_mismatch"),
    )
    doubles = history.groupBy(spec.sk).count().agg(F.count_if(F.col("count") > 1).alias("duplicate_sk"))
    currents = (
        history.groupBy(*spec.keys)
        .agg(F.count_if(current == 1).alias("n"))
        .agg(F.count_if(F.col("n") > 1).alias("multiple_current"))
    )
    overlaps = ordered_ranges(history, spec).agg(overlap_count().alias("overlapping_ranges"))
    # one-row frames side by side: scalar subqueries, no join
    return rows.select(
        "*",
        doubles.scalar().alias("duplicate_sk"),
        currents.scalar().alias("multiple_current"),
        overlaps.scalar().alias("overlapping_ranges"),
    )


def sync_violations(history: DataFrame, snapshot: DataFrame, spec: Dimension) -> DataFrame:
    """One row: snapshot keys without a current version, deleted keys still current, tracked values that differ."""
    pairs = classify(history.where(F.col(CURRENT) == 1), snapshot, spec)
    stale = F.col("change") == "deleted" if spec.detect_deletes else F.lit(False)
    return pairs.agg(
        F.count_if(F.col("change") == "new").alias("missing_current"),
        F.count_if(stale).alias("deleted_still_current"),
        F.count_if(F.col("change") == "changed").alias("value_mismatch"),
    )


def guard_history(history: DataFrame, spec: Dimension, snapshot: DataFrame | None = None) -> None:
    """Raise with every broken rule named; with a snapshot also check that history and source agree."""
    found = history_violations(history, spec).first().asDict()
    if snapshot is not None:
        found |= sync_violations(history, snapshot, spec).first().asDict()
    broken = {rule: count for rule, count in found.items() if count}
    if broken:
        raise RuntimeError(f"{spec.name}: history check failed: {broken}")


def history_of_keys(history: DataFrame, spec: Dimension, keys: Sequence[object], values: Sequence[str]) -> DataFrame:
    """All versions of the given keys with chosen attributes rendered to one text."""
    shown = [F.concat(F.lit(f"{v}="), F.coalesce(F.col(v).cast("string"), F.lit(""))) for v in values]
    return history.where(F.col(spec.keys[0]).isin(*keys)).select(
        F.lit(spec.name).alias("table_name"),
        F.col(spec.keys[0]).cast("string").alias("business_key"),
        F.col(spec.sk).alias("surrogate_key"),
        FROM,
        TO,
        CURRENT,
        F.concat_ws("; ", *shown).alias("business_values"),
    )
