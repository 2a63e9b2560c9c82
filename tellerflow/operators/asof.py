"""Events resolved to the dimension version valid on their date."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tellerflow.functions.columns import surrogate_key
from tellerflow.operators.sinks import durable
from tellerflow.sources.files import asof_dimension

FIRST_DAY = "0001-01-01"  # before any event
MANY_VERSIONS = 16  # of one key; above it versions and events are sorted together
HOT_EVENTS = 1_000_000  # of one key; above it the key is cut into days
MOST_BROADCAST = 10_000  # hot keys; more of them are joined without a hint
SPREAD = 1_000  # parts of the events that have no key


@dataclass(frozen=True)
class Lookup:
    """A dimension to resolve: business key in the events, surrogate key to fetch.

    ``pairs`` holds every (``through``, key) of the events, where ``through`` is a column by which they are already
    partitioned, such as the key of the dimension before.
    """

    versions: DataFrame
    key: str
    sk: str
    through: str | None = None
    pairs: DataFrame | None = None


@dataclass(frozen=True)
class Fact:
    """An event table: unique key, event timestamp and dimensions it refers to."""

    name: str
    key: str
    event: str
    dimensions: tuple[str, ...]

    def validate(self) -> "Fact":
        if not self.key or not self.event or not self.dimensions:
            raise ValueError(f"{self.name}: key, event column and dimensions are required")
        return self


FACTS = {
    "txn_account": Fact("fact_txn_account", "txn_id", "txn_date", ("account", "customer")),
    "card_txn": Fact("fact_card_txn", "txn_id", "txn_date", ("customer",)),
    "crm_interaction": Fact("fact_crm_interaction", "interaction_id", "interaction_date", ("customer",)),
}


def from_the_beginning(versions: DataFrame, key: str) -> DataFrame:
    """Extend each key's first version back in time, so that earlier events find it by the plain range rule."""
    first = F.min("effective_from").over(Window.partitionBy(key))  # a key has one version per processing date at most
    return versions.withColumn(
        "effective_from", F.when(F.col("effective_from") == first, F.lit(FIRST_DAY).cast("date")).otherwise(F.col("effective_from"))
    )


def _hot_keys(events: DataFrame, key: str, on: Column) -> DataFrame | None:
    """(key, first and last day) of keys with more than HOT_EVENTS events, so at most one row for each HOT_EVENTS events."""
    counts = events.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_hot")).agg(F.count("*").alias("n"), F.min(on).alias("_low"), F.max(on).alias("_high"))
    hot = durable(counts.where(F.col("n") > HOT_EVENTS).drop("n"), "hot-keys")
    found = hot.limit(MOST_BROADCAST + 1).count()
    if not found:
        return None
    return F.broadcast(hot) if found <= MOST_BROADCAST else hot


def carry_forward(events: DataFrame, event: str, lookup: Lookup, how: str = "left") -> DataFrame:
    """Add the surrogate key of the version valid on the event date by one sort of events and versions together.

    Per key, versions and events are ordered by date, a version before the events
    of its first day; the last version seen is carried to each event and holds if
    it has not ended. So a key costs the sum of its versions and events, where a
    join costs their product. A key with more than HOT_EVENTS events is cut into
    its days, each with the version valid at its start. Events without a key or
    date meet no version and are spread over tasks. Of overlapping versions of a key, which the
    history checks refuse, the last one started counts.
    """
    key, on, sk = F.col(lookup.key), F.col(event).cast("date"), lookup.sk
    versions = lookup.versions.where(key.isNotNull()).select(
        key, F.col("effective_from").alias("_at"), F.struct(F.col(sk).alias("sk"), F.col("effective_to").alias("to")).alias("_version")
    )
    loose = key.isNull() | on.isNull()
    part = F.when(loose, F.pmod(F.xxhash64(*events.columns), F.lit(SPREAD)).cast("int"))
    hot = _hot_keys(events, lookup.key, on)
    if hot is None:
        rows, versions = events.withColumn("_part", F.coalesce(part, F.lit(0))), versions.withColumn("_part", F.lit(0))
    else:
        same = key == F.col("_hot")
        rows = events.join(hot, same, "left").withColumn("_part", F.coalesce(part, F.datediff(on, "_low"), F.lit(0)))
        first = F.greatest(F.datediff("_at", "_low"), F.lit(0))
        last = F.datediff(F.least(F.col("_version.to"), F.col("_high")), "_low")
        days = F.when(F.col("_hot").isNull(), F.array(F.lit(0))).when(first <= last, F.sequence(first, last))
        versions = versions.join(hot, same, "left").withColumn("_part", F.explode(days))
        rows, versions = rows.drop("_hot", "_low", "_high"), versions.drop("_hot", "_low", "_high")
    both = rows.withColumns({"_at": on, "_event": F.lit(1)}).unionByName(versions.withColumn("_event", F.lit(0)), allowMissingColumns=True)
    sofar = Window.partitionBy(lookup.key, "_part").orderBy("_at", "_event", F.col("_version.to")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = both.withColumn("_carried", F.last("_version", ignorenulls=True).over(sofar)).where(F.col("_event") == 1)
    found = F.when(F.col("_at") <= F.col("_carried.to"), F.col("_carried.sk"))
    out = carried.select(*events.columns, found.alias(sk))
    return out.where(F.col(sk).isNotNull()) if how == "inner" else out


def _many_versions(lookup: Lookup) -> bool:
    most = lookup.versions.groupBy(lookup.key).count().agg(F.max("count")).first()[0]
    return (most or 0) > MANY_VERSIONS


def _ranges(lookup: Lookup, versions: DataFrame) -> DataFrame:
    return versions.select(F.col(lookup.key).alias("_key"), lookup.sk, F.col("effective_from").alias("_from"), F.col("effective_to").alias("_to"))


def _valid(event: str) -> Column:
    return F.col(event).cast("date").between(F.col("_from"), F.col("_to"))


def _in_range(events: DataFrame, event: str, lookup: Lookup, versions: DataFrame, how: str) -> DataFrame:
    """Versions by their business key."""
    return events.join(_ranges(lookup, versions), (F.col(lookup.key) == F.col("_key")) & _valid(event), how).drop("_key", "_from", "_to")


def _through(events: DataFrame, event: str, lookup: Lookup, versions: DataFrame, how: str) -> DataFrame:
    """Versions by the column that the events are partitioned by; the business key is compared as a range, so that it is no join key."""
    pairs = lookup.pairs.select(F.col(lookup.through).alias("_by"), F.col(lookup.key).alias("_pair")).distinct()
    side = pairs.join(_ranges(lookup, versions), F.col("_pair") == F.col("_key")).drop("_pair")
    same = (F.col(lookup.through) == F.col("_by")) & F.col(lookup.key).between(F.col("_key"), F.col("_key"))
    return events.join(side, same & _valid(event), how).drop("_by", "_key", "_from", "_to")


def resolve(
    events: DataFrame, event: str, lookups: Sequence[Lookup], bootstrap: bool = False, how: str = "left", day: dt.date | None = None,
    merge: bool | None = None,
) -> DataFrame:
    """Add each dimension's surrogate key as of the event date.

    When all events fall on one ``day``, only the versions valid then are read:
    at most one per key, and the closed partitions before it are pruned.

    Otherwise events and versions are sorted together (``carry_forward``) where a
    key has more than MANY_VERSIONS versions, or as ``merge`` says. With few
    versions it is an equi join on the business key with the validity range as
    residual condition; only three columns of a dimension travel. A hot key splits
    under AQE because the many-row side is the streamed side of a left join.
    """
    out = events
    for lookup in lookups:
        versions = from_the_beginning(lookup.versions, lookup.key) if bootstrap else lookup.versions
        if day:
            versions = asof_dimension(versions, day)
        elif merge or (merge is None and _many_versions(lookup)):
            out = carry_forward(out, event, Lookup(versions, lookup.key, lookup.sk), how)
            continue
        elif lookup.pairs is not None:
            by = F.col(lookup.through)
            loose = _in_range(out.where(by.isNull()), event, lookup, versions, how)
            out = _through(out.where(by.isNotNull()), event, lookup, versions, how).unionByName(loose)
            continue
        out = _in_range(out, event, lookup, versions, how)
    return out


def keyed(fact: DataFrame, spec: Fact) -> DataFrame:
    """A fact with surrogate keys for the starts of versions that stand in their place."""
    start = lambda d: F.col(f"{d}_sk")
    return fact.withColumns({f"{d}_sk": F.when(start(d).isNotNull(), surrogate_key([f"{d}_id"], start(d))) for d in spec.dimensions})


def contract_counts(fact: DataFrame, spec: Fact, day: dt.date | None = None) -> DataFrame:
    """One row: rows, NULL partitions, rows outside the day, misdated rows, keys with surplus rows. One pass.

    ``misdated`` guards what partition pruning in the marts relies on: cob_dt is the date of the event.
    """
    outside = F.col("cob_dt") != F.lit(day) if day else F.lit(False)
    per_key = fact.groupBy(spec.key).agg(
        F.count("*").alias("n"),
        F.count_if(F.col("cob_dt").isNull()).alias("no_partition"),
        F.count_if(outside).alias("outside"),
        F.count_if(F.col("cob_dt") != F.col(spec.event).cast("date")).alias("misdated"),
    )
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum("no_partition"), F.lit(0)).alias("null_partition"),
        F.coalesce(F.sum("outside"), F.lit(0)).alias("outside_day"),
        F.coalesce(F.sum("misdated"), F.lit(0)).alias("misdated"),
        F.count_if(F.col("n") > 1).alias("duplicate_keys"),
    )


def guard_fact(fact: DataFrame, spec: Fact, day: dt.date | None = None) -> int:
    """Raise when a fact breaks its output contract; otherwise return its row count."""
    missing = sorted({spec.key, "cob_dt"} - set(fact.columns))
    if missing:
        raise ValueError(f"{spec.name}: missing columns {missing}")
    found = contract_counts(fact, spec, day).first().asDict()
    rows = found.pop("row_count")
    broken = {rule: count for rule, count in found.items() if count}
    if broken:
        raise ValueError(f"{spec.name}: output contract broken: {broken}")
    return rows
