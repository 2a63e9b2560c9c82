"""The layered tables built from one folder of given tables.

Silver and gold tables are written once per session to the shared folder and
read back, as a daily pipeline does; queries further up read them as stored
tables. The first build of each table is a normal Spark job.

Surrogate keys are 64 digits that no codec packs well, but a version's business
key and start give them again. Stored tables hold the start, and the key is
computed where a table is read by a plan that uses it; marts join and hold the
start in its place, too.
"""

from __future__ import annotations

import datetime as dt
import threading
import uuid
from collections.abc import Callable, Iterator, Mapping
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerflow.functions.columns import in_window, surrogate_key
from tellerflow.operators import activity, asof, history, rolling
from tellerflow.plans import branch_months, marts, serving
from tellerflow.session import bound_broadcasts, shared_dir
from tellerflow.sources import bank
from tellerflow.sources.files import full_snapshot, incremental_day, initial_history

SALT = "tellerflow-demo-salt"  # the tests' salt; a real run passes its own
SCD1 = {  # feed: (key, status column, status on the second day)
    "deposit": ("deposit_id", "status", "MATURED"),
    "loan": ("loan_id", "loan_status", "OVERDUE"),
    "card": ("card_id", "status", "BLOCKED"),
}


class LazySilver(marts.Silver):
    """Silver frames that are built when a mart first reads them, so that a mart costs only what it reads.

    With ``like`` the activity aggregates are shared with another one.
    """

    def __init__(self, frames: Mapping[str, Callable[[], DataFrame]], like: marts.Silver | None = None, **states: Callable):
        shared = {n: getattr(like, n) for n in ("_shared", "_lock", "_locks")} if like else {"_shared": {}, "_lock": threading.Lock(), "_locks": {}}
        for name, value in (shared | states | {"_frames": dict(frames)}).items():
            object.__setattr__(self, name, value)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in self._frames:
            raise AttributeError(name)
        return self._frames[name]()


class Tables(Mapping):
    """Tables by name, each built when it is first read."""

    def __init__(self, builds: Mapping[str, Callable[[], DataFrame]]):
        self._builds = dict(builds)

    def __getitem__(self, name: str) -> DataFrame:
        return self._builds[name]()

    def __iter__(self) -> Iterator[str]:
        return iter(self._builds)

    def __len__(self) -> int:
        return len(self._builds)


class Lake:
    base, day = bank.BASE_DAY, bank.COB_DAY

    def __init__(self, spark: SparkSession, folder: str, deletes: bool = True):
        self.spark, self.folder, self.deletes = spark, folder.rstrip("/"), deletes
        self.root = f"{shared_dir(spark)}/lake-{uuid.uuid4().hex[:12]}"
        bound_broadcasts(spark)
        self._stored: dict[str, DataFrame] = {}
        self._lock = threading.RLock()  # a build may ask for other tables
        self._silver: marts.Silver | None = None

    # given tables and feeds

    def raw(self, table: str) -> DataFrame:
        return bank.read(self.spark, self.folder, table)

    def feed(self, entity: str) -> DataFrame:
        """A banking feed as it stands on the first day."""
        inputs = {
            "branch": ("nation", "region"), "product": ("part",), "customer": ("customer",), "account": ("orders",),
            "deposit": ("orders",), "loan": ("orders",), "card": ("customer",), "txn_account": ("lineitem", "orders"),
            "card_txn": ("events",), "crm_interaction": ("events",),
        }[entity]
        return getattr(bank, entity)(*[self.raw(t) for t in inputs])

    def snapshot(self, entity: str, day: dt.date) -> DataFrame:
        """A master feed as delivered for a day."""
        second = day > self.base
        if entity in SCD1:
            return bank.scd1_day(self.feed(entity), *SCD1[entity], second)
        return bank.second_day(entity, self.feed(entity), self.deletes) if second else self.feed(entity)

    # stored tables

    def stored(self, name: str, build: Callable[[], DataFrame], partition: str | None = None) -> DataFrame:
        with self._lock:
            if name not in self._stored:
                rows, path = build(), f"{self.root}/{name}"
                writer = rows.write.option("compression", "zstd")
                (writer.partitionBy(partition) if partition else writer).parquet(path)
                self._stored[name] = self.spark.read.schema(rows.schema).parquet(path)
            return self._stored[name]

    def baseline(self, entity: str) -> DataFrame:
        return history.open_versions(self.snapshot(entity, self.base), history.DIMENSIONS[entity], self.base)

    def versions(self, entity: str) -> DataFrame:
        """The history after both days, as a plan; keys are computed after its join, so that their digits are not shuffled."""
        spec = history.DIMENSIONS[entity]
        before = self.baseline(entity).withColumn(spec.sk, F.lit(None).cast("string"))
        rows = history.apply_snapshot(before, self.snapshot(entity, self.day), spec, self.day)
        return rows.withColumn(spec.sk, surrogate_key(spec.keys, F.col(history.FROM)))

    def dim(self, entity: str) -> DataFrame:
        spec = history.DIMENSIONS[entity]
        rows = self.stored(f"dim_{entity}", lambda: self.versions(entity).drop(spec.sk))
        return rows.withColumn(spec.sk, surrogate_key(spec.keys, F.col(history.FROM)))

    def dim_current(self, entity: str) -> DataFrame:
        """deposit, loan and card: current state after both days."""
        key = SCD1[entity][0]
        return self.stored(
            f"dim_{entity}",
            lambda: history.scd1_upsert(self.snapshot(entity, self.base), self.snapshot(entity, self.day), [key]),
        )

    def lookups(self, feed: str) -> list[asof.Lookup]:
        """The start of a version stands for its surrogate key, so that shuffles carry a date.

        Account events meet their order before, and the order names the customer: versions of customers come by the account.
        """
        starts = lambda d: self.dim(d).withColumn(f"{d}_sk", F.col(history.FROM))
        via = {}
        if feed == "txn_account":
            owners = self.raw("orders").select(F.col("o_orderkey").alias("account_id"), F.col("o_custkey").alias("customer_id"))
            via = {"customer": ("account_id", owners)}
        return [asof.Lookup(starts(d), f"{d}_id", f"{d}_sk", *via.get(d, ())) for d in asof.FACTS[feed].dimensions]

    def keyed(self, feed: str, fact: DataFrame) -> DataFrame:
        """A fact with surrogate keys for the starts that ``lookups`` gave it."""
        return asof.keyed(fact, asof.FACTS[feed])

    def _initial(self, feed: str) -> DataFrame:
        spec = asof.FACTS[feed]
        events = initial_history(self.feed(feed), spec.event)
        events = events.where(events.cob_dt < self.day)
        return asof.resolve(events, spec.event, self.lookups(feed), bootstrap=True).drop("last_updated")

    def _daily(self, feed: str) -> DataFrame:
        spec = asof.FACTS[feed]
        events = incremental_day(self.feed(feed), spec.event, self.day)
        return asof.resolve(events, spec.event, self.lookups(feed), day=self.day).drop("last_updated")

    def fact_initial(self, feed: str) -> DataFrame:
        """All days before the last one, early events resolved to the first version."""
        return self.keyed(feed, self._initial(feed))

    def fact_daily(self, feed: str) -> DataFrame:
        return self.keyed(feed, self._daily(feed))

    def fact(self, feed: str) -> DataFrame:
        """Each task writes its rows by date, so that a date filter skips pages and no shuffle is needed for it; the pipeline partitions the same rows by cob_dt."""
        spec = asof.FACTS[feed]
        rows = self.stored(spec.name, lambda: self._initial(feed).unionByName(self._daily(feed)).sortWithinPartitions("cob_dt"))
        return self.keyed(feed, rows)

    def activity_partials(self, source: str) -> DataFrame:
        """Per day and key, the days that any window of the two processing dates holds."""
        src = activity.SOURCES[source]
        back = src.spec().longest + (self.day - self.base).days
        recent = lambda: self.fact(src.fact).where(in_window(F.col("cob_dt"), self.day, back))
        return self.stored(f"activity_{source}_daily", lambda: src.partials(recent()))

    def activity_state(self, source: str, day: dt.date) -> DataFrame | None:
        """The first day's windows are added up once; the second day moves them on."""
        spec, parts = activity.SOURCES[source].spec(), self.activity_partials(source)
        if day == self.base:
            return self.stored(f"activity_{source}_base", lambda: rolling.state_of(parts, spec, day))
        if day == self.day:
            before = self.activity_state(source, self.base)
            return self.stored(f"activity_{source}_day", lambda: rolling.advance(before, parts, spec, self.base, day))
        return None

    def branch_months(self, day: dt.date) -> DataFrame | None:
        """Month rows of the second day: its month's state grows by the day's events, other months keep the first day's."""
        if day != self.day:
            return None
        fact, accounts = self.fact("txn_account"), self.dim("account")
        known = self.stored("branch_months_base", lambda: branch_months.state_of(branch_months.attributed(fact.where(F.col("cob_dt") <= F.lit(self.base)), accounts)))
        own = (F.col("txn_year") == day.year) & (F.col("txn_month") == day.month)
        grown = branch_months.merge(known.where(own), branch_months.state_of(branch_months.attributed(fact, accounts, day=day)))
        return branch_months.month_rows(known.where(~own).unionByName(grown))

    def silver(self) -> marts.Silver:
        """One set of frames, so that all marts of a day share the activity aggregates."""
        if self._silver is None:
            frames = {f"dim_{e}": partial(self.dim, e) for e in ("customer", "account", "branch")}
            frames |= {f"dim_{e}": partial(self.dim_current, e) for e in SCD1}
            frames |= {spec.name: partial(self.fact, feed) for feed, spec in asof.FACTS.items()}
            self._silver = LazySilver(frames, states=self.activity_state, months=self.branch_months)
        return self._silver

    def _by_start(self) -> marts.Silver:
        """The same frames for the marts, where the start of a customer's version stands for its surrogate key."""
        silver = self.silver()
        start = lambda: self.dim("customer").withColumn("customer_sk", F.col(history.FROM).cast("string"))
        return LazySilver(silver._frames | {"dim_customer": start}, silver, states=silver.states, months=silver.months)

    def _with_key(self, rows: DataFrame) -> DataFrame:
        """Rows of a mart with the surrogate key of their customer for the start that stands for it."""
        start = F.col("customer_sk") if "customer_sk" in rows.columns else None
        return rows if start is None else rows.withColumn("customer_sk", F.when(start.isNotNull(), surrogate_key([marts.KEY], start)))

    def _mart_by_start(self, name: str, day: dt.date) -> DataFrame:
        if name == "campaign_target":
            parts = [self._gold(n) for n in ("rfm_segment", "churn_prediction", "cross_sell_segment", "customer_360")]
            return marts.campaign_target(*parts, self.fact("crm_interaction"), day)
        return getattr(marts, name)(self._by_start(), day)

    def _gold(self, name: str) -> DataFrame:
        return self.stored(
            name, lambda: self._mart_by_start(name, self.base).unionByName(self._mart_by_start(name, self.day)), "cob_dt"
        )

    def _current(self) -> DataFrame:
        return self.stored("mart_customer_360", lambda: serving.current_mart(self._gold("customer_360"), self.day))

    def mart_plan(self, name: str, day: dt.date) -> DataFrame:
        """A gold table of one day, built from the stored silver tables."""
        return self._with_key(self._mart_by_start(name, day))

    def gold(self, name: str) -> DataFrame:
        """A gold table with both processing dates as partitions."""
        return self._with_key(self._gold(name))

    def mart(self) -> DataFrame:
        return self._with_key(self._current())

    def masked(self) -> DataFrame:
        return self._with_key(self.stored("mart_customer_360_masked", lambda: serving.mart_masked(self._current())))

    def dashboard(self) -> DataFrame:
        rows = self.stored(
            "mart_customer_360_dashboard",
            lambda: serving.dashboard_mart(self._gold("customer_360"), self._gold("campaign_target"), self.day),
            "cob_dt",
        )
        return self._with_key(rows)

    def tables(self) -> Mapping[str, DataFrame]:
        """The tables the data-quality checks name."""
        return Tables({
            **{f"dim_{e}": partial(self.dim, e) for e in history.DIMENSIONS},
            **{f"dim_{e}": partial(self.dim_current, e) for e in SCD1},
            **{asof.FACTS[f].name: partial(self.fact, f) for f in asof.FACTS},
            **{n: partial(self.gold, n) for n in ("rfm_segment", "churn_prediction", "cross_sell_segment", "campaign_target")},
            "mart_customer_360_history": partial(self.gold, "customer_360"),
            "mart_customer_360": self.mart,
            "mart_customer_360_masked": self.masked,
            "mart_customer_360_dashboard": self.dashboard,
        })

    def bronze(self, entity: str) -> DataFrame:
        """A feed with its processing date: both snapshots of a master table, or the whole event history."""
        if entity in asof.FACTS:
            return initial_history(self.feed(entity), asof.FACTS[entity].event)
        return full_snapshot(self.snapshot(entity, self.base), self.base).unionByName(
            full_snapshot(self.snapshot(entity, self.day), self.day)
        )


_LAKES: dict[tuple[str, str], Lake] = {}


def lake_for(spark: SparkSession, folder: str) -> Lake:
    """One lake per session and folder, so that stored tables are built once."""
    key = (spark.sparkContext.applicationId, folder.rstrip("/"))
    if key not in _LAKES:
        _LAKES[key] = Lake(spark, folder)
    return _LAKES[key]
