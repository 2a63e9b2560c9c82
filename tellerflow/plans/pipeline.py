"""The daily pipeline: layers in dependency order over stored tables, with an append-only run log."""

from __future__ import annotations

import datetime as dt
import functools
import threading
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerflow import schemas as S
from tellerflow.functions.columns import in_window
from tellerflow.operators import activity, asof, buckets, history, rolling, sinks
from tellerflow.plans import branch_months, marts, quality, serving
from tellerflow.sources.files import full_snapshot, incremental_day, initial_history

ERROR_TEXT = 4000  # longest error text kept in the run log
SCD1_KEYS = {"deposit": "deposit_id", "loan": "loan_id", "card": "card_id"}
SUMMARIES = ("balance_summary", "product_summary", "card_summary", "transaction_summary")
SEGMENTS = ("rfm_segment", "churn_prediction", "cross_sell_segment")
STRATEGIES = {"partitions": sinks.overwrite_partitions, "all": sinks.overwrite_all}


@dataclass(frozen=True)
class Gold:
    """A gold table made by the mart plan of its name, and how it is written."""

    name: str
    strategy: str = "partitions"

    def validate(self) -> "Gold":
        if not callable(getattr(marts, self.name, None)):
            raise ValueError(f"{self.name}: no mart plan of this name")
        if self.name not in S.TABLES:
            raise ValueError(f"{self.name}: no declared schema")
        if self.strategy not in STRATEGIES:
            raise ValueError(f"{self.name}: unknown write strategy {self.strategy!r}, known are {sorted(STRATEGIES)}")
        return self


GOLD = tuple(Gold(n) for n in (*SUMMARIES, "customer_360", "branch_monthly_summary", *SEGMENTS))


@functools.cache
def activity_tables(source: str) -> tuple[S.Table, S.Table]:
    """The partials of each day, and the state of each processing date."""
    src = activity.SOURCES[source]
    spec = src.spec()
    keys = (*spec.keys, "cob_dt")
    return (
        S.Table(f"activity_{source}_daily", spec.partial_ddl(src.keys, "TIMESTAMP_NTZ"), keys, "cob_dt"),
        S.Table(f"activity_{source}", spec.state_ddl(src.keys, "TIMESTAMP_NTZ"), keys, "cob_dt"),
    )


@dataclass(frozen=True)
class Job:
    name: str
    layer: str
    work: Callable[[], object]


@dataclass(frozen=True)
class Event:
    """One entry of the run log: R when a job starts, S or F when it ends."""

    job: str
    layer: str
    status: str
    at: dt.datetime
    error: str | None = None


@dataclass(frozen=True)
class Run:
    """The ids and the try number that a run's log entries carry."""

    pipeline: str
    scheduler: str
    attempt: int


@dataclass
class Pipeline:
    """Where the tables live and where the day's feeds come from.

    ``feed(entity, day)`` gives a master table's snapshot of a day, or an event
    table's whole history.
    """

    spark: SparkSession
    root: str
    feed: Callable[[str, dt.date], DataFrame]
    salt: str
    checks: list[quality.Check] = field(default_factory=lambda: list(quality.CHECKS))
    gold: tuple[Gold, ...] = GOLD
    parallel: int = 8  # jobs of one stage submitted to Spark at the same time
    _lock: threading.Lock = field(default_factory=threading.Lock)
    _open: dict[str, DataFrame] = field(default_factory=dict)
    _silver: dict[str, marts.Silver] = field(default_factory=dict)

    def __post_init__(self) -> None:
        """A wrong list of jobs or checks fails here, before Spark starts anything."""
        for job in self.gold:
            job.validate()
        quality.validate_list(self.checks)

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def read(self, layer: str, table: str) -> DataFrame:
        """A stored table; its files are listed once per write, not once per job that reads it."""
        path = self.path(layer, table)
        if path not in self._open:
            self._open[path] = buckets.read(self.spark, path)
        return self._open[path]

    def save(self, layer: str, table: str, write: Callable[[str], object]) -> None:
        """Write a table and forget its old file listing, and the frames that marts share if they may hold it."""
        path = self.path(layer, table)
        write(path)
        self._open.pop(path, None)
        if layer == "silver":
            with self._lock:
                self._silver.clear()

    def store(self, layer: str, table: str | S.Table, rows: DataFrame, write: Callable[[DataFrame, str], object]) -> None:
        """Write rows that have the table's declared columns and types."""
        name, declared = (table, S.TABLES[table]) if isinstance(table, str) else (table.name, table)
        checked = S.assert_schema(rows, declared)
        self.save(layer, name, lambda path: write(checked, path))

    # run log

    def tries(self, day: dt.date, run_id: str) -> int:
        """Attempts of a run so far, by its run log."""
        if not sinks.exists(self.spark, self.path("ops", "run_log")):
            return 0
        own = self.read("ops", "run_log").where((F.col("cob_dt") == F.lit(day)) & (F.col("pipeline_run_id") == run_id))
        return own.agg(F.coalesce(F.max("try_number"), F.lit(0))).first()[0]

    def log(self, events: list[Event], day: dt.date, run: "Run") -> None:
        """Append immutable events; ids grow with time, so the last event of a job is the one with the largest id."""
        now = dt.datetime.now()
        rows = [
            (
                int(now.timestamp() * 1_000_000) * 1000 + n, e.job, e.layer, e.job, e.status, e.at if e.status == "R" else None,
                None if e.status == "R" else e.at, day, run.scheduler, run.pipeline, run.attempt, e.error[:ERROR_TEXT] if e.error else None, now,
            )
            for n, e in enumerate(events)
        ]
        frame = self.spark.createDataFrame(rows, S.RUN_LOG_TABLE.struct).coalesce(1)
        self.save("ops", "run_log", lambda path: sinks.append(frame, path))

    @staticmethod
    def attempt(job: Job) -> tuple[Event, Exception | None]:
        """Run one job; its outcome is an event, and the failure if there was one."""
        try:
            job.work()
            return Event(job.name, job.layer, "S", dt.datetime.now()), None
        except Exception as error:  # noqa: BLE001 - logged, then raised by run()
            return Event(job.name, job.layer, "F", dt.datetime.now(), f"{type(error).__name__}: {error}"), error

    def run_stage(self, pool: ThreadPoolExecutor, stage: list[Job], day: dt.date, run: Run) -> None:
        """Jobs of one stage side by side, between their log events; the first failure stops the pipeline."""
        self.log([Event(j.name, j.layer, "R", dt.datetime.now()) for j in stage], day, run)
        outcomes = list(pool.map(self.attempt, stage))
        self.log([event for event, _ in outcomes], day, run)
        for _, failure in outcomes:
            if failure:
                raise failure

    # jobs

    def ingest(self, entity: str, day: dt.date, initial: bool) -> None:
        """A day replaces its own partition even when it is empty; the initial load fills all past days."""
        rows = self.feed(entity, day)
        if entity not in asof.FACTS:
            self.save("bronze", entity, lambda path: sinks.overwrite_day(full_snapshot(rows, day), path, day))
            return
        spec = asof.FACTS[entity]
        if initial:
            past = initial_history(rows, spec.event).where(F.col("cob_dt") <= F.lit(day))
            self.save("bronze", entity, lambda path: sinks.load_partitions(sinks.by_day(past, spec.key), path))
        else:
            self.save("bronze", entity, lambda path: sinks.overwrite_day(incremental_day(rows, spec.event, day), path, day))

    def bronze(self, entity: str, day: dt.date) -> DataFrame:
        return self.read("bronze", entity).where(F.col("cob_dt") == F.lit(day)).drop("cob_dt")

    def versioned(self, entity: str, day: dt.date) -> None:
        """Guards, the changed buckets of the history written again, history and source compared afterwards."""
        spec, table = history.DIMENSIONS[entity].validate(), f"dim_{entity}"
        snapshot, path = self.bronze(entity, day), self.path("silver", table)
        checked = lambda rows: S.assert_schema(rows, S.TABLES[table])
        history.guard_source(snapshot, spec)
        if not sinks.exists(self.spark, path):
            first = checked(history.open_versions(snapshot, spec, day))
            self.save("silver", table, lambda to: buckets.save_history(first, to, spec.keys))
        else:
            history.guard_backdated(self.read("silver", table), spec, day)
            self.save("silver", table, lambda to: buckets.save_history_day(to, snapshot, spec, day, checked))
        history.guard_history(history.day_slice(self.read("silver", table), day), spec, snapshot)

    def verify_dimensions(self) -> None:
        """All history rules over all versions ever; a job of its own, as a day checks only what it can change."""
        for entity, spec in history.DIMENSIONS.items():
            history.guard_history(self.read("silver", f"dim_{entity}"), spec)

    def current_state(self, entity: str, day: dt.date) -> None:
        table, snapshot = f"dim_{entity}", self.bronze(entity, day)
        checked = lambda rows: S.assert_schema(rows, S.TABLES[table])
        self.save("silver", table, lambda path: buckets.save_current(path, snapshot, [SCD1_KEYS[entity]], checked))

    def fact(self, feed: str, day: dt.date, initial: bool) -> None:
        spec = asof.FACTS[feed].validate()
        # The start of a version stands for its surrogate key until the rows are in place, so that shuffles carry a date.
        starts = lambda d: self.read("silver", f"dim_{d}").withColumn(f"{d}_sk", F.col(history.FROM))
        lookups = [asof.Lookup(starts(d), f"{d}_id", f"{d}_sk") for d in spec.dimensions]
        events = self.read("bronze", feed)
        if not initial:
            events = events.where(F.col("cob_dt") == F.lit(day))
        resolved = asof.resolve(events, spec.event, lookups, bootstrap=initial, day=None if initial else day)
        rows = sinks.durable(resolved.drop("last_updated"), spec.name)
        asof.guard_fact(rows, spec, None if initial else day)
        if initial:
            self.store("silver", spec.name, asof.keyed(sinks.by_day(rows, spec.key), spec), sinks.load_partitions)
        else:
            self.store("silver", spec.name, asof.keyed(rows, spec), lambda checked, path: sinks.overwrite_day(checked, path, day))

    def roll(self, source: str, day: dt.date, initial: bool) -> None:
        """The day's partials, and the state moved on from the day before; the first load adds up whole windows."""
        src, (daily, state) = activity.SOURCES[source], activity_tables(source)
        spec, fact = src.spec(), self.read("silver", asof.FACTS[src.fact].name)
        if initial:
            rows = sinks.durable(src.partials(fact.where(in_window(F.col("cob_dt"), day, spec.longest))), daily.name)
            self.store("silver", daily, rows, lambda checked, path: sinks.load_partitions(sinks.by_day(checked, spec.keys[0]), path))
        else:
            rows = src.partials(fact.where(F.col("cob_dt") == F.lit(day)))
            self.store("silver", daily, rows, lambda checked, path: sinks.overwrite_day(checked, path, day))
        parts, before = self.read("silver", daily.name), None
        if sinks.exists(self.spark, self.path("silver", state.name)):
            known = self.read("silver", state.name)
            before = known.where(F.col("cob_dt") < F.lit(day)).agg(F.max("cob_dt")).first()[0]
        if before:
            after = rolling.advance(known.where(F.col("cob_dt") == F.lit(before)), parts, spec, before, day)
        else:
            after = rolling.state_of(parts, spec, day)
        self.store("silver", state, after, lambda checked, path: sinks.overwrite_day(checked, path, day))

    def grow_months(self, day: dt.date, initial: bool) -> None:
        """The state of the day's month grows by the day's events; the first load makes the states of all months."""
        fact, accounts = self.read("silver", "fact_txn_account"), self.read("silver", "dim_account")
        if initial:
            state = branch_months.state_of(branch_months.attributed(fact.where(F.col("cob_dt") <= F.lit(day)), accounts))
        else:
            state = branch_months.state_of(branch_months.attributed(fact, accounts, day=day))
            if sinks.exists(self.spark, self.path("silver", branch_months.STATE.name)):
                own = (F.col("txn_year") == day.year) & (F.col("txn_month") == day.month)
                known = branch_months.latest(self.read("silver", branch_months.STATE.name).where(own), day - dt.timedelta(days=1))
                state = branch_months.merge(known, state)
        self.store_months(sinks.durable(state, branch_months.STATE.name), day)

    def store_months(self, state: DataFrame, day: dt.date) -> None:
        """Write a day's states and their month rows; months it does not hold keep those of an earlier day."""
        for table, rows in ((branch_months.STATE, state), (branch_months.ROWS, branch_months.month_rows(state))):
            self.store("silver", table, rows.withColumn("cob_dt", F.lit(day)), lambda checked, path: sinks.overwrite_day(checked, path, day))

    def rebuild_months(self, days: list[dt.date], day: dt.date) -> None:
        """States as of ``day`` of the months of ``days``, from those months' events alone; for events that changed or went."""
        months = sorted({(d.year, d.month) for d in days})
        own = F.struct("txn_year", "txn_month").isin([F.struct(F.lit(y), F.lit(m)) for y, m in months])
        span = [F.col("cob_dt").between(F.lit(dt.date(y, m, 1)), F.last_day(F.lit(dt.date(y, m, 1)))) for y, m in months]
        inside = functools.reduce(lambda a, b: a | b, span) & (F.col("cob_dt") <= F.lit(day))
        events = branch_months.attributed(self.read("silver", "fact_txn_account").where(inside), self.read("silver", "dim_account"))
        others = self.read("silver", branch_months.STATE.name).where((F.col("cob_dt") == F.lit(day)) & ~own).drop("cob_dt")
        state = branch_months.state_of(events).unionByName(branch_months.emptied(self.spark, months)).unionByName(others)
        self.store_months(sinks.durable(state, branch_months.STATE.name), day)

    def month_rows(self, day: dt.date) -> DataFrame | None:
        """Each month's stored rows as of a day, or None before the first load."""
        if not sinks.exists(self.spark, self.path("silver", branch_months.ROWS.name)):
            return None
        return branch_months.latest(self.read("silver", branch_months.ROWS.name), day)

    def correct(self, feed: str, days: list[dt.date], day: dt.date) -> None:
        """Load past days of an event feed again, and put right what is carried from day to day as of ``day``: activity
        without adding up its windows, branch months from the events of the months touched."""
        with sinks.scratch(self.spark, "correction"):
            for late in days:
                self.ingest(feed, late, False)
                self.fact(feed, late, False)
            for source, src in activity.SOURCES.items():
                if src.fact != feed:
                    continue
                daily, state = activity_tables(source)
                spec, late = src.spec(), F.col("cob_dt").isin(days)
                old = sinks.durable(self.read("silver", daily.name).where(late), daily.name)
                new = sinks.durable(src.partials(self.read("silver", asof.FACTS[feed].name).where(late)), daily.name)
                for d in days:
                    self.store("silver", daily, new, lambda checked, path, d=d: sinks.overwrite_day(checked, path, d))
                known = self.read("silver", state.name).where(F.col("cob_dt") == F.lit(day))
                after = sinks.durable(rolling.correct(known, old, new, self.read("silver", daily.name), spec, days, day), state.name)
                self.store("silver", state, after, lambda checked, path: sinks.overwrite_day(checked, path, day))
            if feed == "txn_account":
                self.rebuild_months(days, day)

    def activity_state(self, source: str, day: dt.date) -> DataFrame | None:
        """The stored state of a day, or None where the day has none."""
        table = activity_tables(source)[1].name
        if not sinks.exists(self.spark, self.path("silver", table)):
            return None
        rows = self.read("silver", table).where(F.col("cob_dt") == F.lit(day))
        return None if rows.isEmpty() else rows

    def silver(self) -> marts.Silver:
        dims = [self.read("silver", f"dim_{d}") for d in ("customer", "account", "branch", "deposit", "loan", "card")]
        return marts.Silver(*dims, *[self.read("silver", f.name) for f in asof.FACTS.values()], states=self.activity_state, months=self.month_rows)

    def silver_of(self, run_id: str) -> marts.Silver:
        """One set of frames per run, so that its marts share the activity aggregates."""
        with self._lock:
            if run_id not in self._silver:
                self._silver = {run_id: self.silver()}
            return self._silver[run_id]

    def mart(self, job: Gold, day: dt.date, silver: marts.Silver) -> None:
        self.store("gold", job.name, getattr(marts, job.name)(silver, day), STRATEGIES[job.strategy])

    def campaign(self, day: dt.date) -> None:
        inputs = [self.read("gold", n) for n in (*SEGMENTS, "customer_360")]
        rows = marts.campaign_target(*inputs, self.read("silver", "fact_crm_interaction"), day)
        self.store("gold", "campaign_target", rows, sinks.overwrite_partitions)

    def publish_current(self, day: dt.date) -> None:
        current = serving.current_mart(self.read("gold", "customer_360"), day)
        self.store("gold", "mart_customer_360", current, sinks.overwrite_all)

    def mask(self, day: dt.date) -> None:
        masked = serving.customer_masked(self.read("silver", "dim_customer"), day, self.salt)
        self.store("sandbox", "dim_customer_masked", masked, sinks.overwrite_all)
        mart = serving.mart_masked(self.read("gold", "mart_customer_360"))
        self.store("sandbox", "mart_customer_360_masked", mart, sinks.overwrite_all)
        rows = serving.dashboard_mart(self.read("gold", "customer_360"), self.read("gold", "campaign_target"), day)
        self.store("sandbox", "mart_customer_360_dashboard", rows, lambda checked, path: serving.publish_dashboard(checked, path, day))

    def tables(self) -> dict[str, DataFrame]:
        out = {f"dim_{d}": self.read("silver", f"dim_{d}") for d in (*history.DIMENSIONS, *SCD1_KEYS)}
        out |= {f.name: self.read("silver", f.name) for f in asof.FACTS.values()}
        out |= {n: self.read("gold", n) for n in (*SEGMENTS, "campaign_target", "mart_customer_360")}
        out["mart_customer_360_history"] = self.read("gold", "customer_360")
        out |= {n: self.read("sandbox", n) for n in ("mart_customer_360_masked", "mart_customer_360_dashboard")}
        return out

    def check(self, day: dt.date, run_id: str) -> None:
        """Results are stored before the gate may raise."""
        results = quality.run_checks(self.checks, self.tables(), day, run_id, f"dq-{run_id}")
        stored = quality.result_frame(self.spark, results).coalesce(1)
        self.save("ops", "dq_result", lambda path: sinks.append(stored, path))
        quality.gate(results)

    def run(self, day: dt.date, run_id: str, initial: bool = False, scheduler_run: str | None = None, verify: bool = False) -> None:
        """All layers of one processing date, in dependency order; stops after the first stage with a failure.

        Jobs of one stage do not depend on each other and are submitted side by
        side. A run id may be used again to repeat a run: its log entries then
        carry the next try number. ``verify`` checks whole histories as well, not
        only what the day can change. Intermediate tables go when the run ends.
        """
        facts = asof.FACTS
        stages = [
            [Job(f"bronze_{e}", "bronze", lambda e=e: self.ingest(e, day, initial)) for e in S.FEEDS],
            [Job(f"dim_{e}", "silver", lambda e=e: self.versioned(e, day)) for e in history.DIMENSIONS]
            + [Job(f"dim_{e}", "silver", lambda e=e: self.current_state(e, day)) for e in SCD1_KEYS],
            [Job(facts[f].name, "silver", lambda f=f: self.fact(f, day, initial)) for f in facts],
            [Job(f"activity_{a}", "silver", lambda a=a: self.roll(a, day, initial)) for a in activity.SOURCES]
            + [Job("branch_months", "silver", lambda: self.grow_months(day, initial))],
            [Job(g.name, "gold", lambda g=g: self.mart(g, day, self.silver_of(run_id))) for g in self.gold],
            [Job("mart_customer_360", "gold", lambda: self.publish_current(day)), Job("campaign_target", "gold", lambda: self.campaign(day))],
            [Job("masking", "sandbox", lambda: self.mask(day))],
            [Job("data_quality", "ops", lambda: self.check(day, run_id))] + [Job("verify_dimensions", "ops", self.verify_dimensions)] * verify,
        ]
        run = Run(run_id, scheduler_run or run_id, self.tries(day, run_id) + 1)
        try:
            with sinks.scratch(self.spark, "run"), ThreadPoolExecutor(self.parallel) as pool:
                for stage in stages:
                    self.run_stage(pool, stage, day, run)
        finally:
            self._silver.clear()  # its frames may read intermediate tables
