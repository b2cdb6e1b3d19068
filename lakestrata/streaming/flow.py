"""The incremental flow: files to raw, raw to staging, staging to warehouse, marts.

What a step has taken is part of the published state, next to the tables it changed: a
ledger of files, a queue of landed snapshots not yet staged, versions of a step's inputs.  A step
looks there first, which keeps idle cycles free, and all it does becomes visible at once.  An
outside scheduler decides when to call a cycle, or ``follow`` does.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime, timedelta
from functools import partial, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.config import LINEAGE, Dimension, Entity, Fact, Model
from lakestrata.functions.scalar import run_id, ts
from lakestrata.operators import audit, checks, dedupe, fact, merge, scd2
from lakestrata.plans.marts import is_stale
from lakestrata.plans.staging import stage_delta, stage_full
from lakestrata.session import materialize, side_by_side, working_tables
from lakestrata.sources import files, landing
from lakestrata.sources.buckets import Buckets
from lakestrata.sources.store import FOLD, Store

AUDIT = "etl_audit_log"
HISTORY = "load_history"
HISTORY_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("load_time", T.TimestampNTZType()),
        T.StructField("status", T.StringType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("error_count", T.LongType()),
        T.StructField("first_error", T.StringType()),
    ]
)
LEDGER = "ingest_ledger"
# Fixed value: how long a file's name is refused after it was loaded.
REMEMBER = timedelta(days=14)
# Bulk-loaded rows are batch -1; before anything reached staging, no batch has.
BULK, NOTHING = -1, -2


def _tidied(step: Callable) -> Callable:
    """A step that leaves nothing in ``_work`` below the flow's root, where its working
    tables are made."""

    @wraps(step)
    def run(self, *args, **options):
        with working_tables(self.spark, f"{self.root}/_work"):
            return step(self, *args, **options)

    return run


class Flow:
    """One model's tables under ``root``, fed from ``inbox/<entity>`` folders.

    An entry of an inbox folder, a file or a folder of part files moved there whole, is one
    snapshot.  Snapshots land and are staged one at a time, in the order of their last change.

    ``remember``: a file's path is refused that long after it was loaded, then it is new again.
    ``dedupe="latest"``: of several rows of a key in one snapshot the last one, by file and row
    number, counts; without it they raise ``DuplicateKeyError``.
    ``buckets``: into how many parts by key the current rows of dimensions and the fact table
    are cut; a cycle rewrites those parts that rows change in.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        inbox: str,
        model: Model,
        now: Callable[[], datetime] = datetime.now,
        remember: timedelta = REMEMBER,
        dedupe: str | None = None,
        buckets: int = 64,
        short_rows: str = landing.REJECT,
        long_rows: str = landing.REJECT,
    ):
        if dedupe not in (None, "latest"):
            raise ValueError(f"dedupe={dedupe!r}")
        self.spark, self.root, self.inbox = spark, root.rstrip("/"), inbox.rstrip("/")
        self.model, self.now = model, now
        self.remember, self.dedupe, self.n_buckets = remember, dedupe, buckets
        self.shapes = {"short_rows": short_rows, "long_rows": long_rows}
        schemas = {
            AUDIT: audit.AUDIT_SCHEMA,
            HISTORY: HISTORY_SCHEMA,
            LEDGER: landing.LEDGER_SCHEMA,
            **model.schemas,
        }
        for entity in model.entities:
            schemas[entity.raw_table] = self.raw_schema(entity)
            schemas[self.reject_table(entity)] = landing.REJECT_SCHEMA
        for spec in model.dimensions:
            schemas[f"{spec.table}_history"] = model.schemas[spec.table]
        self.store = Store(spark, root, schemas)

    def buckets(self, spec: Dimension | Fact) -> Buckets:
        return Buckets(self.store, spec.table, spec.key, spec.surrogate, self.n_buckets)

    # -- raw -----------------------------------------------------------------------

    def raw_schema(self, entity: Entity) -> T.StructType:
        return T.StructType(
            [
                *entity.text_schema.fields,
                *LINEAGE.fields,
                T.StructField("load_status", T.StringType()),
                T.StructField("batch_id", T.LongType()),
            ]
        )

    def reject_table(self, entity: Entity) -> str:
        return f"rejects_{entity.name}"

    def raw(self, entity: Entity) -> DataFrame:
        """Raw rows with the load status the queue gives them."""
        done = self.store.meta(f"consumed:{entity.name}", NOTHING)
        return landing.with_load_status(self.store.read(entity.raw_table), done)

    def rejects(self, entity: Entity) -> DataFrame:
        return self.store.read(self.reject_table(entity))

    def queue(self, entity: Entity) -> list[list]:
        """Landed snapshots not yet staged, oldest first: [batch, folder of its raw rows]."""
        return self.store.meta(f"queue:{entity.name}", [])

    @_tidied
    def land(self, entity: Entity, run_ts: datetime, run: str | None = None) -> bool:
        """Take in snapshots of files not loaded before; False if there were none."""
        folder = f"{self.inbox}/{entity.name}"
        if not self.store.exists(folder):
            return False
        fresh = landing.new_files(
            files.list_files(self.spark, folder),
            self.store.read(LEDGER),
            entity.raw_table,
            run_ts - self.remember,
        )
        # The new files have to be named to the reader by the driver; old ones stay out.
        snapshots = files.snapshots(fresh.collect(), folder)
        for listed in snapshots:
            self._land_one(entity, listed, folder, run_ts, run or run_id(run_ts))
        return bool(snapshots)

    def _land_one(
        self, entity: Entity, listed: list, home: str, run_ts: datetime, run: str
    ) -> None:
        start, step = self.now(), self.model.steps[entity.raw_table]
        batch = self.store.meta(f"landed:{entity.name}", -1) + 1
        raw_path, bad_path, history = self._write_landed(entity, batch, listed, home, run_ts)
        ledger = landing.ledger_rows(self.spark, listed, entity.raw_table, batch, run_ts)
        self._publish(
            step,
            start,
            run,
            (self._row_count(history), 0, 0),
            append={
                entity.raw_table: [raw_path],
                self.reject_table(entity): [bad_path],
                HISTORY: [history],
                LEDGER: [self.store.write(LEDGER, ledger)],
            },
            meta={
                f"landed:{entity.name}": batch,
                f"queue:{entity.name}": [*self.queue(entity), [batch, raw_path]],
            },
        )

    def _write_landed(
        self, entity: Entity, batch: int, listed: list, home: str, run_ts: datetime
    ) -> tuple[str, str, str]:
        """Folders of raw rows, rejects and history; nobody sees them before they are published."""
        paths = [r["path"] for r in listed] or [home]
        feed = files.read_feed(self.spark, paths, entity, home)
        names = self.spark.createDataFrame([(r["path"],) for r in listed], "path string").select(
            files.file_name(F.col("path"), home).alias("_source_file")
        )
        landed = landing.land(feed, entity, run_ts, **self.shapes)
        numbered = landed.raw.withColumn("batch_id", F.lit(batch).cast("bigint"))
        raw_path = self.store.write(entity.raw_table, numbered)
        bad_path = self.store.write(self.reject_table(entity), landed.rejects)
        history = landing.load_history(
            self.model.steps[entity.raw_table].target,
            self.spark.read.schema(self.raw_schema(entity)).parquet(raw_path),
            self.spark.read.schema(landing.REJECT_SCHEMA).parquet(bad_path),
            names,
            run_ts,
        )
        return raw_path, bad_path, self.store.write(HISTORY, history)

    def _row_count(self, history: str) -> int:
        written = self.spark.read.schema(HISTORY_SCHEMA).parquet(history)
        return written.agg(F.sum("row_count")).first()[0] or 0

    @_tidied
    def bulk_load(self, entity: Entity, path: str, run_ts: datetime) -> None:
        """Replace raw with all rows of ``path``, loaded before or not.  They are new until
        ``build`` takes them to staging; the load is in history and audit.  Landed snapshots
        that still wait in the queue stay."""
        start, step = self.now(), self.model.steps[entity.raw_table]
        listed = files.list_files(self.spark, path).select("path").collect()
        raw_path, bad_path, history = self._write_landed(entity, BULK, listed, path, run_ts)
        self._publish(
            step,
            start,
            run_id(run_ts),
            (self._row_count(history), 0, 0),
            replace={
                entity.raw_table: [raw_path, *[folder for _, folder in self.queue(entity)]],
                self.reject_table(entity): [bad_path],
            },
            append={HISTORY: [history]},
            meta={f"consumed:{entity.name}": NOTHING},
        )

    # -- staging ---------------------------------------------------------------------

    @_tidied
    def stage(self, entity: Entity, run_ts: datetime, run: str | None = None) -> bool:
        """Merge the snapshots that wait into staging, one after the other, each with its
        deletions; False if there was nothing to merge."""
        merged = False
        for batch, folder in self.queue(entity):
            merged |= self._stage_one(entity, batch, folder, run_ts, run or run_id(run_ts))
        return merged

    def _stage_one(
        self, entity: Entity, batch: int, folder: str, run_ts: datetime, run: str
    ) -> bool:
        start = self.now()
        table, step = entity.staging_table, self.model.steps[entity.staging_table]
        rows = self.spark.read.schema(self.raw_schema(entity)).parquet(folder)
        # Its place in the queue and its rows in staging are given up and taken in one.
        taken = {
            f"queue:{entity.name}": [q for q in self.queue(entity) if q[0] != batch],
            f"consumed:{entity.name}": batch,
        }
        if rows.isEmpty():
            self.store.publish(meta=taken)
            return False
        if self.dedupe:
            rows = dedupe.latest_rows(rows, F.trim(entity.key), ("_source_file", "_file_row_number"))
        typed = materialize(stage_delta(rows, entity, run_ts))
        path = self.store.new_path(table)
        watched = audit.Watched(step)
        target = self.store.read(table)
        changes = merge.merge(
            target, typed, entity.key, delete_missing=True, whole_deletes=False
        )
        materialize(watched(changes), partition_by=merge.OP, path=path)
        kept = (merge.INSERT, merge.UPDATE, merge.KEEP)
        self._publish(
            step,
            start,
            run,
            watched.counts,
            replace={table: [f"{path}/{merge.OP}={kind}" for kind in kept]},
            meta=taken,
        )
        return True

    # -- warehouse -------------------------------------------------------------------

    def dimension(self, spec: Dimension) -> DataFrame:
        """All versions: the current ones and the closed ones."""
        return self.store.read(f"{spec.table}_history").unionByName(self.store.read(spec.table))

    @_tidied
    def load_dimension(
        self, spec: Dimension, clock: scd2.Clock, run: str | None = None, **options
    ) -> None:
        """An SCD2 cycle.  Only current rows are read, and only buckets with a changed row
        rewritten; closed rows are appended to the history, which is never touched again."""
        start, step = self.now(), self.model.steps[spec.table]
        top = self.store.meta(f"top:{spec.table}", 0)
        path, watched = self.store.new_path(f"{spec.table}_history"), audit.Watched(step)
        result = scd2.scd2_apply(
            self.store.read(spec.table),
            self.store.read(f"stg_{spec.name}"),
            spec,
            clock,
            start_key=top,
            path=path,
            kept=False,
            watch=watched,
            **options,
        )
        coming = materialize(result.new_versions)
        state = self.buckets(spec).change(result.newly_closed, coming)
        self._publish(
            step,
            start,
            run or run_id(clock.run_ts),
            watched.counts,
            replace=state["replace"],
            append={f"{spec.table}_history": [f"{path}/{merge.OP}={scd2.CLOSE}"]},
            meta={
                **state["meta"],
                f"top:{spec.table}": top + coming.count(),
                f"from:{spec.table}": self.store.version(f"stg_{spec.name}"),
            },
        )

    @_tidied
    def load_fact(self, clock: scd2.Clock, run: str | None = None, initial: bool = False) -> None:
        """A cycle of the fact table, or its first load."""
        spec = self.model.fact
        start, step = self.now(), self.model.steps[spec.table]
        top = self.store.meta(f"top:{spec.table}", 0)
        apply = fact.fact_initial if initial else fact.fact_apply
        options = {"load_time_as_source": False} if initial else {}
        watched = audit.Watched(step)
        result = apply(
            self.store.read(spec.table),
            self.store.read(f"stg_{spec.name}"),
            {d.table: self.store.read(d.table) for d in self.model.dimensions},
            spec,
            clock,
            start_key=top,
            kept=False,
            watch=watched,
            **options,
        )
        fresh = materialize(result.new_rows)
        changed = result.changes.where(F.col(merge.OP) != merge.INSERT).select(*fresh.columns)
        state = self.buckets(spec).change(changed, changed.unionByName(fresh))
        self._publish(
            step,
            start,
            run or run_id(clock.run_ts),
            watched.counts,
            replace=state["replace"],
            meta={
                **state["meta"],
                f"top:{spec.table}": top + fresh.count(),
                f"from:{spec.table}": self._fact_inputs(),
            },
        )

    def _fact_inputs(self) -> list[int]:
        names = [f"stg_{self.model.fact.name}", *[d.table for d in self.model.dimensions]]
        return [self.store.version(n) for n in names]

    @_tidied
    def build(self, run_ts: datetime, run_date: date) -> None:
        """First load: staging from all raw rows, then dimensions, then the fact table."""
        clock = scd2.Clock(run_date, run_ts)
        for entity in self.model.entities:
            full = stage_full(self.raw(entity), entity, run_ts)
            table = entity.staging_table
            taken = self.raw(entity).agg(F.max("batch_id").alias("top")).first()["top"]
            self.store.publish(
                replace={table: [self.store.write(table, full)]},
                meta={
                    f"consumed:{entity.name}": NOTHING if taken is None else taken,
                    f"queue:{entity.name}": [],
                },
            )
        for spec in self.model.dimensions:
            self.load_dimension(
                spec,
                clock,
                compare=spec.initial_compare,
                close_missing=False,
                reopen=False,
            )
        self.load_fact(clock, initial=True)

    def register_views(self) -> None:
        """Temporary views of all tables: raw with load status, dimensions with all
        their versions, marts, logs, and the summary of runs."""
        self.store.register_views()
        for entity in self.model.entities:
            self.raw(entity).createOrReplaceTempView(entity.raw_table)
        for spec in self.model.dimensions:
            self.dimension(spec).createOrReplaceTempView(spec.table)
        summary = audit.audit_summary(self.store.read(AUDIT))
        summary.createOrReplaceTempView("etl_pipeline_summary")

    # -- marts and cycle ---------------------------------------------------------------

    @_tidied
    def refresh_marts(self, now: datetime, lag: timedelta = timedelta(hours=1)) -> list[str]:
        """Recompute the marts older than ``lag`` whose inputs have changed since."""
        done = []
        inputs = [self.model.fact.table, *[d.table for d in self.model.dimensions]]
        versions = [self.store.version(n) for n in inputs]
        for name, plan in self.model.marts.items():
            if not is_stale(self.store.refreshed(name), now, lag):
                continue
            if self.store.meta(f"from:{name}") == versions:
                self.store.publish(meta={f"refreshed:{name}": now.isoformat()})
            else:
                tables = [self.store.read(d.table) for d in self.model.dimensions]
                df = plan(self.store.read(self.model.fact.table), *tables)
                self.store.schemas[name] = df.schema
                self.store.publish(
                    replace={name: [self.store.write(name, df)]},
                    meta={f"refreshed:{name}": now.isoformat(), f"from:{name}": versions},
                )
                done.append(name)
        return done

    @_tidied
    def run_cycle(self, run_ts: datetime, run_date: date | None = None) -> dict[str, str]:
        """One pass over all steps, in order; what became of each.

        A failing step is recorded and raised, and leaves every table as it was.
        """
        outcome = self._run_steps(run_ts, run_date)
        self.refresh_marts(run_ts)
        self.tidy()
        return outcome

    def _run_steps(self, run_ts: datetime, run_date: date | None) -> dict[str, str]:
        clock = scd2.Clock(run_date or run_ts.date(), run_ts)
        run = run_id(run_ts)
        outcome = {}

        def dimension(spec: Dimension) -> bool:
            seen = self.store.meta(f"from:{spec.table}", 0)
            if seen == self.store.version(f"stg_{spec.name}"):
                return False
            self.load_dimension(spec, clock, run)
            return True

        def facts() -> bool:
            inputs = self._fact_inputs()
            if not any(inputs) or self.store.meta(f"from:{self.model.fact.table}") == inputs:
                return False
            self.load_fact(clock, run)
            return True

        entities, dimensions = self.model.entities, self.model.dimensions
        stages = [
            {e.raw_table: lambda e=e: self.land(e, run_ts, run) for e in entities},
            {e.staging_table: lambda e=e: self.stage(e, run_ts, run) for e in entities},
            {s.table: lambda s=s: dimension(s) for s in dimensions},
            {self.model.fact.table: facts},
        ]
        for steps in stages:
            side_by_side(
                self.spark, *[partial(self._step, t, w, run, outcome) for t, w in steps.items()]
            )
        return outcome

    def follow(self, every: str = "5 minutes") -> StreamingQuery:
        """Run a cycle now, then one as often as said until the query is stopped.  A tick says
        only that time has passed; what is new, the published state tells."""
        self.run_cycle(self.now())
        ticks = self.spark.readStream.format("rate").load()
        return (
            ticks.writeStream.foreachBatch(lambda rows, batch: self.run_cycle(self.now()))
            .trigger(processingTime=every)
            .start()
        )

    def tidy(self) -> None:
        """Fold small folders of appended tables.  Old folders stay until ``store.vacuum``."""
        for table in (AUDIT, HISTORY, *[f"{d.table}_history" for d in self.model.dimensions]):
            self.store.compact(table)
        self._forget()

    def _forget(self) -> None:
        """Write the ledger anew without the names that are new again."""
        if len(self.store.manifest()["tables"].get(LEDGER, [])) >= FOLD:
            since = ts(self.now() - self.remember)
            held = self.store.read(LEDGER).where(F.col("loaded_at") >= since)
            self.store.publish(replace={LEDGER: [self.store.write(LEDGER, held)]})

    # -- repair and checks ---------------------------------------------------------------

    @_tidied
    def check(self) -> DataFrame:
        """(check_name, table_name, n): how many keys or rows each check finds at fault in the
        published tables.  Nothing is changed."""
        model, found = self.model, []

        def add(check: str, table: str, faulty: DataFrame) -> None:
            found.append((check, table, faulty.count()))

        for entity in model.entities:
            staged = self.store.read(entity.staging_table)
            add("duplicate keys", entity.staging_table, checks.duplicates(staged, entity.key))
        fact_table = self.store.read(model.fact.table)
        add("duplicate keys", model.fact.table, checks.duplicates(fact_table, model.fact.key))
        for spec in model.dimensions:
            current, versions = self.store.read(spec.table), self.dimension(spec)
            add("duplicate keys", spec.table, checks.duplicates(current, spec.key))
            add("overlapping versions", spec.table, checks.overlaps(versions, spec.key, spec.surrogate))
            add("orphans", model.fact.table, checks.orphans(fact_table, versions, spec.surrogate))
        return self.spark.createDataFrame(found, "check_name string, table_name string, n bigint")

    @_tidied
    def repair(self, run_ts: datetime) -> dict[str, int]:
        """Keep the newest current row of each key in dimensions and fact table, by surrogate
        key; how many rows went from each table.  Each table is published with an audit row."""
        gone = {}
        for spec in (*self.model.dimensions, self.model.fact):
            start = self.now()
            rows = self.store.read(spec.table)
            step = replace(self.model.steps[spec.table], operation="DEDUPLICATE")
            keep = dedupe.keep_latest if spec is self.model.fact else dedupe.keep_latest_current
            stay = keep(rows, spec.key, spec.surrogate).select(spec.surrogate)
            leaving = materialize(rows.join(stay, spec.surrogate, "left_anti").where(
                F.col(spec.surrogate).isNotNull()
            ))
            gone[spec.table] = leaving.count()
            if gone[spec.table]:
                state = self.buckets(spec).change(leaving, leaving.limit(0))
                self._publish(step, start, run_id(run_ts), (0, 0, gone[spec.table]), **state)
        return gone

    @_tidied
    def backfill(self, run_ts: datetime, run_date: date, days: int = 1) -> None:
        """Move the end of closed versions back by ``days``, and let current ones begin on the
        run date; each table is published with an audit row."""
        for spec in self.model.dimensions:
            start, history = self.now(), f"{spec.table}_history"
            step = replace(self.model.steps[spec.table], operation="BACKFILL")
            closed = scd2.shift_closed_end(self.store.read(history), days)
            current = scd2.reset_current_start(self.store.read(spec.table), run_date)
            state = self.buckets(spec).change(self.store.read(spec.table), materialize(current))
            folder = self.store.write(history, closed)
            changed = self.spark.read.schema(self.store.schemas[history]).parquet(folder).count()
            self._publish(
                step,
                start,
                run_id(run_ts),
                (0, changed + self.store.read(spec.table).count(), 0),
                replace={**state["replace"], history: [folder]},
                meta=state["meta"],
            )

    # -- shared ------------------------------------------------------------------------

    def _step(
        self,
        table: str,
        work: Callable[[], bool],
        run: str,
        outcome: dict[str, str],
    ) -> None:
        start, step = self.now(), self.model.steps[table]
        try:
            did = work()
        except Exception as error:
            outcome[table] = audit.FAILED
            self._publish(step, start, run, (0, 0, 0), audit.FAILED, error=str(error))
            raise
        outcome[table] = audit.SUCCESS if did else audit.SKIPPED
        if not did:
            self._publish(step, start, run, (0, 0, 0), audit.SKIPPED)

    def _publish(
        self,
        step: audit.Step,
        start: datetime,
        run: str,
        counts: tuple[int, int, int],
        status: str = audit.SUCCESS,
        error: str | None = None,
        append: dict | None = None,
        **published,
    ) -> None:
        """Publish a step's folders together with its audit row."""
        with self.store.lock:  # siblings have numbers of their own
            number = self.store.meta("audit_id", 0) + 1
            row = audit.audit_row(
                self.spark,
                number,
                run,
                step,
                start,
                self.now(),
                *counts,
                status=status,
                error=error,
            )
            path = self.store.write(AUDIT, row)
            meta = {"audit_id": number, **published.pop("meta", {})}
            self.store.publish(append={AUDIT: [path], **(append or {})}, meta=meta, **published)
