"""Resumable ingest: landed text rows become typed, keyed raw tables, batch by batch.

A batch writes its rows under its own id, then its log row, then the cursor. Rows
count only once the log says the batch finished, so a batch is there or not, and
doing one again replaces it. One writer at a time per root folder.
"""

from __future__ import annotations

import datetime
import hashlib
import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from orderlens.operators.keyed import absent_from, after_cursor, union_all, up_to_cursor
from orderlens.operators.ordering import global_order
from orderlens.plans.mart import PERSON_TABLES, Mart, RawTables
from orderlens.plans.quality import DataQualityError, IngestState, dq_checks, failed_errors
from orderlens.session import at_once, cut_lineage, passing_tables
from orderlens.sources.file_index import FileIndex, LandedFiles, read_files
from orderlens.sources.landing import typed_feed
from orderlens.sources.schemas import BATCH_STATUSES, LANDING, OPS, RAW, RAW_KEYS
from orderlens.sources.tables import TableStore
from orderlens.streaming import rules

SOURCE = "orders_feed"
_BACKFILL = "children backfill"
#: Batches that are indexed together.
_RAW_TAIL = 8


@dataclass(frozen=True)
class Cursor:
    """The last (purchase time, order id) taken; no time before the first batch."""

    last_ts: datetime.datetime | None = None
    last_id: str = ""
    orders_ingested: int = 0


@dataclass(frozen=True)
class BatchResult:
    batch_id: int
    orders_attempted: int
    rows_loaded: int
    rows_rejected: int
    watermark_to: datetime.datetime | None
    status: str


def next_window(feed: DataFrame, cursor: Cursor, size: int, end: tuple | None = None) -> DataFrame:
    """The `size` rows that follow the cursor in (purchase time, order id).

    `end` is a place that the window cannot pass, as a file index knows it. Without one, rows
    per month, of which there are as many as the calendar has, tell how far the window can
    reach. Only rows up to there are ordered, by many tasks whatever the size. All columns
    break ties, so copies of one order are taken in the same order always.
    """
    ts, key = F.col("purchase_ts"), F.col("order_id")
    ahead = feed.filter(after_cursor(ts, key, cursor.last_ts, cursor.last_id))
    if end is not None:
        ahead = ahead.filter(up_to_cursor(ts, key, *end))
    else:
        month = F.add_months(F.trunc(ts, "month"), 1).alias("end")
        seen = 0
        for row in ahead.groupBy(month).count().orderBy("end").collect():
            seen += row["count"]
            if seen >= size:
                ahead = ahead.filter(ts < F.lit(str(row["end"])).cast("timestamp_ntz"))
                break
    ties = [F.col(c).asc_nulls_last() for c in feed.columns if c not in ("purchase_ts", "order_id")]
    placed = global_order(ahead, [ts.asc(), key.asc(), *ties], "_at")
    return placed.filter(F.col("_at") <= size).drop("_at")


def _one_row_per_person(table: DataFrame) -> None:
    copies = table.groupBy("customer_unique_id").count().filter("count > 1")
    if not copies.isEmpty():
        raise DataQualityError("a person table repeats customers")


def _digest(rows: DataFrame) -> str:
    """What tells one set of rows from another, whatever their order and number of files."""
    columns = sorted(rows.columns)
    each = F.xxhash64(*columns)
    found = rows.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(each.cast("decimal(20,0)")).alias("sum"),
        F.bit_xor(F.xxhash64(F.lit("rows"), *columns)).alias("xor"),
    ).first()
    return hashlib.sha256(f"{found.n} {found.sum} {found.xor}".encode()).hexdigest()[:24]


def _now() -> datetime.datetime:
    return datetime.datetime.now()


class Drip(list):
    """The results of a run of batches; `drained` is False when a limit ended the run."""

    drained = False


class Ingest:
    """`landing` maps table names to landed all-text tables; `root` is a shared folder.

    A table may be given as a function that opens it. It is then opened anew by every
    batch, so files that land later are seen; a frame keeps the files it was made with.
    For `LandedFiles` an index of the files is kept: a batch opens only files that may hold
    its window or its keys, and a backfill only those that landed since the last one.
    """

    #: What rows of a landed table are looked up by, and the time that orders the feed.
    _KEYS = {
        "orders": ("order_id", "purchase_ts"),
        "customers": ("customer_id", None),
        "products": ("product_id", None),
        "order_items": ("order_id", None),
        "order_payments": ("order_id", None),
        "order_reviews": ("order_id", None),
    }

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        landing: Mapping[str, DataFrame | Callable[[], DataFrame]],
        indexed: bool = True,
    ):
        """`indexed=False` keeps no index: for bulk loads, whose batches open most files anyway."""
        self.spark = spark
        self.store = TableStore(spark, root)
        self._landing = dict(landing)
        self._indexes: dict[str, FileIndex] = {}
        self._use_index = indexed

    def landed(self, table: str) -> DataFrame:
        opened = self._landing[table]
        return opened() if callable(opened) else opened

    def _index(self, table: str) -> FileIndex:
        name = f"landed/{table}"
        return self._indexes.setdefault(name, FileIndex(self.store, name, *self._KEYS[table]))

    def _raw_index(self, table: str) -> FileIndex:
        name = f"raw/{table}"
        return self._indexes.setdefault(name, FileIndex(self.store, name, RAW_KEYS[table][0]))

    def _indexed(self, table: str) -> bool:
        source = self._landing.get(table)
        return self._use_index and isinstance(source, LandedFiles) and (table != "orders" or "purchase_ts" in source().columns)

    def _refresh_indexes(self, generation: int) -> dict[str, list[str]]:
        """Index files that are new; gives the files that are there, by table."""
        files = {t: source().inputFiles() for t, source in self._landing.items() if t in self._KEYS and self._indexed(t)}
        raw = self._raw_files() if files else {}
        work = {("landed", t): partial(self._index(t).refresh, f, generation) for t, f in files.items()}
        for table, there in raw.items():
            new = [f for f in there if f not in self._raw_index(table).known()]
            if len({f.split("batch_id=")[-1].split("/")[0] for f in new}) >= _RAW_TAIL:
                work["raw", table] = partial(self._raw_index(table).refresh, new, generation)
        if work:
            at_once(work)
        return files | {f"raw/{t}": f for t, f in raw.items()}

    def _raw_files(self) -> dict[str, list[str]]:
        done = self.committed()
        return {t: self.raw(t, done).inputFiles() if done else [] for t in RAW}

    def _landed_with(self, table: str, keys: DataFrame, files: Mapping[str, list[str]]) -> DataFrame:
        """A landed table without the files that cannot hold any of the keys."""
        if table not in files:
            return self.landed(table)
        return self._landing[table].only(self._index(table).files_with(keys, files[table]))

    def _raw_with(self, table: str, keys: DataFrame, files: Mapping[str, list[str]], done: list[int]) -> DataFrame:
        """What finished batches loaded, without the files that cannot hold any of the keys.

        The files of the last few batches are not indexed yet and always read.
        """
        if f"raw/{table}" not in files:
            return self.raw(table, done)
        there, index = files[f"raw/{table}"], self._raw_index(table)
        found = [f for f in there if f not in index.known()]
        found += index.files_with(keys, there) if there else []
        return read_files(self.spark, RAW[table], f"{self.store.root}/raw/{table}", found)

    @property
    def feed(self) -> DataFrame:
        orders = self.landed("orders")
        return orders if "purchase_ts" in orders.columns else typed_feed(orders)

    # -- state -------------------------------------------------------------------
    def load_batch(self) -> DataFrame:
        return self.store.read_batches("ops/load_batch", OPS["load_batch"])

    def committed(self) -> list[int]:
        done = self.load_batch().filter(F.col("status").isin("succeeded", "partial"))
        return [row.batch_id for row in done.select("batch_id").collect()]

    def load_errors(self) -> DataFrame:
        return self.store.read_batches("ops/load_errors", OPS["load_errors"])

    def dq_result(self) -> DataFrame:
        return self.store.read_batches("ops/dq_result", OPS["dq_result"])

    def raw(self, table: str, committed: list[int] | None = None) -> DataFrame:
        """A raw table as the finished batches have left it."""
        done = self.committed() if committed is None else committed
        return self.store.read_batches(f"raw/{table}", RAW[table], done)

    def read_cursor(self) -> Cursor:
        rows = self.store.read_batches("ops/ingest_watermark", OPS["ingest_watermark"])
        last = rows.orderBy(F.col("batch_id").desc()).first()
        if last is None:
            return Cursor()
        return Cursor(last.last_purchase_ts, last.last_order_id or "", last.orders_ingested)

    def _put_row(self, table: str, values: dict, batch_id: int) -> None:
        fields = [f for f in OPS[table].fields if f.name != "batch_id"]
        schema = type(OPS[table])(fields)
        row = self.spark.createDataFrame([tuple(values.get(f.name) for f in fields)], schema)
        self.store.put_batch(f"ops/{table}", row.coalesce(1), batch_id)

    def _log_batch(self, batch_id: int, status: str, **values) -> None:
        if status not in BATCH_STATUSES:
            raise ValueError(f"unknown batch status {status}")
        counts = {"orders_attempted": 0, "rows_loaded": 0, "rows_rejected": 0}
        row = {"source_name": SOURCE, "finished_at": _now(), "status": status, **counts, **values}
        self._put_row("load_batch", row, batch_id)

    def _next_id(self) -> int:
        return max(self.store.batches("ops/load_batch"), default=0) + 1

    # -- one batch -----------------------------------------------------------------
    def next_batch(self, size: int = 500) -> BatchResult:
        """Load the next `size` orders with everything that belongs to them."""
        with passing_tables(self.spark):
            cursor, batch_id = self.read_cursor(), self._next_id()
            files = self._refresh_indexes(batch_id)
            feed, end = self.feed, None
            if "orders" in files:
                found, end = self._index("orders").window(cursor.last_ts, cursor.last_id, size, files["orders"])
                feed = self._landing["orders"].only(found)
            window = next_window(feed, cursor, size, end)
            return self._guarded(window, cursor, f"drip batch, size={size}", files)

    def arrivals(self, rows: DataFrame, epoch: int, query: str = "stream") -> BatchResult | None:
        """Load one micro-batch of a stream; rows that a finished one has brought are not loaded again.

        What marks a micro-batch is its rows, not its number: a checkpoint that was lost starts
        to count anew, and may cut the same files otherwise.
        """
        with passing_tables(self.spark):
            arrived = cut_lineage(rows if "purchase_ts" in rows.columns else typed_feed(rows))
            note = f"{query} {_digest(arrived)}"
            finished = self.load_batch().filter(F.col("status").isin("succeeded", "partial"))
            if not finished.filter(F.col("notes") == note).isEmpty():
                return None
            window = arrived.filter("purchase_ts is not null")
            files = self._refresh_indexes(self._next_id())
            return self._guarded(window, self.read_cursor(), note, files, unparsed_in=arrived)

    def _guarded(
        self,
        window: DataFrame,
        cursor: Cursor,
        note: str,
        files: Mapping[str, list[str]],
        unparsed_in: DataFrame | None = None,
    ) -> BatchResult:
        batch_id, started = self._next_id(), _now()
        try:
            source = self._unparsed_feed(files) if unparsed_in is None else unparsed_in
            return self._load(cut_lineage(window), cursor, batch_id, started, note, source, files)
        except Exception as error:
            self.record_failure(batch_id, started, "ingest", error)
            raise

    def _unparsed_feed(self, files: Mapping[str, list[str]]) -> DataFrame:
        """The feed, or only its files that hold rows without a time."""
        if "orders" not in files:
            return self.feed
        return self._landing["orders"].only(self._index("orders").files_without_time(files["orders"]))

    def record_failure(self, batch_id: int, started: datetime.datetime, step: str, error: Exception) -> None:
        """Log a failed batch and what stopped it; its rows stay invisible."""
        entry = {
            "error_id": batch_id,
            "source_table": f"pipeline:{step}",
            "error_type": "pipeline_failure",
            # the column's own length, as the log is read by people
            "error_detail": f"{type(error).__name__}: {error}"[:2000],
            "logged_at": _now(),
        }
        self._put_row("load_errors", entry, batch_id)
        self._log_batch(batch_id, "failed", started_at=started, notes=step)

    def _children(self, orders: DataFrame, files: Mapping[str, list[str]]) -> dict[str, DataFrame]:
        """Landed rows of the given orders, each with the reason it is refused, if any."""
        keys = orders.select("order_id").distinct()

        def of(table: str) -> DataFrame:
            landed = self._landed_with(table, keys, files).select(*LANDING[table].names)
            return cut_lineage(landed.join(keys, "order_id", "left_semi"))

        return self._checked(at_once({t: partial(of, t) for t in self._TYPED}), files)

    def _checked(self, rows: dict[str, DataFrame], files: Mapping[str, list[str]]) -> dict[str, DataFrame]:
        products = self._landed_with("products", rows["order_items"].select("product_id"), files)
        return {
            "order_items": cut_lineage(rules.check_items(rows["order_items"], products)),
            "order_payments": rules.check_payments(rows["order_payments"]),
            "order_reviews": rules.check_reviews(rows["order_reviews"]),
        }

    _TYPED = {
        "order_items": rules.typed_items,
        "order_payments": rules.typed_payments,
        "order_reviews": rules.typed_reviews,
    }

    def _typed(self, children: dict[str, DataFrame]) -> dict[str, DataFrame]:
        return {n: self._TYPED[n](rows.filter("reason is null")) for n, rows in children.items()}

    def _write_all(
        self, typed: dict[str, DataFrame], refused: list[DataFrame], batch_id: int, files: Mapping[str, list[str]]
    ) -> tuple[int, int]:
        """Write the raw tables and the rejects of a batch; no write needs another."""
        done = self.committed()
        writes = {
            table: partial(self._write_raw, table, rows, batch_id, done, files) for table, rows in typed.items()
        }
        writes["rejects"] = partial(self._write_errors, union_all(refused), batch_id)
        counts = at_once(writes)
        rejected = counts.pop("rejects")
        return sum(counts.values()), rejected

    def _write(self, name: str, rows: DataFrame, batch_id: int) -> int:
        """Write one batch's rows and count them on the way."""
        seen = Observation()
        self.store.put_batch(name, rows.observe(seen, F.count(F.lit(1)).alias("n")), batch_id)
        return seen.get["n"]

    def _write_raw(
        self, table: str, typed: DataFrame, batch_id: int, committed: list[int], files: Mapping[str, list[str]]
    ) -> int:
        held = self._raw_with(table, typed.select(RAW_KEYS[table][0]), files, committed)
        fresh = absent_from(typed, held, RAW_KEYS[table])
        names = [n for n in RAW[table].names if n not in ("batch_id", "ingested_at")]
        return self._write(f"raw/{table}", fresh.select(*names, F.now().alias("ingested_at")), batch_id)

    def _write_errors(self, rejected: DataFrame, batch_id: int) -> int:
        """A record is logged once per reason, however often its batch is tried."""
        key = ["source_table", "record_key", "error_type"]
        logged = self.load_errors().filter(F.col("batch_id") != batch_id)
        known = logged.select(*key, "raw_payload").distinct()
        same = [rejected[c].eqNullSafe(known[c]) for c in known.columns]
        fresh = rejected.join(known, same, "left_anti").select(
            F.xxhash64(*rejected.columns).alias("error_id"), *rejected.columns, F.now().alias("logged_at")
        )
        return self._write("ops/load_errors", fresh, batch_id)

    def _load(
        self,
        window: DataFrame,
        cursor: Cursor,
        batch_id: int,
        started: datetime.datetime,
        note: str,
        unparsed_in: DataFrame,
        files: Mapping[str, list[str]],
    ) -> BatchResult:
        last = window.agg(
            F.count(F.lit(1)).alias("n"), F.max(F.struct("purchase_ts", "order_id")).alias("at")
        ).first()
        columns = LANDING["orders"].names
        unparsed = unparsed_in.filter("purchase_ts is null").withColumn("reason", F.lit("bad_timestamp"))
        refused = [rules.rejects(unparsed, "orders", columns)]
        loaded = 0
        if last.n:
            customers = self._landed_with("customers", window.select("customer_id"), files)
            checked = cut_lineage(rules.check_orders(window, customers))
            good = checked.filter("reason is null")
            children = self._children(good, files)
            refused.append(rules.rejects(checked, "orders", columns))
            refused += [
                rules.rejects(rows, name, LANDING[name].names) for name, rows in children.items()
            ]
            buyers = customers.join(
                good.select("customer_id").distinct(), "customer_id", "left_semi"
            )
            typed = {"customers": rules.typed_customers(buyers), "orders": rules.typed_orders(good)}
            loaded, rejected = self._write_all({**typed, **self._typed(children)}, refused, batch_id, files)
        else:
            rejected = self._write_errors(union_all(refused), batch_id)

        # The cursor follows the window, also when all of it was refused.
        reached = cursor
        if last.n:
            seen = (last.at.purchase_ts, last.at.order_id)
            before = (cursor.last_ts, cursor.last_id)
            ahead = cursor.last_ts is None or seen > before
            ts, key = seen if ahead else before
            reached = Cursor(ts, key, cursor.orders_ingested + last.n)
        status = "partial" if rejected else "succeeded"
        self._log_batch(
            batch_id,
            status,
            started_at=started,
            orders_attempted=last.n,
            rows_loaded=loaded,
            rows_rejected=rejected,
            watermark_from=cursor.last_ts,
            watermark_to=reached.last_ts,
            notes=note if last.n else "nothing left in the feed",
        )
        if last.n:
            self._put_row(
                "ingest_watermark",
                {
                    "source_name": SOURCE,
                    "last_purchase_ts": reached.last_ts,
                    "last_order_id": reached.last_id,
                    "orders_ingested": reached.orders_ingested,
                    "updated_at": _now(),
                },
                batch_id,
            )
        return BatchResult(batch_id, last.n, loaded, rejected, reached.last_ts, status)

    # -- whole runs ----------------------------------------------------------------
    def drip(self, runs: int | None = None, size: int = 500) -> Drip:
        """Batches until the feed is drained, or until `runs` are done if that is given."""
        results = Drip()
        while not results.drained and (runs is None or len(results) < runs):
            results.append(self.next_batch(size))
            results.drained = results[-1].orders_attempted == 0
        return results

    def stream(self, source: DataFrame, checkpoint: str, query: str = "stream"):
        """Load whatever a stream of landed orders holds now, then stop.

        With its checkpoint lost, a stream brings all files again; rows that are loaded or
        logged stay as they are, and only the others are added.
        """
        return (
            source.writeStream.foreachBatch(lambda rows, epoch: self.arrivals(rows, epoch, query) and None)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )

    def late_rows(self) -> DataFrame:
        """Feed rows at or behind the cursor that are neither loaded nor logged."""
        cursor = self.read_cursor()
        ts, key = F.col("purchase_ts"), F.col("order_id")
        passed = self.feed.filter(up_to_cursor(ts, key, cursor.last_ts, cursor.last_id))
        logged = self.load_errors().filter("source_table = 'seed.orders'")
        logged = logged.select(F.col("record_key").alias("order_id"))
        return absent_from(absent_from(passed, self.raw("orders"), ["order_id"]), logged, ["order_id"])

    def _late_children(self, files: Mapping[str, list[str]]) -> dict[str, DataFrame]:
        """Landed rows of loaded orders; of indexed tables only those in files that no batch of
        their order can have seen: the first batch and every backfill saw all files there were."""
        log = self.load_batch().filter(F.col("status").isin("succeeded", "partial"))
        backfill = F.col("notes") == _BACKFILL
        seen = log.agg(F.coalesce(F.max(F.when(backfill, F.col("batch_id"))), F.min("batch_id"), F.lit(0)).alias("n"))
        seen, done = seen.first().n, self.committed()

        def of(table: str) -> DataFrame:
            if table in files:
                landed = self._landing[table].only(self._index(table).files_since(seen, files[table]))
            else:
                landed = self.landed(table)
            landed = landed.select(*LANDING[table].names)
            orders = self._raw_with("orders", landed.select("order_id"), files if table in files else {}, done)
            return cut_lineage(landed.join(orders.select("order_id").distinct(), "order_id", "left_semi"))

        return self._checked(at_once({t: partial(of, t) for t in self._TYPED}), files)

    def backfill_children(self) -> BatchResult:
        """Load items, payments and reviews that landed after their order's batch."""
        batch_id, started = self._next_id(), _now()
        try:
            with passing_tables(self.spark):
                files = self._refresh_indexes(batch_id)
                children = self._late_children(files)
                refused = [rules.rejects(rows, name, LANDING[name].names) for name, rows in children.items()]
                loaded, rejected = self._write_all(self._typed(children), refused, batch_id, files)
        except Exception as error:
            self.record_failure(batch_id, started, "backfill", error)
            raise
        status = "partial" if rejected else "succeeded"
        self._log_batch(
            batch_id,
            status,
            started_at=started,
            rows_loaded=loaded,
            rows_rejected=rejected,
            notes=_BACKFILL,
        )
        return BatchResult(batch_id, 0, loaded, rejected, self.read_cursor().last_ts, status)

    def reset(self) -> None:
        """Empty raw and ops tables and rewind the cursor; the landing stays."""
        for table in RAW:
            self.store.clear(f"raw/{table}")
        for table in OPS:
            self.store.clear(f"ops/{table}")
        self.store.clear("index")
        self._indexes.clear()

    # -- after the batches -----------------------------------------------------------
    def mart(self, reference: Mapping, **options) -> Mart:
        """The model over what is loaded; `reference` adds geolocation and the lookups."""
        done = self.committed()
        raw = RawTables(
            self.spark,
            **{table: self.raw(table, done) for table in RAW},
            products=self.landed("products"),
            sellers=self.landed("sellers"),
            category_translation=self.landed("category_translation"),
            calendar=self.feed.select("purchase_ts"),
            **reference,
        )
        return Mart(raw, store=options.pop("store", self.store), **options)

    def refresh_customer_layer(self, mart: Mart) -> DataFrame:
        """Count the raw tables and replace the person tables, timing every step."""
        rows = []
        for table in ("orders", "order_items", "order_payments", "order_reviews", "customers"):
            start = time.monotonic()
            count = self.raw(table).count()
            rows.append(("analyze", f"raw.{table}", count, round(time.monotonic() - start, 3)))
        built = {"mv_dim_customer": "dim_customer", "mv_rfm": "rfm", "mv_customer_ltv": "customer_ltv"}
        for name in PERSON_TABLES:
            start = time.monotonic()
            self.store.publish(name, getattr(mart, built[name]), check=_one_row_per_person)
            count = self.store.current(name).count()
            rows.append(("refresh", f"mart.{name}", count, round(time.monotonic() - start, 3)))
        return self.spark.createDataFrame(
            rows, "step string, object_name string, row_count bigint, seconds double"
        )

    def ingest_state(self) -> IngestState:
        cursor = self.read_cursor()
        return IngestState(
            self.feed, self.load_batch(), self.load_errors(), cursor.last_ts, cursor.last_id, SOURCE
        )

    def run_dq_checks(self, mart: Mart, batch_id: int, gate: bool = True) -> DataFrame:
        """Evaluate the checks once, keep them, and stop on a failed error check."""
        results = dq_checks(mart, self.ingest_state()).withColumn("checked_at", F.now())
        self.store.put_batch("ops/dq_result", results.coalesce(1), batch_id)
        kept = self.dq_result().filter(F.col("batch_id") == batch_id).drop("batch_id", "checked_at")
        broken = failed_errors(kept.collect()) if gate else []
        if broken:
            raise DataQualityError(f"batch {batch_id}: {', '.join(sorted(broken))}")
        return kept
