"""Raw documents -> order and item tables: the composed ingest job (section 3.1).

A run flattens its documents once; publishes the outcomes of all rules and then gates
on them; upserts orders by key and appends the items newer than the high-water
mark, which is taken once per run over all its documents. Orders and items
become visible together by one pointer; a run id that is done changes nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ordermill.operators import deltas, quality
from ordermill.operators.flatten import flatten_order_lines
from ordermill.operators.shape import assign_ids, distinct_rows, latest_per_key, order_headers, order_items
from ordermill.operators.tables import newer_than
from ordermill.schemas import WATERMARK_FLOOR
from ordermill.session import free_shuffles, remove, require_utc
from ordermill.sources import keyed, retention, snapshots
from ordermill.sources.raw import CORRUPT, parse_documents
from ordermill.sources.sinks import write_staging
from ordermill.streaming.files import append_to_parquet, run_available, stream_raw_texts


@dataclass
class Tables:
    """Folder layout of the target tables; with ``reports`` every run keeps the reports up to date."""

    root: str
    reports: bool = False
    rows_per_file: int = keyed.ROWS_PER_FILE

    @property
    def items(self) -> str:
        return f"{self.root}/order_items"

    @property
    def outcomes(self) -> str:
        return f"{self.root}/dq_outcomes"

    @property
    def states(self) -> str:
        return f"{self.root}/dq_states"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/quarantine"

    @property
    def landed(self) -> str:
        return f"{self.root}/landed"


ITEM_ORDER = ["order_id", "product_sku", "product_id", "product_price", "product_quantity",
              "product_name", "product_color"]
#: Rules of a run: those of the lines, and amounts and documents that cannot be read.
RULES = (*quality.ORDER_LINE_RULES, quality.ColumnValues("out_of_range_amounts", "=", 0), quality.ColumnValues("malformed_amounts", "=", 0))
CORRUPT_RULE = f'ColumnValues "{CORRUPT}" = null'
#: Reported but not gated on: malformed amounts count as 0 (D1).
REPORT_ONLY = (RULES[-1].name,)
#: Reports that runs maintain; the cut list is made of the pending one.
REPORTS = {"pending": deltas.pending_report, "schedule": deltas.schedule_report}
#: Metrics of a run, kept as facts of its pointer row.
METRICS = ("inserted", "updated", "affected", "items_appended", "lines_collapsed")
LANDED_THROUGH = "landed_through"
#: Staged tables are read soon and removed: the fastest level is small enough.
STAGED = {"compression": "zstd", "parquet.compression.codec.zstd.level": "1"}
#: Landed lines are documents, no two alike: a dictionary of them saves nothing.
LANDED = STAGED | {"parquet.enable.dictionary": "false"}


def version_of(spark: SparkSession, tables: Tables, name: str, now: snapshots.Snapshot | None = None) -> keyed.Version | None:
    """The current version of ``orders`` or ``items``, or that of a snapshot."""
    now = now or snapshots.current(spark, tables.root)
    return keyed.open_version(spark, now.paths[name]) if now and name in now.paths else None


def read_orders(spark: SparkSession, tables: Tables) -> DataFrame | None:
    """Current orders."""
    version = version_of(spark, tables, "orders")
    return version.read() if version else None


def read_items(spark: SparkSession, tables: Tables) -> DataFrame | None:
    """Items of all published runs."""
    version = version_of(spark, tables, "items")
    return version.read() if version else None


def read_report(spark: SparkSession, tables: Tables, name: str) -> DataFrame | None:
    """The groups of a maintained report (``pending`` or ``schedule``) as of the last run."""
    now = snapshots.current(spark, tables.root)
    state = now.read(spark, f"reports/{name}") if now else None
    return deltas.current_groups(state, sum(k.startswith(f"reports/{name}/") for k in now.paths)) if state is not None else None


def table_outcomes(spark: SparkSession, tables: Tables, rules=RULES) -> DataFrame | None:
    """Outcomes of the rules over the lines of all published runs, merged from the runs' states without reading a line."""
    done = snapshots.pointers(spark, tables.root)
    if done is None:
        return None
    return quality.outcomes_of(quality.read_states(spark, tables.states).join(done.select("run_id").distinct(), "run_id", "left_semi"), rules)


def run_batch(raw: DataFrame, tables: Tables, run_id: str, dedupe: str = "rows", by_item_id: bool = False,
              rules=RULES, report_only=REPORT_ONLY, accept_corrupt: bool = False, landed_through: int | None = None) -> dict:
    """Process one run of raw documents; returns its metrics.

    ``dedupe`` as in ``flatten_order_lines``. ``by_item_id`` tells lines of one order apart by the
    source's item id, so that two equal items are kept; without it equal lines are one (D4)
    and ``lines_collapsed`` counts what that drops.
    Unreadable documents (``raw`` with the corrupt-record column) go to the quarantine
    and fail the run unless ``accept_corrupt``. A run that fails publishes its outcomes and nothing else.
    ``landed_through`` is the last landed batch that the run takes (``run_stream``); every run carries it on.
    """
    spark = raw.sparkSession
    require_utc(spark)
    known = snapshots.current(spark, tables.root, run_id)
    if known is not None:
        return {k: int(known.facts[k]) for k in METRICS}
    work = f"{tables.root}/work/{run_id}"
    try:
        # The flatten reads all documents, so it also sees whether some are unreadable; only then are those read once more.
        unreadable = Observation()
        seen = raw.observe(unreadable, F.count_if(F.col(CORRUPT).isNotNull()).alias("n")) if CORRUPT in raw.columns else raw
        flat, n_flat = _staged(flatten_order_lines(seen, dedupe=dedupe, keep_item_id=True, amount_checks=True, place=True), f"{work}/flat")
        outcomes = quality.evaluate_rules(flat, rules)
        if CORRUPT in raw.columns:
            # Spark reads the corrupt-record column of raw files only along with others.
            bad = raw.filter(F.col(CORRUPT).isNotNull()).select("source_file", CORRUPT, F.size("result").alias("orders_read"))
            bad = bad if unreadable.get["n"] else spark.createDataFrame([], bad.schema)
            n_bad = spark.read.parquet(write_staging(bad, f"{tables.quarantine}/run_id={run_id}")).count()
            outcomes = outcomes.unionByName(spark.createDataFrame(
                [(CORRUPT_RULE, "Failed" if n_bad else "Passed", float(n_bad))], "rule string, outcome string, actual double"))
        # Evaluated once: published first, then gated on what was published.
        published = quality.append_outcomes(outcomes, tables.outcomes, run_id)
        quality.append_states(quality.rule_states(flat, rules), tables.states, run_id)
        quality.gate(published, ignore=(*report_only, *((CORRUPT_RULE,) if accept_corrupt else ())))

        before = snapshots.current(spark, tables.root) or snapshots.Snapshot("", {}, {})
        counts, paths, facts = _change(flat, n_flat, tables, before, run_id, work, by_item_id)
        through = landed_through if landed_through is not None else before.facts.get(LANDED_THROUGH)
        if through is not None:
            facts[LANDED_THROUGH] = str(through)
        snapshots.commit(spark, tables.root, run_id, paths, facts)
        return counts
    finally:
        remove(spark, work)


def _staged(df: DataFrame, path: str) -> tuple[DataFrame, int]:
    """Write an intermediate table; the table read back and its rows, counted by the write."""
    seen = Observation()
    write_staging(df.observe(seen, F.count(F.lit(1)).alias("n")), path, **STAGED)
    return df.sparkSession.read.schema(df.schema).parquet(path), int(seen.get.get("n") or 0)


def _change(flat: DataFrame, n_flat: int, tables: Tables, before: snapshots.Snapshot, run_id: str, work: str, by_item_id: bool) -> tuple[dict, dict, dict]:
    """Write the orders, items and report deltas of a run; returns metrics, folders and facts for the pointer."""
    spark = flat.sparkSession
    plain = flat.drop("out_of_range_amounts", "malformed_amounts", "line_place")
    # Only the item columns of the distinct lines are needed again; the headers come from
    # the first line of every order as it was read, which has the same header as its other lines.
    lines, n_lines = _staged(order_items(distinct_rows(plain if by_item_id else plain.drop("line_item_id"))), f"{work}/lines")
    headers = order_headers(flat.filter("line_place = 0"))
    # The last columns make the order total: rows that tie are equal.
    rest = [F.col(c).desc_nulls_last() for c in headers.columns if c not in ("order_id", "modified_on")]
    # An order without an id fails the gate; where that rule is left out it is in no order table.
    headers = headers.filter("order_id is not null")
    staged, n_staged = _staged(latest_per_key(headers, ["order_id"], [F.col("modified_on").desc_nulls_last()], tie_break=rest), f"{work}/staged")
    # What the run is done with goes at once: the disk holds one step's files, not those of the whole run.
    remove(spark, f"{work}/flat")
    free_shuffles(spark)

    paths = {"orders": f"{tables.root}/orders/run={run_id}", "items": f"{tables.items}/run={run_id}"}
    old_orders, old_items = (version_of(spark, tables, name, before) if before.run_id else None for name in ("orders", "items"))
    touched = keyed.hits(old_orders, staged.select("order_id")) if old_orders else {}
    if old_orders is None:
        orders = keyed.create(staged, "order_id", paths["orders"], tables.rows_per_file, n_staged)
        n_updated = 0
    else:
        orders = keyed.upsert(old_orders, staged, paths["orders"], tables.rows_per_file, touched, checked=True)
        n_updated = keyed.updated(old_orders, orders, n_staged)

    mark = before.facts.get("mark", WATERMARK_FLOOR)
    done = int(before.facts.get("items_total", 0))
    fresh = newer_than(lines, F.lit(mark).cast("timestamp"))
    summary = fresh.agg(F.count(F.lit(1)).alias("n"), F.max("created_on").cast("string").alias("mark")).first()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-summary["n"] // keyed.ROWS_PER_FILE))
    fresh = assign_ids(fresh, "order_item_id", ITEM_ORDER, start=done + 1, num_partitions=parts, path=f"{work}/numbered").drop("created_on")
    remove(spark, f"{work}/lines")
    free_shuffles(spark)
    if old_items is None:
        keyed.create(fresh, "order_id", paths["items"], tables.rows_per_file, summary["n"])
    else:
        keyed.append(old_items, fresh, paths["items"], tables.rows_per_file, summary["n"])
    free_shuffles(spark)
    if tables.reports:
        paths |= _reports(spark, tables, before, run_id, old_orders, old_items, orders, touched, staged, fresh)

    counts = {"inserted": n_staged - n_updated, "updated": n_updated, "affected": n_staged,
              "items_appended": summary["n"], "lines_collapsed": n_flat - n_lines}
    facts = {k: str(v) for k, v in counts.items()} | {"items_total": str(done + summary["n"]), "mark": max(mark, summary["mark"] or mark), "keyed": "orders,items"}
    return counts, paths, facts


def _reports(spark: SparkSession, tables: Tables, before: snapshots.Snapshot, run_id: str, old_orders: keyed.Version | None, old_items: keyed.Version | None,
             orders: keyed.Version, touched: dict[str, int], staged: DataFrame, fresh: DataFrame) -> dict[str, str]:
    """Deltas of the maintained reports, next to those of earlier runs; without any the reports begin with the whole tables."""
    paths = {k: p for k, p in before.paths.items() if k.startswith("reports/")}
    work = f"{tables.root}/work/{run_id}"
    kept = {name: report() for name, report in REPORTS.items()}
    if old_orders is None or not paths:
        now, moved, existing = orders.read(), None, None
        fresh = fresh if old_items is None else old_items.read().unionByName(fresh)
    else:
        was, now = keyed.lookup(old_orders, staged.select("order_id"), touched), staged
        moved, _ = _staged(deltas.moved_in_any(kept, was, now), f"{work}/moved")
        existing = keyed.lookup(old_items, moved.select("order_id"))
    changes = deltas.report_deltas(kept, now, fresh, lambda rows: _staged(rows, f"{work}/changes")[0], moved, existing)
    free_shuffles(spark)
    for name, change in changes.items():
        path = f"{tables.root}/reports/{name}/run={run_id}"
        write_staging(change, path)
        paths[f"reports/{name}/{run_id}"] = path
        free_shuffles(spark)
    return paths


def compact(spark: SparkSession, tables: Tables, run_id: str) -> bool:
    """Merge small files of orders and items and all deltas of each report; False if there is nothing to merge.

    Contents, mark and facts stay; a crash before the pointer row leaves everything as it was.
    """
    now = snapshots.current(spark, tables.root)
    if now is None or snapshots.current(spark, tables.root, run_id) is not None:
        return False
    paths = dict(now.paths)
    for name, folder in (("orders", f"{tables.root}/orders/run={run_id}"), ("items", f"{tables.items}/run={run_id}")):
        if retention.compact_keyed(version_of(spark, tables, name, now), folder, tables.rows_per_file) is not None:
            paths[name] = folder
    for name in REPORTS:
        parts = [k for k in paths if k.startswith(f"reports/{name}/")]
        if len(parts) > 1:
            path = retention.compact_deltas(now.read(spark, f"reports/{name}"), f"{tables.root}/reports/{name}/run={run_id}")
            for k in parts:
                del paths[k]
            paths[f"reports/{name}/{run_id}"] = path
    if paths == now.paths:
        return False
    snapshots.commit(spark, tables.root, run_id, paths, now.facts | dict.fromkeys(METRICS, "0"))
    return True


def run_stream(spark: SparkSession, landing: str, tables: Tables, checkpoint: str,
               archive_dir: str | None = None, max_files_per_trigger: int | None = None, **options) -> dict | None:
    """Process every raw file landed since the last run, once, then stop (O-02).

    The stream only picks the files up: its micro-batches land their lines as text
    under the batch id, and the run parses them. All documents that no published run has taken are then one run, with
    one high-water mark, so how many files a micro-batch holds does not matter,
    and what a failed run left is taken up by the next. Returns the run's metrics, None if nothing is pending.
    """
    stream = stream_raw_texts(spark, landing, archive_dir=archive_dir, max_files_per_trigger=max_files_per_trigger)
    run_available(stream, append_to_parquet(tables.landed, **LANDED), checkpoint)
    now = snapshots.current(spark, tables.root)
    taken = int(now.facts.get(LANDED_THROUGH, -1)) if now else -1
    try:
        landed = spark.read.parquet(tables.landed).filter(F.col("batch_id") > taken)
    except Exception as e:  # nothing was ever landed
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return None
        raise
    last = landed.agg(F.max("batch_id")).first()[0]
    if last is None:
        return None
    return run_batch(parse_documents(landed.drop("batch_id")), tables, f"through-{last}", landed_through=last, **options)


__all__ = ["Tables", "run_batch", "run_stream", "compact", "read_orders", "read_items", "read_report", "table_outcomes", "version_of", "RULES", "REPORT_ONLY", "REPORTS"]
