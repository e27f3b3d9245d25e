"""End-to-end run (C7): raw → staged → data-quality gate → curated.

Every zone keeps one partition ``_run`` per run, in both modes and with one layout. A
full run stages everything it is given and becomes the new base; an incremental
run stages its drop on top of the committed runs. Curated tables are computed from state that
each run adds to (``tidemark.plans.maintained``) and written to folders of their own; then one small
record makes the run, the files it read and all published tables visible at once
(``tidemark.plans.lake``). After a failure, wherever it happens, everything published is as before.
Counts come from ``Observation``s on the writes; nothing but counts, bucket numbers and the check results
reaches the driver, and from ``run_sources`` the names of the files to read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import COMPLETED_STATUS, DEFAULT_FUNNEL, FunnelSpec
from tidemark.operators import dq
from tidemark.operators.category import top_categories
from tidemark.operators.profile import average_conversion
from tidemark.operators.spend import completed
from tidemark.plans import incremental as inc
from tidemark.plans import lake as log
from tidemark.plans import maintained as kept
from tidemark.plans.curated import business_columns
from tidemark.plans.staged import stage_passthrough, tag_clickstream, tag_transactions
from tidemark.schemas import RAW_COLUMNS, STAGED_TYPES
from tidemark.session import delete_path, together
from tidemark.sources.files import stamp_ingest, union_sources

DIMENSIONS = ("customers", "products")
FACTS = ("clickstream_events", "transactions")
CURATED = ("customer_360", "category_performance", "funnel_dropoff", "event_type_counts")

# The standard suite on the staged zone.
STANDARD_SUITE = (
    dq.CheckSpec("completeness", "transactions", ("customer_id", "product_id", "amount")),
    dq.CheckSpec("uniqueness", "transactions", ("order_id",)),
    dq.CheckSpec("referential_integrity", "transactions", ("customer_id",), "customers", "customer_id"),
    dq.CheckSpec("freshness", "transactions", ("order_date",), options={"max_age_days": 3650}),
    dq.CheckSpec("uniqueness", "customers", ("customer_id",)),
    dq.CheckSpec("uniqueness", "clickstream_events", ("event_id",)),
    dq.CheckSpec("referential_integrity", "clickstream_events", ("customer_id",), "customers",
                 "customer_id"),
)


@dataclass
class MedallionConfig:
    lake_dir: str
    funnel: FunnelSpec = DEFAULT_FUNNEL
    completed_value: str = COMPLETED_STATUS
    clickstream_key: Sequence[str] = ("event_id",)
    transaction_key: Sequence[str] = ("order_id",)
    clickstream_order: Sequence[str] = ("_ingested_ts", "event_ts")
    transaction_order: Sequence[str] = ("_ingested_ts",)
    types: dict = field(default_factory=lambda: dict(STAGED_TYPES))
    dq_suite: Sequence[dq.CheckSpec] = STANDARD_SUITE
    as_of: str | None = None
    clickstream_partition: str = "event_type"
    transaction_partition: str = "status"
    # Facts whose rows wait until their customer is known; those of others are staged without.
    wait_for_customer: Sequence[str] = ("transactions",)
    # Parts of the keyed tables, fixed when a lake is new or a full run replaces it.
    buckets: int = 16
    # "full": every zone recomputed from what is given. "incremental": dimensions are snapshots,
    # facts are drops added to those of the committed runs.
    mode: str = "full"


@dataclass
class MedallionResult:
    counts: dict
    dq_results: DataFrame
    curated: dict
    summary: dict


def _zone(conf: MedallionConfig, zone: str, table: str) -> str:
    return f"{conf.lake_dir.rstrip('/')}/{zone}/{table}"


def facts(conf: MedallionConfig, customers: DataFrame | None) -> dict[str, inc.Fact]:
    """How the two facts are staged; ``customers`` are the known ones."""
    click_key, txn_key = tuple(conf.clickstream_key), tuple(conf.transaction_key)
    known = lambda fact: customers if fact in conf.wait_for_customer else None
    return {
        "clickstream_events": inc.Fact(
            "clickstream_events", click_key, tuple(conf.clickstream_order), conf.clickstream_partition,
            lambda rows: tag_clickstream(rows, click_key, types=conf.types.get("clickstream_events"),
                                         valid_customers=known("clickstream_events"))),
        "transactions": inc.Fact(
            "transactions", txn_key, tuple(conf.transaction_order), conf.transaction_partition,
            lambda rows: tag_transactions(rows, known("transactions"), txn_key, types=conf.types.get("transactions"))),
    }


def run_medallion(spark: SparkSession, raw: dict[str, DataFrame], conf: MedallionConfig,
                  run_id: str | None = None, files: Sequence[tuple[str, str, int, int]] = ()) -> MedallionResult:
    """Run every zone for the four tables in ``raw`` (any columns; text or typed).

    ``files`` are the arrivals the raw tables were read from; they count as read once the run is committed.
    Raises ``DataQualityError`` after writing the staged run and the check
    results when a check fails, ``ConcurrentRunError`` if another run committed in the meantime; nothing is
    committed then, and everything published stays as it was.
    """
    if conf.mode not in ("full", "incremental"):
        raise ValueError(f"unknown mode {conf.mode!r}")
    run_id = run_id or uuid.uuid4().hex[:12]
    lake, counts = conf.lake_dir.rstrip("/"), {}
    before = log.latest(spark, lake)
    run = log.take_run(spark, lake)
    runs = list(before.runs) if conf.mode == "incremental" else []

    # raw zone: land as received (text) with the ingest stamp
    def land(name):
        df = raw[name]
        text = stamp_ingest(df.select(*[F.col(c).cast("string").alias(c) for c in df.columns]))
        n = inc.write_run(text, _zone(conf, "raw", name), run)
        return n, spark.read.schema(text.schema).parquet(inc.run_path(_zone(conf, "raw", name), run))

    landed = dict(zip(raw, together(*[partial(land, name) for name in raw])))
    counts.update({f"raw.{name}": n for name, (n, _) in landed.items()})

    # staged zone: customers first, the facts are judged by them
    def stage_dimension(name):
        typed = stage_passthrough(landed[name][1], conf.types.get(name), stamp="now")
        n = inc.write_run(typed, _zone(conf, "staged", name), run)
        return n, spark.read.schema(typed.schema).parquet(inc.run_path(_zone(conf, "staged", name), run))

    staged, schemas = {}, {}
    counts["staged.customers"], staged["customers"] = stage_dimension("customers")
    todo = facts(conf, staged["customers"])
    (counts["staged.products"], staged["products"]), *done = together(
        partial(stage_dimension, "products"),
        *[partial(inc.stage_fact, spark, lake, fact, landed[name][1], run, runs) for name, fact in todo.items()])
    for (name, fact), (schema, n) in zip(todo.items(), done):
        schemas[name] = schema
        counts[f"staged.{name}"] = n["staged"]
        counts[f"rejected.{name}"] = n["rejected"] + n["pending"]
        counts[f"pending.{name}"] = n["pending"]
        counts[f"duplicate.{name}"] = n["duplicate"]
        counts[f"superseded.{name}"] = n["superseded"]
        staged[name] = inc.read_staged(spark, lake, fact, schema, [*runs, run]).drop(inc.RUN, inc.ARRIVED)

    # data-quality gate on the staged zone
    results, _ = dq.run_suite_specs(conf.dq_suite, staged, conf.as_of)
    dq.write_results(results, f"{lake}/dq_results", run_id)
    this_run = spark.read.schema(results.schema).parquet(f"{lake}/dq_results/run_id={run_id}")
    dq.gate(this_run)

    # curated zone, in folders that nobody reads yet; then everything becomes visible at once
    new = publish(spark, conf, before, run, runs, staged, schemas, counts)
    log.record_arrivals(spark, lake, run, files)
    log.commit(spark, lake, new)
    forget(spark, conf, before, new)

    published = read_published(spark, lake, new)
    summary = {
        "funnel": published["funnel_dropoff"].orderBy("stage_no"),
        "top_categories": top_categories(published["category_performance"], 5),
        "avg_conversion": average_conversion(published["customer_360"], conf.funnel),
    }
    return MedallionResult(counts, this_run, published, summary)


def _changes(spark: SparkSession, conf: MedallionConfig, fact: inc.Fact, schema, run: int, runs: Sequence[int], superseded: int,
             everything: DataFrame | None) -> DataFrame:
    """A fact's rows for the state: all staged ones, or what this run added (+1) and superseded (-1)."""
    lake = conf.lake_dir.rstrip("/")
    if everything is not None:
        return everything.withColumn("_sign", F.lit(1))
    rows = inc.read_runs(spark, inc.staged_path(lake, fact.name), schema, [run]).drop(inc.RUN).withColumn("_sign", F.lit(1))
    if superseded:
        rows = rows.unionByName(inc.superseded_rows(spark, lake, fact, schema, run, runs).withColumn("_sign", F.lit(-1)))
    return rows


def _rules(conf: MedallionConfig) -> str:
    """What the state depends on beside the rows."""
    return repr((conf.funnel, conf.completed_value, sorted(conf.types.get("customers", {}).items())))


def publish(spark: SparkSession, conf: MedallionConfig, before: log.Version, run: int, runs: Sequence[int],
            staged: dict[str, DataFrame], schemas: dict, counts: dict) -> log.Version:
    """Bring state and curated tables up to date in this run's folders; the version that names them.

    Reads what the run added, the state's touched buckets and the dimensions. The whole staged zone is
    read only by a full run, or when the rules have changed.
    """
    lake, rules = conf.lake_dir.rstrip("/"), _rules(conf)
    fresh = not runs or before.rules != rules or not before.buckets
    buckets = conf.buckets if fresh else before.buckets
    old = {} if fresh else before.tables
    customers, products = business_columns(staged["customers"]), business_columns(staged["products"])
    rows = {n: _changes(spark, conf, f, schemas[n], run, runs, counts[f"superseded.{n}"], staged[n] if fresh else None)
            for n, f in facts(conf, None).items()}
    events, done = rows["clickstream_events"], completed(rows["transactions"], completed_value=conf.completed_value)
    key_type = dict(customers.dtypes)["customer_id"]
    who = kept.customer_state(conf.funnel)
    tables, shapes, touched = {}, {}, {}
    states = ((who, kept.customer_changes(events, done, conf.funnel, key_type), buckets),
              (kept.PRODUCTS, kept.product_changes(done), buckets), (kept.TYPES, kept.type_changes(events), 1))
    sums, *applied = together(
        partial(kept.checksums, customers, "customer_id", buckets),
        *[partial(kept.apply_changes, spark, lake, state, old.get(state.name, {}), changes, run, n) for state, changes, n in states])
    for (state, _, _), (held, schema, which) in zip(states, applied):
        tables[state.name], shapes[state.name], touched[state.name] = held, schema, which

    # profiles: the buckets in which the state or the customers' own rows changed
    seen = {} if fresh else before.checksums.get("customers", {})
    differ = {int(b) for b in {*sums, *seen} if sums.get(b) != seen.get(b)}
    state_of = lambda s, wanted=None: kept.read_buckets(spark, lake, s.name, shapes[s.name], tables[s.name], wanted)
    whole = kept.profile(customers, state_of(who), conf.funnel)
    name = "curated/customer_360"
    if whole.schema.json() != before.schemas.get(name):
        changed = sorted(range(buckets))
    else:
        changed = sorted({*touched[who.name], *differ}) if not fresh else sorted(range(buckets))
    bucket = kept.bucket_of("customer_id", buckets)
    some = customers if len(changed) == buckets else customers.filter(bucket.isin(changed))

    def write_profiles():
        return kept.write_buckets(kept.profile(some, state_of(who, changed), conf.funnel), lake, name, run, bucket, changed) \
            if changed else {}

    # the small tables are written whole
    small = {"category_performance": kept.categories(state_of(kept.PRODUCTS), products),
             "funnel_dropoff": kept.dropoff(state_of(kept.TYPES), conf.funnel.stages),
             "event_type_counts": state_of(kept.TYPES).select("event_type", F.col("events").alias("event_count"))}

    def write_small(t, df):
        df.coalesce(1).write.mode("overwrite").parquet(kept.bucket_path(lake, f"curated/{t}", run, 0))

    wrote, *_ = together(write_profiles, *[partial(write_small, t, df) for t, df in small.items()])
    tables[name], shapes[name] = kept.carried(old.get(name, {}), changed, wrote), whole.schema
    counts[f"rewritten.{name}"] = len(changed)
    for t, df in small.items():
        tables[f"curated/{t}"], shapes[f"curated/{t}"] = {"0": run}, df.schema
    return log.Version(version=before.version + 1, run=run, mode=conf.mode, runs=(*runs, run), buckets=buckets, tables=tables,
                       schemas={**{n: x.json() for n, x in shapes.items()}, **{f"staged/{n}": x.json() for n, x in schemas.items()}},
                       checksums={"customers": sums}, rules=rules)


def read_published(spark: SparkSession, lake: str, version: log.Version | int | None = None) -> dict[str, DataFrame]:
    """The curated tables of one version of a lake, by default the latest; no table of a lake without one."""
    lake = lake.rstrip("/")
    if not isinstance(version, log.Version):
        version = log.latest(spark, lake) if version is None else log.read_version(spark, lake, version)
    return {t: kept.read_buckets(spark, lake, f"curated/{t}", T.StructType.fromJson(json.loads(version.schemas[f"curated/{t}"])),
                                 version.tables[f"curated/{t}"])
            for t in CURATED if f"curated/{t}" in version.tables}


def register_published(spark: SparkSession, lake: str, version: int | None = None, prefix: str = "") -> list[str]:
    """The curated tables of one version as temporary views for ``spark.sql``."""
    tables = read_published(spark, lake, version)
    for t, df in tables.items():
        df.createOrReplaceTempView(prefix + t)
    return [prefix + t for t in tables]


def forget(spark: SparkSession, conf: MedallionConfig, before: log.Version, new: log.Version) -> None:
    """Delete what no kept version needs: staged runs that were replaced, folders of replaced buckets.

    Raw drops stay. Staged runs that a full run has replaced go at once; runs that were merged and a version's
    folders stay for ``log.KEEP`` more versions, so its readers can finish.
    """
    lake = conf.lake_dir.rstrip("/")
    tables = [_zone(conf, "staged", t) for t in (*DIMENSIONS, *FACTS)]
    tables += [inc.reject_path(lake, f, k) for f in FACTS for k in ("pending", "superseded", "rejects")]
    for t in tables:
        for r in before.runs if new.mode == "full" else ():
            delete_path(spark, inc.run_path(t, r))
    gone = new.version - log.KEEP - 1
    if gone >= 0:
        needed_runs = {r for v in range(gone + 1, new.version) for r in log.read_version(spark, lake, v).runs} | set(new.runs)
        for r in set(log.read_version(spark, lake, gone).runs) - needed_runs:
            for t in (*tables, f"{lake}/_arrivals"):
                delete_path(spark, inc.run_path(t, r))
        named = lambda v: {(t, r, b) for t, held in v.tables.items() for b, r in held.items()}
        needed = {x for v in range(gone + 1, new.version) for x in named(log.read_version(spark, lake, v))} | named(new)
        for t, r, b in named(log.read_version(spark, lake, gone)) - needed:
            delete_path(spark, kept.bucket_path(lake, t, r, b))


# ----- runs over sources ------------------------------------------------------------

def run_sources(spark: SparkSession, sources: dict[str, Sequence[log.Source]], conf: MedallionConfig,
                columns: dict[str, Sequence[str]] | None = None) -> MedallionResult:
    """A run over what has arrived (S6, S8): each table of ``sources`` has one or several of them.

    A full run reads every file, an incremental run every file of the dimensions (snapshots) and
    those of the facts that no committed run has read: batch files, landed stream records and catalog tables
    alike. The files are listed once; exactly these are read and recorded.
    """
    lake, columns = conf.lake_dir.rstrip("/"), columns or RAW_COLUMNS
    known = log.arrivals(spark, lake, log.latest(spark, lake).runs) if conf.mode == "incremental" else None
    raw, read = {}, []
    for t, own in sources.items():
        frames = []
        for source in own:
            files = log.files_of(spark, source, known if t in FACTS else None)
            read += files
            frames.append(log.read_files(spark, source, files, columns[t]))
        raw[t] = union_sources(*frames).select(*frames[0].columns)
    return run_medallion(spark, raw, conf, files=read)


# ----- command line ---------------------------------------------------------------

def main(argv: Sequence[str] | None = None) -> int:
    """``spark-submit -m tidemark.plans.medallion --raw-dir ... --lake-dir ...``.

    Reads the four raw tables (``<raw-dir>/<table>.csv`` or ``.parquet``, a file or a folder
    of files, or with ``--catalog DB`` the file-based tables of a catalog database),
    runs every zone and prints the summary. ``--mode incremental`` takes only fact files and landed
    records that no committed run has read. ``--cores`` and ``--input-tb`` size the session for a cluster.
    Exit code 1 when the data-quality gate stops the run.
    """
    import argparse

    from tidemark.session import cluster_conf, get_session

    ap = argparse.ArgumentParser(prog="tidemark-medallion")
    ap.add_argument("--raw-dir", default=None)
    ap.add_argument("--catalog", default=None, help="database that holds the four raw tables")
    ap.add_argument("--lake-dir", required=True)
    ap.add_argument("--format", default="csv", choices=("csv", "parquet"))
    ap.add_argument("--mode", default="full", choices=("full", "incremental"))
    ap.add_argument("--landed-stream", default=None, help="folder of landed stream records to add to the clickstream")
    ap.add_argument("--as-of", default=None, help="evaluation time for freshness, e.g. 2026-06-01")
    ap.add_argument("--buckets", type=int, default=None, help="parts of the keyed tables of a new lake")
    ap.add_argument("--compact", action="store_true", help="afterwards merge the small runs of the lake")
    ap.add_argument("--cores", type=int, default=None)
    ap.add_argument("--input-tb", type=float, default=1.0)
    ap.add_argument("--master", default=None)
    args = ap.parse_args(argv)
    if bool(args.raw_dir) == bool(args.catalog):
        ap.error("give either --raw-dir or --catalog")
    spark = get_session(args.master, extra_conf=cluster_conf(args.cores, args.input_tb) if args.cores else None)
    sources = {t: [log.Source(t, table=f"{args.catalog}.{t}") if args.catalog else
                   log.Source(t, f"{args.raw_dir.rstrip('/')}/{t}.{args.format}", args.format)] for t in RAW_COLUMNS}
    if args.landed_stream:
        sources["clickstream_events"].append(log.Source("clickstream_events/landed", args.landed_stream, "parquet", optional=True))
    conf = MedallionConfig(lake_dir=args.lake_dir.rstrip("/"), as_of=args.as_of, mode=args.mode)
    if args.buckets:
        conf.buckets = args.buckets
    try:
        res = run_sources(spark, sources, conf)
    except dq.DataQualityError as e:
        print(f"curated layer NOT published: {e}")
        return 1
    if args.compact:
        from tidemark.plans.compaction import compact
        compact(spark, conf)
    for k, v in sorted(res.counts.items()):
        print(f"{k:40s} {v:>14,}")
    res.summary["funnel"].show(truncate=False)
    res.summary["top_categories"].show(truncate=False)
    res.summary["avg_conversion"].show(truncate=False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
