"""One run over landed payloads: what is due is merged, checked and exported, and leaves its run rows.

Payloads are fetched by others and land below an inbox:

    primary/*.json     pages of statuses, and verifications ({"id": ..., "error": ...} for a post that is gone)
    tracker/listing/*.html, tracker/status/*.html
    bulk/*.json        the bulk archive, one array a file

A file's time is the instant of observation, of every row in it: what stands in
several files is as many observations.  The data set knows the files it has
taken (by name and time, written with the version that has their rows), so a
run takes the others whenever they landed.  ``verify`` names the posts that the
next verification should look at.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelog import control, report
from tidelog.operators import checks
from tidelog.operators import merge as merging
from tidelog.plans import views
from tidelog.schema import ENGAGEMENT, OBSERVATION, RUN
from tidelog.sources import landed, paged, sinks, store, tracker_html
from tidelog.streaming import micro

HANDLE = "own"


PATTERNS = {"primary": ("primary/*.json",), "tracker": ("tracker/listing/*.html", "tracker/status/*.html"), "bulk": ("bulk/*.json",)}
_ENGAGEMENT = "struct<replies:bigint,reblogs:bigint,favourites:bigint,upvotes:bigint,downvotes:bigint>"
#: What comes along with a partial: the instant of observation, and where it stands.
_CARRY = ("observed_at", "file", "line")


def _wholes(spark: SparkSession, paths: list[str]) -> DataFrame:
    """file, observed_at and value of whole files: pages, which are small."""
    meta = F.col("_metadata")
    return spark.read.text(paths, wholetext=True).select(meta["file_path"].alias("file"), meta["file_modification_time"].cast("timestamp_ntz").alias("observed_at"), "value")


def _primary(spark: SparkSession, paths: list[str]) -> list[DataFrame]:
    array = F.when(F.ltrim("value").startswith("["), F.col("value")).otherwise(F.concat(F.lit("["), "value", F.lit("]")))
    raw = _wholes(spark, paths).select("observed_at", "file", F.posexplode(F.from_json(array, "array<string>")).alias("pos", "raw")).withColumn("line", F.struct(F.lit(0).cast("bigint").alias("block"), F.col("pos").cast("bigint").alias("turn")))
    return [landed.primary_rows(raw, _CARRY)]


def _tracked(spark: SparkSession, paths: list[str], handle: str) -> list[DataFrame]:
    out, line = [], F.struct(F.lit(0).cast("bigint").alias("block"), F.lit(0).cast("bigint").alias("turn"))
    for folder, parse in (("/listing/", lambda f: landed.of_account(tracker_html.listing(f), handle).filter("not reposted")), ("/status/", lambda f: tracker_html.status_pages(f, handle))):
        if some := [p for p in paths if folder in p]:
            files = _wholes(spark, some)
            found = parse(files.select(F.col("file").alias("url"), F.col("value").alias("html"))).filter("error is null and ts_id is not null")
            # a page's time by its name, which is its key
            out.append(found.join(files.select(F.col("file").alias("page"), "observed_at"), "page").withColumn("file", F.col("page")).withColumn("line", line).drop("page", "error"))
    return out


def _bulk(spark: SparkSession, paths: list[str], handle: str) -> list[DataFrame]:
    return [landed.bulk_partials(landed.bulk_objects(spark, paths).withColumnRenamed("at", "observed_at"), handle, _CARRY)]


def partials(spark: SparkSession, paths: list[str], source: str, run_id: str, handle: str = HANDLE) -> DataFrame:
    """Observations (seq null) of a source's files, with engagement, statuses_count, file and line."""
    found = _primary(spark, paths) if source == "primary" else _tracked(spark, paths, handle) if source == "tracker" else _bulk(spark, paths, handle)
    out = None
    for p in found:
        given = {"run_id": F.lit(run_id), "seq": F.lit(0)}
        fields = [given.get(f.name, F.col(f.name) if f.name in p.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in OBSERVATION.fields]
        counts = (F.col("engagement") if "engagement" in p.columns else F.lit(None)).cast(_ENGAGEMENT).alias("engagement")
        account = (F.col("account.statuses_count") if "account" in p.columns and source == "primary" else F.lit(None)).cast("bigint").alias("statuses_count")
        one = p.select(*fields, counts, account, "file", "line")
        out = one if out is None else out.unionByName(one)
    return out


#: Order of observations: by time, then by where they stand.
_ORDER = ("observed_at", "file", "line")


def _batch(rows: DataFrame) -> DataFrame:
    turn = F.row_number().over(Window.partitionBy("ts_id").orderBy(*_ORDER, F.xxhash64(*OBSERVATION.fieldNames()))).cast("bigint")
    return rows.withColumn("seq", turn).select(*OBSERVATION.fieldNames())


def _merged(spark: SparkSession, root: str, stage: str, paths: list[str], source: str, run_id: str, name: str, files: DataFrame | None, handle: str) -> tuple[DataFrame, dict]:
    """Merges what stands in files, under a batch's name; gives its rows, written once below stage, and the counts."""
    partials(spark, paths, source, run_id, handle).write.mode("overwrite").parquet(f"{stage}/rows")
    rows = spark.read.parquet(f"{stage}/rows")
    counted = rows.filter("engagement is not null").select("ts_id", "source", "observed_at", "engagement.*", *_ORDER[1:])
    ingested = F.struct(F.col("observed_at").cast("timestamp").alias("at"), "file", F.col("line.block").alias("block"), F.col("line.turn").alias("turn"))
    shots = counted.select(*[F.col(f.name) for f in ENGAGEMENT.fields], ingested.alias("ingest_seq"))
    return rows, micro.merge_into(_batch(rows), root, name, shots, files)


def walk(spark: SparkSession, root: str, inbox: str, checkpoint: str, pages: int = 20, handle: str = HANDLE) -> None:
    """Merges the pages of a timeline that have landed (see ``paged``), so many a batch, and ends; a later call goes on where this one stopped."""
    spark.dataSource.register(paged.LandedPages)

    def step(batch: DataFrame, batch_id: int) -> None:
        found = [r["file"] for r in batch.orderBy("run", "page").collect()]
        if found:
            stream = json.loads(store.read_text(spark, f"{checkpoint}/metadata"))["id"]
            stage = f"{root}/staging/{stream}-{batch_id}"
            _merged(spark, root, stage, found, "primary", f"walk-{batch_id}", f"{stream}-{batch_id}", None, handle)
            sinks.remove(spark, stage)

    stream = spark.readStream.format("landed_pages").option("path", inbox).option("pagesPerBatch", str(pages)).load()
    query = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def ingest(spark: SparkSession, root: str, inbox: str, source: str, run_id: str, state: dict, handle: str = HANDLE) -> dict:
    """Merges a source's new files; gives the counts of its run row."""
    known = state.setdefault("sources", {}).setdefault(source, {})
    stage = f"{root}/staging/{run_id}-{source}"
    listed = None
    for pattern in PATTERNS[source]:
        some = landed.landed_files(spark, f"{inbox}/{pattern}")
        listed = some if listed is None else listed.unionByName(some)
    taken = landed.processed_files(spark, root).filter(F.col("source") == source).select("file", "at")
    # the list stands before anything is read; the files' names are what any reader of them holds
    listed.join(taken, ["file", "at"], "left_anti").select(F.lit(source).alias("source"), "file", F.col("at").cast("string").alias("at")).write.mode("overwrite").parquet(f"{stage}/files")
    files = spark.read.schema("source string, file string, at string").parquet(f"{stage}/files")
    paths = sorted(r["file"] for r in files.select("file").collect())
    if not paths:
        sinks.remove(spark, stage)
        return {"notes": "nothing new"}
    rows, done = _merged(spark, root, stage, paths, source, run_id, f"{run_id}-{source}", files, handle)
    batch, order = _batch(rows), _ORDER
    if source == "primary":
        count = rows.filter("statuses_count is not null").agg(F.max_by("statuses_count", F.struct(*order))).first()[0]
        known["statuses_count"] = count if count is not None else known.get("statuses_count")
        fetched = batch.filter("not coalesce(gone, false)").select("ts_id", "created_at_utc")
        known["verify"] = [r["ts_id"] for r in merging.deletion_candidates(landed.posts(spark, root), fetched).collect()]
    sinks.remove(spark, stage)
    return done


def run(spark: SparkSession, root: str, inbox: str, output: str | None, now: dt.datetime, sources: tuple[str, ...] = control.ORDER, handle: str = HANDLE) -> tuple[int, str]:
    """(exit code, summary line): 2 for hard violations, 1 for a source that failed, else 0.  Rows, checks and exports are written."""
    state_path, run_id = f"{root}/state.json", control.new_run_id(now)
    state = landed.state(state_path)
    due = [s for s in control.ORDER if s in sources and control.due(state, s, now)]

    def step(source: str):
        def one() -> dict:
            done = ingest(spark, root, inbox, source, run_id, state, handle)
            state["sources"][source]["last_fetch_at"] = now.isoformat()
            return done

        return one

    outcome = control.run_sources({s: step(s) for s in due}, run_id, lambda: now)
    sinks.save_state(state, state_path)
    rows = [tuple(r.get(f.name).replace(tzinfo=None) if isinstance(r.get(f.name), dt.datetime) else r.get(f.name) for f in RUN.fields) for r in outcome.rows]
    if rows:
        sinks.append_log(spark.createDataFrame(rows, RUN), f"{root}/runs/{run_id}")
    bad = violations(spark, root, now, run_id if rows else None, state)
    counts = {(r["severity"], r["code"]): r["n"] for r in bad.groupBy("severity", "code").agg(F.count("*").alias("n")).collect()}
    outcome.hard = any(severity == "hard" for severity, _ in counts)
    if output is not None:
        export(spark, root, output, now, counts)
    total = lambda k: sum(r.get(k) or 0 for r in outcome.rows)
    return outcome.exit_code, f"+{total('new_posts')} posts, +{total('deletions_found')} deletions, checks {'failed' if outcome.hard else 'ok'}"


def violations(spark: SparkSession, root: str, now: dt.datetime, run_id: str | None = None, state: dict | None = None) -> DataFrame:
    """All checks over the data set at root: records, files, logs, and the totals that the sources gave last."""
    filed = landed.filed_posts(spark, root)
    known = (state or {}).get("sources", {})
    at = F.lit(now.replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")
    return checks.run(
        landed.posts(spark, root), landed.deletion_log(spark, root), landed.engagement(spark, root), landed.runs(spark, root), at, lines=filed.select("line"), filed=filed, run_id=run_id,
        statuses_count=known.get("primary", {}).get("statuses_count"), tracker_total=known.get("tracker", {}).get("total"),
    )


def export(spark: SparkSession, root: str, output: str, now: dt.datetime, counts: dict) -> None:
    """checks.json, posts.csv and metrics.json (the last seven Eastern days and the weeks before them)."""
    posts = landed.posts(spark, root)
    sinks.export_json([{"severity": s, "code": c, "n": n} for (s, c), n in sorted(counts.items())], f"{output}/checks.json")
    sinks.export_posts(posts, f"{output}/posts.csv")
    day = spark.range(1).select(F.convert_timezone(F.lit("UTC"), F.lit("America/New_York"), F.lit(now.replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")).cast("date")).first()[0]
    found = views.register(spark, posts, landed.engagement(spark, root), landed.deletion_log(spark, root), landed.runs(spark, root))
    sinks.export_json(report.baseline(found, (day - dt.timedelta(days=6)).isoformat(), day.isoformat()), f"{output}/metrics.json")


def rebuild(spark: SparkSession, root: str, database: str) -> dict[str, int]:
    """The relations as tables of a database, all of one version of the data set; rows by table.

    All are written to a folder of this rebuild first.  Then each table is
    pointed at its part of it: no table is ever missing, and a query that has
    begun goes on with the files it has.  ``rebuilt`` gives readers all tables
    of one rebuild, whatever is being pointed elsewhere.
    """
    version = store.current(spark, root)
    found = {"posts": landed.posts(spark, root, version), "engagement": landed.engagement(spark, root, version), "deletions": landed.deletion_log(spark, root, version), "runs": landed.runs(spark, root)}
    found["media"] = views.media_rows(found["posts"])
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    base = _rebuilds(spark, database)
    before = store.numbers(spark, base)
    name = f"{max(before, default=0) + 1:012d}"
    for table, df in found.items():
        df.write.mode("overwrite").parquet(f"{base}/{name}/{table}")
    made = store.Batch(spark, base, name)
    made.logs = {table: [f"{name}/{table}"] for table in found}
    made.commit({})
    for table, df in found.items():
        if spark.catalog.tableExists(f"{database}.{table}"):
            spark.sql(f"ALTER TABLE {database}.{table} SET LOCATION '{base}/{name}/{table}'")
            spark.catalog.refreshTable(f"{database}.{table}")
        else:
            spark.catalog.createTable(f"{database}.{table}", f"{base}/{name}/{table}", "parquet", df.schema)
    for old in before[:-1]:
        sinks.remove(spark, f"{base}/{old:012d}")
    return {table: spark.table(f"{database}.{table}").count() for table in found}


def _rebuilds(spark: SparkSession, database: str) -> str:
    where = spark.sql(f"DESCRIBE DATABASE {database}").filter("info_name = 'Location'").first()["info_value"]
    return f"{where.rstrip('/')}/rebuilds"


def rebuilt(spark: SparkSession, database: str) -> dict[str, DataFrame]:
    """The tables of the last rebuild that was finished, all of it: one pointer says which."""
    found = store.current(spark, _rebuilds(spark, database))
    return {table: spark.read.parquet(*found.log_paths(table)) for table in found.logs}
