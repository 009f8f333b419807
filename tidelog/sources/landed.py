"""Landed files as DataFrames: stored data sets and source payloads.

Schemas are given, never inferred: all-null columns and maps would come out
wrong.  Instants are ISO strings in files and TIMESTAMP_NTZ here.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions.texts import card_domain, classify, media_type_of, repost_split, without_accounts
from tidelog.functions.times import parse_instant
from tidelog.schema import DELETION, ENGAGEMENT, MEDIA_ITEM, POST, RUN, as_text
from tidelog.sources import json_array, store


def _typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """df in the types of a schema; instants are ISO text.

    All of a row's instants are parsed by one expression: one for each would be
    too much code for a generated stage.
    """
    instants = [f.name for f in schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
    if instants:
        df = df.withColumn("__instants", F.transform(F.array(*instants), parse_instant))
    at = lambda f: F.get("__instants", F.lit(instants.index(f.name)))
    return df.select(*[at(f).alias(f.name) if f.name in instants else F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(where)
    return found is not None and len(found) > 0


def _empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def _json(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    there = isinstance(path, list) or _exists(spark, path)
    return _typed(spark.read.schema(as_text(schema)).json(path), schema) if there else _empty(spark, schema)


def posts(spark: SparkSession, root: str, version: store.Version | None = None) -> DataFrame:
    """Records of a data set's newest version (or of a given one); without a manifest, posts/*.jsonl or posts/month=*/; none without the folder."""
    return standing_posts(spark, version or store.current(spark, root)).drop("standing")


def standing_posts(spark: SparkSession, version: store.Version, months: list[str] | None = None) -> DataFrame:
    """posts of a version (of some months' folders) with standing, the month of the folder or file that each stands in."""
    paths, schema = version.post_paths(months), T.StructType([*POST.fields, T.StructField("standing", T.StringType())])
    if not paths:
        return _empty(spark, schema)
    return _typed(spark.read.schema(as_text(POST)).json(paths).withColumn("standing", _standing(F.col("_metadata.file_path"))), schema)


def _standing(path: Column) -> Column:
    folder = F.regexp_extract(path, r"month=([^/]+?)(?:\.old)?/[^/]*$", 1)
    return F.when(folder != "", folder).otherwise(F.regexp_extract(path, r"/([^/]+)\.jsonl$", 1))


def sorted_posts(spark: SparkSession, root: str) -> DataFrame:
    return posts(spark, root).orderBy(F.col("ts_id").cast("bigint"))


FILED = T.StructType([T.StructField("file", T.StringType()), T.StructField("file_month", T.StringType()), T.StructField("line_no", T.LongType()), T.StructField("line", T.StringType()), *POST.fields])


def filed_posts(spark: SparkSession, root: str) -> DataFrame:
    """posts with file, file_month, line_no (ascending in a file) and line, as they stand in the files of either layout."""
    paths = store.current(spark, root).post_paths()
    if not paths:
        return _empty(spark, FILED)
    where = F.col("_metadata.file_path")
    month = _standing(where)
    # splits of a file are read in order of their start; a split's rows in order of the running id
    number = F.col("_metadata.file_block_start") * F.lit(1 << 20) + F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    lines = spark.read.text(paths).select(where.alias("file"), month.alias("file_month"), number.alias("line_no"), F.col("value").alias("line")).filter(F.trim("line") != "")
    parsed = lines.withColumn("r", F.from_json("line", as_text(POST)))
    return _typed(parsed.select("file", "file_month", "line_no", "line", "r.*"), FILED)


def keyed_posts(spark: SparkSession, root: str) -> DataFrame:
    """One record for each id: of several the last, in order of file and line."""
    filed = filed_posts(spark, root)
    record = F.struct(*POST.fieldNames())
    return filed.groupBy("ts_id").agg(F.max_by(record, F.struct("file", "line_no")).alias("r")).select("r.*")


def engagement(spark: SparkSession, root: str, version: store.Version | None = None) -> DataFrame:
    """engagement/*.csv with header, blank for null.

    ingest_seq is the order of ingest, the same at every read: by the file's
    time and name, the split's start in the file, and the row's turn in the split.
    """
    paths = (version or store.current(spark, root)).log_paths("engagement")
    if not paths:
        return _empty(spark, T.StructType([*ENGAGEMENT.fields, T.StructField("ingest_seq", T._parse_datatype_string("struct<at:timestamp,file:string,block:bigint,turn:bigint>"))]))
    raw = spark.read.schema(as_text(ENGAGEMENT)).option("header", True).option("nullValue", "").option("recursiveFileLookup", True).csv(paths)
    file = F.col("_metadata")
    order = F.struct(file["file_modification_time"].alias("at"), file["file_path"].alias("file"), file["file_block_start"].alias("block"), F.monotonically_increasing_id().alias("turn"))
    typed = [parse_instant(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.TimestampNTZType) else F.col(f.name) for f in ENGAGEMENT.fields]
    return raw.select(*typed, order.alias("ingest_seq"))


def deletion_log(spark: SparkSession, root: str, version: store.Version | None = None) -> DataFrame:
    paths = (version or store.current(spark, root)).log_paths("deletions")
    return _json(spark, paths, DELETION) if paths else _empty(spark, DELETION)


def anomalies(spark: SparkSession, root: str) -> DataFrame:
    """What the merges noted: ts_id, seq, code, detail."""
    schema = T._parse_datatype_string("ts_id string, seq long, code string, detail string")
    paths = store.current(spark, root).log_paths("anomalies")
    return _json(spark, paths, schema) if paths else _empty(spark, schema)


def runs(spark: SparkSession, root: str) -> DataFrame:
    return _json(spark, f"{root}/runs/*", RUN)


def state(path: str) -> dict:
    """Per-source cursors, a small document of the driver; a fresh one if there is none."""
    try:
        with open(path, encoding="utf-8") as f:
            return json.load(f)
    except FileNotFoundError:
        return {"version": 1, "sources": {}}


# -- payloads ----------------------------------------------------------------

_PERSON = "struct<acct:string,statuses_count:bigint,followers_count:bigint,last_status_at:string>"
_BODY = (
    "content:string,language:string,media_attachments:array<struct<type:string,url:string,preview_url:string,meta:struct<original:struct<width:int,height:int,duration:double>>>>,"
    "card:struct<url:string,title:string>,mentions:array<struct<acct:string>>,tags:array<struct<name:string>>"
)
STATUS = (
    f"struct<id:string,created_at:string,edited_at:string,in_reply_to_id:string,quote_id:string,pinned:boolean,{_BODY},account:{_PERSON},"
    f"reblog:struct<id:string,created_at:string,account:{_PERSON},{_BODY}>,quote:struct<id:string,account:{_PERSON}>,"
    "replies_count:bigint,reblogs_count:bigint,favourites_count:bigint,upvotes_count:bigint,downvotes_count:bigint>"
)
BULK_ROW = "struct<id:string,created_at:string,content:string,url:string,media:array<string>,replies_count:bigint,reblogs_count:bigint,favourites_count:bigint>"


#: What a verification of a post that is gone lands as.
GONE = "struct<id:string,error:string>"


def gone(raw: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Observation fields of verifications (column raw, JSON text) that found no post: an id and an error.  Columns to carry come along."""
    s = raw.select(*carry, F.from_json("raw", GONE).alias("s")).filter(F.col("s.error").isNotNull() & (F.coalesce("s.id", F.lit("")) != ""))
    return s.select(*carry, F.col("s.id").alias("ts_id"), F.lit("primary").alias("source"), F.lit(True).alias("gone"))


def unprocessed(hits: DataFrame, processed: DataFrame) -> DataFrame:
    """Tracker ids of search hits marked as removed that no run has processed yet (processed: tracker_id)."""
    found = hits.filter(F.col("removed") & F.col("tracker_id").isNotNull()).select("tracker_id").distinct()
    return found.join(processed.select("tracker_id").distinct(), "tracker_id", "left_anti")


def statuses(documents: DataFrame, column: str = "value") -> DataFrame:
    """One row (raw: JSON text) for each status in payloads that are one status or an array of them."""
    array = F.when(F.ltrim(F.col(column)).startswith("["), F.col(column)).otherwise(F.concat(F.lit("["), column, F.lit("]")))
    return documents.select(F.explode(F.from_json(array, "array<string>")).alias("raw"))


def primary_partials(raw: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Observation fields of primary statuses (column raw, JSON text); rows without an id go.  Columns to carry come along.

    A reblog's content is that of the post it names.
    """
    return _primary_fields(raw.select(*carry, "raw", F.from_json("raw", STATUS).alias("s")).filter((F.coalesce(F.col("s.id"), F.lit("")) != "") & F.get_json_object("raw", "$.error").isNull()), carry)


def primary_rows(raw: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """What ``primary_partials`` and ``gone`` give, in one pass: of a verification that found no post all fields but its id and source are null."""
    # as an item of an array, so that the text is parsed once, not again by the filter
    status = F.from_json("raw", STATUS.replace("struct<", "struct<error:string,", 1))
    wanted = lambda s: (F.coalesce(s["id"], F.lit("")) != "") & (s["error"].isNotNull() | F.get_json_object("raw", "$.error").isNull())
    s, is_gone = raw.select(*carry, "raw", F.explode(F.filter(F.array(status), wanted)).alias("s")), F.col("s.error").isNotNull()
    some = _primary_fields(s.select(*carry, F.when(~is_gone, F.col("raw")).alias("raw"), "s", F.when(is_gone, F.lit(True)).alias("gone")), (*carry, "gone"))
    named = (*carry, "gone", "ts_id", "source")
    return some.select(*[F.col(c) if c in named else F.when(F.col("gone").isNull(), F.col(c)).alias(c) for c in some.columns])


def _primary_fields(s: DataFrame, carry: tuple[str, ...]) -> DataFrame:
    is_reblog = F.col("s.reblog.id").isNotNull()
    body = lambda f: F.when(is_reblog, F.col(f"s.reblog.{f}")).otherwise(F.col(f"s.{f}"))
    null = F.lit(None).cast("string")
    kind = classify(is_reblog, F.coalesce("s.in_reply_to_id", F.lit("")) != "", (F.coalesce("s.quote_id", F.lit("")) != "") | F.col("s.quote").isNotNull())
    item = lambda a: F.struct(a["type"].alias("type"), a["url"].alias("url"), a["preview_url"].alias("preview_url"), null.alias("mirror_url"), a["meta"]["original"]["width"].alias("width"), a["meta"]["original"]["height"].alias("height"), a["meta"]["original"]["duration"].alias("duration"))
    names = lambda c, f: F.filter(F.transform(F.coalesce(c, F.array().cast(f"array<struct<{f}:string>>")), lambda x: x[f]), lambda x: F.coalesce(x, F.lit("")) != "")
    media = F.transform(body("media_attachments"), item).cast(T.ArrayType(MEDIA_ITEM))
    quoted = F.col("kind") == "quote"
    some = s.withColumn("kind", kind)
    return some.select(
        *carry, F.col("s.id").alias("ts_id"), F.lit("primary").alias("source"), parse_instant(F.col("s.created_at")).alias("created_at_utc"), "kind",
        F.coalesce(body("content"), F.lit("")).alias("content_html"), body("language").alias("lang"), F.col("s.in_reply_to_id").alias("in_reply_to_id"),
        parse_instant(F.col("s.edited_at")).alias("edited_at"), F.coalesce("s.pinned", F.lit(False)).alias("pinned"),
        F.coalesce(media, F.array().cast(T.ArrayType(MEDIA_ITEM))).alias("media"), names(body("mentions"), "acct").alias("mentions"), names(body("tags"), "name").alias("tags"),
        F.when(quoted, F.coalesce("s.quote.id", "s.quote_id")).alias("quote_id"), F.when(quoted, F.col("s.quote.account.acct")).alias("quote_of_acct"),
        F.when(F.col("kind") == "reblog", F.col("s.reblog.id")).alias("reblog_of_id"), F.when(F.col("kind") == "reblog", F.col("s.reblog.account.acct")).alias("reblog_of_acct"),
        F.when(F.col("kind") == "reblog", parse_instant(F.col("s.reblog.created_at"))).alias("reblog_of_created_at"),
        body("card.url").alias("card_url"), card_domain(body("card.url")).alias("card_domain"), body("card.title").alias("card_title"),
        without_accounts("raw").alias("raw_primary"),
        F.struct(*[F.col(f"s.{c}_count").alias(c) for c in ("replies", "reblogs", "favourites", "upvotes", "downvotes")]).alias("engagement"),
        F.struct("s.account.statuses_count", "s.account.followers_count", "s.account.last_status_at").alias("account"),
    )


def bulk_partials(rows: DataFrame, handle: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """Observation fields of bulk archive rows (columns of BULK_ROW); rows without an id go.  Columns to carry come along."""
    some = rows.filter(F.coalesce("id", F.lit("")) != "")
    null = F.lit(None)
    item = lambda u: F.struct(media_type_of(u).alias("type"), u.alias("url"), null.cast("string").alias("preview_url"), null.cast("string").alias("mirror_url"), null.cast("int").alias("width"), null.cast("int").alias("height"), null.cast("double").alias("duration"))
    parts = repost_split(F.coalesce("content", F.lit("")), handle)
    return some.select(
        *carry, F.col("id").alias("ts_id"), F.lit("bulk").alias("source"), parse_instant(F.col("created_at")).alias("created_at_utc"), *[c.alias(k) for k, c in parts.items()],
        F.transform(F.coalesce("media", F.array().cast("array<string>")), item).alias("media"),
        F.struct(F.col("replies_count").alias("replies"), F.col("reblogs_count").alias("reblogs"), F.col("favourites_count").alias("favourites"), null.cast("bigint").alias("upvotes"), null.cast("bigint").alias("downvotes")).alias("engagement"),
    )


def bulk_archive(spark: SparkSession, path: str) -> DataFrame:
    """Rows of bulk archive files: each one JSON array."""
    return spark.read.schema(T._parse_datatype_string(BULK_ROW)).option("multiLine", True).json(path)


def bulk_objects(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Columns of BULK_ROW of archive files of any size, read by many tasks (see ``json_array``), with file, at and line, ascending in a file."""
    found = json_array.objects(spark, paths).select("file", "at", F.struct("block", "turn").alias("line"), F.from_json("value", BULK_ROW).alias("r"))
    return found.select("file", "at", "line", "r.*")


def landed_files(spark: SparkSession, pattern: str) -> DataFrame:
    """file and at (its time) of the files of a pattern; contents are not read."""
    schema = "file string, at timestamp_ntz"
    if not _exists(spark, pattern):
        return _empty(spark, T._parse_datatype_string(schema))
    found = spark.read.format("binaryFile").load(pattern)
    return found.select(F.col("path").alias("file"), F.col("modificationTime").cast("timestamp_ntz").alias("at"))


def processed_files(spark: SparkSession, root: str) -> DataFrame:
    """source, file and at of what the data set has taken."""
    schema = T._parse_datatype_string("source string, file string, at string")
    paths = store.current(spark, root).log_paths("files")
    return (spark.read.schema(schema).json(paths) if paths else _empty(spark, schema)).withColumn("at", F.col("at").cast("timestamp_ntz"))


def feed_items(spark: SparkSession, path: str) -> DataFrame:
    """RSS items: ts_id, tracker_id, url, created_at_utc, title, description_html."""
    schema = "link string, guid string, `truth:originalId` string, pubDate string, title string, description string"
    raw = spark.read.format("xml").option("rowTag", "item").schema(schema).load(path)
    url = F.coalesce(F.nullif(F.trim("link"), F.lit("")), F.nullif(F.trim("guid"), F.lit("")))
    return raw.select(
        F.trim("`truth:originalId`").alias("ts_id"), F.nullif(F.regexp_extract(url, r"/statuses/(\d+)", 1), F.lit("")).cast("int").alias("tracker_id"), url.alias("url"),
        parse_instant(F.col("pubDate")).alias("created_at_utc"), F.coalesce("title", F.lit("")).alias("title"), F.coalesce("description", F.lit("")).alias("description_html"),
    )


# Class names and the heading of a stats page, by which its figures are found.
STATS_CARD, STATS_VALUE, STATS_TOTAL, STATS_COVERAGE = "stats-page__summary-card--", "stats-page__summary-value", "stats-page__summary-value--total", "Total archive coverage:"


def stats_page(html: Column) -> dict[str, Column]:
    """total, original, quote, reblog, coverage_start, coverage_end of a stats page; null where it has none."""
    def within(rest: Column) -> Column:
        """The text of the element whose opening tag rest is in, a number without commas."""
        text = F.substring_index(F.substr(rest, F.instr(rest, ">") + 1), "<", 1)
        return F.replace(F.trim(text), F.lit(","))

    def count(kind: str) -> Column:
        card = F.substr(html, F.instr(html, f'{STATS_CARD}{kind}"') + 1)
        value = F.substr(card, F.instr(card, f'{STATS_VALUE}"') + 1)
        return F.when(html.contains(f'{STATS_CARD}{kind}"') & card.contains(f'{STATS_VALUE}"'), within(value)).try_cast("int")

    total = F.when(html.contains(f'{STATS_TOTAL}"'), within(F.substr(html, F.instr(html, f'{STATS_TOTAL}"') + 1))).try_cast("int")
    span = F.when(html.contains(STATS_COVERAGE), F.substring_index(F.substr(F.substring_index(html, STATS_COVERAGE, -1), F.instr(F.substring_index(html, STATS_COVERAGE, -1), ">") + 1), "<", 1))
    days = F.split(F.replace(span, F.lit("–"), F.lit("-")), "-")

    def day(i: int) -> Column:
        """Feb 14, 2022, the month by its first three letters."""
        words = F.filter(F.split(F.replace(F.get(days, F.lit(i)), F.lit(","), F.lit(" ")), "[ \\n\\t]+"), lambda w: w != "")
        at = lambda k: F.get(words, F.lit(k))
        return parse_instant(F.concat(at(1), F.lit(" "), F.substring(at(0), 1, 3), F.lit(" "), at(2), F.lit(" 00:00:00"))).cast("date")

    return {"total": total, **{k: count(k) for k in ("original", "quote", "reblog")}, "coverage_start": day(0), "coverage_end": day(1)}


def of_account(cards: DataFrame, handle: str) -> DataFrame:
    return cards.filter(F.col("account") == handle)


def observations(partials: DataFrame, observed_at: Column, run_id: Column, seq: Column) -> DataFrame:
    """Partials as observations, with the fields that their source lacks null."""
    from tidelog.schema import OBSERVATION

    given = {"observed_at": observed_at, "run_id": run_id, "seq": seq}
    out = []
    for f in OBSERVATION.fields:
        c = given.get(f.name, F.col(f.name) if f.name in partials.columns else F.lit(None))
        out.append(c.cast(f.dataType).alias(f.name))
    return partials.select(*out)
