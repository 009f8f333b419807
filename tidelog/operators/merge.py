"""Reconciling observations of posts into one record each.

Observations of a post come in order of seq; the current record, if there is
one, stands before them as a row of its own (seq -1), with the source of each
of its fields taken from field_sources.  Most rules then are aggregates:

* a field's value is the non-empty one of the highest source rank, of equals
  the latest: ``max_by(value, (rank, seq))`` over the non-empty ones.
  created_at_utc has a rank order of its own;
* deletion bounds are the largest lower and the smallest upper bound of the
  deletion signals; a signal's lower bound knows only what stood before it;
* status is that of the last signal or live sighting.

What depends on the state before a row (anomalies, bounds at a signal, the
source of a derived text) comes from running windows over the post's rows.

A list of media stands until one of the same or a higher rank comes; null parts
of its items fill from lists of the same length, those that stood before first,
then those that lost, in order.  So lists fall into runs of winners of one
length, and in the last run an item's part is that of the latest winner that
has it, else of the first loser that has it: running values by item, no list of
all lists.

A batch counts as one update: updated_at and updated_run_id are those of its
last observation of the post, if the record has changed.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.functions.texts import html_to_text
from tidelog.functions.times import eastern_fields, minutes_between
from tidelog.schema import CREATED_RANK, DEFAULT_SOURCE, DELETION, FIELDS, MEDIA_FILL, MEDIA_ITEM, POST, SCALARS, SOURCE_RANK


def rank_of(source: Column, ranks: dict[str, int] = SOURCE_RANK) -> Column:
    found = F.lit(0)
    for name, rank in ranks.items():
        found = F.when(source == name, F.lit(rank)).otherwise(found)
    return found


def non_empty(c: Column, kind: str) -> Column:
    if kind == "string":
        return c.isNotNull() & (c != "")
    if kind.startswith(("array", "map")):
        return c.isNotNull() & (F.size(c) > 0)
    return c.isNotNull()


def winner(value: Column, rank: Column, seq: Column, present: Column) -> Column:
    """The present value of the highest rank, of equals the latest."""
    return F.max_by(F.when(present, value), F.when(present, F.struct(rank, seq)))


def precedence(rows: DataFrame, key: list[str], value: str, rank: str, seq: str) -> DataFrame:
    """(key, value, rank) of the winning non-empty value by key."""
    present = non_empty(F.col(value), dict(rows.dtypes)[value])
    return rows.groupBy(*key).agg(
        winner(F.col(value), F.col(rank), F.col(seq), present).alias(value), F.max(F.when(present, F.struct(rank, seq))).getField(rank).alias(rank)
    )


def _held(value: Column, source: Column, rank: Column, seq: Column, kind: str) -> Column:
    """A present value as an offer; the largest one before a row is what stands."""
    return F.when(non_empty(value, kind), F.struct(rank.alias("r"), seq.alias("q"), source.alias("s"), value.alias("v")))


def _lost(value: Column, rank: Column, held: Column, kind: str, tolerance_s: float | None = None) -> Column:
    """Whether a present value lost against another that stood."""
    differs = held["v"] != value if tolerance_s is None else F.abs(minutes_between(held["v"], value)) * 60 > tolerance_s
    return non_empty(value, kind) & (held["r"] > rank) & differs


def _cut_text(value: Column, kind: str) -> Column:
    whole = F.to_json(F.struct(value.alias("v"))) if kind.startswith(("array", "map", "struct")) else value.cast("string")
    return F.substring(whole, 1, 60)


def disagreements(rows: DataFrame, key: list[str], value: str, source: str, rank: str, seq: str, field: str | None = None, tolerance_s: float | None = None) -> DataFrame:
    """Rows whose non-empty value lost against another value that stood: key, seq, field, old and new source and value."""
    kind = dict(rows.dtypes)[value]
    before = Window.partitionBy(*key).orderBy(seq).rowsBetween(Window.unboundedPreceding, -1)
    found = rows.withColumn("__h", F.max(_held(F.col(value), F.col(source), F.col(rank), F.col(seq), kind)).over(before)).filter(_lost(F.col(value), F.col(rank), F.col("__h"), kind, tolerance_s))
    return found.select(*key, F.col(seq), F.lit(field or value).alias("field"), F.col("__h.s").alias("old_source"), _cut_text(F.col("__h.v"), kind).alias("old_value"), F.col(source).alias("new_source"), _cut_text(F.col(value), kind).alias("new_value"))


_BEFORE = "OVER (PARTITION BY ts_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
_SO_FAR = "OVER (PARTITION BY ts_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
#: Fields that offer a value at each row; created_at_utc has ranks of its own.
OFFERED = (*SCALARS, "created_at_utc", "content_html", "media")
_LOOKED = tuple(f for f in OFFERED if f != "media")


def _rank(source: str, ranks: dict[str, int] = SOURCE_RANK) -> str:
    return f"CASE {source} " + " ".join(f"WHEN '{name}' THEN {rank}" for name, rank in ranks.items()) + " ELSE 0 END"


def _present(field: str, kind: str) -> str:
    if kind == "string":
        return f"{field} IS NOT NULL AND {field} <> ''"
    return f"{field} IS NOT NULL AND size({field}) > 0" if kind.startswith(("array", "map")) else f"{field} IS NOT NULL"


def _rows(current: DataFrame, observations: DataFrame) -> DataFrame:
    """Current records and observations as rows of one shape, each with what it offers.

    o_<field> is (rank, seq, source, value) of a present value; the largest one
    of a post's rows is what stands.  A default without provenance has the
    lowest rank and no source.
    """
    names = [f for f in FIELDS if f in observations.columns and f != "ts_id"]
    state = current.selectExpr(
        "ts_id", "-1L AS seq", "CAST(NULL AS STRING) AS source", "CAST(NULL AS TIMESTAMP_NTZ) AS observed_at", "CAST(NULL AS STRING) AS run_id", "false AS signal", "false AS removed", *names, f"struct({', '.join(FIELDS)}) AS was",
    )
    signal = "coalesce(removed, false) OR coalesce(gone, false) AS signal"
    seen = observations.selectExpr("ts_id", "seq", "source", "observed_at", "run_id", signal, "coalesce(removed, false) AS removed", *names, f"CAST(NULL AS {POST.simpleString()}) AS was")
    rows = state.unionByName(seen)
    kinds, out = dict(rows.dtypes), []
    for f in OFFERED:
        named = f"CASE WHEN seq < 0 THEN was.field_sources['{f}'] ELSE source END"
        rank = _rank(f"coalesce({named}, '{DEFAULT_SOURCE}')", CREATED_RANK if f == "created_at_utc" else SOURCE_RANK)
        out.append(f"CASE WHEN {_present(f, kinds[f])} THEN struct({rank} AS r, seq AS q, {named} AS s, {f} AS v) END AS o_{f}")
    plain = f"CASE WHEN seq < 0 THEN coalesce(was.field_sources['content_text'], '{DEFAULT_SOURCE}') ELSE source END"
    has_text = f"{_present('content_text', 'string')} AND coalesce(content_html, '') = ''"
    return rows.selectExpr(
        "ts_id", "seq", "source", "observed_at", "run_id", "signal", "removed", "was", *out,
        f"CASE WHEN {has_text} THEN struct({_rank(plain)} AS r, seq AS q, {plain} AS s, content_text AS v) END AS o_text", f"{plain} AS text_source",
        "CASE WHEN seq < 0 THEN was.last_verified_live_at WHEN source = 'primary' AND NOT signal THEN observed_at END AS live", "last_verified_live_at AS verified",
        "CASE WHEN seq < 0 THEN was.status WHEN signal THEN 'deleted' WHEN source = 'primary' THEN 'present' END AS event",
        "CASE WHEN seq < 0 THEN was.tracker_removed_at WHEN source = 'tracker' THEN tracker_removed_at END AS taken_down", "tracker_removed_at AS removed_at",
        *[f"CASE WHEN seq < 0 OR source = 'tracker' THEN {c} END AS {c}" for c in ("tracker_id", "tracker_captured_at")], "CASE WHEN seq < 0 OR source = 'primary' THEN raw_primary END AS raw_primary",
    )


def _with_state(rows: DataFrame) -> DataFrame:
    """rows with lower and upper, a signal's bounds, and html_set, whether the row's HTML came to stand."""
    known = rows.selectExpr("*", f"max(live) {_BEFORE} AS __live", f"(max(o_created_at_utc) {_SO_FAR}).v AS __created", f"max(o_content_html) {_BEFORE} AS __html")
    return known.selectExpr(
        *rows.columns,
        "CASE WHEN seq < 0 THEN was.deleted_lower WHEN signal THEN greatest(__live, verified, __created) END AS lower",
        "CASE WHEN seq < 0 THEN was.deleted_upper WHEN signal THEN CASE WHEN removed THEN removed_at ELSE observed_at END END AS upper",
        "o_content_html IS NOT NULL AND (__html IS NULL OR (o_content_html.r >= __html.r AND o_content_html.v <> __html.v)) AS html_set",
    )


def _media(rows: DataFrame) -> DataFrame:
    """ts_id, seq, winner, source, media, g (number of the run), i and item of each list in rows, an item for each place of the list that stands."""
    source = f"coalesce(o_media.s, '{DEFAULT_SOURCE}')"
    lists = rows.filter("o_media IS NOT NULL").selectExpr("ts_id", "seq", f"{source} AS source", "o_media.v AS media", "size(o_media.v) AS n", f"o_media.r >= coalesce(max(o_media.r) {_BEFORE}, 0) AS winner")
    lists = lists.selectExpr("*", f"last(CASE WHEN winner THEN n END, true) {_BEFORE} AS __n", f"last(CASE WHEN winner THEN n END, true) {_SO_FAR} AS n_run")
    runs = lists.selectExpr("*", f"count_if(winner AND NOT (n <=> __n)) {_SO_FAR} AS g")
    return runs.selectExpr("ts_id", "seq", "winner", "source", "media", "n", "n_run", "g", "explode(sequence(0, n_run - 1)) AS i").selectExpr("*", "CASE WHEN n = n_run THEN get(media, i) END AS item")


def _standing(frame: str) -> tuple[str, str]:
    """The item that stands and the list's source, over rows of ``_media`` in a frame."""
    over = f"OVER (PARTITION BY ts_id, g, i ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND {frame})"
    part = {f.name: f"(last(CASE WHEN winner THEN item END, true) {over}).{f.name}" for f in MEDIA_ITEM.fields}
    part |= {f: f"coalesce(last(CASE WHEN winner THEN item.{f} END, true) {over}, first(CASE WHEN NOT winner THEN item.{f} END, true) {over})" for f in MEDIA_FILL}
    return f"struct({', '.join(f'{c} AS {name}' for name, c in part.items())}) AS stands", f"last(CASE WHEN winner THEN source END, true) {over} AS stands_source"


def media_state(rows: DataFrame) -> DataFrame:
    """ts_id, media and media_source after all rows."""
    after = _media(rows).selectExpr("ts_id", "seq", "g", "i", *_standing("CURRENT ROW"))
    by_item = after.groupBy("ts_id", "i").agg(F.expr("max_by(struct(g, stands, stands_source), struct(g, seq)) AS x"))
    # places that only earlier, longer lists had are left out
    return by_item.groupBy("ts_id").agg(F.expr("max(x.g) AS __g"), F.expr("array_sort(collect_list(struct(i, x))) AS __x")).selectExpr(
        "ts_id", "transform(filter(__x, y -> y.x.g = __g), y -> y.x.stands) AS media", "element_at(filter(__x, y -> y.x.g = __g), 1).x.stands_source AS media_source",
    )


def media_disagreements(rows: DataFrame) -> DataFrame:
    """ts_id, seq, old and new source and value of lists that lost against another one."""
    before = _media(rows).selectExpr("ts_id", "seq", "winner", "source", "media", "i", *_standing("1 PRECEDING")).filter("NOT winner")
    whole = before.groupBy("ts_id", "seq").agg(F.expr("transform(array_sort(collect_list(struct(i, stands))), y -> y.stands) AS __old"), F.expr("first(stands_source) AS old_source"), F.expr("first(source) AS new_source"), F.expr("first(media) AS media"))
    return whole.filter("media <> __old").selectExpr("ts_id", "seq", "old_source", "to_json(__old) AS old_value", "new_source", "to_json(media) AS new_value")


class Merged:
    """posts: all records after the merge, with changed and is_new; events: new deletion events; anomalies: one row each.  Each is planned when it is asked for."""

    def __init__(self, rows: DataFrame, logged: DataFrame | None) -> None:
        self.rows, self.logged = rows, logged

    @cached_property
    def posts(self) -> DataFrame:
        return _posts(self.rows)

    @cached_property
    def events(self) -> DataFrame:
        return _events(self.rows, self.logged)

    @cached_property
    def anomalies(self) -> DataFrame:
        return _anomalies(self.rows)


def merge(current: DataFrame, observations: DataFrame, logged: DataFrame | None = None, stage: Callable[[DataFrame], DataFrame] | None = None) -> Merged:
    """current (POST) and observations (OBSERVATION) to records, new deletion events and anomalies.

    logged holds the (ts_id, source) of deletion events that are known.
    Records that no observation names come out as they are.  stage may write
    the rows that all three are made of, so inputs are read once.
    """
    rows = _with_state(_rows(current, observations))
    return Merged(stage(rows) if stage else rows, logged)


def _posts(rows: DataFrame) -> DataFrame:
    def latest(c: str) -> str:
        return f"max_by({c}, CASE WHEN {c} IS NOT NULL THEN seq END)"

    def first(c: str) -> str:
        return f"min_by({c}, CASE WHEN {c} IS NOT NULL THEN seq END)"

    folded = rows.groupBy("ts_id").agg(*map(F.expr, (
        *(f"max(o_{f}) AS w_{f}" for f in _LOOKED), "max(o_text) AS w_text", latest("CASE WHEN html_set THEN text_source END") + " AS __html_source",
        "max(lower) AS deleted_lower", "min(upper) AS deleted_upper", first("CASE WHEN seq < 0 THEN was.deleted_source WHEN signal THEN CASE WHEN removed THEN 'tracker' ELSE 'gone' END END") + " AS deleted_source",
        f"coalesce({latest('event')}, 'present') AS status", "max(live) AS last_verified_live_at", *(f"{latest(c)} AS {c}" for c in ("tracker_id", "tracker_captured_at", "raw_primary")), first("taken_down") + " AS tracker_removed_at",
        "collect_set(source) AS __sources", first("CASE WHEN seq < 0 THEN was.first_seen_at ELSE observed_at END") + " AS first_seen_at", first("CASE WHEN seq < 0 THEN was.first_seen_source ELSE source END") + " AS first_seen_source",
        "max_by(observed_at, seq) AS __at", "max_by(run_id, seq) AS __run", "first(was, true) AS was", "max(seq) AS __last",
    )))
    folded = folded.join(media_state(rows), "ts_id", "left")
    html = "w_content_html.v IS NOT NULL"
    sources = [f"struct('{f}' AS k, w_{f}.s AS v)" for f in _LOOKED] + ["struct('media' AS k, media_source AS v)", f"struct('content_text' AS k, CASE WHEN {html} THEN __html_source ELSE w_text.s END AS v)"]
    strings = "CAST(array() AS ARRAY<STRING>)"
    given = {
        "kind": "coalesce(w_kind.v, '')", "pinned": "coalesce(w_pinned.v, false)", "mentions": f"coalesce(w_mentions.v, {strings})", "tags": f"coalesce(w_tags.v, {strings})", "content_html": "coalesce(w_content_html.v, '')",
        "media": f"coalesce(media, CAST(array() AS ARRAY<{MEDIA_ITEM.simpleString()}>))", "seen_sources": f"array_sort(array_distinct(concat(coalesce(was.seen_sources, {strings}), __sources)))",
        "field_sources": f"map_from_entries(array_sort(filter(array({', '.join(sources)}), x -> x.v IS NOT NULL)))",
    }
    later = ("content_text", "created_at_et", "et_date", "et_hour", "et_dow", "updated_at", "updated_run_id")
    some = folded.selectExpr(*[f"{given.get(f) or (f'w_{f}.v' if f in _LOOKED else f)} AS {f}" for f in FIELDS if f not in later], "__at", "__run", "was", "__last", "w_text.v AS __text", f"{html} AS __has_html")
    text = F.when(F.col("__has_html"), html_to_text(F.col("content_html"))).otherwise(F.coalesce("__text", F.lit("")))
    some = some.withColumns({"content_text": text, **eastern_fields(F.col("created_at_utc"))})
    # maps have no equality; as sorted entries they have
    compared = [f for f in FIELDS if f not in ("updated_at", "updated_run_id", "ts_id")]
    as_one = lambda at: "struct(" + ", ".join(f"array_sort(map_entries({at}{f}))" if f == "field_sources" else f"CAST({at}{f} AS {POST[f].dataType.simpleString()})" for f in compared) + ")"
    some = some.selectExpr("*", f"__last >= 0 AND (was IS NULL OR NOT {as_one('')} <=> {as_one('was.')}) AS changed", "was IS NULL AS is_new")
    updated = {"updated_at": "CASE WHEN changed THEN __at ELSE was.updated_at END", "updated_run_id": "CASE WHEN changed THEN __run ELSE was.updated_run_id END"}
    return some.selectExpr(*[f"CAST({updated.get(f, f)} AS {POST[f].dataType.simpleString()}) AS {f}" for f in FIELDS], "changed", "is_new")


def _events(rows: DataFrame, logged: DataFrame | None) -> DataFrame:
    bounds = rows.selectExpr(
        "ts_id", "source", "signal", "observed_at AS detected_at", "seq", "run_id", f"max(lower) {_SO_FAR} AS deleted_lower", f"min(upper) {_SO_FAR} AS deleted_upper",
        f"min_by(taken_down, CASE WHEN taken_down IS NOT NULL THEN seq END) {_SO_FAR} AS tracker_removed_at",
    )
    signals = bounds.filter("signal")
    if logged is not None:
        signals = signals.join(logged.select("ts_id", "source").distinct(), ["ts_id", "source"], "left_anti")
    return signals.selectExpr("*", "row_number() OVER (PARTITION BY ts_id, source ORDER BY seq) AS __n").filter("__n = 1").select(*DELETION.fieldNames())


def _anomalies(rows: DataFrame) -> DataFrame:
    kinds = {f: rows.schema[f"o_{f}"].dataType["v"].dataType.simpleString() for f in _LOOKED}
    # one window by post holds what stood before a row, for all fields; one pass over it gives all notes but those on media
    held = rows.selectExpr(
        "ts_id", "seq", "source", "signal", *[f"o_{f}" for f in _LOOKED], *[f"max(o_{f}) {_BEFORE} AS h_{f}" for f in _LOOKED],
        f"max(lower) {_SO_FAR} AS low", f"min(upper) {_SO_FAR} AS up", f"last(event, true) {_BEFORE} AS status_before",
    )

    def text(value: str, kind: str) -> str:
        return f"substring({f'to_json(struct({value} AS v))' if kind.startswith(('array', 'map', 'struct')) else f'CAST({value} AS STRING)'}, 1, 60)"

    notes = []
    for f in _LOOKED:
        differs = f"h_{f}.v <> o_{f}.v" if f != "created_at_utc" else f"abs(timestampdiff(MICROSECOND, h_{f}.v, o_{f}.v)) > 2000000"
        detail = f"concat('{f}_disagreement:', ts_id, ':', coalesce(h_{f}.s, '{DEFAULT_SOURCE}'), '=', {text(f'h_{f}.v', kinds[f])}, ',', coalesce(o_{f}.s, '{DEFAULT_SOURCE}'), '=', {text(f'o_{f}.v', kinds[f])})"
        notes.append(f"CASE WHEN h_{f}.r > o_{f}.r AND {differs} THEN struct('{f}_disagreement' AS code, {detail} AS detail) END")
    notes.append("CASE WHEN signal AND low > up THEN struct('inverted_bounds' AS code, concat('inverted_bounds:', ts_id) AS detail) END")
    notes.append("CASE WHEN NOT signal AND source = 'primary' AND status_before = 'deleted' THEN struct('resurrected' AS code, concat('resurrected:', ts_id) AS detail) END")
    found = held.selectExpr("ts_id", "seq", f"inline(filter(array({', '.join(notes)}), x -> x IS NOT NULL))")
    detail = "concat('media_disagreement:', ts_id, ':', old_source, '=', substring(old_value, 1, 60), ',', new_source, '=', substring(new_value, 1, 60))"
    return found.unionByName(media_disagreements(rows).selectExpr("ts_id", "seq", "'media_disagreement' AS code", f"{detail} AS detail"))


def deletion_candidates(posts: DataFrame, fetched: DataFrame, most: int = 3) -> DataFrame:
    """Present, verified posts inside the fetched time span that the fetch does not have: the first ``most`` by id."""
    span = fetched.agg(F.min("created_at_utc").alias("__a"), F.max("created_at_utc").alias("__b"))  # one row
    some = posts.filter((F.col("status") == "present") & F.col("last_verified_live_at").isNotNull()).join(F.broadcast(span), F.col("created_at_utc").between(F.col("__a"), F.col("__b")))
    return some.join(fetched.select("ts_id"), "ts_id", "left_anti").orderBy(F.col("ts_id").cast("bigint")).limit(most).select("ts_id")


def all_known(page: DataFrame, posts: DataFrame) -> DataFrame:
    """One row: ids on the page, and how many of them are known."""
    known = page.join(posts.select("ts_id"), "ts_id", "left_semi").agg(F.count("*").alias("known"))
    return page.agg(F.count("*").alias("ids")).join(F.broadcast(known)).withColumn("all_known", F.col("ids") == F.col("known"))
