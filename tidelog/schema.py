"""Fixed schemas, enumerations and source ranks.

All instants are TIMESTAMP_NTZ and mean UTC, so no result depends on a session
or machine time zone.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The record's enumerations and ranks.
KINDS = ("original", "quote", "reblog", "reply")
STATUSES = ("present", "deleted")
SOURCES = ("primary", "tracker", "bulk")
SOURCE_RANK = {"primary": 3, "tracker": 2, "bulk": 1}
CREATED_RANK = {"primary": 3, "bulk": 2, "tracker": 1}
#: What a field without provenance counts as.
DEFAULT_SOURCE = "bulk"
#: Fields merged by rank alone.
SCALARS = (
    "kind", "lang", "in_reply_to_id", "quote_id", "quote_of_acct", "reblog_of_id", "reblog_of_acct", "reblog_of_created_at",
    "card_url", "card_domain", "card_title", "mentions", "tags", "edited_at", "pinned",
)
MEDIA_FILL = ("mirror_url", "preview_url", "width", "height", "duration")

_S, _I, _L, _B, _TS = T.StringType(), T.IntegerType(), T.LongType(), T.BooleanType(), T.TimestampNTZType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


MEDIA_ITEM = _struct(type=_S, url=_S, preview_url=_S, mirror_url=_S, width=_I, height=_I, duration=T.DoubleType())
MEDIA = T.ArrayType(MEDIA_ITEM)
STRINGS = T.ArrayType(_S)

POST = _struct(
    ts_id=_S, created_at_utc=_TS, created_at_et=_S, et_date=T.DateType(), et_hour=_I, et_dow=_I, kind=_S,
    content_html=_S, content_text=_S, lang=_S, in_reply_to_id=_S, quote_id=_S, quote_of_acct=_S,
    reblog_of_id=_S, reblog_of_acct=_S, reblog_of_created_at=_TS, media=MEDIA,
    card_url=_S, card_domain=_S, card_title=_S, mentions=STRINGS, tags=STRINGS, edited_at=_TS, pinned=_B,
    first_seen_at=_TS, first_seen_source=_S, seen_sources=STRINGS, updated_at=_TS, updated_run_id=_S,
    last_verified_live_at=_TS, status=_S, deleted_lower=_TS, deleted_upper=_TS, deleted_source=_S,
    tracker_id=_I, tracker_captured_at=_TS, tracker_removed_at=_TS,
    field_sources=T.MapType(_S, _S), raw_primary=_S,
)
FIELDS = tuple(POST.fieldNames())
#: Fields that hold instants; in JSON they are ISO strings.
INSTANTS = tuple(f.name for f in POST.fields if f.dataType == _TS)

OBSERVATION = T.StructType(
    [*_struct(ts_id=_S, source=_S, observed_at=_TS, run_id=_S, seq=_L, removed=_B, gone=_B).fields]
    + [f for f in POST.fields if f.name in (
        "created_at_utc", *SCALARS, "content_html", "content_text", "media", "last_verified_live_at", "tracker_id", "tracker_captured_at", "tracker_removed_at", "raw_primary")]
)
ENGAGEMENT = _struct(observed_at=_TS, ts_id=_S, source=_S, replies=_L, reblogs=_L, favourites=_L, upvotes=_L, downvotes=_L)
DELETION = _struct(ts_id=_S, detected_at=_TS, deleted_lower=_TS, deleted_upper=_TS, source=_S, tracker_removed_at=_TS, run_id=_S)
RUN = _struct(run_id=_S, source=_S, started_at=_TS, finished_at=_TS, ok=_B, requests=_L, new_posts=_L, updated_posts=_L, deletions_found=_L, errors=_L, notes=_S)


def as_text(schema: T.StructType) -> T.StructType:
    """The schema of the JSON and CSV form: instants and dates are strings."""
    return T.StructType([T.StructField(f.name, _S if f.dataType in (_TS, T.DateType()) else f.dataType) for f in schema.fields])
