"""A generated archive, the same for the same seed, and observation helpers, for tests."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions.times import eastern_fields
from tidelog.schema import DELETION, ENGAGEMENT, MEDIA_ITEM, OBSERVATION, POST, RUN

U = lambda s: dt.datetime.fromisoformat(s)
FIRST_ID = 110000000000000000
START, DAYS = dt.datetime(2026, 1, 5), 330
#: UTC instants at which Eastern clocks change in that year.
CHANGES = (dt.datetime(2026, 3, 8, 7), dt.datetime(2026, 11, 1, 6))


def item(kind: str, **more) -> dict:
    return dict.fromkeys(MEDIA_ITEM.fieldNames()) | {"type": kind} | more


def post(number: int, at: str | dt.datetime, kind: str = "original", **more) -> dict:
    at = U(at) if isinstance(at, str) else at
    base = dict.fromkeys(POST.fieldNames()) | {
        "ts_id": str(FIRST_ID + number), "created_at_utc": at, "kind": kind, "content_html": "", "content_text": f"text {number}", "media": [], "mentions": [], "tags": [], "pinned": False,
        "first_seen_at": at, "first_seen_source": "bulk", "seen_sources": ["bulk"], "updated_at": at, "updated_run_id": "r0", "status": "present", "field_sources": {},
    }
    return base | more


def _some(r: random.Random, number: int, at: dt.datetime) -> dict:
    """One post with whatever chance gives it."""
    kind = r.choices(["original", "reblog", "quote", "reply"], [6, 3, 1, 1])[0]
    more: dict = {"media": [item(r.choice(["image", "video", "gifv"])) for _ in range(r.choice([0, 0, 0, 1, 2, 3]))]}
    if kind == "reblog" and r.random() < 0.9:
        more["reblog_of_acct"] = r.choice(["ada", "bob", "cyd", "dee", "eve", "fay", "gus", "hal", "ivy", "jon", "kim", "lee"])
    if r.random() < 0.3:
        host = r.choice([f"site{k}.example" for k in range(13)])
        more |= {"card_url": f"https://www.{host}/{number}", "card_domain": host}
    if r.random() < 0.08:
        more["edited_at"] = at + dt.timedelta(minutes=r.randint(1, 600))
    if r.random() < 0.12:
        lower = at + dt.timedelta(minutes=r.randint(0, 3000))
        more |= {"status": "deleted", "deleted_source": r.choice(["tracker", "gone"]), "deleted_lower": lower, "deleted_upper": lower + dt.timedelta(minutes=r.randint(0, 500))}
    if r.random() < 0.1:
        more["content_text"] = "long " * r.randint(20, 60)
    return post(number, at, kind, **more)


def archive() -> list[dict]:
    """Posts at random instants, a few bursts, and a close series over both changes of the clock."""
    r = random.Random(31)
    times = [START + dt.timedelta(seconds=r.randrange(DAYS * 86_400)) for _ in range(220)]
    for _ in range(6):
        at = START + dt.timedelta(minutes=r.randrange(DAYS * 1440))
        for _ in range(r.randint(4, 11)):
            times.append(at)
            at += dt.timedelta(seconds=r.randint(20, 260))
    for change in CHANGES:
        times += [change + dt.timedelta(minutes=m) for m in range(-130, 131, 26)]
    r.shuffle(times)
    return [_some(r, number, at) for number, at in enumerate(times, 1)]


def posts(spark, rows=None):
    df = spark.createDataFrame([tuple(r[f] for f in POST.fieldNames()) for r in (archive() if rows is None else rows)], POST)
    return df.withColumns(eastern_fields(F.col("created_at_utc"))).select(*POST.fieldNames())


def snapshot_rows() -> list[tuple]:
    """Up to three snapshots, hours apart, of most posts, in order of ingest."""
    r, rows = random.Random(32), []
    for p in archive():
        at = p["created_at_utc"]
        for _ in range(r.choice([0, 1, 1, 2, 3])):
            at += dt.timedelta(hours=r.randint(1, 40))
            rows.append((at, p["ts_id"], r.choice(["primary", "bulk"]), *[r.choice([None, r.randint(0, 60)]) for _ in range(3)], None, None))
    return rows


def snapshots(spark):
    rows = [(*x, i) for i, x in enumerate(snapshot_rows())]
    return spark.createDataFrame(rows, T.StructType([*ENGAGEMENT.fields, T.StructField("ingest_seq", T.LongType())]))


def deletion_log(spark):
    gone = [p for p in archive() if p["status"] == "deleted"]
    return spark.createDataFrame([(p["ts_id"], p["deleted_upper"], p["deleted_lower"], p["deleted_upper"], p["deleted_source"], None, "r1") for p in gone], DELETION)


def runs(spark):
    return spark.createDataFrame([("r1", s, U("2026-08-03 00:00"), U("2026-08-03 00:01"), True, 3, 2, 1, 1, 0, None) for s in ("primary", "bulk")], RUN)


def observation(seq: int, source: str, at: str = "2026-07-01 12:00", ts_id: str = "110000000000000001", **fields) -> dict:
    return dict.fromkeys(OBSERVATION.fieldNames()) | {"ts_id": ts_id, "source": source, "observed_at": U(at), "run_id": f"run{seq}", "seq": seq} | fields


def observations(spark, rows):
    return spark.createDataFrame([tuple(r[f] for f in OBSERVATION.fieldNames()) for r in rows], OBSERVATION)
