"""The weekly report: metrics of a window and of the weeks before it, as a dict, Markdown and CSV files."""

from __future__ import annotations

import datetime
import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.times import week_bounds
from tidelog.operators import metrics, sequences

TABLES = ("posts_by_day", "hour_histogram", "bursts", "deletions", "top_accounts", "link_domains", "engagement_stats", "edits")


def iso_week(spark: SparkSession, week: str) -> tuple[str, str]:
    a, b = spark.range(1).select(*week_bounds(F.lit(week))).first()
    if a is None:
        raise ValueError(f"no such week: {week}")
    return a.isoformat(), b.isoformat()


def _rows(df: DataFrame) -> list[dict]:
    """A small result on the driver: reports are lists of days, hours, kinds and top tens."""
    return [r.asDict(True) for r in df.collect()]


def _one(df: DataFrame) -> dict | None:
    found = _rows(df)
    return found[0] if found else None


def report(views: dict[str, DataFrame], start: str, end: str) -> dict:
    view = metrics.between(views["v_posts_et"], start, end).persist()
    try:
        return {
            "posts_by_day": _rows(metrics.posts_by_day(view, start, end).orderBy("et_date")),
            "hour_histogram": [r["n"] for r in _rows(metrics.hour_histogram(view, start, end).orderBy("et_hour"))],
            "overnight_share": _one(metrics.overnight_share(view, start, end)),
            "bursts": _rows(sequences.bursts(view).orderBy("start_et")),
            "deletions": _rows(metrics.deletion_listing(view.filter("is_deleted = 1"), start, end)),
            "top_accounts": _rows(metrics.top_accounts(view)),
            "link_domains": _rows(metrics.link_domains(view)),
            "media_mix": _one(metrics.media_sets(view)) | {"items": {r["type"]: r["n"] for r in _rows(metrics.media_items_between(view, views["media"], start, end))}},
            "engagement_stats": _rows(metrics.engagement_stats(view, views["v_engagement_latest"]).orderBy("kind")),
            "longest_silence": _one(sequences.longest_silence(view)),
            "edits": _rows(metrics.edits(view, start, end)),
        }
    finally:
        view.unpersist()


def baseline(views: dict[str, DataFrame], start: str, end: str, trailing_weeks: int = 8) -> dict:
    first = datetime.date.fromisoformat(start)
    a, b = first - datetime.timedelta(weeks=trailing_weeks), first - datetime.timedelta(days=1)
    return {
        "window": report(views, start, end), "trailing": report(views, a.isoformat(), b.isoformat()),
        "meta": {"start": start, "end": end, "trailing_start": a.isoformat(), "trailing_end": b.isoformat()},
    }


def text_of(x) -> str:
    if x is None:
        return "-"
    if isinstance(x, float):
        return f"{x:.1f}"
    if isinstance(x, dict):
        return json.dumps(x, sort_keys=True)
    return str(x).replace("|", "\\|")


def table(rows: list[dict], columns: list[str] | None = None) -> str:
    columns = columns or (list(rows[0]) if rows else [])
    if not columns:
        return "none"
    lines = [columns, ["---"] * len(columns), *[[text_of(r[c]) for c in columns] for r in rows]]
    return "\n".join("| " + " | ".join(x) + " |" for x in lines)


def chart(hours: list[int], width: int = 30) -> str:
    peak = max(hours, default=0)
    return "\n".join(f"{h:02d}:00  {'#' * (round(n / peak * width) if peak else 0)} {n}" for h, n in enumerate(hours))


def markdown(found: dict) -> str:
    """Thirteen sections: the headline, eleven metrics, and what to mind."""
    meta, window, trailing = found["meta"], found["window"], found["trailing"]
    total = lambda r: sum(d["total"] for d in r["posts_by_day"])
    weeks = max(1, len(trailing["posts_by_day"])) / 7
    night, silence = window["overnight_share"], window["longest_silence"]
    share = "-" if night["share"] is None else f"{100 * night['share']:.1f}%"
    sections = {
        "Headline": f"- Posts in the window ({meta['start']} to {meta['end']}): **{total(window)}**\n- Weekly average before it ({meta['trailing_start']} to {meta['trailing_end']}, {weeks:.1f} weeks): **{total(trailing) / weeks:.1f}**",
        "Posts by day": table(window["posts_by_day"]),
        "Posts by hour (Eastern)": f"```\n{chart(window['hour_histogram'])}\n```",
        "Overnight share": f"{night['overnight']} of {night['total']} posts between 00:00 and 05:59 ({share})",
        "Bursts": table(window["bursts"]), "Deletions": table(window["deletions"]), "Reposted accounts": table(window["top_accounts"]), "Linked domains": table(window["link_domains"]),
        "Media": table([window["media_mix"]]), "Engagement": table(window["engagement_stats"]),
        "Longest silence": "-" if silence is None else f"{silence['gap_min']:.1f} minutes, {silence['from_et']} to {silence['to_et']}",
        "Edits": table(window["edits"]),
        "To mind": "- A deletion is an interval, from last seen alive to first seen gone; lifetimes are upper bounds.\n- Engagement is the latest snapshot of each post.\n- Times are Eastern unless marked.",
    }
    return f"# Report: {meta['start']} to {meta['end']}\n\n" + "\n\n".join(f"## {k}\n\n{v}" for k, v in sections.items()) + "\n"


def comma(rows: list[dict]) -> str:
    if not rows:
        return ""
    quote = lambda s: '"' + s.replace('"', '""') + '"' if any(c in s for c in ',"\n') else s
    cell = lambda v: "" if v is None else quote(json.dumps(v, sort_keys=True) if isinstance(v, dict) else str(v))
    return "\n".join([",".join(rows[0]), *[",".join(cell(v) for v in r.values()) for r in rows]]) + "\n"


def write(found: dict, folder: str, label: str) -> list[str]:
    """<label>.md and one CSV for each table."""
    os.makedirs(folder, exist_ok=True)
    window = found["window"] | {"hour_histogram": [{"et_hour": h, "n": n} for h, n in enumerate(found["window"]["hour_histogram"])]}
    files = {f"{label}.md": markdown(found)} | {f"{label}__{t}.csv": comma(window[t]) for t in TABLES}
    for name, text in files.items():
        with open(os.path.join(folder, name), "w", encoding="utf-8", newline="\n") as f:
            f.write(text)
    return sorted(files)
