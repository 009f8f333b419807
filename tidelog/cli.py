"""Commands: collect, query, weekly, check, materialize, ingest, validate.

    python -m tidelog.cli query --root DATA --sql "SELECT ..." --format markdown
"""

from __future__ import annotations

import argparse
import datetime as dt
import os
import sys
import time
from importlib import resources

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog import collect, control, report
from tidelog.operators import validate
from tidelog.plans import functions, views
from tidelog.sources import landed


def saved_queries() -> dict[str, str]:
    """The saved queries by name."""
    return {p.name.removesuffix(".sql"): p.read_text() for p in resources.files("tidelog.sql").iterdir() if p.name.endswith(".sql")}


def run_query(spark: SparkSession, sql: str, params: list | None = None, limit: int | None = None) -> DataFrame:
    """SQL over the registered views; params fill its question marks."""
    if views.PREVIOUS in sql:
        views.register_previous(spark)
    found = spark.sql(sql, args=params) if params else spark.sql(sql)
    return found if limit is None else found.limit(limit)


def formatted(df: DataFrame, style: str) -> str:
    rows = [r.asDict(True) for r in df.collect()]
    if style == "csv":
        return report.comma(rows) or ",".join(df.columns) + "\n"
    if style == "markdown":
        return report.table(rows, df.columns)
    cells = [df.columns, *[["" if v is None else str(v) for v in r.values()] for r in rows]]
    widths = [max(len(r[i]) for r in cells) for i in range(len(df.columns))]
    return "\n".join("  ".join(c.ljust(w) for c, w in zip(r, widths)).rstrip() for r in cells)


def load(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    found = views.register(spark, landed.posts(spark, root), landed.engagement(spark, root), landed.deletion_log(spark, root), landed.runs(spark, root))
    functions.register(spark)
    return found


def instant(text: str | None) -> dt.datetime:
    return dt.datetime.fromisoformat(text).astimezone(dt.UTC) if text else dt.datetime.now(dt.UTC)


def session() -> SparkSession:
    return SparkSession.builder.appName("tidelog").config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").getOrCreate()


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tidelog")
    sub = parser.add_subparsers(dest="command", required=True)
    for name in ("collect", "query", "weekly", "check", "materialize", "ingest", "validate"):
        sub.add_parser(name).add_argument("--root", required=True)
    g = sub.choices["collect"]
    g.add_argument("--inbox", required=True)
    g.add_argument("--output")
    g.add_argument("--now", help="an instant, 2026-09-11T12:00:00Z; now, if not given")
    g.add_argument("--sources", default=",".join(control.ORDER))
    g.add_argument("--handle", default=collect.HANDLE)
    q = sub.choices["query"]
    what = q.add_mutually_exclusive_group(required=True)
    what.add_argument("--sql")
    what.add_argument("--file")
    what.add_argument("--name", choices=sorted(saved_queries()))
    q.add_argument("--param", action="append")
    q.add_argument("--format", choices=("table", "csv", "markdown"), default="table")
    q.add_argument("--limit", type=int)
    w = sub.choices["weekly"]
    w.add_argument("--week")
    w.add_argument("--start")
    w.add_argument("--end")
    w.add_argument("--trailing-weeks", type=int, default=8)
    w.add_argument("--out", required=True)
    c = sub.choices["check"]
    c.add_argument("--now", required=True, help="an instant, 2026-09-11T12:00:00Z")
    c.add_argument("--run-id")
    sub.choices["materialize"].add_argument("--database", required=True)
    i = sub.choices["ingest"]
    i.add_argument("--observations", required=True)
    i.add_argument("--checkpoint", required=True)
    sub.choices["validate"].add_argument("--other", required=True)
    a = parser.parse_args(argv)
    if a.command == "weekly" and bool(a.week) == bool(a.start and a.end):
        parser.error("give --week, or --start and --end")
    spark = session()
    if a.command == "ingest":
        from tidelog.streaming import micro

        micro.run_merge(micro.observation_stream(spark, a.observations), a.root, a.checkpoint).awaitTermination()
        return 0
    if a.command == "collect":
        os.makedirs(a.root, exist_ok=True)
        if a.output:
            os.makedirs(a.output, exist_ok=True)
        with control.lock(os.path.join(a.root, ".lock")) as mine:
            if not mine:
                print("another run holds the lock")
                return 1
            code, summary = collect.run(spark, a.root, a.inbox, a.output, instant(a.now), tuple(a.sources.split(",")), a.handle)
        print(summary)
        return code
    if a.command == "check":
        bad = collect.violations(spark, a.root, instant(a.now), a.run_id, landed.state(f"{a.root}/state.json")).persist()
        print(formatted(bad.groupBy("severity", "code").agg(F.count("*").alias("n")).orderBy("severity", "code"), "table"))
        return int(not bad.filter("severity = 'hard'").isEmpty())
    if a.command == "materialize":
        started = time.monotonic()
        for name, n in collect.rebuild(spark, a.root, a.database).items():
            print(f"{name}  {n}")
        print(f"seconds  {time.monotonic() - started:.1f}")
        return 0
    found = load(spark, a.root)
    if a.command == "query":
        sql = a.sql or (saved_queries()[a.name] if a.name else open(a.file, encoding="utf-8").read())
        print(formatted(run_query(spark, sql, a.param, a.limit), a.format))
    elif a.command == "weekly":
        start, end = report.iso_week(spark, a.week) if a.week else (a.start, a.end)
        print("\n".join(report.write(report.baseline(found, start, end, a.trailing_weeks), a.out, a.week or f"{start}_{end}")))
    else:
        other = landed.posts(spark, a.other)
        mine = landed.posts(spark, a.root)
        for part in (validate.overlap(mine, other), validate.confusion(mine, other).orderBy("kind_a", "kind_b"), validate.content_agreement(mine, other)):
            print(formatted(part, "table"))
    return 0


if __name__ == "__main__":
    sys.exit(main())
