"""Versions of a stored data set: folders that never change, named by a manifest.

    <root>/versions/<n>.json    what version n consists of: the folders of posts by month, and of each log in order
    <root>/data/<batch>-<id>/   what one batch wrote: posts/month=<yyyy-MM>, deletions, engagement, anomalies, files

A batch only adds folders; it counts when the manifest that names them stands,
which takes one rename.  So readers see all of a batch or nothing of it, a
version stays readable while later ones are made, and a batch that died before
its commit is done again from the same records.  One that died after it is
known by name (the manifest keeps the last REMEMBERED) and gives what it gave.

A data set without manifest (files laid out by others, or by ``sinks``) counts
as version 0 with what its folders hold; the first commit takes that over where
it stands.  There is one writer at a time: a commit whose number is taken fails.
"""

from __future__ import annotations

import atexit
import contextlib
import json
import re
import tempfile
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

#: How many batches are known by name, the latest ones; a retry asks for the last.
REMEMBERED = 64
#: What plain layouts call a log: a pattern below the root.
LOGS = {"deletions": "deletions*", "engagement": "engagement/*", "anomalies": "anomalies/*", "files": "files/*"}


@dataclass
class Version:
    """number; posts: folders by month; logs: folders by log; batches: what the latest ones gave, by name."""

    root: str
    number: int = 0
    posts: dict[str, list[str]] = field(default_factory=dict)
    logs: dict[str, list[str]] = field(default_factory=dict)
    batches: dict[str, dict] = field(default_factory=dict)

    def post_paths(self, months: list[str] | None = None) -> list[str]:
        return [f"{self.root}/{p}" for m in sorted(self.posts) if months is None or m in months for p in self.posts[m]]

    def log_paths(self, log: str) -> list[str]:
        return [f"{self.root}/{p}" for p in self.logs.get(log, [])]


def _fs(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def glob(spark: SparkSession, pattern: str) -> list[str]:
    where, fs = _fs(spark, pattern)
    return sorted(x.getPath().toString() for x in fs.globStatus(where) or [])


def read_text(spark: SparkSession, path: str) -> str:
    where, fs = _fs(spark, path)
    stream = fs.open(where)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def scratch(spark: SparkSession) -> str:
    """A new folder that driver and executors share, below spark.checkpoint.dir; it goes when the process ends.

    A folder of this machine is used only where the session names none and runs in one JVM, as in tests.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base is None:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.gettempdir()
    path = f"{base.rstrip('/')}/tidelog-{uuid.uuid4().hex}"
    atexit.register(_forget, spark, path)
    return path


def _forget(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):  # the JVM may be gone at exit; the folder is scratch space
        where, fs = _fs(spark, path)
        fs.delete(where, True)


def _name(number: int) -> str:
    return f"{number:012d}.json"


def numbers(spark: SparkSession, root: str) -> list[int]:
    return [int(p.rsplit("/", 1)[1].removesuffix(".json")) for p in glob(spark, f"{root}/versions/[0-9]*.json")]


def current(spark: SparkSession, root: str, number: int | None = None) -> Version:
    """The newest version, or the one of a number."""
    root = root.rstrip("/")
    there = numbers(spark, root)
    if not there and number is None:
        return _plain(spark, root)
    return Version(root, **json.loads(read_text(spark, f"{root}/versions/{_name(max(there) if number is None else number)}")))


def _plain(spark: SparkSession, root: str) -> Version:
    """Version 0: posts/month=<yyyy-MM>/ or posts/<yyyy-MM>.jsonl, and the logs; a folder that a swap moved aside stands in for a missing one."""
    found = Version(root)
    where, fs = _fs(spark, root)
    above = fs.makeQualified(where).toString() + "/"
    short = lambda p: p.removeprefix(above)
    for folder in ("posts", "posts.old"):
        months = {p.rsplit("month=", 1)[1]: short(p) for p in glob(spark, f"{root}/{folder}/month=*")}
        found.posts = {m.removesuffix(".old"): [p] for m, p in months.items() if not m.endswith(".old") or m.removesuffix(".old") not in months}
        found.posts = found.posts or {p.rsplit("/", 1)[1].removesuffix(".jsonl"): [short(p)] for p in glob(spark, f"{root}/{folder}/*.jsonl")}
        if found.posts:
            break
    found.logs = {log: [short(p) for p in glob(spark, f"{root}/{pattern}")] for log, pattern in LOGS.items()}
    return found


class Batch:
    """What a batch adds to the version it started from; nothing counts before ``commit``."""

    def __init__(self, spark: SparkSession, root: str, name: str) -> None:
        self.spark, self.name, self.base = spark, name, current(spark, root)
        self.folder = f"data/{name.replace('/', '_')}-{uuid.uuid4().hex[:8]}"
        self.posts, self.logs = dict(self.base.posts), {k: list(v) for k, v in self.base.logs.items()}

    @property
    def done(self) -> dict | None:
        """What the batch gave, if it has been committed before."""
        return self.base.batches.get(self.name)

    def path(self, part: str) -> str:
        return f"{self.base.root}/{self.folder}/{part}"

    def pending(self) -> Version:
        """The version that a commit would make."""
        return Version(self.base.root, self.base.number + 1, self.posts, self.logs)

    def staged(self, df: DataFrame, part: str) -> DataFrame:
        """df written once, as Parquet, and read again; it is no part of the data set."""
        df.write.mode("overwrite").parquet(self.path(f"staging/{part}"))
        return self.spark.read.schema(df.schema).parquet(self.path(f"staging/{part}"))

    def replace_months(self, months: list[str] | None, write) -> None:
        """The months' posts (None: all posts) from now on: write(path) makes month=<month> folders; a month without one is gone."""
        write(self.path("posts"))
        made = {p.rsplit("month=", 1)[1] for p in glob(self.spark, self.path("posts/month=*"))}
        self.posts = {m: p for m, p in self.posts.items() if months is not None and m not in months}
        self.posts |= {m: [f"{self.folder}/posts/month={m}"] for m in made if months is None or m in months}

    def append(self, log: str, write) -> None:
        """One more folder of a log: write(path) makes it; partitions below it stay there."""
        write(self.path(log))
        self.logs.setdefault(log, []).append(f"{self.folder}/{log}")

    def commit(self, gave: dict) -> dict:
        """Makes the version; gave is what a retry of the batch will give."""
        root, number = self.base.root, self.base.number + 1
        batches = dict(list({**self.base.batches, self.name: gave}.items())[-REMEMBERED:])
        text = json.dumps({"number": number, "posts": self.posts, "logs": self.logs, "batches": batches}, indent=1)
        target, fs = _fs(self.spark, f"{root}/versions/{_name(number)}")
        made, _ = _fs(self.spark, f"{root}/versions/.{_name(number)}.{uuid.uuid4().hex}")
        out = fs.create(made, True)
        out.write(bytearray(text.encode()))
        out.close()
        if fs.exists(target) or not fs.rename(made, target):
            fs.delete(made, False)
            raise RuntimeError(f"version {number} of {root} was committed by another writer")
        where, _ = _fs(self.spark, self.path("staging"))
        fs.delete(where, True)
        return gave


def compact(spark: SparkSession, root: str, log: str, rewrite) -> None:
    """A log's folders as one: rewrite(paths, path) writes the rows of paths to path."""
    batch = Batch(spark, root, f"compact-{log}")
    paths = batch.base.log_paths(log)
    if len(paths) > 1:
        batch.logs[log] = []
        batch.append(log, lambda path: rewrite(paths, path))
        batch.commit({})


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> None:
    """Only the last ``keep`` versions stay: older manifests go, and then the batches' folders that no manifest names; readers of older versions must have ended, and no batch may be under way."""
    root, there = root.rstrip("/"), sorted(numbers(spark, root))
    kept = [current(spark, root, n) for n in there[-keep:]]
    named = {p.split("/")[1] for v in kept for folders in (*v.posts.values(), *v.logs.values()) for p in folders if p.startswith("data/")}
    for n in there[:-keep]:
        where, fs = _fs(spark, f"{root}/versions/{_name(n)}")
        fs.delete(where, False)
    for path in glob(spark, f"{root}/data/*"):
        if kept and path.rsplit("/", 1)[1] not in named:
            where, fs = _fs(spark, path)
            fs.delete(where, True)
