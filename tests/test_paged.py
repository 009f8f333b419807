"""A timeline's pages as a stream: it stops where the rest is known, and a read that was stopped and resumed equals an unbroken one."""

import json
import os

from tests.fixture import FIRST_ID, U

from tidelog import collect
from tidelog.sources import landed, paged, store

#: Pages of each run by their post numbers, newest first; the third run's last page lies behind a page of known posts.
RUNS = {"a": [[6, 5], [4, 3], [2, 1]], "b": [[9, 8], [7, 6], [5, 4]], "c": [[11, 10], [9, 8], [7, 6]], "d": [[], [3]], "e": [[12]]}
READ = [("a", 1), ("a", 2), ("a", 3), ("b", 1), ("b", 2), ("b", 3), ("c", 1), ("c", 2), ("d", 1), ("e", 1)]


def land(inbox, run, number):
    folder = inbox / f"run={run}"
    folder.mkdir(parents=True, exist_ok=True)
    file = folder / f"page-{number}.json"
    file.write_text(json.dumps([{"id": str(FIRST_ID + n), "created_at": f"2026-07-01T{n:02d}:00:00Z", "content": f"<p>{run} {n}</p>", "favourites_count": n} for n in RUNS[run][number - 1]]))
    at = U(f"2026-07-{'abcde'.index(run) + 2:02d} 00:00").timestamp() + number
    os.utime(file, (at, at))


def test_offsets(tmp_path):
    for run, pages in RUNS.items():
        for number in range(1, len(pages) + 1):
            land(tmp_path, run, number)
    whole = paged.PageReader({"path": f"file://{tmp_path}", "pagesPerBatch": "1000"})
    rows, end = whole.read(whole.initialOffset())
    assert [r[:2] for r in rows] == READ and end["top"] == FIRST_ID + 12
    for size in (1, 2, 3):
        some, at, got = paged.PageReader({"path": f"file://{tmp_path}", "pagesPerBatch": str(size)}), whole.initialOffset(), []
        while True:
            rows, after = some.read(at)
            rows = list(rows)
            assert list(some.readBetweenOffsets(at, after)) == rows
            if after == at:
                break
            got, at = got + [r[:2] for r in rows], json.loads(json.dumps(after))
        assert got == READ and at == end


def test_resumed_equals_unbroken(spark, tmp_path):
    inbox = tmp_path / "in"
    landing = [(run, number) for run, pages in RUNS.items() for number in range(1, len(pages) + 1)]
    for part in (landing[:4], landing[4:]):
        for run, number in part:
            land(inbox, run, number)
        collect.walk(spark, str(tmp_path / "broken"), f"file://{inbox}", str(tmp_path / "mark"), pages=3)
    collect.walk(spark, str(tmp_path / "broken"), f"file://{inbox}", str(tmp_path / "mark"), pages=3)  # nothing more
    collect.walk(spark, str(tmp_path / "whole"), f"file://{inbox}", str(tmp_path / "other"), pages=100)
    skip = ("updated_run_id", "updated_at")  # a batch is one update
    posts = [sorted(map(repr, landed.posts(spark, str(tmp_path / x)).drop(*skip).collect())) for x in ("broken", "whole")]
    assert posts[0] == posts[1] and len(posts[0]) == 12
    shots = [sorted(map(repr, landed.engagement(spark, str(tmp_path / x)).drop("ingest_seq").collect())) for x in ("broken", "whole")]
    assert shots[0] == shots[1] and store.current(spark, str(tmp_path / "broken")).number == 4
    text = {r["ts_id"]: r["content_text"] for r in landed.posts(spark, str(tmp_path / "whole")).collect()}
    assert text[str(FIRST_ID + 8)] == "c 8" and text[str(FIRST_ID + 6)] == "b 6" and text[str(FIRST_ID + 3)] == "a 3"  # pages behind a known one are not read
