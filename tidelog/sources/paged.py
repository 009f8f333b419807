"""Pages of a timeline as a stream that stops where it knows the rest, and resumes.

    <inbox>/run=<name>/page-<number>.json     pages of one fetch, newest posts first

A fetch walks back through a timeline; it may end at the first page all of whose
posts are known.  Ids grow with time, so known means: not above the newest id of
the earlier runs.  The source gives references to pages in order, run by run,
and leaves out what lies behind such a page.  Its offset says all that it needs
to go on: the run, how many of its pages were taken, whether it is still open,
the newest id before it (mark) and so far (top).  A run ends with a known or an
empty page, or when a later one has begun.

Only references and the ids of pages pass through the source; contents are read
by Spark where a batch is used (``collect.walk``).
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

from pyarrow import fs
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

SCHEMA = "run string, page int, file string, ends boolean"


class PageReader(SimpleDataSourceStreamReader):
    def __init__(self, options: dict) -> None:
        self.files, self.path = fs.FileSystem.from_uri(options["path"])
        self.prefix = options["path"].removesuffix(self.path)
        self.most = int(options.get("pagesPerBatch", "20"))

    def initialOffset(self) -> dict:
        return {"run": "", "pages": 0, "open": False, "mark": 0, "top": 0}

    def _runs(self) -> list[str]:
        found = self.files.get_file_info(fs.FileSelector(self.path, allow_not_found=True))
        return sorted(m[1] for f in found if (m := re.search(r"/run=([^/]+)$", f.path)))

    def _pages(self, run: str) -> list[str]:
        """Paths of a run's pages by number, up to the first that is missing."""
        found = self.files.get_file_info(fs.FileSelector(f"{self.path}/run={run}"))
        numbered = {int(m[1]): f.path for f in found if (m := re.search(r"/page-(\d+)\.json$", f.path))}
        pages: list[str] = []
        while len(pages) + 1 in numbered:
            pages.append(numbered[len(pages) + 1])
        return pages

    def _ids(self, path: str) -> list[int]:
        with self.files.open_input_stream(path) as f:
            found = json.loads(f.read() or b"[]")
        return [int(x["id"]) for x in (found if isinstance(found, list) else [found]) if str(x.get("id", "")).isdigit()]

    def _step(self, at: dict) -> tuple[dict, tuple | None] | None:
        """The offset after one more page (or after a run without more), and the page; None while there is nothing more."""
        later = [r for r in self._runs() if r > at["run"]]
        if not at["open"]:
            return ({**at, "run": later[0], "pages": 0, "open": True, "mark": at["top"]}, None) if later else None
        pages = self._pages(at["run"])
        if at["pages"] == len(pages):
            return ({**at, "open": False}, None) if later else None
        path = pages[at["pages"]]
        ids = self._ids(path)
        ends = max(ids, default=0) <= at["mark"]
        after = {**at, "pages": at["pages"] + 1, "open": not ends, "top": max(at["top"], *ids) if ids else at["top"]}
        return after, (at["run"], after["pages"], self.prefix + path, ends)

    def _walk(self, start: dict, until: dict | None) -> tuple[list[tuple], dict]:
        rows: list[tuple] = []
        while (until is None and len(rows) < self.most) or (until is not None and start != until):
            step = self._step(start)
            if step is None:
                break
            start, row = step
            rows += [row] if row else []
        return rows, start

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        rows, end = self._walk(start, None)
        return iter(rows), end

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        return iter(self._walk(start, end)[0])

    def commit(self, end: dict) -> None:
        pass


class LandedPages(DataSource):
    """Options: path (a URI), pagesPerBatch."""

    @classmethod
    def name(cls) -> str:
        return "landed_pages"

    def schema(self) -> str:
        return SCHEMA

    def simpleStreamReader(self, schema) -> PageReader:
        return PageReader(self.options)
