"""What the driver decides around a run: which sources are due, one run at a time, what failed."""

from __future__ import annotations

import contextlib
import datetime as dt
import os
import secrets
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

#: How long a source rests: the bulk archive after a download, the primary after it was found unreachable.
REST = {"bulk": dt.timedelta(hours=2), "primary": dt.timedelta(hours=6)}
STALE_LOCK = dt.timedelta(minutes=30)
#: Order of the sources in a run.
ORDER = ("primary", "tracker", "bulk")


def new_run_id(now: dt.datetime) -> str:
    """20260911T120000Z-1a2b."""
    return now.astimezone(dt.UTC).strftime("%Y%m%dT%H%M%SZ") + "-" + secrets.token_hex(2)


def due(state: dict, source: str, now: dt.datetime) -> bool:
    """Whether a source is to be asked: a bulk download is not repeated, an unreachable primary not probed again, before its rest is over."""
    known = state.get("sources", {}).get(source, {})
    if source == "primary" and known.get("reachable", True):
        return True
    last = known.get("last_probe_at" if source == "primary" else "last_fetch_at")
    rest = REST.get(source)
    return last is None or rest is None or now - dt.datetime.fromisoformat(last) >= rest


@dataclass
class Outcome:
    """Run rows, one for each source, in order; hard: whether the checks found hard violations."""

    rows: list[dict] = field(default_factory=list)
    hard: bool = False

    @property
    def exit_code(self) -> int:
        """2 for hard violations, 1 for a source that failed, else 0."""
        return 2 if self.hard else int(any(not r["ok"] for r in self.rows))


def run_sources(steps: dict[str, Callable[[], dict]], run_id: str, clock: Callable[[], dt.datetime] = lambda: dt.datetime.now(dt.UTC)) -> Outcome:
    """Runs each source's step; one that fails leaves a row with ok false and does not stop the others."""
    out = Outcome()
    for source in [s for s in ORDER if s in steps] + [s for s in steps if s not in ORDER]:
        row = {"run_id": run_id, "source": source, "started_at": clock(), "ok": True, "requests": 0, "new_posts": 0, "updated_posts": 0, "deletions_found": 0, "errors": 0, "notes": None}
        try:
            row |= steps[source]()
        except Exception as e:  # any failure of a source is a row of the run
            row |= {"ok": False, "errors": 1, "notes": f"{type(e).__name__}: {e}"}
        out.rows.append(row | {"finished_at": clock()})
    return out


@contextlib.contextmanager
def lock(path: str, stale: dt.timedelta = STALE_LOCK) -> Iterator[bool]:
    """True if this process holds the lock file; one older than ``stale`` is taken over."""
    with contextlib.suppress(FileNotFoundError):
        if time.time() - os.stat(path).st_mtime > stale.total_seconds():
            os.unlink(path)
    try:
        os.close(os.open(path, os.O_CREAT | os.O_EXCL | os.O_WRONLY))
    except FileExistsError:
        yield False
        return
    try:
        yield True
    finally:
        with contextlib.suppress(FileNotFoundError):
            os.unlink(path)
