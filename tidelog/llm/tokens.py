"""Byte-level BPE of whole texts, and token counts by section.

``attribute`` encodes each whole document once and gives every token its
character span; the spans are joined to the sections of the same document as
intervals.  A token that crosses a boundary goes, whole, to the section that
holds most of its characters, on a tie to the earlier one; a token that meets
no section counts for section -1 (start and end null), a row that is there
only if it counts something.  Characters split over several tokens count as
one character for each of them.

Sections default to the lines of the text, each with its line feed; any other
array of (start, end) can be named.  They are numbered in order of (start,
end); what two of them share belongs to the earlier one alone; empty ones get
0 tokens.

Nulls: a null text is empty and has one empty section 0; null sections, and
sections of a null start or end, count as none.  Repeated rows are counted row by row.  An empty table gives an empty
result.  Other columns are ignored.
"""

from __future__ import annotations

import json
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import arrow_map, texts_of


def default_vocabulary() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_symbols() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for code points from 256 on, in order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


#: Runs of white space (Unicode's) that are too long for the pattern's lookahead, which is tried at each of their places.
LONG_BLANKS = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{4096,}")


class Encoder:
    """The ids of a byte-level BPE vocabulary in tokenizers' JSON form; special tokens' strings are ordinary text.

    Ids of a byte-level BPE are its merge ranks, so the vocabulary is handed to
    the faster of the two public implementations; tests hold the ids equal.
    """

    def __init__(self, vocabulary: str) -> None:
        with open(vocabulary, encoding="utf-8") as f:
            model = json.load(f)
        symbols, special = _byte_symbols(), {x["content"] for x in model.get("added_tokens", [])}
        ranks = {bytes(symbols[c] for c in t): i for t, i in model["model"]["vocab"].items() if t not in special}
        self.bpe = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        n = max(ranks.values()) + 1
        #: characters that begin in a token; whether it begins inside one
        self.begun, self.inside = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for t, i in ranks.items():
            self.begun[i] = sum(b & 0xC0 != 0x80 for b in t)
            self.inside[i] = t[0] & 0xC0 == 0x80

    def ids(self, text: str) -> np.ndarray:
        """Ids of the whole text.

        The pattern takes a run of white space as one part: all of it at the
        text's end, else all but its last character, which goes with what
        follows.  Long runs are cut out by that rule and merged on their own.
        """
        parts, at = [], 0
        for run in LONG_BLANKS.finditer(text):
            stop = run.end() - (run.end() < len(text))
            parts += [self._ids(text[at : run.start()]), np.array(self.bpe._encode_single_piece(text[run.start() : stop]), np.uint32)]
            at = stop
        parts.append(self._ids(text[at:] if at else text))
        return np.concatenate(parts) if len(parts) > 1 else parts[0]

    def _ids(self, text: str) -> np.ndarray:
        return self.bpe.encode_to_numpy(text, disallowed_special=()) if text else np.zeros(0, np.uint32)

    def spans(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First character and the one after the last, by token."""
        end = np.cumsum(self.begun[ids])
        return end - self.begun[ids] - self.inside[ids], end


_ENCODERS: dict[str, Encoder] = {}


def encoder(vocabulary: str) -> Encoder:
    """This process's encoder: a worker keeps it from task to task."""
    if vocabulary not in _ENCODERS:
        _ENCODERS[vocabulary] = Encoder(vocabulary)
    return _ENCODERS[vocabulary]


def _lines(text: str) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(x) + 1 for x in text.split("\n")], np.int64)
    sizes[-1] -= 1
    ends = np.cumsum(sizes)
    return ends - sizes, ends


def allocate(first: np.ndarray, last: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(section of each token or -1, whether it crosses a section's boundary).

    Sections are disjoint, their starts and ends ascend, so a token meets a contiguous run of
    them: two binary searches give the run.  Nearly every run is one section;
    of a longer one all parts are compared.
    """
    low = np.searchsorted(end, first, "right")
    high = np.searchsorted(start, last, "left") - 1
    where = np.where(high >= low, low, -1)
    for t in np.nonzero(high > low)[0]:
        s = np.arange(low[t], high[t] + 1)
        shared = np.minimum(end[s], last[t]) - np.maximum(start[s], first[t])
        where[t] = s[np.argmax(shared)]
    within = where >= 0
    crosses = within.copy()
    crosses[within] = (first[within] < start[where[within]]) | (last[within] > end[where[within]])
    return where, crosses


def attribute(docs: DataFrame, sections: Column | None = None, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, section, start, end, n_tokens, n_crossing): a row for every section of every row of docs."""
    vocabulary = vocabulary or default_vocabulary()
    some = docs.select("doc_id", F.col("text").cast("string").alias("text"), *([] if sections is None else [sections.alias("sections")]))
    kind, named = dict(some.dtypes)["doc_id"], sections is not None

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        code = encoder(vocabulary)
        given = batch.column("sections").to_pylist() if named else None
        rows, parts = [], []
        for i, text in enumerate(texts_of(batch, "text")):
            if given is None:
                start, end = _lines(text)
            else:
                pairs = sorted((x["start"], x["end"]) for x in given[i] or [] if x is not None and None not in (x["start"], x["end"]))
                start, end = np.array([p[0] for p in pairs], np.int64), np.array([p[1] for p in pairs], np.int64)
            reach = np.maximum.accumulate(end)
            own = np.maximum(start, np.append(start[:1], reach[:-1]))  # without what an earlier section holds
            where, crosses = allocate(*code.spans(code.ids(text)), own, np.maximum(own, reach))
            tokens = np.bincount(where + 1, minlength=len(start) + 1)
            across = np.bincount(where[crosses] + 1, minlength=len(start) + 1)
            lost = int(tokens[0] > 0)
            number = np.arange(-lost, len(start))
            rows.append(np.full(len(number), i))
            parts.append((number, start, end, tokens[1 - lost :], across[1 - lost :], lost))
        cat = lambda xs: np.concatenate([np.asarray(x, np.int64) for x in xs])
        hole = lambda k: pa.concat_arrays([pa.concat_arrays([pa.nulls(p[5], pa.int64()), pa.array(p[k], pa.int64())]) for p in parts])
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(pa.array(cat(rows))), pa.array(cat([p[0] for p in parts]), pa.int32()), hole(1), hole(2), pa.array(cat([p[3] for p in parts])), pa.array(cat([p[4] for p in parts]))],
            names=["doc_id", "section", "start", "end", "n_tokens", "n_crossing"],
        )

    return arrow_map(some, count, f"doc_id {kind}, section int, start bigint, end bigint, n_tokens bigint, n_crossing bigint", "text")
