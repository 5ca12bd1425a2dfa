"""Periodic runs of words by a sparse diagonal DP over earlier occurrences.

The match length of diagonal ``lag`` at word i counts how many words in a row
equal the word ``lag`` before them.  A word that occurred before continues the
diagonals of its earlier occurrences; all others end there, and one that ends
long enough is a run at once.

Done for every earlier occurrence this is quadratic in frequent words, so an
occurrence is that of a word with its context: for periods in (c/2, c] (from 1
on for the smallest c) the c words that end here.  Of those only the nearest
one is looked at, and only if its lag is in that octave, so each word
continues at most one diagonal an octave.  Nothing is lost by it:

- A run of smallest period q has 3q words and 24 at least, so from some word
  on the context of c >= q words repeats q before, inside the run.
- Contexts that long repeat inside the run at multiples of q only, as q is
  the smallest period: the nearest occurrence is the one at lag q.
- A diagonal thus stays active from there to the last word of the run, and a
  lag that is the nearest all along is the smallest period of its stretch.

Contexts are compared exactly: a context of 2c words is the pair of the names
of its halves, and a name stands for one string.  Contexts that occur once in
their document are dropped at each doubling, since none that holds them can
repeat; in ordinary text next to nothing is left after eight words.

A document is its own work, so nothing is shuffled.  A task holds ``GROUP``
characters of documents at a time, or one longer document: about 50 bytes for
each word beside its text.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from docengine.llm.common import prepare, text_column, texts

LEAST_WORDS, LEAST_PERIODS = 24, 3
FIRST = 8  # the smallest context: a run of period 1 to 8 has 24 words, so it repeats in it
GROUP = 2 << 20  # characters of texts worked on together
PIECE = 1 << 20  # characters of a long text that are split into words at a time

_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
_SPACE = re.compile(r"[\x20\x09-\x0D]")

SCHEMA = ("doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, "
          "best struct<start: long, length: long, period: long>, collapsed string")
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(_RUN)), ("best", _RUN),
                  ("collapsed", pa.string())])


def _pieces(text: str) -> Iterator[str]:
    """A text in pieces cut at white space."""
    at = 0
    while len(text) - at > PIECE and (cut := _SPACE.search(text, at + PIECE)):
        yield text[at:cut.start()]
        at = cut.end()
    yield text[at:] if at else text


def _named(group: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(name of each word, first word of each document): documents share no name."""
    names, starts, base = [], [0], 0
    for text in group:
        seen: dict[str, int] = defaultdict(count(base).__next__)
        n = 0
        for piece in _pieces(text):
            words = _WORDS.findall(piece)
            names.append(np.fromiter(map(seen.__getitem__, words), np.int64, len(words)))
            n += len(words)
        base += len(seen)
        starts.append(starts[-1] + n)
    return np.concatenate(names), np.array(starts, np.int64)


def _stretches(at: np.ndarray, lag: np.ndarray, context: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of the diagonals that end long enough.

    at: words, ascending, that continue a diagonal of their context; lag: which.
    """
    if not len(at):
        return at, at, lag
    goes_on = (at[1:] == at[:-1] + 1) & (lag[1:] == lag[:-1])
    first = np.flatnonzero(np.concatenate([[True], ~goes_on]))
    last = np.append(first[1:], len(at)) - 1
    period = lag[first]
    start = at[first] - context + 1 - period
    length = at[last] - start + 1
    enough = length >= np.maximum(LEAST_WORDS, LEAST_PERIODS * period)
    return start[enough], length[enough], period[enough]


def runs_of(names: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs, by start, then period; words are numbered over all documents."""
    found = []
    longest = int(np.diff(starts).max(initial=0))
    name = np.zeros(len(names), np.int64)  # of the context that ends at a word; 0: it occurs once
    occurrences = np.bincount(names) if len(names) else np.zeros(0, np.int64)
    at = np.flatnonzero(occurrences[names] > 1)
    name[at] = names[at] + 1
    half = 1
    while len(at) and 3 * half < longest:  # a run of the next octave of periods has more words
        context = 2 * half
        at = at[at >= half]
        at = at[name[at - half] > 0]
        at = at[at - context + 1 >= starts[np.searchsorted(starts, at, "right") - 1]]
        key = name[at - half] * (int(name.max()) + 1) + name[at]
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        lag = np.zeros(len(at), np.int64)  # to the nearest earlier occurrence; 0: there is none
        lag[order[1:]] = np.where(same, at[order][1:] - at[order][:-1], 0)
        if context >= FIRST:
            octave = (lag > (half if context > FIRST else 0)) & (lag <= context)
            found.append(_stretches(at[octave], lag[octave], context))
        repeats = np.concatenate([same, [False]]) | np.concatenate([[False], same])
        renamed = np.empty(len(at), np.int64)
        renamed[order] = np.cumsum(np.concatenate([[True], ~same])[:len(at)])
        kept = np.zeros(len(at), bool)
        kept[order] = repeats[:len(at)]
        name[:] = 0
        at = at[kept]
        name[at] = renamed[kept]
        half = context
    start, length, period = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in range(3))
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def _best(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of the greatest length / period, compared exactly; ties: smallest start, then period."""
    best = None
    for run in runs:  # by start, then period
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def _collapsed(text: str, dropped: np.ndarray | None) -> str:
    kept, at = [], 0
    for piece in _pieces(text):
        words = _WORDS.findall(piece)
        if dropped is not None:
            gone = dropped[at:at + len(words)]
            at += len(words)
            words = [w for w, g in zip(words, gone.tolist()) if not g]
        if words:
            kept.append(" ".join(words))
    return " ".join(kept)


def _found(ids: list, group: list[str]) -> pa.RecordBatch:
    names, starts = _named(group)
    start, length, period = runs_of(names, starts)
    owner = np.searchsorted(starts, start, "right") - 1
    bounds = np.searchsorted(owner, np.arange(len(group) + 1))
    change = np.zeros(len(names) + 1, np.int32)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    dropped = np.cumsum(change)[:-1] > 0
    best, collapsed = [], []
    for k, text in enumerate(group):
        own = slice(bounds[k], bounds[k + 1])
        some = bounds[k] < bounds[k + 1]
        run = _best(list(zip((start[own] - starts[k]).tolist(), length[own].tolist(), period[own].tolist())))
        best.append(run and dict(zip(("start", "length", "period"), run)))
        collapsed.append(_collapsed(text, dropped[starts[k]:starts[k + 1]] if some else None))
    runs = pa.StructArray.from_arrays([pa.array(start - starts[owner]), pa.array(length), pa.array(period)],
                                      fields=list(_RUN))
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(np.diff(starts)),
         pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), runs, type=pa.list_(_RUN)),
         pa.array(best, _RUN), pa.array(collapsed, pa.string())], schema=_OUT)


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, runs, best, collapsed) of every document.

    A run is a stretch of consecutive words of smallest period q and at least
    max(24, 3q) words that cannot be made longer on either side.  ``runs`` has
    all, by start, then period; ``best`` the one of greatest length / period
    (ties: smallest start, then period) or null; ``collapsed`` is the text
    without the words that stand in any run after its first q, joined by one
    space.

    A null or empty text has no words, no runs and an empty ``collapsed``.
    Rows that repeat give a row each, a null doc_id stays null, other columns
    are left behind whatever their names, an empty table gives no rows.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, group, size = [], [], 0
        for record in batches:
            for i, t in zip(record.column(0).to_pylist(), text_column(record)):
                ids.append(i)
                group.append(t)
                size += len(t)
                if size >= GROUP or len(group) >= 4096:
                    yield _found(ids, group)
                    ids, group, size = [], [], 0
        if group:
            yield _found(ids, group)

    prepare(docs.sparkSession)
    return texts(docs, doc_id, text).mapInArrow(emit, SCHEMA)
