"""Periodic runs of words, by recursive frequency splitting and a lag scan.

A run is a maximal stretch of words with smallest period q (words q apart are
identical) of at least ``max(MIN_WORDS, 2 q)`` words.

1. *Splitting.*  In a run every word has a copy q words away, and q is at most
   half of the segment the run lies in.  A word with no copy that near is in
   no run of its segment and splits it.  The parts are smaller, so more words
   become too rare; this goes on until no segment is split.
2. *Lag scan* of the segments left.  Lags below 16 are compared word by word.
   Lags from 2h to 4h (h = 8, 16, ...) use grams of h words: a run of such a
   period repeats, one period later, a gram that begins at a multiple of h, so
   only those grams look for their copies.  Words in no repeated gram of h
   words split the segments again before the next h.

All texts of a block are worked on at once as arrays; there is no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesift.llm.anchors import blocks

# Fixed by the definition of a run.
MIN_WORDS = 12
# Lags below this are compared directly; 16 = 2 * the shortest gram of the scan.
DIRECT_LAGS = 16
BLOCK_BYTES = 1 << 20

BLANK = np.zeros(256, dtype=bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def ranges(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """lo[0], ..., hi[0] - 1, lo[1], ..., hi[1] - 1, ..."""
    n = hi - lo
    return np.arange(int(n.sum())) + np.repeat(lo - (np.cumsum(n) - n), n)


def dense(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1]


def near_copies(word: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of the copy before and after each word in its text; -1 and the number of words where there is none."""
    key = text * (int(word.max(initial=0)) + 1) + word
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    before = np.full(len(word), -1, dtype=np.int64)
    after = np.full(len(word), len(word), dtype=np.int64)
    before[order[1:][same]] = order[:-1][same]
    after[order[:-1][same]] = order[1:][same]
    return before, after


def pieces(lo: np.ndarray, hi: np.ndarray, cuts: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """What is left of the segments without the places ``cuts``, from ``least`` places on."""
    starts, ends = np.sort(np.concatenate([lo, cuts + 1])), np.sort(np.concatenate([cuts, hi]))
    long = ends - starts >= least
    return starts[long], ends[long]


def split_rare(lo: np.ndarray, hi: np.ndarray, before: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The segments in which each word has a copy at most half a segment away."""
    done = [(np.empty(0, np.int64), np.empty(0, np.int64))]
    lo, hi = pieces(lo, hi, np.empty(0, np.int64), MIN_WORDS)
    while len(lo):
        seg, at = np.repeat(np.arange(len(lo)), hi - lo), ranges(lo, hi)
        reach = ((hi - lo) // 2)[seg]
        left, right = before[at], after[at]
        rare = ((left < lo[seg]) | (at - left > reach)) & ((right >= hi[seg]) | (right - at > reach))
        split = np.zeros(len(lo), dtype=bool)
        split[seg[rare]] = True
        done.append((lo[~split], hi[~split]))
        lo, hi = pieces(lo[split], hi[split], at[rare], MIN_WORDS)
    lo, hi = (np.concatenate(x) for x in zip(*done, strict=True))
    order = np.argsort(lo)
    return lo[order], hi[order]


class Found:
    """Runs in order of their starts; a new one inside a run of a smaller period is no run of its own."""

    def __init__(self) -> None:
        self.rows = np.empty((0, 3), dtype=np.int64)
        self.reach = np.empty(0, dtype=np.int64)

    def add(self, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> None:
        if not len(start):
            return
        if len(self.rows):
            i = np.searchsorted(self.rows[:, 0], start, side="right") - 1
            new = (i < 0) | (self.reach[np.maximum(i, 0)] < start + length)
            start, length, period = start[new], length[new], period[new]
        rows = np.concatenate([self.rows, np.stack([start, length, period], axis=1)])
        self.rows = rows[np.lexsort((rows[:, 2], rows[:, 0]))]
        self.reach = np.maximum.accumulate(self.rows[:, 0] + self.rows[:, 1])


class Grams:
    """Numbers of the grams of 1, 2, 4, ... words that begin at each place of the segments; equal grams of a segment have one number."""

    def __init__(self, word: np.ndarray, lo: np.ndarray, hi: np.ndarray):
        self.place = ranges(lo, hi)
        self._bound(hi - lo)
        self.levels = [dense(self.segment * (int(word.max(initial=0)) + 1) + word[self.place])]

    def _bound(self, n: np.ndarray) -> None:
        self.segment = np.repeat(np.arange(len(n)), n)
        self.end = np.repeat(np.cumsum(n), n)
        self.start = np.repeat(np.cumsum(n) - n, n)

    def __len__(self) -> int:
        return len(self.place)

    def double(self) -> None:
        last, h = self.levels[-1], 1 << (len(self.levels) - 1)
        whole = np.arange(len(self)) + 2 * h <= self.end
        at = np.flatnonzero(whole)
        grams = np.full(len(self), -1, dtype=np.int64)
        grams[at] = dense(last[at] * (int(last.max(initial=0)) + 1) + last[at + h])
        self.levels.append(grams)

    def ordered(self) -> np.ndarray:
        """The places of whole grams of the last level, by gram and place."""
        at = np.flatnonzero(self.levels[-1] >= 0)
        return at[np.argsort(self.levels[-1][at], kind="stable")]

    def split(self, order: np.ndarray, h: int) -> None:
        """Drops what no repeated gram of ``h`` words covers, and pieces of fewer than 4 h words."""
        gram = self.levels[-1][order]
        same = np.zeros(len(gram) + 1, dtype=bool)
        same[1:-1] = gram[1:] == gram[:-1]
        again = order[same[1:] | same[:-1]]
        edge = np.zeros(len(self) + 1, dtype=np.int64)
        np.add.at(edge, again, 1)
        np.add.at(edge, again + h, -1)
        bare = np.flatnonzero(np.cumsum(edge[:-1]) == 0)
        ends = np.unique(self.end)
        lo, hi = pieces(np.unique(self.start), ends, bare, 4 * h)
        keep = ranges(lo, hi)
        self.place = self.place[keep]
        self.levels = [x[keep] for x in self.levels]
        self._bound(hi - lo)
        at = np.arange(len(self))
        for i in range(1, len(self.levels)):
            self.levels[i] = np.where(at + (1 << i) <= self.end, self.levels[i], -1)

    def copies(self, order: np.ndarray, h: int) -> tuple[np.ndarray, np.ndarray]:
        """Grams of ``h`` words at multiples of ``h``, and the lags of 2 h to 4 h at which they occur again."""
        gram = self.levels[-1]
        size = len(self) + 4 * h
        keys = gram[order] * size + order
        a = np.flatnonzero(((np.arange(len(self)) - self.start) % h == 0) & (gram >= 0))
        first = np.searchsorted(keys, gram[a] * size + a + 2 * h)
        until = np.searchsorted(keys, gram[a] * size + a + 4 * h)
        b = order[ranges(first, until)]
        a = np.repeat(a, until - first)
        one = self.segment[a] == self.segment[b]
        return a[one], b[one] - a[one]

    def stretches(self, a: np.ndarray, lag: np.ndarray, h: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Maximal stretches [x, y) of words that equal those a lag later, from the grams found in them."""
        order = np.lexsort((a, lag))
        a, lag = a[order], lag[order]
        new = np.ones(len(a) + 1, dtype=bool)
        new[1:-1] = (lag[1:] != lag[:-1]) | (a[1:] != a[:-1] + h) | (self.segment[a[1:]] != self.segment[a[:-1]])
        x, y, lag = a[new[:-1]], a[new[1:]] + h, lag[new[:-1]]
        start, end = self.start[x], self.end[x]
        for i in range(len(self.levels) - 2, -1, -1):
            grams, step = self.levels[i], 1 << i
            fits = np.flatnonzero(x - step >= start)
            x[fits] -= step * (grams[x[fits] - step] == grams[x[fits] + lag[fits] - step])
            fits = np.flatnonzero(y + lag + step <= end)
            y[fits] += step * (grams[y[fits]] == grams[y[fits] + lag[fits]])
        return x, y, lag


def find_runs(word: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Rows start, length, period of the runs inside the segments, by start and period."""
    found = Found()
    if not len(lo):
        return found.rows
    grams = Grams(word, lo, hi)
    one = grams.levels[0]
    for q in range(1, min(DIRECT_LAGS, len(one))):
        same = np.concatenate([[False], one[q:] == one[:-q], [False]])
        edge = np.flatnonzero(same[1:] != same[:-1])
        x, y = edge[0::2], edge[1::2]
        long = y - x >= max(MIN_WORDS - q, q)
        found.add(grams.place[x[long]], (y - x)[long] + q, np.full(int(long.sum()), q))
    h = 1
    while h < DIRECT_LAGS // 2:
        grams.double()
        h *= 2
    while True:
        grams.split(grams.ordered(), h)
        if not len(grams):
            return found.rows
        x, y, lag = grams.stretches(*grams.copies(grams.ordered(), h), h)
        long = y - x >= lag
        found.add(grams.place[x[long]], (y - x + lag)[long], lag[long])
        grams.double()
        h *= 2


def _runs_of_block(ids: pa.Array, texts: pa.Array) -> pa.RecordBatch:
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8)[offsets[0] : offsets[-1]] if held is not None else np.empty(0, np.uint8)
    offsets = offsets - offsets[0]

    # words: where they start and end, and a number for each distinct one
    solid = ~BLANK[data]
    joint = np.zeros(len(data) + 1, dtype=bool)
    joint[offsets] = True
    start = np.flatnonzero(solid & (joint[:-1] | ~np.concatenate([[False], solid[:-1]])))
    end = np.flatnonzero(solid & (joint[1:] | ~np.concatenate([solid[1:], [False]]))) + 1
    at = np.concatenate([[0], np.cumsum(end - start)])
    buffers = [None, pa.py_buffer(at), pa.py_buffer(data[solid])]
    word = pa.Array.from_buffers(pa.large_binary(), len(start), buffers).dictionary_encode().indices.to_numpy().astype(np.int64)
    first = np.searchsorted(start, offsets)
    text = np.repeat(np.arange(len(texts)), np.diff(first))

    lo, hi = split_rare(first[:-1], first[1:], *near_copies(word, text))
    runs = find_runs(word, lo, hi)
    owner = text[runs[:, 0]]
    n_runs = np.bincount(owner, minlength=len(texts))

    # the words left when each run is cut to its first period, joined by one space
    edge = np.zeros(len(word) + 1, dtype=np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    kept = np.flatnonzero(np.cumsum(edge[:-1]) == 0)
    last = np.concatenate([text[kept][1:] != text[kept][:-1], [True]])[: len(kept)]
    inside = np.zeros(len(data) + 1, dtype=np.int8)
    inside[start[kept]] += 1
    inside[end[kept]] -= 1
    shown = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
    shown[end[kept[~last]]] = True
    collapsed = np.where(solid, data, np.uint8(0x20))[shown]
    bound = np.concatenate([[0], np.cumsum(shown)])[offsets]

    listed = pa.StructArray.from_arrays([pa.array(runs[:, 0] - first[owner]), pa.array(runs[:, 1]), pa.array(runs[:, 2])], fields=list(RUN))
    return pa.record_batch(
        {
            "doc_id": ids,
            "n_words": pa.array(np.diff(first), pa.int64()),
            "runs": pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n_runs)]), pa.int32()), listed),
            "collapsed": pa.Array.from_buffers(pa.large_string(), len(texts), [None, pa.py_buffer(bound), pa.py_buffer(collapsed)]).cast(pa.string()),
        }
    )


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_words, runs (array of start, length, period by start and period), collapsed.

    ``collapsed`` is the text without the words that any run has after its
    first period, the rest joined by one space.

    Defined results: null, empty and blank texts have no words, no runs and an
    empty ``collapsed``; null ids and repeated rows keep their rows; runs that
    start together are ordered by period; an empty table gives an empty result;
    other columns are not read.  A text is worked on as a whole, texts of up
    to ``BLOCK_BYTES`` in all together.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
            for a, b in blocks(sizes, BLOCK_BYTES):
                yield _runs_of_block(batch.column(0).slice(a, b - a), texts.slice(a, b - a))

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
