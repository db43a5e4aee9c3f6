"""Substring deduplication over bytes by grouping strings of one length.

A byte goes when it lies in a string of ``length`` bytes that also starts
earlier (in a document with a smaller id, or earlier in its own).  The corpus
is indexed in blocks.  A block holds the contexts of the anchors (see
``anchors``) of one hash bucket: all strings of ``length`` bytes with the same
anchor gram are in one block, so it has every place a string of its own could
match.  In a block:

* each string of ``length`` bytes gets a name of 128 bits from two independent
  polynomial hashes, read off running sums, so a string costs the same
  whatever its length;
* equal strings have their anchor at the same offset, so the strings are
  sorted by name for one range of offsets at a time, and a string has a match
  at an earlier place exactly if the first place of its name is earlier.

This is no Burrows-Wheeler transform: ranking all suffixes of the blocks to
``length`` bytes took more than the time there is (README), and strings of
one fixed length need no order, only equality.  Anchors that no other place
shares are not indexed at all, a batch of documents sends each distinct
context once, and each carries its document's place in the order of ids as a
number of fixed width, so the shuffle grows in proportion to the text.

Defined results: a null text has no bytes; places in rows with the same id are
ordered by their start, and equal ones are not earlier than each other; null
ids come after all others; an empty table gives an empty result; only the id
and text columns are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tablesift.llm import exchange as X
from tablesift.llm.anchors import BYTE_HASH, anchors, blocks, mix

CONTEXTS = 1
_ENTRY = np.dtype([("offset", "<u2"), ("windows", "<u2"), ("place", "<u4")])
_BLOCK_BYTES = 1 << 20
# strings sorted at once
PASS_STRINGS = 1 << 20
# odd factors of the two names of a string
_FACTORS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


class _Batch:
    """Bytes and anchors of a batch of documents, in id order."""

    def __init__(self, table: pa.Table, length: int, k: int):
        value, null = X.order_of(table)
        raw = [t.encode() for t in table["text"].to_pylist()]
        # rows of one id in the order of their texts, so that every step has them alike
        order = np.array(sorted(range(len(raw)), key=lambda i: (null[i], value[i], raw[i])), dtype=np.int64)
        raw = [raw[i] for i in order]
        self.ids = table["doc_id"].combine_chunks().take(pa.array(order))
        self.value, self.null = value[order], null[order]
        self.rank = X.dense_ranks(self.value, self.null)
        self.lengths = np.array([len(r) for r in raw], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.buffer = np.frombuffer(b"".join(raw), dtype=np.uint8)
        self.length = length
        parts = []
        for a, b in blocks(self.lengths, _BLOCK_BYTES):
            s, e = int(self.starts[a]), int(self.starts[b - 1] + self.lengths[b - 1])
            found = anchors(BYTE_HASH[self.buffer[s:e]], self.starts[a:b] - s, self.lengths[a:b], length, k)
            parts.append((found.row + a, found.place + s, found.first + s, found.last + s, found.seed))
        empty = np.empty(0, dtype=np.int64)
        cols = [np.concatenate(c) for c in zip(*parts, strict=True)] if parts else [empty, empty, empty, empty, empty.astype(np.uint64)]
        self.row, self.place, self.first, self.last, self.seed = cols

    def contexts(self, shared: np.ndarray) -> None:
        """Distinct contexts of the shared anchors, each with its first place."""
        for name in ("row", "place", "first", "last", "seed"):
            setattr(self, name, getattr(self, name)[shared])
        data = self.buffer.tobytes()
        offset = self.place - self.first
        who = self.rank[self.row]
        within = self.place - self.starts[self.row]
        known: dict[tuple[int, bytes], int] = {}
        self.entry = np.empty(len(self.row), dtype=np.int64)
        heads: list[int] = []
        until = self.last + self.length
        for i, key in enumerate(zip(offset.tolist(), [data[a:b] for a, b in zip(self.first.tolist(), until.tolist(), strict=True)], strict=True)):
            e = known.setdefault(key, len(heads))
            self.entry[i] = e
            if e == len(heads):
                heads.append(i)
            elif (who[i], within[i]) < (who[heads[e]], within[heads[e]]):
                heads[e] = i
        self.heads = np.array(heads, dtype=np.int64)
        self.who, self.within, self.offset = who, within, offset
        self.windows = self.last - self.first + 1

    def by_bucket(self, n_buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """Order of the distinct contexts by bucket, and their buckets."""
        bucket = ((self.seed[self.heads] >> np.uint64(32)) % np.uint64(n_buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        return order, bucket[order]


def _send_contexts(batch: _Batch, number: int, n_buckets: int) -> pa.Table:
    order, bucket = batch.by_bucket(n_buckets)
    heads = batch.heads[order]
    row = batch.row[heads]
    value, null = batch.value[row], batch.null[row]
    entries = np.empty(len(heads), dtype=_ENTRY)
    entries["offset"], entries["windows"], entries["place"] = batch.offset[heads], batch.windows[heads], batch.within[heads]
    data = batch.buffer.tobytes()
    starts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else []
    ends = [*starts[1:], len(bucket)] if len(bucket) else []
    payload = []
    for s, e in zip(starts, ends, strict=True):
        texts = [data[batch.first[h] : batch.last[h] + batch.length] for h in heads[s:e]]
        payload.append(b"".join([int(e - s).to_bytes(8, "little"), entries[s:e].tobytes(), X.pack_order(value[s:e], null[s:e]), *texts]))
    return X.packed([int(bucket[s]) for s in starts], number, CONTEXTS, payload)


class StringNames:
    """Names of the strings of one length in a text of short pieces: two 64-bit hashes each."""

    def __init__(self, text: np.ndarray, sizes: np.ndarray, length: int):
        self.length, longest = length, int(sizes.max())
        ends = np.cumsum(sizes)
        within = (np.arange(len(text)) - np.repeat(ends - sizes, sizes)).astype(np.int32)
        self.sums, self.inverse = [], []
        for family, factor in enumerate(_FACTORS):
            powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(longest, factor, dtype=np.uint64)]))
            back = np.uint64(pow(factor, -1, 1 << 64))
            self.inverse.append(np.cumprod(np.concatenate([[np.uint64(1)], np.full(longest, back, dtype=np.uint64)])))
            byte = mix(BYTE_HASH + np.uint64(family))
            sums = np.zeros(len(text) + 1, dtype=np.uint64)
            np.cumsum(byte[text] * powers[within], out=sums[1:])
            self.sums.append(sums)

    def at(self, start: np.ndarray, within: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Names of the strings at these places of the text, which lie at ``within`` of their pieces."""
        one, two = (mix((s[start + self.length] - s[start]) * i[within]) for s, i in zip(self.sums, self.inverse, strict=True))
        return one, two


def _later(one: np.ndarray, two: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Whether another string of the same name has an earlier place."""
    order = np.argsort(one)
    head = np.concatenate([[True], one[order[1:]] != one[order[:-1]]])
    if not head[np.flatnonzero(two[order[1:]] != two[order[:-1]]) + 1].all():  # first names that agree by chance
        order = np.lexsort((two, one))
        head = np.concatenate([[True], (one[order[1:]] != one[order[:-1]]) | (two[order[1:]] != two[order[:-1]])])
    earliest = np.minimum.reduceat(place[order], np.flatnonzero(head))
    later = np.empty(len(order), dtype=bool)
    later[order] = earliest[np.cumsum(head) - 1] < place[order]
    return later


def offset_ranges(offset: np.ndarray, windows: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Ranges of anchor offsets (first, last) with about ``most`` strings each."""
    top = int(offset.max())
    step = np.bincount(offset - windows + 1, minlength=top + 2) - np.bincount(offset + 1, minlength=top + 2)
    return [(a, b - 1) for a, b in blocks(np.cumsum(step)[: top + 1], most)]


def _answer_contexts(table: pa.Table, length: int) -> pa.Table:
    """For each string start of each context: it is not the first of its string."""
    entries, orders, texts = [], [], []
    for raw in table["payload"].to_pylist():
        n = int.from_bytes(raw[:8], "little")
        after = 8 + n * _ENTRY.itemsize
        entries.append(np.frombuffer(raw, _ENTRY, n, 8))
        orders.append(X.unpack_order(raw[after : after + X.order_bytes(n)], n))
        texts.append(np.frombuffer(raw, np.uint8, offset=after + X.order_bytes(n)))
    counts = np.cumsum([int(e["windows"].astype(np.int64).sum()) for e in entries])
    entry, text = np.concatenate(entries), np.concatenate(texts)
    who = X.dense_ranks(*(np.concatenate(c) for c in zip(*orders, strict=True)))
    del entries, orders, texts
    offset, windows = entry["offset"].astype(np.int64), entry["windows"].astype(np.int64)
    sizes = windows + length - 1
    base = np.cumsum(sizes) - sizes
    flag = np.cumsum(windows) - windows
    names = StringNames(text, sizes, length)
    later = np.zeros(int(windows.sum()), dtype=bool)
    for low, high in offset_ranges(offset, windows, PASS_STRINGS):
        # the string at window j of a context has its anchor at offset - j
        begin = np.maximum(0, offset - high)
        many = np.maximum(0, np.minimum(windows - 1, offset - low) - begin + 1)
        of = np.repeat(np.arange(len(entry)), many)
        if not len(of):
            continue
        nth = np.arange(len(of)) + np.repeat(begin - (np.cumsum(many) - many), many)
        place = (who[of] << 32) | (entry["place"][of].astype(np.int64) - offset[of] + nth)
        later[flag[of] + nth] = _later(*names.at(base[of] + nth, nth), place)
    bits = [np.packbits(later[a:b]).tobytes() for a, b in zip([0, *counts[:-1]], counts, strict=True)]
    return table.select(["bucket", "batch", "kind"]).append_column("payload", pa.array(bits, pa.binary()))


def _removed(batch: _Batch, answers: pa.Table, n_buckets: int) -> np.ndarray:
    """Whether each byte of the batch goes."""
    order, bucket = batch.by_bucket(n_buckets)
    windows = batch.windows[batch.heads]
    sent = windows[order]
    later = []
    if len(order):
        cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        n = np.add.reduceat(sent, cuts)
        later = [np.unpackbits(np.frombuffer(p, np.uint8), count=int(c)) for p, c in zip(X.answers_of(answers, CONTEXTS), n, strict=True)]
    step = np.zeros(len(batch.buffer) + 1, dtype=np.int64)
    if len(order):
        flags = np.concatenate(later).astype(bool)
        # where each distinct context's flags begin
        begin = np.empty(len(order), dtype=np.int64)
        begin[order] = np.cumsum(sent) - sent
        head = batch.heads[batch.entry]
        first = (batch.who == batch.who[head]) & (batch.within == batch.within[head])
        counts = batch.windows
        ends = np.cumsum(counts)
        nth = np.arange(int(ends[-1])) - np.repeat(ends - counts, counts)
        gone = flags[np.repeat(begin[batch.entry], counts) + nth] | ~np.repeat(first, counts)
        at = (np.repeat(batch.first, counts) + nth)[gone]
        step += np.bincount(at, minlength=len(step)) - np.bincount(at + batch.length, minlength=len(step))
    return np.cumsum(step[:-1]) > 0


def duplicate_bytes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = 100,
    k: int = 32,
    batch_bytes: int = 4 * X.MB,
    bucket_bytes: int = 4 * X.MB,
) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, ``spans`` (first byte and length of each removed run),
    ``kept`` (the other bytes) and its SHA-256."""
    n_batches, n_buckets = X.sizes(docs, text_col, batch_bytes, bucket_bytes)
    rows = X.in_order(docs, id_col, text_col, n_batches)

    def seeds(table: pa.Table) -> pa.Table:
        return X.send_seeds(_Batch(table, length, k).seed, table["batch"][0].as_py(), n_buckets)[1]

    def with_contexts(table: pa.Table, answers: pa.Table) -> _Batch:
        batch = _Batch(table, length, k)
        sent, where = np.unique(X.keys_of(batch.seed, n_buckets), return_inverse=True)
        batch.contexts(X.seed_bits(sent, answers)[where] if len(sent) else np.empty(0, bool))
        return batch

    def contexts(table: pa.Table, answers: pa.Table) -> pa.Table:
        return _send_contexts(with_contexts(table, answers), table["batch"][0].as_py(), n_buckets)

    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema[id_col].dataType),
            *[T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")],
            T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("length", T.LongType())]))),
            T.StructField("kept", T.BinaryType()),
            T.StructField("kept_sha256", T.StringType()),
        ]
    )

    def cut(table: pa.Table, answers: pa.Table) -> pa.Table:
        batch = with_contexts(table, answers)
        gone = _removed(batch, answers, n_buckets)
        removed, spans, kept, shas = [], [], [], []
        for s, n in zip(batch.starts.tolist(), batch.lengths.tolist(), strict=True):
            mask = gone[s : s + n]
            removed.append(int(mask.sum()))
            edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
            spans.append([{"start": int(a), "length": int(b - a)} for a, b in zip(edge[::2], edge[1::2], strict=True)])
            kept.append(batch.buffer[s : s + n][~mask].tobytes())
            shas.append(hashlib.sha256(kept[-1]).hexdigest())
        columns = [
            batch.ids, pa.array(batch.lengths, pa.int64()), pa.array(removed, pa.int64()), pa.array([len(x) for x in spans], pa.int64()),
            pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))), pa.array(kept, pa.binary()), pa.array(shas, pa.string()),
        ]
        return pa.table(columns, names=schema.names)

    def answer(table: pa.Table) -> pa.Table:
        return _answer_contexts(table, length)

    seed_answers = X.per_bucket(X.per_batch(rows, seeds, X.PACKED), X.answer_seeds)
    found = X.per_bucket(X.per_batch_with(rows, seed_answers, contexts, X.PACKED), answer)
    return X.per_batch_with(rows, seed_answers.unionByName(found), cut, schema)
