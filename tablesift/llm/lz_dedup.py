"""Substring deduplication by lookup of word windows.

The texts are cut into blocks of ``window`` words, one at every place of
every document.  The index has each block once, with the smallest document it
starts in; it is spread over the buckets of a hash space.  Every block of a
document is looked up, and the answer is one bit: some smaller document has
it.  Words in a matching block become duplicate spans, the others are kept.
This is no Lempel-Ziv parse: there is no reference place, and blocks of one
span may be from different documents.  The 64-bit block hash finds the match;
a second, independent 32-bit hash checks it.

Only blocks that may match are looked up: a block's anchor (see ``anchors``)
is sent first, 40 bits for each distinct one of a batch, and blocks whose
anchor no other place has match nothing at once.  Each block carries its
document's place in the order of ids as a number of fixed width, so the
shuffle grows in proportion to the text.

Defined results: a null text has no words; repeated rows are judged by their
ids, so rows that share an id are no duplicates of each other; null ids come
after all others; an empty table gives an empty result; only the id and text
columns are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tablesift.llm import exchange as X
from tablesift.llm.anchors import anchors, rolling, word_units

BLOCKS = 1


class _Batch:
    """Words, anchors and distinct blocks of a batch of documents."""

    def __init__(self, table: pa.Table, window: int, k: int):
        value, null = X.order_of(table)
        order = np.lexsort((value, null))  # rows in id order
        self.ids = table["doc_id"].combine_chunks().take(pa.array(order))
        self.value, self.null = value[order], null[order]
        self.rank = X.dense_ranks(self.value, self.null)
        texts = table["text"].combine_chunks().take(pa.array(order)).to_pylist()
        self.raw = [t.encode() for t in texts]
        buffer = np.frombuffer(b" ".join(self.raw), dtype=np.uint8)
        self.begin, self.end, words = word_units(buffer)
        bytes_ = np.array([len(r) + 1 for r in self.raw])
        until = np.cumsum(bytes_)
        self.starts = np.searchsorted(self.begin, until - bytes_)
        self.lengths = np.searchsorted(self.begin, until) - self.starts
        self.buffer, self.words, self.window = buffer, words, window
        self.anchors = anchors(words, self.starts, self.lengths, window, k)

    def looked_up(self, shared: np.ndarray) -> None:
        """Blocks whose anchor is shared, and the distinct ones among them with their first document."""
        a = self.anchors
        first, n, row = a.first[shared], (a.last - a.first + 1)[shared], a.row[shared]
        ends = np.cumsum(n)
        self.place = np.arange(int(n.sum())) + np.repeat(first - (ends - n), n)
        self.row = np.repeat(row, n)
        self.hash = rolling(self.words, self.window, 1)[self.place]
        check = rolling(self.words, self.window, 2)[self.place].astype("<u4")
        # rows are in id order, so the first of equal blocks has the smallest id
        by = np.lexsort((np.arange(len(check)), check, self.hash))
        h, c = self.hash[by], check[by]
        new = np.concatenate([[True], (h[1:] != h[:-1]) | (c[1:] != c[:-1])]) if len(h) else np.empty(0, bool)
        self.entry = np.empty(len(h), dtype=np.int64)
        self.entry[by] = np.cumsum(new) - 1
        self.distinct, self.distinct_check = h[new], c[new]
        self.first_row = self.row[by[new]]


def _send_blocks(batch: _Batch, number: int, n_buckets: int) -> pa.Table:
    """The distinct blocks by bucket: their number, hashes, checks and the first document's place in the order of ids."""
    bucket = ((batch.distinct >> np.uint64(32)) % np.uint64(n_buckets)).astype(np.int64)
    by = np.argsort(bucket, kind="stable")
    hash_, check, row = batch.distinct[by], batch.distinct_check[by], batch.first_row[by]
    value, null = batch.value[row], batch.null[row]
    b = bucket[by]
    starts = np.flatnonzero(np.concatenate([[True], b[1:] != b[:-1]])) if len(b) else []
    ends = [*starts[1:], len(b)] if len(b) else []
    payload = [
        int(e - s).to_bytes(8, "little") + X.planes(hash_[s:e]) + check[s:e].tobytes() + X.pack_order(value[s:e], null[s:e])
        for s, e in zip(starts, ends, strict=True)
    ]
    return X.packed([int(b[s]) for s in starts], number, BLOCKS, payload)


def _answer_blocks(table: pa.Table) -> pa.Table:
    """A bit for each block: a smaller document of another batch has it."""
    parts = []
    for r in table["payload"].to_pylist():
        n = int.from_bytes(r[:8], "little")
        parts.append((X.from_planes(r[8 : 8 + 8 * n]), np.frombuffer(r, "<u4", n, 8 + 8 * n), *X.unpack_order(r[8 + 12 * n :], n)))
    ends = np.cumsum([len(p[0]) for p in parts])
    hash_, check, value, null = (np.concatenate(c) for c in zip(*parts, strict=True))
    del parts
    by = np.lexsort((value, null, check, hash_))
    h, c, v, z = hash_[by], check[by], value[by], null[by]
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (c[1:] != c[:-1])])
    first = np.flatnonzero(new)[np.cumsum(new) - 1]
    # in a block's rows the first is the smallest
    smaller = np.empty(len(by), dtype=bool)
    smaller[by] = (v != v[first]) | (z != z[first])
    bits = [np.packbits(smaller[s:e]).tobytes() for s, e in zip([0, *ends[:-1]], ends, strict=True)]
    return table.select(["bucket", "batch", "kind"]).append_column("payload", pa.array(bits, pa.binary()))


def _factors(batch: _Batch, answers: pa.Table, n_buckets: int) -> np.ndarray:
    """Whether each word lies in a matching block."""
    bucket = ((batch.distinct >> np.uint64(32)) % np.uint64(n_buckets)).astype(np.int64)
    by = np.argsort(bucket, kind="stable")
    counts = np.bincount(bucket, minlength=n_buckets)
    counts = counts[counts > 0]
    got = X.answers_of(answers, BLOCKS)
    bits = [np.unpackbits(np.frombuffer(p, np.uint8), count=int(n)) for p, n in zip(got, counts, strict=True)]
    elsewhere = np.zeros(len(batch.distinct), dtype=bool)
    if bits:
        elsewhere[by] = np.concatenate(bits).astype(bool)
    matched = elsewhere[batch.entry] | (batch.rank[batch.row] > batch.rank[batch.first_row][batch.entry])
    # each matching block reaches window - 1 words on
    at = batch.place[matched]
    step = np.bincount(at, minlength=len(batch.words) + 1) - np.bincount(at + batch.window, minlength=len(batch.words) + 1)
    return np.cumsum(step[:-1]) > 0


def duplicate_spans(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = 13,
    k: int = 5,
    batch_bytes: int = 4 * X.MB,
    bucket_bytes: int = 8 * X.MB,
) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, ``spans`` (array of first word and words of each run),
    ``kept_text`` (the other words, joined by one space) and its SHA-256."""
    n_batches, n_buckets = X.sizes(docs, text_col, batch_bytes, bucket_bytes)
    rows = X.in_order(docs, id_col, text_col, n_batches)

    def seeds(table: pa.Table) -> pa.Table:
        _, sent = X.send_seeds(_Batch(table, window, k).anchors.seed, table["batch"][0].as_py(), n_buckets)
        return sent

    def shared(batch: _Batch, answers: pa.Table) -> None:
        keys = X.keys_of(batch.anchors.seed, n_buckets)
        sent, where = np.unique(keys, return_inverse=True)
        batch.looked_up(X.seed_bits(sent, answers)[where] if len(sent) else np.empty(0, bool))

    def blocks(table: pa.Table, answers: pa.Table) -> pa.Table:
        batch = _Batch(table, window, k)
        shared(batch, answers)
        return _send_blocks(batch, table["batch"][0].as_py(), n_buckets)

    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema[id_col].dataType),
            T.StructField("n_words", T.LongType()),
            T.StructField("n_removed", T.LongType()),
            T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("length", T.LongType())]))),
            T.StructField("kept_text", T.StringType()),
            T.StructField("kept_sha256", T.StringType()),
        ]
    )

    def parse(table: pa.Table, answers: pa.Table) -> pa.Table:
        batch = _Batch(table, window, k)
        shared(batch, answers)
        inside = _factors(batch, answers, n_buckets)
        removed, spans, texts, shas = [], [], [], []
        for raw, s, n in zip(batch.raw, batch.starts, batch.lengths, strict=True):
            cover = inside[s : s + n]
            removed.append(int(cover.sum()))
            edge = np.flatnonzero(np.diff(np.concatenate([[0], cover.view(np.int8), [0]])))
            spans.append([{"start": int(a), "length": int(b - a)} for a, b in zip(edge[::2], edge[1::2], strict=True)])
            words = raw.split()
            kept = b" ".join([w for w, c in zip(words, cover.tolist(), strict=True) if not c] if removed[-1] else words)
            texts.append(kept.decode())
            shas.append(hashlib.sha256(kept).hexdigest())
        columns = [batch.ids, pa.array(batch.lengths, pa.int64()), pa.array(removed, pa.int64())]
        columns += [pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))), pa.array(texts, pa.string()), pa.array(shas, pa.string())]
        return pa.table(columns, names=schema.names)

    seed_answers = X.per_bucket(X.per_batch(rows, seeds, X.PACKED), X.answer_seeds)
    block_answers = X.per_bucket(X.per_batch_with(rows, seed_answers, blocks, X.PACKED), _answer_blocks)
    return X.per_batch_with(rows, seed_answers.unionByName(block_answers), parse, schema)
