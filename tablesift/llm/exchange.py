"""Exchange between batches of documents and buckets of a hash space.

Several operators need, for each piece of content of a document (a window, a
word, a context), what all other documents have of it.  They share this plan:

* documents are dealt over batches of about ``batch_bytes`` of text;
* a batch sends each *distinct* piece once, packed by bucket of its hash, so
  content that a third of all documents share is one entry per batch;
* a bucket, which sees every batch's entry of a piece, answers each batch in
  the order the entries came (often one bit an entry);
* the batch, computed again from its text, applies the answers.

So no task holds more than a batch or a bucket, both sized by bytes, and the
shuffles carry packed arrays.  Texts are shuffled once: every step that reads
them uses the same exchange by batch.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesift.session import checkpoint_dir

PACKED = "bucket int, batch int, kind int, payload binary"
# of a 64-bit hash the upper half names the bucket, the lower 40 bits the entry in it
ENTRY_BITS = np.uint64(40)
ENTRY_MASK = np.uint64((1 << 40) - 1)

MB = 1 << 20


def sizes(docs: DataFrame, text_col: str, batch_bytes: int, bucket_bytes: int) -> tuple[int, int]:
    """Number of batches and of buckets for these texts."""
    total = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string")))).first()[0] or 0
    return max(1, -(-total // batch_bytes)), max(1, -(-total // bucket_bytes))


def batched(docs: DataFrame, id_col: str, text_col: str, n_batches: int) -> DataFrame:
    """Rows (batch, doc_id, text); null texts are empty.  Rows that repeat id and text share a batch."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_batches)).cast("int").alias("batch"), "doc_id", "text")


def packed(bucket: list[int], batch: int, kind: int, payload: list[bytes]) -> pa.Table:
    n = len(bucket)
    return pa.table(
        {
            "bucket": pa.array(bucket, pa.int32()),
            "batch": pa.array([batch] * n, pa.int32()),
            "kind": pa.array([kind] * n, pa.int32()),
            "payload": pa.array(payload, pa.binary()),
        }
    )


def per_batch(rows: DataFrame, func: Callable[[pa.Table], pa.Table], schema) -> DataFrame:
    return rows.groupBy("batch").applyInArrow(func, schema)


def per_bucket(sent: DataFrame, func: Callable[[pa.Table], pa.Table]) -> DataFrame:
    """``func`` answers a bucket's rows, in any order, with rows of the same kind of table."""
    return sent.groupBy("bucket").applyInArrow(func, PACKED)


def per_batch_with(rows: DataFrame, answers: DataFrame, func: Callable[[pa.Table, pa.Table], pa.Table], schema) -> DataFrame:
    """``func`` gets a batch and its answers (maybe none)."""
    return rows.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(func, schema)


def answers_of(table: pa.Table, kind: int) -> list[bytes]:
    """Payloads of one kind in bucket order."""
    got = [(b, p) for b, k, p in zip(table["bucket"].to_pylist(), table["kind"].to_pylist(), table["payload"].to_pylist(), strict=True) if k == kind]
    return [p for _, p in sorted(got, key=lambda x: x[0])]


def keys_of(hashes: np.ndarray, n_buckets: int) -> np.ndarray:
    """Bucket and entry of a hash in one number, ordered by bucket."""
    bucket = (hashes >> np.uint64(32)) % np.uint64(n_buckets)
    return (bucket << ENTRY_BITS) | (hashes & ENTRY_MASK)


def bucket_bounds(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets present in sorted keys, and where each begins (with the end)."""
    bucket = (keys >> ENTRY_BITS).astype(np.int64)
    starts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(keys) else np.empty(0, np.int64)
    return bucket[starts], np.concatenate([starts, [len(keys)]])


def pack40(entries: np.ndarray) -> bytes:
    return entries.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def unpack40(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 5, 8), dtype=np.uint8)
    out[:, :5] = np.frombuffer(raw, dtype=np.uint8).reshape(-1, 5)
    return out.reshape(-1).view("<u8")


def planes(values: np.ndarray) -> bytes:
    """Numbers byte by byte: all lowest bytes, then the next, ...; what sorted or small numbers share then compresses well in a shuffle."""
    return values.astype(f"<{values.dtype.kind}8").view(np.uint8).reshape(-1, 8).T.tobytes()


def from_planes(raw: bytes, kind: str = "u") -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).reshape(-1).view(f"<{kind}8")


# Answers of one bit an entry

SEEDS = 0


def send_seeds(hashes: np.ndarray, batch: int, n_buckets: int) -> tuple[np.ndarray, pa.Table]:
    """The batch's distinct seeds as sorted keys, and what is sent: 40 bits each, then a bit for those that occur twice here."""
    keys, counts = np.unique(keys_of(hashes, n_buckets), return_counts=True)
    buckets, at = bucket_bounds(keys)
    payload = []
    for i in range(len(buckets)):
        part = slice(at[i], at[i + 1])
        payload.append(pack40(keys[part] & ENTRY_MASK) + np.packbits(counts[part] > 1).tobytes())
    return keys, packed(buckets.tolist(), batch, SEEDS, payload)


def answer_seeds(table: pa.Table) -> pa.Table:
    """A bit for each seed: it occurs twice or more in all."""
    raw = table["payload"].to_pylist()
    sizes_ = [_entries(len(r)) for r in raw]
    keys = np.concatenate([unpack40(r[: 5 * n]) for r, n in zip(raw, sizes_, strict=True)])
    twice = np.concatenate([np.unpackbits(np.frombuffer(r[5 * n :], np.uint8), count=n) for r, n in zip(raw, sizes_, strict=True)]).astype(bool)
    order = np.argsort(keys, kind="stable")
    same = np.zeros(len(keys) + 1, dtype=bool)
    same[1:-1] = keys[order[1:]] == keys[order[:-1]]
    shared = np.empty(len(keys), dtype=bool)
    shared[order] = same[1:] | same[:-1]
    # a seed that occurs twice in one batch is shared there; elsewhere it has this batch as a neighbour
    shared |= twice
    ends = np.cumsum(sizes_)
    bits = [np.packbits(shared[e - n : e]).tobytes() for e, n in zip(ends, sizes_, strict=True)]
    return table.select(["bucket", "batch", "kind"]).append_column("payload", pa.array(bits, pa.binary()))


def _entries(n_bytes: int) -> int:
    """n with 5 n + ceil(n / 8) = n_bytes."""
    n = n_bytes * 8 // 41
    while 5 * n + -(-n // 8) < n_bytes:
        n += 1
    return n


def seed_bits(keys: np.ndarray, answers: pa.Table) -> np.ndarray:
    """The answer to each key, in the order sent."""
    _, at = bucket_bounds(keys)
    got = answers_of(answers, SEEDS)
    bits = [np.unpackbits(np.frombuffer(p, np.uint8), count=int(at[i + 1] - at[i])) for i, p in enumerate(got)]
    return np.concatenate(bits).astype(bool) if bits else np.zeros(0, dtype=bool)


# Order of document ids across batches: a number of fixed width goes with each entry


def in_order(docs: DataFrame, id_col: str, text_col: str, n_batches: int) -> DataFrame:
    """``batched`` rows with ``ord``, a long in the order of the ids (null for a null id).

    An integer id is its own place.  Ids of another type are put in order by
    one sort of the distinct ones over ranges; their numbers are checkpointed,
    so that every step sees the same.
    """
    rows = batched(docs, id_col, text_col, n_batches)
    if isinstance(docs.schema[id_col].dataType, T.IntegralType):
        return rows.withColumn("ord", F.col("doc_id").cast("long"))
    checkpoint_dir(docs.sparkSession)
    ids = rows.select("doc_id").where("doc_id is not null").distinct().orderBy("doc_id")
    # numbers grow within a partition and from one to the next
    ids = ids.withColumn("ord", F.monotonically_increasing_id()).checkpoint()
    return rows.join(ids, "doc_id", "left").select("batch", "doc_id", "text", "ord")


def order_of(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """``ord`` of each row (0 where null), and whether it is null."""
    column = table["ord"].combine_chunks()
    return column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), column.is_null().to_numpy(zero_copy_only=False)


def dense_ranks(value: np.ndarray, null: np.ndarray) -> np.ndarray:
    """Dense rank of each place in the order, nulls last."""
    out = np.empty(len(value), dtype=np.int64)
    known, out[~null] = np.unique(value[~null], return_inverse=True)
    out[null] = len(known)
    return out


def pack_order(value: np.ndarray, null: np.ndarray) -> bytes:
    return planes(value) + np.packbits(null).tobytes()


def unpack_order(raw: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    return from_planes(raw[: 8 * n], "i"), np.unpackbits(np.frombuffer(raw[8 * n :], np.uint8), count=n).astype(bool)


def order_bytes(n: int) -> int:
    return 8 * n + -(-n // 8)
