"""Best-fit packing of token sequences with a swap-based local search.

Documents become pieces of at most ``capacity`` tokens (only longer ones are
cut; the first piece takes the remainder).  Pieces are dealt by a hash over
groups of about ``group_size`` pieces, so no group depends on the size of the
corpus or on copies.  Each group is packed best-fit decreasing, then improved:
the emptiest bin gives documents away by moves, one-for-one and two-for-one
exchanges with fuller bins.  Each exchange moves tokens from an emptier into a
fuller bin, so the sum of squared fills grows and the search ends; a bin that
runs empty is gone.  A group needs at most a bin or so more than its tokens
do, which for groups of thousands of pieces is a small share of a percent.

Defined results: a null text counts as empty (one piece, the end token);
repeated rows are packed one by one; an empty table gives an empty result;
only the id and text columns are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesift.llm.tokens import default_tokenizer, encoder

END_ID = 0
# two-for-one exchanges look at the pairs of bins with at most this many pieces
PAIR_BIN = 24
# the search ends after so many bins in a row that could give nothing away
PATIENCE = 20


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of each piece of a document of ``n`` tokens."""
    first = n % capacity or capacity
    return [(0, min(first, n)), *[(s, capacity) for s in range(first, n, capacity)]]


def best_fit(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Best-fit decreasing: bins of item numbers."""
    bins: list[list[int]] = []
    by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_mask = 0  # bit f: some bin has f tokens free
    for i in np.argsort(-sizes, kind="stable"):
        i, size = int(i), int(sizes[i])
        fits = open_mask >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            b = by_free[free].pop()
            if not by_free[free]:
                open_mask &= ~(1 << free)
            bins[b].append(i)
        else:
            free, b = capacity, len(bins)
            bins.append([i])
        if left := free - size:
            by_free[left].append(b)
            open_mask |= 1 << left
    return bins


def fewest(sizes: np.ndarray, capacity: int) -> int:
    """Lower bound on the bins (Martello and Toth's L2): large pieces need one each, the rest fills what those leave."""
    if not len(sizes):
        return 0
    s = np.sort(sizes)[::-1].astype(np.int64)
    total = np.concatenate([[0], np.cumsum(s)])
    large = int((2 * s > capacity).sum())
    best = -(-int(total[-1]) // capacity)
    for t in np.unique(s[2 * s <= capacity]):
        alone = int((s > capacity - t).sum())
        upto = int((s >= t).sum())
        left = (large - alone) * capacity - int(total[large] - total[alone])
        best = max(best, large + max(0, -(-(int(total[upto] - total[large]) - left) // capacity)))
    return max(best, large)


def improve(bins: list[list[int]], sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Local search over the bins that are not full."""
    least = fewest(sizes, capacity)
    fill = np.array([int(sizes[b].sum()) for b in bins], dtype=np.int64)
    bins = [list(b) for b in bins]
    stuck: set[int] = set()
    alive, idle = len(bins), 0
    while alive > least and idle < PATIENCE:
        rest = [b for b in np.argsort(fill, kind="stable") if 0 < fill[b] < capacity and b not in stuck]
        if not rest:
            break
        source = int(rest[0])
        if not _give_away(source, bins, sizes, fill, capacity):
            stuck.add(source)
            idle += 1
            continue
        idle = 0
        if not bins[source]:
            alive -= 1
    return [b for b in bins if b]


def _give_away(source: int, bins: list[list[int]], sizes: np.ndarray, fill: np.ndarray, capacity: int) -> bool:
    """Exchange as much as possible out of one bin; whether anything moved."""
    moved = False
    while bins[source]:
        others = [b for b in np.flatnonzero((fill > 0) & (fill < capacity)) if b != source and fill[b] >= fill[source]]
        if not others:
            return moved
        # what a fuller bin can give: nothing, one piece, or two
        give = [(0, b, ()) for b in others]
        for b in others:
            items = bins[b]
            give += [(int(sizes[i]), b, (i,)) for i in items]
            if len(items) <= PAIR_BIN:
                give += [(int(sizes[i] + sizes[j]), b, (i, j)) for k, i in enumerate(items) for j in items[k + 1 :]]
        gives = np.array([g[0] for g in give])
        room = capacity - fill[[g[1] for g in give]]
        mine = bins[source]
        take = [(int(sizes[i]), (i,)) for i in mine]
        if len(mine) <= PAIR_BIN:
            take += [(int(sizes[i] + sizes[j]), (i, j)) for k, i in enumerate(mine) for j in mine[k + 1 :]]
        best = (0, None, None)
        for size, out in take:
            gain = size - gives
            gain[gain > room] = 0
            if len(out) == 2:  # two for one, not two for two
                gain[[len(g[2]) == 2 for g in give]] = 0
            at = int(gain.argmax())
            if gain[at] > best[0]:
                best = (int(gain[at]), out, give[at])
        gain, out, got = best
        if not gain:
            return moved
        _, target, back = got
        bins[source] = [i for i in mine if i not in out] + list(back)
        bins[target] = [i for i in bins[target] if i not in back] + list(out)
        fill[source] -= gain
        fill[target] += gain
        moved = True
    return moved


def pack(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each size."""
    place, offset = np.zeros(len(sizes), dtype=np.int64), np.zeros(len(sizes), dtype=np.int64)
    part = np.flatnonzero(sizes < capacity)
    bins = [[int(part[i]) for i in b] for b in improve(best_fit(sizes[part], capacity), sizes[part], capacity)]
    bins += [[int(i)] for i in np.flatnonzero(sizes >= capacity)]
    for n, b in enumerate(bins):
        place[b] = n
        offset[b] = np.concatenate([[0], np.cumsum(sizes[b])[:-1]])
    return place, offset


def token_pieces(docs: DataFrame, id_col: str, text_col: str, capacity: int, tokenizer: str, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 (and ``ids``, if wanted)."""
    fields = [
        T.StructField("doc_id", docs.schema[id_col].dataType),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ]
    if with_ids:
        fields.append(T.StructField("ids", T.BinaryType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        end = np.array([END_ID], dtype="<u4")
        for batch in batches:
            row, piece, start, length, crc, ids = [], [], [], [], [], []
            for r, text in enumerate(batch.column(1)):
                all_ids = np.concatenate([enc.ids(text.as_py()), end])
                for k, (s, n) in enumerate(cut(len(all_ids), capacity)):
                    raw = all_ids[s : s + n].tobytes()
                    row.append(r)
                    piece.append(k)
                    start.append(s)
                    length.append(n)
                    crc.append(zlib.crc32(raw))
                    if with_ids:
                        ids.append(raw)
            out = [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                out.append(pa.array(ids, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(out, names)

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, T.StructType(fields))


def pack_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 2048,
    tokenizer: str | None = None,
    group_size: int = 5_000,
    with_ids: bool = False,
) -> DataFrame:
    """``token_pieces`` with sequence_id and offset."""
    pieces = token_pieces(docs, id_col, text_col, capacity, tokenizer or default_tokenizer(), with_ids)
    groups = max(1, -(-docs.count() // group_size))
    # copies differ in nothing but their place, so the salt keeps a large group of repeated rows apart
    key = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id() % 64), F.lit(groups))
    pieces = pieces.withColumn("group", key)
    schema = T.StructType([*[f for f in pieces.schema if f.name != "group"], T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")])
        place, offset = pack(table["length"].to_numpy(), capacity)
        first = int(table["group"][0].as_py()) << 32
        table = table.drop_columns(["group"])
        return table.append_column("sequence_id", pa.array(first + place)).append_column("offset", pa.array(offset))

    return pieces.groupBy("group").applyInArrow(run, schema)
