"""Similarity join of documents by their sets of word n-grams.

The overlaps of all documents are the product of the document by n-gram
incidence matrix with its transpose.  Only a few of its entries reach the
threshold, and bounds derived from the sizes of the sets tell which blocks of
the product are needed:

* Sets of sizes a and b with Jaccard similarity P % differ in at most
  H = floor((a + b) (100 - P) / (100 + P)) n-grams.  The n-grams are dealt by
  hash over H + s column parts, so s parts at least are equal in both.
  Documents with an equal part (``keys``) are rows of one block.  A part of
  fewer than ``SMALL`` n-grams says little: a set with fewer than s such parts
  does without them, as one of any s equal parts is another one.  The few sets
  with more of them have keys for them, in pairs if H is small.
* The bound depends on the sizes, so sizes are cut into levels; a set has keys
  at its own level, and at the next if a set of that level may be large enough.
* In a block the product is made by column blocks.  Overlaps add up, and a
  pair whose overlap so far and columns to come stay below what its sizes ask
  for is discarded; a row without pairs leaves the block.

Links are wanted for what they connect, so a pair that other links join
already isn't multiplied.  Each document is first compared with one row (the
pivot) of each of its blocks.  Blocks with one pivot are then one block, as
near copies meet in many, and only those whose rows are still in different
components are multiplied as a whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesift.llm.anchors import blocks, mix, rolling, word_units
from tablesift.llm.order_minhash import LOWER, Folder, _of_keys, _with_frequent, across, connected, dealt

GRAM_BITS = np.uint64(40)
SMALL = 2
# sets that differ in fewer n-grams have small parts in pairs
PAIRED = 16
# sizes grow by half from level to level
LEVEL_GROWTH = 1.5
BLOCK_BYTES = 4 << 20
# n-grams compared at once, columns multiplied at once, column blocks of a product
PAIR_GRAMS = 1 << 21
COLUMNS = 512
COLUMN_BLOCKS = 8


def gram_sets(texts: list[str], k: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ``k``-word n-grams of the texts (64-bit hashes, sorted in each text), and how many each text has.

    A text of fewer than ``k`` words, but any, has one n-gram of all its words.
    """
    raw = [t.encode().translate(LOWER) for t in texts]
    begin, _, words = word_units(np.frombuffer(b" ".join(raw), dtype=np.uint8))
    size = np.array([len(r) + 1 for r in raw], dtype=np.int64)
    until = np.cumsum(size)
    first = np.searchsorted(begin, until - size)
    n_words = np.searchsorted(begin, until) - first
    n = np.maximum(n_words - k + 1, 0)
    row = np.repeat(np.arange(len(texts)), n)
    at = np.arange(int(n.sum())) + np.repeat(first - (np.cumsum(n) - n), n)
    grams = mix(rolling(words, k)[at]) if len(at) else np.empty(0, np.uint64)
    few = np.flatnonzero((n_words > 0) & (n_words < k))
    short = np.zeros(len(few), dtype=np.uint64)
    for i, r in enumerate(few):
        h = np.array([n_words[r]], dtype=np.uint64)
        for w in words[first[r] : first[r] + n_words[r]]:
            h = mix(h ^ w)
        short[i] = h[0]
    row, grams = np.concatenate([row, few]), np.concatenate([grams, short])
    order = np.lexsort((grams, row))
    row, grams = row[order], grams[order]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (grams[1:] != grams[:-1])
    return grams[new], np.bincount(row[new], minlength=len(texts)).astype(np.int64)


def summed(values: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Sums (mod 2^64) of consecutive stretches of ``n`` values."""
    total = np.concatenate([[np.uint64(0)], np.cumsum(values, dtype=np.uint64)])
    end = np.cumsum(n)
    return total[end] - total[end - n]


def level_bounds(largest: int) -> list[int]:
    """Smallest sizes of the levels, up to one beyond ``largest``."""
    out = [1]
    while out[-1] <= largest:
        out.append(max(out[-1] + 1, int(out[-1] * LEVEL_GROWTH)))
    return out + [max(out[-1] + 1, int(out[-1] * LEVEL_GROWTH))]


def block_keys(grams: np.ndarray, n: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the blocks of each set, and how many each set has."""
    bounds = np.array(level_bounds(int(n.max(initial=0))))
    level = np.searchsorted(bounds, n, side="right") - 1
    reaches = (n > 0) & (100 * n >= percent * bounds[np.minimum(level + 1, len(bounds) - 1)])
    # a row per set and level
    own = np.concatenate([np.flatnonzero(n > 0), np.flatnonzero(reaches)])
    at_level = np.concatenate([level[n > 0], level[reaches] + 1])
    differ = 2 * (bounds[at_level + 1] - 1) * (100 - percent) // (100 + percent)
    # sets that may differ in nothing are equal, and equal sets are one row
    own, at_level, differ = own[differ > 0], at_level[differ > 0], differ[differ > 0]
    equal = np.where(differ < PAIRED, 2, 2 + differ // 8)
    parts = differ + equal
    first_part = np.cumsum(parts) - parts
    start = np.cumsum(n) - n
    # the part of each n-gram of each row
    size = n[own]
    one = np.repeat(np.arange(len(own)), size)
    gram = grams[np.arange(int(size.sum())) + np.repeat(start[own] - (np.cumsum(size) - size), size)]
    part = first_part[one] + (((mix(gram) >> np.uint64(32)) * parts[one].astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
    total = int(parts.sum())
    held = np.bincount(part, minlength=total)
    sums = np.zeros(total, dtype=np.uint64)
    np.add.at(sums, part, mix(gram ^ np.uint64(0x5851F42D4C957F2D)))
    owner = np.repeat(np.arange(len(own)), parts)
    number = (np.arange(total) - first_part[owner]).astype(np.uint64)
    keys = mix(sums ^ mix((at_level[owner].astype(np.uint64) << np.uint64(40)) | number))
    large = held >= SMALL
    n_small = np.bincount(owner[~large], minlength=len(own))
    crowded = (n_small >= equal) & (differ >= PAIRED)
    single = np.flatnonzero(large | crowded[owner])
    # small parts of a row, in pairs
    small = np.flatnonzero(~large & (differ < PAIRED)[owner])
    n_small = np.bincount(owner[small], minlength=len(own))
    after = np.repeat(np.cumsum(n_small), n_small) - np.arange(len(small)) - 1
    left = np.repeat(np.arange(len(small)), after)
    right = left + 1 + np.arange(int(after.sum())) - np.repeat(np.cumsum(after) - after, after)
    pair_keys = mix(keys[small[left]] ^ mix(keys[small[right]] + np.uint64(1)))
    of = own[np.concatenate([owner[single], owner[small[left]]])]
    order = np.argsort(of, kind="stable")
    return np.concatenate([keys[single], pair_keys])[order], np.bincount(of, minlength=len(n))


def fingerprints(docs: DataFrame, id_col: str, text_col: str, k: int, percent: int) -> DataFrame:
    """Rows node (a number of the row), doc_id, digest (of the text), n (n-grams), h1 and h2 (of the set), keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch["text"].to_pylist()
            for a, b in blocks(np.array([len(t) for t in texts]), BLOCK_BYTES):
                grams, n = gram_sets(texts[a:b], k)
                keys, n_keys = block_keys(grams, n, percent)
                part = batch.slice(a, b - a)
                columns = [part["node"], part["doc_id"], part["digest"], pa.array(n)]
                columns += [pa.array(summed(mix(grams ^ np.uint64(salt)), n).view(np.int64)) for salt in (1, 2)]
                listed = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n_keys)]), pa.int32()), pa.array(keys.view(np.int64)))
                yield pa.record_batch([*columns, listed], names=["node", "doc_id", "digest", "n", "h1", "h2", "keys"])

    rows = texts_of(docs, id_col, text_col).withColumn("node", F.monotonically_increasing_id())
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"node long, doc_id {kind}, digest long, n long, h1 long, h2 long, keys array<long>")


def texts_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).withColumn("digest", F.xxhash64("text"))


def sets_of(docs: DataFrame, nodes: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """Rows node, n, grams (40 bits each, sorted) of these nodes (with doc_id and digest)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch["text"].to_pylist()
            for a, b in blocks(np.array([len(t) for t in texts]), BLOCK_BYTES):
                grams, n = gram_sets(texts[a:b], k)
                raw = (grams >> (np.uint64(64) - GRAM_BITS)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()
                end = np.concatenate([[0], 5 * np.cumsum(n)])
                packed = pa.array([raw[i:j] for i, j in zip(end, end[1:], strict=False)], pa.binary())
                yield pa.record_batch([batch["node"].slice(a, b - a), pa.array(n), packed], names=["node", "n", "grams"])

    rows = texts_of(docs, id_col, text_col).withColumnRenamed("digest", "d")
    wanted = nodes.select("node", F.col("doc_id").alias("id"), "digest")
    # the same plan at every size: texts, keys and sets are shuffled, never the other side broadcast
    met = rows.hint("merge").join(wanted, (F.col("d") == F.col("digest")) & F.col("doc_id").eqNullSafe(F.col("id")))
    # rows that repeat id and text are one node
    met = met.select("node", "text").groupBy("node").agg(F.first("text").alias("text"))
    return met.mapInArrow(run, "node long, n long, grams binary")


def unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of the rows, and where each row begins (with the end)."""
    rows = column.to_pylist()
    out = np.zeros((sum(map(len, rows)) // 5, 8), dtype=np.uint8)
    out[:, :5] = np.frombuffer(b"".join(rows), np.uint8).reshape(-1, 5)
    return out.reshape(-1).view("<u8"), np.concatenate([[0], np.cumsum([len(r) // 5 for r in rows])]).astype(np.int64)


def asked(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """The least overlap of linked sets of sizes a and b: 100 o >= P (a + b - o)."""
    return -(-percent * (a + b) // (100 + percent))


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (node, pivot) whose sets are linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = batch["n"].to_numpy(), batch["m"].to_numpy()
            for a, b in blocks(n + m, PAIR_GRAMS):
                part = batch.slice(a, b - a)
                sides = []
                for name in ("grams", "theirs"):
                    grams, at = unpacked(part[name])
                    sides.append((np.repeat(np.arange(b - a, dtype=np.uint64), np.diff(at)) << GRAM_BITS) | grams)
                # both sides are sorted by pair and n-gram
                one, two = sides
                place = np.searchsorted(two, one)
                hit = place < len(two)
                hit[hit] = two[place[hit]] == one[hit]
                overlap = np.bincount((one[hit] >> GRAM_BITS).astype(np.int64), minlength=b - a)
                yield part.select(["node", "pivot"]).filter(pa.array(overlap >= asked(n[a:b], m[a:b], percent)))

    theirs = sets.select(F.col("node").alias("pivot"), F.col("n").alias("m"), F.col("grams").alias("theirs"))
    joined = pairs.hint("merge").join(sets, "node").hint("merge").join(theirs, "pivot")
    sizes_fit = 100 * F.least("n", "m") >= percent * F.greatest("n", "m")
    return joined.where(sizes_fit).select("node", "pivot", "n", "m", "grams", "theirs").mapInArrow(run, "node long, pivot long")


def product_links(sets: list[np.ndarray], rows: np.ndarray, columns: np.ndarray, apart: np.ndarray, percent: int) -> np.ndarray:
    """The linked pairs (row, column) of two groups of sets, of those marked in ``apart``, by blocks of n-grams."""
    n, m = (np.array([len(sets[i]) for i in side], dtype=np.int64) for side in (rows, columns))
    need = asked(n[:, None], m[None, :], percent)
    alive = apart & (100 * np.minimum(n[:, None], m[None, :]) >= percent * np.maximum(n[:, None], m[None, :]))
    overlap = np.zeros(alive.shape, dtype=np.int32)
    edges = (np.arange(COLUMN_BLOCKS + 1, dtype=np.uint64) << GRAM_BITS) // np.uint64(COLUMN_BLOCKS)
    cuts = [[np.searchsorted(sets[i], edges) for i in side] for side in (rows, columns)]
    for c in range(COLUMN_BLOCKS):
        up, across_ = alive.any(axis=1), alive.any(axis=0)
        if not up.any():
            break
        sides = []
        for side, live, cut in ((rows, up, cuts[0]), (columns, across_, cuts[1])):
            live = np.flatnonzero(live)
            parts = [sets[side[i]][cut[i][c] : cut[i][c + 1]] for i in live]
            sides.append((live, np.concatenate(parts), np.repeat(np.arange(len(live)), [len(p) for p in parts])))
        (x, gx, rx), (y, gy, ry) = sides
        shared = np.intersect1d(gx, gy)
        added = np.zeros((len(x), len(y)), dtype=np.float32)
        for s in range(0, len(shared), COLUMNS):
            some = shared[s : s + COLUMNS]
            incidence = []
            for g, r, many in ((gx, rx, len(x)), (gy, ry, len(y))):
                at = np.minimum(np.searchsorted(some, g), len(some) - 1)
                hit = some[at] == g
                dense = np.zeros((many, len(some)), dtype=np.float32)
                dense[r[hit], at[hit]] = 1
                incidence.append(dense)
            added += incidence[0] @ incidence[1].T
        overlap[np.ix_(x, y)] += added.astype(np.int32)
        left = [np.array([len(sets[i]) - cut[j][c + 1] for j, i in enumerate(side)]) for side, cut in ((rows, cuts[0]), (columns, cuts[1]))]
        alive &= overlap + np.minimum(left[0][:, None], left[1][None, :]) >= need
    i, j = np.nonzero(alive & (overlap >= need))
    return np.stack([rows[i], columns[j]], axis=1)


def unresolved(banded: DataFrame, roots: DataFrame, sets: DataFrame, folder: Folder, percent: int) -> DataFrame:
    """Links (node, pivot) between nodes of one key that are in different components; a forest of each task."""
    rows = dealt(banded, roots, folder).hint("merge").join(sets, "node")

    def run(table: pa.Table) -> pa.Table:
        key, low, high, block, node, root = (table[c].to_numpy() for c in ("key", "low", "high", "block", "node", "root"))
        grams, at = unpacked(table["grams"].combine_chunks())
        held = [grams[i:j] for i, j in zip(at, at[1:], strict=False)]
        joined: dict[int, int] = {}

        def top(r: int) -> int:
            while r in joined:
                r = joined[r]
            return r

        order = np.lexsort((node, high, low, key))
        new = np.ones(len(order) + 1, dtype=bool)
        new[1:-1] = (np.diff(key[order]) != 0) | (np.diff(low[order]) != 0) | (np.diff(high[order]) != 0)
        starts = np.flatnonzero(new)
        links = []
        for s, e in zip(starts, starts[1:], strict=False):
            mine = order[s:e]
            one, two = (mine[block[mine] == b[mine[0]]] for b in (low, high))
            # roots as far as this task has joined them
            r1, r2 = (np.array([top(int(root[i])) for i in side], dtype=np.int64) for side in (one, two))
            apart = r1[:, None] != r2[None, :]
            if low[mine[0]] == high[mine[0]]:
                apart = np.triu(apart, 1)
            for i, j in product_links(held, one, two, apart, percent).tolist():
                a, b = top(int(root[i])), top(int(root[j]))
                if a != b:
                    joined[max(a, b)] = min(a, b)
                    links.append((max(node[i], node[j]), min(node[i], node[j])))
        found = np.array(links, dtype=np.int64).reshape(-1, 2)
        return pa.table({"node": found[:, 0], "pivot": found[:, 1]})

    return rows.groupBy("part", "low", "high").applyInArrow(run, "node long, pivot long").distinct()


def similar_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3, percent: int = 90) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, component_size.

    Documents are linked when the Jaccard similarity of their sets of distinct
    ``k``-word n-grams (A-Z lower-cased) is at least ``percent`` / 100.  Every
    pair that reaches it meets in a block (see the module), so no component is
    missed.  The pairs themselves aren't returned: those that other links join
    already are never multiplied.

    N-grams are told by 64 bits of hash in counts, keys and digests, by 40 of
    them in overlaps.

    Defined results: texts without words (null, empty, blank) have no n-grams
    and are alone, each row by itself; a text of fewer than ``k`` words has one
    n-gram; equal sets are linked; repeated rows are linked rows; the
    component's id is its smallest, nulls last; an empty table gives an empty
    result; other columns are not read.
    """
    if not 0 < percent < 100:
        raise ValueError("percent must be between 1 and 99")
    spark = docs.sparkSession
    folder = Folder(spark)
    prints = folder.cut(fingerprints(docs, id_col, text_col, k, percent))

    # equal sets are one node
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "node")).alias("first")
    copies = prints.where("n > 0").groupBy("h1", "h2").agg(first, F.count("*").alias("copies")).where("copies > 1")
    copies = folder.cut(copies.select("h1", "h2", F.col("first.node").alias("first_node"), "copies"))
    members = _with_frequent(prints.select("node", "doc_id", "h1", "h2", "n"), copies, ["h1", "h2"], "copies")
    rep = F.when(F.col("n") > 0, F.coalesce("first_node", "node")).otherwise(F.col("node"))
    members = folder.cut(members.select("node", "doc_id", "n", rep.alias("rep")))
    reps = members.where("node = rep AND n > 0").select("node")

    # keys that several nodes have
    banded = prints.join(reps.hint("merge"), "node", "left_semi").select("node", F.explode("keys").alias("key"))
    shared = banded.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high"), F.count("*").alias("in_band"))
    shared = folder.cut(shared.where("low <> high").select("key", "in_band"))
    banded = folder.cut(_of_keys(banded, shared.hint("merge"), "key", "in_band"))
    meeting = banded.select("node").distinct()
    wanted = folder.cut(prints.select("node", "doc_id", "digest").join(meeting, "node", "left_semi"))
    sets = folder.cut(sets_of(docs, wanted, id_col, text_col, k))

    # each node against one row of each of its blocks: first the row it meets most often; near copies tend to have the same pivot
    pivots = banded.groupBy("key").agg(F.min(F.struct(F.xxhash64("node").alias("h"), "node")).alias("p"), F.count("*").alias("in_band"))
    pivots = folder.cut(pivots.select("key", F.col("p.node").alias("pivot"), "in_band"))
    pairs = _with_frequent(banded, pivots, ["key"], "in_band").where("node <> pivot")
    pairs = folder.cut(pairs.groupBy("node", "pivot").agg(F.count("*").alias("times")))
    best = pairs.groupBy("node").agg(F.min(F.struct((-F.col("times")).alias("t"), "pivot")).alias("b"))
    best = folder.cut(best.select("node", F.col("b.pivot").alias("pivot")))
    links = folder.cut(verified(best, sets, percent))
    roots = connected(links, folder)
    rest = folder.cut(across(pairs.join(best, ["node", "pivot"], "left_anti"), roots))
    links = links.unionAll(folder.cut(verified(rest, sets, percent)))
    roots = connected(links, folder)
    # two nodes of a block have its pivot
    links = links.unionAll(folder.cut(unresolved(pairs.select(F.col("pivot").alias("key"), "node"), roots, sets, folder, percent)))
    roots = connected(links, folder).withColumnRenamed("node", "rep")

    by_rep = members.groupBy("rep").agg(F.count("*").alias("rep_size")).join(roots, "rep")
    rows = _with_frequent(members, by_rep, ["rep"], "rep_size").withColumn("root", F.coalesce("root", "rep"))
    rows = folder.cut(rows.select("node", "doc_id", "n", "root"))
    classes = rows.groupBy("root").agg(first, F.count("*").alias("component_size"))
    classes = folder.cut(classes.select("root", F.col("first.doc_id").alias("component_id"), "component_size"))
    out = _with_frequent(rows, classes, ["root"], "component_size")
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id", "component_size")
