"""Near-duplicate classes by Order MinHash.

A hash function samples the two labelled shingles with the smallest values and
keeps them in the order of the text; several samples make a band.  Documents
that share a band are candidates, and a banded alignment of their shingles
decides.
"""

from __future__ import annotations

import hashlib
import uuid
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesift.llm.anchors import blocks, mix, rolling, word_units
from tablesift.session import checkpoint_dir

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
# bins of a signature, and how many deviations below the threshold it may be
BINS = 512
MARGIN = 3.5
# nodes of a band that are compared in one task at most, times two
BLOCK = 2048
POS_BITS = np.uint64(20)
POS_MASK = np.uint64((1 << 20) - 1)


def labelled_shingles(texts: list[str], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each occurrence-labelled ``k``-word shingle of the texts, in order; words, first shingle and shingles of each text.

    A text of fewer than ``k`` words, but any, has one shingle of all its words.
    """
    raw = [t.encode().translate(LOWER) for t in texts]
    begin, _, words = word_units(np.frombuffer(b" ".join(raw), dtype=np.uint8))
    size = np.array([len(r) + 1 for r in raw], dtype=np.int64)
    until = np.cumsum(size)
    first_word = np.searchsorted(begin, until - size)
    n_words = np.searchsorted(begin, until) - first_word
    n = np.where(n_words >= k, n_words - k + 1, np.minimum(n_words, 1))
    starts = np.cumsum(n) - n
    row = np.repeat(np.arange(len(texts)), n)
    at = np.arange(int(n.sum())) - np.repeat(starts - first_word, n)
    grams = rolling(words, k)
    shingles = np.empty(len(at), dtype=np.uint64)
    long = n_words[row] >= k
    shingles[long] = grams[at[long]] if len(grams) else 0
    for i in np.flatnonzero((n_words > 0) & (n_words < k)):
        h = np.uint64(n_words[i])
        for w in words[first_word[i] : first_word[i] + n_words[i]]:
            h = mix(np.array([h ^ w]))[0]
        shingles[starts[i]] = h
    # the occurrence number of a shingle in its text
    order = np.lexsort((np.arange(len(row)), shingles, row))
    s, r = shingles[order], row[order]
    new = np.concatenate([[True], (s[1:] != s[:-1]) | (r[1:] != r[:-1])]) if len(s) else np.empty(0, bool)
    group = np.flatnonzero(new)
    nth = np.arange(len(s)) - np.repeat(group, np.diff(np.concatenate([group, [len(s)]])))
    label = np.empty(len(s), dtype=np.uint64)
    label[order] = nth.astype(np.uint64)
    shingles = np.where(label > 0, mix(shingles + label * np.uint64(0x9E3779B97F4A7C15)), shingles)
    return shingles, n_words, starts, n


def _smallest(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Place of the smallest value of each text, by the bits above ``POS_MASK``; of equal ones the first."""
    high = h & ~POS_MASK
    if len(h) <= 1 << int(POS_BITS):
        return (np.minimum.reduceat(high | np.arange(len(h), dtype=np.uint64), first) & POS_MASK).astype(np.int64)
    # places that don't fit into the bits
    return np.array([a + high[a:b].argmin() for a, b in zip(first, [*first[1:], len(h)], strict=True)], dtype=np.int64)


def sketches(shingles: np.ndarray, starts: np.ndarray, n: np.ndarray, bands: int, per_band: int) -> np.ndarray:
    """Band keys of each text with a shingle (texts by bands).

    Each of ``bands * per_band`` hash functions samples the two labelled
    shingles with the smallest values; its sketch is the two in the order of
    the text.
    """
    some = np.flatnonzero(n > 0)
    out = np.zeros((len(n), bands), dtype=np.uint64)
    if not len(some):
        return out
    first = starts[some]
    lone = n[some] == 1
    for b in range(bands):
        key = np.full(len(some), b + 1, dtype=np.uint64)
        for f in range(per_band):
            salt = mix(np.array([b * per_band + f + 1], dtype=np.uint64))[0]
            # a multiply and a shift rank well-mixed hashes anew
            h = shingles * (salt | np.uint64(1))
            h ^= h >> np.uint64(29)
            h *= np.uint64(0xBF58476D1CE4E5B9)
            at = _smallest(h, first)
            h[at] = np.uint64(0xFFFFFFFFFFFFFFFF)
            at2 = np.where(lone, at, _smallest(h, first))
            early, late = shingles[np.minimum(at, at2)], shingles[np.maximum(at, at2)]
            key = mix(key + early * np.uint64(0x9E3779B97F4A7C15) + mix(late))
        out[some, b] = key
    return out


def signatures(shingles: np.ndarray, starts: np.ndarray, n: np.ndarray) -> np.ndarray:
    """``BINS`` bytes for each text: of the shingles of a bin the smallest, by its hash (1 to 255); 0 for an empty bin."""
    out = np.zeros((len(n), BINS), dtype=np.uint8)
    h = mix(shingles ^ np.uint64(0x5851F42D4C957F2D))
    place = np.repeat(np.arange(len(n)), n) * BINS + (h % np.uint64(BINS)).astype(np.int64)
    order = np.lexsort((h, place))
    p = place[order]
    first = order[np.concatenate([[True], p[1:] != p[:-1]])] if len(p) else order
    out.reshape(-1)[place[first]] = 1 + (h[first] >> np.uint64(32)) % np.uint64(255)
    return out


def plausible(mine: np.ndarray, theirs: np.ndarray, n: np.ndarray, m: np.ndarray, similarity: float) -> np.ndarray:
    """Whether signatures (rows of ``theirs`` against one or as many of ``mine``) allow the similarity, with ``MARGIN`` deviations to spare."""
    used = np.maximum(((mine | theirs) > 0).sum(axis=1), 1)
    same = ((mine == theirs) & (mine > 0)).sum(axis=1)
    # the share of equal bins of a sample of the union without replacement
    union = (n + m) / (1 + similarity)
    deviation = np.sqrt(similarity * (1 - similarity) / used * np.maximum(1 - used / union, 0) + 0.05 / used**1.5)
    return (same / used >= similarity - MARGIN * deviation) & (np.minimum(n, m) >= np.maximum(n, m) * (similarity - 1e-9))


def banded_lcs(x: list[int], y: list[int], band: int) -> int:
    """Longest common subsequence over alignments that stay within ``band`` of the diagonal.

    One bit for each place of the band; a step along ``y`` is one addition.
    """
    places: dict[int, list[int]] = {}
    for i, s in enumerate(x):
        places.setdefault(s, []).append(i)
    width = 2 * band + 1
    window = (1 << width) - 1
    v, matched = window, 0
    for j, s in enumerate(y):
        low = j - band
        if j:
            matched += 1 - (v & 1)
            v = (v >> 1) | (1 << (width - 1))
        at = places.get(s, ())
        u = 0
        for p in at[bisect_left(at, low) :]:
            if p > j + band:
                break
            u |= 1 << (p - low)
        u &= v
        if u:
            v = ((v + u) | (v - u)) & window
    return matched + width - v.bit_count()


def increasing(places: np.ndarray) -> int:
    """Length of the longest increasing subsequence."""
    tails: list[int] = []
    for p in places.tolist():
        at = bisect_left(tails, p)
        tails[at : at + 1] = [p]
    return len(tails)


def is_near(one: np.ndarray, two: np.ndarray, similarity: float) -> bool:
    """Whether the best alignment of two sequences of labelled shingles matches ``similarity`` of their union.

    M matched of n and m are M / (n + m - M).  Shared shingles bound M from
    above and those of them in the same order from below; the banded alignment
    decides in between.  An alignment that suffices can't leave the band.
    """
    n, m = len(one), len(two)
    need = int(np.ceil(similarity / (1 + similarity) * (n + m) - 1e-9))
    if min(n, m) < need:
        return False
    _, at, places = np.intersect1d(one, two, assume_unique=True, return_indices=True)
    if len(at) < need:
        return False
    places = places[np.argsort(at)]
    if np.all(np.diff(places) > 0) or increasing(places) >= need:
        return True
    return banded_lcs(one.tolist(), two.tolist(), n + m - 2 * need) >= need


def fingerprints(docs: DataFrame, id_col: str, text_col: str, k: int, bands: int, per_band: int) -> DataFrame:
    """doc_id, digest of the words (h1, h2), shingles (n), band keys, and the labelled shingles themselves."""
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema[id_col].dataType),
            T.StructField("h1", T.LongType()),
            T.StructField("h2", T.LongType()),
            T.StructField("n", T.LongType()),
            T.StructField("bands", T.ArrayType(T.LongType())),
            T.StructField("signature", T.BinaryType()),
            T.StructField("shingles", T.BinaryType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            lengths = pc.binary_length(whole.column(1)).to_numpy(zero_copy_only=False)
            for s, e in blocks(lengths, 1 << 20):
                part = whole.slice(s, e - s)
                shingles, _, starts, n = labelled_shingles(part.column(1).to_pylist(), k)
                keys = sketches(shingles, starts, n, bands, per_band)
                digests = np.empty((len(n), 2), dtype=np.int64)
                raw = []
                for i, (a, c) in enumerate(zip(starts, n, strict=True)):
                    own = shingles[a : a + c].astype("<u8")
                    digests[i] = np.frombuffer(hashlib.blake2b(own.tobytes(), digest_size=16).digest(), dtype="<i8")
                    # half a hash is enough to compare two texts
                    raw.append((own >> np.uint64(32)).astype("<u4").tobytes())
                offsets = pa.array(np.concatenate([[0], np.cumsum(np.where(n > 0, bands, 0))]), pa.int32())
                values = pa.array(keys[n > 0].reshape(-1).view(np.int64))
                columns = [part.column(0), pa.array(digests[:, 0]), pa.array(digests[:, 1]), pa.array(n, pa.int64())]
                columns += [pa.ListArray.from_arrays(offsets, values), pa.array([g.tobytes() for g in signatures(shingles, starts, n)], pa.binary())]
                columns.append(pa.array(raw, pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(run, schema).withColumn("node", F.monotonically_increasing_id())


def candidates(banded: DataFrame, salts: int) -> DataFrame:
    """Pairs (node, pivot, n_bands): in each band, nodes to a pivot of their salt, and these pivots to the smallest.

    A band that a third of all rows share is so spread over ``salts`` tasks,
    and the pairs grow with its nodes, not with their square.
    """
    salted = banded.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(salts)))
    stars = salted.withColumn("pivot", F.min("node").over(Window.partitionBy("key", "salt")))
    heads = stars.where("node = pivot").withColumn("pivot", F.min("node").over(Window.partitionBy("key")))
    pairs = stars.select("node", "pivot").unionAll(heads.select("node", "pivot")).where("node <> pivot")
    return pairs.groupBy("node", "pivot").agg(F.count("*").alias("n_bands"))


def verified(pairs: DataFrame, prints: DataFrame, similarity: float) -> DataFrame:
    """Pairs (node, pivot) whose alignment is similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = [
                is_near(np.frombuffer(a, "<u4"), np.frombuffer(b, "<u4"), similarity)
                for a, b in zip(batch["mine"].to_pylist(), batch["theirs"].to_pylist(), strict=True)
            ]
            yield batch.select(["node", "pivot"]).filter(pa.array(near, pa.bool_()))

    mine = prints.select("node", F.col("shingles").alias("mine"))
    theirs = prints.select(F.col("node").alias("pivot"), F.col("shingles").alias("theirs"))
    # the same plan at every size: texts are shuffled, whatever the pairs' size
    return pairs.hint("merge").join(mine, "node").hint("merge").join(theirs, "pivot").mapInArrow(run, "node long, pivot long")


class Folder:
    """Writes intermediate tables to a folder of their own in the shared checkpoint folder.

    A table read back has a known size, so Spark broadcasts the small ones
    and shuffles the others.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.path, self.n = spark, f"{checkpoint_dir(spark)}/order_minhash-{uuid.uuid4().hex}", 0

    def cut(self, rows: DataFrame) -> DataFrame:
        self.n += 1
        path = f"{self.path}/{self.n}"
        rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)


def connected(links: DataFrame, folder: Folder) -> DataFrame:
    """(node, root): the smallest node of each linked one's component; hooks roots until no link joins two of them."""
    both = links.unionAll(links.select(F.col("pivot").alias("node"), F.col("node").alias("pivot")))
    roots = both.groupBy("node").agg(F.min("pivot").alias("root")).select("node", F.least("node", "root").alias("root"))
    roots = folder.cut(roots)
    while True:
        ends = links.join(roots, "node").withColumnRenamed("root", "mine")
        ends = ends.join(roots.select(F.col("node").alias("pivot"), "root"), "pivot").where("mine <> root")
        hooks = folder.cut(ends.groupBy(F.greatest("mine", "root").alias("root")).agg(F.min(F.least("mine", "root")).alias("lower")))
        if hooks.isEmpty():
            return roots
        roots = folder.cut(roots.join(hooks, "root", "left").select("node", F.coalesce("lower", "root").alias("root")))


def across(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs whose ends are in different components so far."""
    out = pairs.join(roots, "node", "left").withColumn("mine", F.coalesce("root", "node")).drop("root")
    out = out.join(roots.withColumnRenamed("node", "pivot"), "pivot", "left").withColumn("theirs", F.coalesce("root", "pivot"))
    return out.where("mine <> theirs").select("node", "pivot")


def possible(pairs: DataFrame, prints: DataFrame, similarity: float) -> DataFrame:
    """Pairs whose signatures allow the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mine, theirs = (_matrix(batch[c]) for c in ("signature", "theirs"))
            ok = plausible(mine, theirs, batch["n"].to_numpy(), batch["m"].to_numpy(), similarity)
            yield batch.select(["node", "pivot"]).filter(pa.array(ok))

    mine = prints.select("node", "n", "signature")
    theirs = prints.select(F.col("node").alias("pivot"), F.col("n").alias("m"), F.col("signature").alias("theirs"))
    joined = pairs.hint("merge").join(mine, "node").hint("merge").join(theirs, "pivot")
    return joined.mapInArrow(run, "node long, pivot long")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, BINS)


def dealt(banded: DataFrame, roots: DataFrame, folder: Folder) -> DataFrame:
    """Rows key, node, root, block, low, high, and part: nodes of one band and of different roots, for the tasks that compare them.

    A band is dealt over blocks of about ``BLOCK`` nodes, and two blocks meet
    in one task.  A root with more than ``BLOCK`` nodes in a band has blocks
    of its own there, which do not meet each other, as links join their nodes
    already.  Two blocks of a band of several are a task (``part`` is the
    band); bands of one block share tasks of about as many rows.
    """
    rows = banded.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    large = folder.cut(roots.groupBy("root").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK).select("root"))
    big = rows.join(large, "root", "left_semi").groupBy("key", "root").agg(F.count("*").alias("n_root"))
    big = big.where(F.col("n_root") > BLOCK).withColumn("own", F.ceil(F.col("n_root") / BLOCK).cast("int"))
    before = F.sum("own").over(Window.partitionBy("key").orderBy("root").rowsBetween(Window.unboundedPreceding, -1))
    big = folder.cut(big.withColumn("before", F.coalesce(before, F.lit(0)).cast("int")))
    of_band = big.groupBy("key").agg(F.sum("n_root").alias("in_big"), F.sum("own").cast("int").alias("big_blocks"))
    many = rows.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("in_band"))
    many = many.where("low <> high").select("key", "in_band").join(of_band, "key", "left").na.fill(0, ["in_big", "big_blocks"])
    many = many.withColumn("shared", F.ceil((F.col("in_band") - F.col("in_big")) / BLOCK).cast("int"))
    many = folder.cut(many.withColumn("blocks", (F.col("shared") + F.col("big_blocks")).cast("int")).select("key", "in_band", "shared", "blocks"))
    rows = _with_frequent(rows, many, ["key"], "in_band").where("in_band IS NOT NULL").select("key", "node", "root", "shared", "blocks")
    rows = _with_frequent(folder.cut(rows), big, ["key", "root"], "n_root")
    # the blocks of the own root, which a node doesn't meet
    rows = rows.withColumn("first", F.col("shared") + F.col("before")).withColumn("place", F.xxhash64("node"))
    rows = rows.withColumn("own", F.coalesce("own", F.lit(0)))
    rows = folder.cut(rows.select("key", "node", "root", "shared", "blocks", "first", "own", "place"))
    at = F.when(F.col("own") > 0, F.col("first") + F.pmod("place", F.greatest("own", F.lit(1))))
    rows = rows.withColumn("block", at.otherwise(F.pmod("place", F.greatest("shared", F.lit(1)))).cast("int"))
    n_small = rows.where("blocks = 1").count()
    tasks = max(1, -(-n_small // (2 * BLOCK)))
    met = F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: (F.col("own") == 0) | (x < F.col("first")) | (x >= F.col("first") + F.col("own")))
    rows = rows.withColumn("other", F.explode(met))
    part = F.when(F.col("blocks") > 1, F.col("key")).otherwise(F.pmod(F.xxhash64("key"), F.lit(tasks)))
    return rows.select("key", "node", "root", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), part.alias("part"))


def unresolved(banded: DataFrame, roots: DataFrame, prints: DataFrame, folder: Folder, similarity: float) -> DataFrame:
    """Links (node, pivot) between nodes of one band that are in different components.

    A task (see ``dealt``) compares signatures, verifies what they allow, and
    skips pairs that links found there already join, so its links are a forest.
    """
    rows = dealt(banded, roots, folder).join(prints, "node")

    def run(table: pa.Table) -> pa.Table:
        key, low, high, block, n, node, root = (table[c].to_numpy() for c in ("key", "low", "high", "block", "n", "node", "root"))
        signs, shingles = _matrix(table["signature"]), table["shingles"].to_pylist()
        joined: dict[int, int] = {}

        def top(r: int) -> int:
            while r in joined:
                r = joined[r]
            return r

        order = np.lexsort((node, n, high, low, key))
        new = np.ones(len(order) + 1, dtype=bool)
        new[1:-1] = (np.diff(key[order]) != 0) | (np.diff(low[order]) != 0) | (np.diff(high[order]) != 0)
        at = np.flatnonzero(new)
        links, tried = [], set()
        for s, e in zip(at, at[1:], strict=False):
            rows_ = order[s:e]
            cross = low[rows_[0]] != high[rows_[0]]
            until = np.searchsorted(n[rows_] * (similarity - 1e-9), n[rows_], side="right")
            for i, r in enumerate(rows_):
                others = rows_[i + 1 : until[i]]
                others = others[(root[others] != root[r]) & (~cross | (block[others] != block[r]))]
                if not len(others):
                    continue
                for o in others[plausible(signs[r][None], signs[others], n[r], n[others], similarity)]:
                    mine, theirs = top(int(root[r])), top(int(root[o]))
                    pair = (int(max(node[r], node[o])), int(min(node[r], node[o])))
                    if mine == theirs or pair in tried:
                        continue
                    tried.add(pair)
                    if is_near(np.frombuffer(shingles[r], "<u4"), np.frombuffer(shingles[o], "<u4"), similarity):
                        joined[max(mine, theirs)] = min(mine, theirs)
                        links.append(pair)
        found = np.array(links, dtype=np.int64).reshape(-1, 2)
        return pa.table({"node": found[:, 0], "pivot": found[:, 1]})

    return rows.groupBy("part", "low", "high").applyInArrow(run, "node long, pivot long").distinct()


def _with_frequent(rows: DataFrame, table: DataFrame, keys: list[str], size: str, share: int = 1000) -> DataFrame:
    """Left join of rows (with a unique ``node``) to one row per key.

    Keys with more than 1/``share`` of all rows are fewer than ``share``, so
    that part is broadcast; no key of the rest is frequent.
    """
    total = rows.count()
    frequent = F.col(size) * share > total
    got = [c for c in table.columns if c not in keys]
    hot = table.where(frequent).select(*[F.col(k).alias(f"hot_{k}") for k in keys], *[F.col(c).alias(f"hot_{c}") for c in got])
    match = F.lit(True)
    for k in keys:
        match = match & (F.col(k) == F.col(f"hot_{k}"))
    out = rows.join(F.broadcast(hot), match, "left")
    # rows that have their answer go to a place of their own
    found = F.col(f"hot_{size}").isNotNull()
    join_on = [F.when(found, -F.col("node") - 1).otherwise(F.col(keys[0])).alias("j0")]
    join_on += [F.when(~found, F.col(k)).alias(f"j{i}") for i, k in enumerate(keys[1:], 1)]
    out = out.select("*", *join_on)
    rest = table.where(~frequent).select(*[F.col(k).alias(f"j{i}") for i, k in enumerate(keys)], *got)
    out = out.join(rest, [f"j{i}" for i in range(len(keys))], "left")
    return out.select(*[rows[c] for c in rows.columns], *[F.coalesce(f"hot_{c}", c).alias(c) for c in got])


def _of_keys(rows: DataFrame, table: DataFrame, key: str, size: str, share: int = 1000) -> DataFrame:
    """The rows whose key is in ``table`` (one row per key, ``size`` rows each).

    Keys with more than 1/``share`` of all rows are fewer than ``share``: they
    are named in a filter, so their rows stay where they are.
    """
    frequent = F.col(size) * share > rows.count()
    hot = F.col(key).isin([r[0] for r in table.where(frequent).select(key).collect()])
    return rows.where(hot).unionAll(rows.where(~hot).join(table.where(~frequent).select(key), key, "left_semi").select(*rows.columns))


def near_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    k: int = 5,
    similarity: float = 0.8,
    bands: int = 16,
    per_band: int = 2,
) -> DataFrame:
    """One row per input row: doc_id, class_id, class_size, kept, n_shingles, and ``node`` (a number of the row).

    Classes are the components of the links between texts whose sequences of
    ``k``-word shingles (A-Z lower-cased) align to ``similarity`` or more.
    ``class_id`` is the smallest id of the class, whose row is kept.  A pair
    at the threshold meets in a band with odds of 1 - (1 - s^(2 per_band))^bands,
    which is 0.9998 as set; every candidate is verified.

    1. One pass writes fingerprints to the shared checkpoint folder; texts of
       equal words become one node.
    2. In each band, nodes are paired with a pivot; a signature of each text rules most false pairs out before shingles move.  Verified pairs are links.
       First one pivot per node, then the others that would join components.
    3. Nodes that meet in a band and are still in different components are
       compared pair by pair in blocks, so no link that would join two is lost.

    Defined results: a null text is empty; texts without words are one class;
    one of fewer than ``k`` words has one shingle; repeated rows are one class, of which one is kept;
    null ids come last; an empty table gives an empty result; other columns
    are not read.
    """
    spark = docs.sparkSession
    folder = Folder(spark)
    prints = folder.cut(fingerprints(docs, id_col, text_col, k, bands, per_band))
    salts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    copies = prints.groupBy("h1", "h2").agg(F.min("node").alias("first"), F.count("*").alias("copies")).where("copies > 1")
    members = _with_frequent(prints.select("node", "doc_id", "h1", "h2", "n"), copies, ["h1", "h2"], "copies")
    members = folder.cut(members.select("node", "doc_id", "n", F.coalesce("first", "node").alias("rep")))

    nodes = prints.join(members.where("node = rep").select("node"), "node", "left_semi")
    banded = nodes.select("node", F.explode("bands").alias("key"))
    # a band of one node pairs with nothing
    shared = banded.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high"), F.count("*").alias("in_band"))
    shared = folder.cut(shared.where("low <> high").select("key", "in_band"))
    banded = folder.cut(_of_keys(banded, shared, "key", "in_band"))
    # from here on, only the shingles of these nodes move
    meeting = banded.select("node").distinct()
    prints = folder.cut(prints.select("node", "n", "signature", "shingles").join(meeting.hint("merge"), "node", "left_semi"))

    pairs = folder.cut(candidates(banded, salts))
    best = pairs.groupBy("node").agg(F.min(F.struct(-F.col("n_bands"), "pivot")).alias("b"))
    best = folder.cut(best.select("node", F.col("b.pivot").alias("pivot")))
    links = folder.cut(verified(possible(best, prints, similarity), prints, similarity))
    roots = connected(links, folder)
    rest = folder.cut(across(pairs.join(best, ["node", "pivot"], "left_anti"), roots))
    links = links.unionAll(folder.cut(verified(possible(rest, prints, similarity), prints, similarity)))
    roots = connected(links, folder)
    links = links.unionAll(folder.cut(unresolved(banded, roots, prints, folder, similarity)))
    roots = connected(links, folder).withColumnRenamed("node", "rep")

    by_rep = members.groupBy("rep").agg(F.count("*").alias("rep_size")).join(roots, "rep")
    rows = _with_frequent(members, by_rep, ["rep"], "rep_size").withColumn("root", F.coalesce("root", "rep"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("null_id"), "doc_id", "node")).alias("first")
    classes = rows.groupBy("root").agg(first, F.count("*").alias("class_size"))
    classes = classes.select("root", F.col("first.doc_id").alias("class_id"), F.col("first.node").alias("first_node"), "class_size")
    out = _with_frequent(rows.select("node", "doc_id", "n", "root"), classes, ["root"], "class_size")
    return out.select("doc_id", "class_id", "class_size", (F.col("node") == F.col("first_node")).alias("kept"), F.col("n").alias("n_shingles"), "node")


def keep_first_of_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that ``near_classes`` keeps, with all their columns; of rows that repeat id and text, one.

    Rows are told by their id and a digest of their text.
    """
    digest = F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")), 256)
    key = F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"), digest.alias("sha"))
    kept = near_classes(docs.select(key.alias("key"), F.col(text_col).alias("text")), "key", "text", **options)
    kept = kept.where("kept").select(F.col("doc_id").alias("key"))
    # a row is one struct beside its key, so no column of it can clash with the key, which is never null
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(row, key.alias("key")).join(kept, "key", "left_semi").dropDuplicates(["key"])
    return rows.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
