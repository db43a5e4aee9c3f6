"""Token counts that follow edits.

A document keeps a segment tree over runs of pre-tokens: each leaf has the
characters and the tokens of its run, each inner node the sums of its two
children.  A run begins at a blank or line feed after a visible character;
byte-level BPE cuts there in any context and never merges across such a cut,
so the tokens of a text are the sum over its runs.  An edit re-encodes the
runs it touches, and those that hold the character on either side of it, and
updates the sums on the paths to the root.  All edits of a document are
applied in one sweep over its text, so work is linear in the text and the
edits.

Counts are those of ordinary text: strings that spell a special token are
text.  All work is inside the document's row: no shuffle, but for
``apply_edits``, which brings each document its edits.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesift.llm.tokens import default_tokenizer, encoder

# a leaf is about this many characters when built, and is split when it has grown fourfold
LEAF_CHARS = 256

# Personal data that the query blanks: e-mail addresses, and runs of digits as long as a telephone or card number.
SCRUB = [
    (r"[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,8}", "[email]"),
    (r"\+?[0-9](?:[ -]?[0-9]){8,18}", "[number]"),
]


def runs(text: str, least: int) -> list[int]:
    """Ends of the runs: the first cut after every ``least`` characters, and the end of the text."""
    ends, at = [], least
    ahead = {" ": -1, "\n": -1}
    while at < len(text):
        if text[at] in ahead and not text[at - 1].isspace():
            ends.append(at)
            at += least
            continue
        for c, place in ahead.items():
            # a place still ahead is not searched again
            if place <= at:
                place = text.find(c, at + 1)
                ahead[c] = place if place >= 0 else len(text)
        at = min(ahead.values())
    return [*ends, len(text)]


class CountTree:
    """Segment tree of one document; ``sums[i]`` is (characters, tokens) under node i, whose children are 2 i and 2 i + 1."""

    def __init__(self, text: str, enc, sums: np.ndarray | None = None):
        self.text, self.enc, self.encoded = text, enc, 0
        if sums is None:
            self.build()
        else:
            self.sums, self.width = sums, len(sums) // 2

    def tokens(self, text: str) -> int:
        self.encoded += len(text)
        return len(self.enc.fast.encode_ordinary(text)) if self.enc.fast else len(self.enc.ids(text))

    def leaves_of(self, text: str, ends: list[int]) -> list[tuple[int, int]]:
        return [(e - s, self.tokens(text[s:e])) for s, e in zip([0, *ends], ends, strict=False)]

    def build(self) -> None:
        self._grow(np.array(self.leaves_of(self.text, runs(self.text, LEAF_CHARS)), dtype=np.int64))

    def _grow(self, leaves: np.ndarray) -> None:
        """A tree of its own for the leaves."""
        self.width = 1 << max(0, len(leaves) - 1).bit_length()
        self.sums = np.zeros((2 * self.width, 2), dtype=np.int64)
        self.sums[self.width : self.width + len(leaves)] = leaves
        level = self.width
        while level > 1:
            self.sums[level // 2 : level] = self.sums[level : 2 * level : 2] + self.sums[level + 1 : 2 * level : 2]
            level //= 2

    def total(self) -> int:
        return int(self.sums[1, 1])

    def leaf_at(self, char: int) -> tuple[int, int]:
        """Leaf that holds a character, and where the leaf begins."""
        node, start = 1, 0
        while node < self.width:
            node *= 2
            left = int(self.sums[node, 0])
            if char >= start + left:
                start, node = start + left, node + 1
        return node, start

    def edit(self, start: int, stop: int, new: str) -> None:
        """Replace characters ``start`` to ``stop``."""
        self.edit_all([(start, stop, new)])

    def edit_all(self, edits: list[tuple[int, int, str]]) -> None:
        """Apply edits (start, stop, new), given in places of the text as it is, in one sweep.

        Edits whose leaves overlap are one region, which is encoded once.  The
        character on either side of an edit stays, so the cuts beyond the
        region do.
        """
        old, edits = len(self.text), sorted(edits, key=lambda e: (e[0], e[1]))
        upto = 0
        for start, stop, _ in edits:
            if not 0 <= start <= stop <= old:
                raise ValueError(f"edit {start}:{stop} of a text of {old} characters")
            if start < upto:
                raise ValueError("edits of a document overlap")
            upto = stop
        out, copied, regions, i = [], 0, [], 0
        while i < len(edits):
            first, begin = self.leaf_at(max(0, edits[i][0] - 1)) if old else (self.width, 0)
            pieces, at = [], begin
            while True:
                start, stop, new = edits[i]
                pieces += [self.text[at:start], new]
                at, i = stop, i + 1
                last, end = self.leaf_at(min(stop, old - 1)) if old else (self.width, 0)
                end += int(self.sums[last, 0])
                if i == len(edits) or (old and edits[i][0] - 1 >= end):
                    break
            region = "".join([*pieces, self.text[at:end]])
            out += [self.text[copied:begin], region]
            copied = end
            regions.append((first, last, region))
        self.text = "".join([*out, self.text[copied:]])
        self._set_regions(regions)

    def _set_regions(self, regions: list[tuple[int, int, str]]) -> None:
        """New leaves in the places of old ones; a region that has outgrown its places gives the tree new ones."""
        changed, wider = [], []
        for first, last, region in regions:
            ends = runs(region, LEAF_CHARS) if len(region) > 4 * LEAF_CHARS else [len(region)]
            leaves = self.leaves_of(region, ends)
            if len(leaves) > last - first + 1:
                wider.append((first, last, leaves))
                continue
            self.sums[first : last + 1] = 0
            self.sums[first : first + len(leaves)] = leaves
            changed.append(np.arange(first, last + 1))
        if wider:
            parts, upto = [], self.width
            for first, last, leaves in wider:
                parts += [self.sums[upto:first], np.array(leaves, dtype=np.int64)]
                upto = last + 1
            leaves = np.concatenate([*parts, self.sums[upto:]])
            self._grow(leaves[leaves.any(axis=1)])
        elif changed:
            nodes = np.unique(np.concatenate(changed) // 2)
            while nodes[-1] > 0:
                self.sums[nodes] = self.sums[2 * nodes] + self.sums[2 * nodes + 1]
                nodes = np.unique(nodes // 2)


def scrub_edits(text: str, rules: list[tuple[str, str]]) -> list[tuple[int, int, str]]:
    """Matches of the patterns from left to right; of overlapping ones the first, and of those the earlier rule's."""
    found = sorted((m.start(), r, m.end(), new) for r, (pattern, new) in enumerate(rules) for m in re.finditer(pattern, text))
    out, upto = [], 0
    for start, _, end, new in found:
        if start >= upto and end > start:
            out.append((start, end, new))
            upto = end
    return out


def build_trees(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None) -> DataFrame:
    """doc_id, text, n_tokens and ``tree`` (the sums as little-endian 64-bit numbers), one row per input row."""
    path = tokenizer or default_tokenizer()
    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("text", T.StringType()), T.StructField("n_tokens", T.LongType()), T.StructField("tree", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            trees = [CountTree(t.as_py(), enc) for t in batch.column(1)]
            counts = pa.array([t.total() for t in trees], pa.int64())
            sums = pa.array([t.sums.astype("<i8").tobytes() for t in trees], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, counts, sums], names=schema.names)

    return _texts(docs, id_col, text_col).mapInArrow(run, schema)


def apply_edits(trees: DataFrame, edits: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """``trees`` after ``edits`` (doc_id, start, stop, text): same columns, and ``n_encoded`` characters.

    Places are characters of the text before all edits; edits of a document
    must not overlap, and of insertions at one place the order is undefined.
    A null replacement is empty; edits of unknown or null ids do nothing; rows
    that repeat an id are all edited.
    """
    path = tokenizer or default_tokenizer()
    lists = edits.select("doc_id", F.struct("start", "stop", "text").alias("edit")).groupBy("doc_id").agg(F.collect_list("edit").alias("edits"))
    rows = trees.join(lists, "doc_id", "left").select("doc_id", "text", "tree", "edits")
    schema = T.StructType([*trees.select("doc_id", "text", "n_tokens", "tree").schema, T.StructField("n_encoded", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            out = []
            for text, sums, todo in zip(*[batch.column(i).to_pylist() for i in (1, 2, 3)], strict=True):
                tree = CountTree(text, enc, np.frombuffer(sums, "<i8").reshape(-1, 2).copy())
                tree.edit_all([(e["start"], e["stop"], e["text"] or "") for e in todo or []])
                out.append(tree)
            columns = [batch.column(0), pa.array([t.text for t in out], pa.string()), pa.array([t.total() for t in out], pa.int64())]
            columns += [pa.array([t.sums.astype("<i8").tobytes() for t in out], pa.binary()), pa.array([t.encoded for t in out], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(run, schema)


def scrubbed_counts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rules: list[tuple[str, str]] | None = None,
    tokenizer: str | None = None,
) -> DataFrame:
    """Counts before and after the edits that ``rules`` (pattern, replacement) make, one row per input row.

    doc_id, n_tokens, n_edits, n_encoded (characters encoded again),
    n_tokens_after, text_after.

    Defined results: a null text counts as empty (no tokens); null and
    repeated ids keep their rows; a text without blanks is one leaf; an empty
    table gives an empty result; other columns are not read.
    """
    path, rules = tokenizer or default_tokenizer(), SCRUB if rules is None else rules
    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType)])
    for name in ("n_tokens", "n_edits", "n_encoded", "n_tokens_after"):
        schema = schema.add(name, T.LongType())
    schema = schema.add("text_after", T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            counts, after = [], []
            for text in batch.column(1):
                tree = CountTree(text.as_py(), enc)
                before, tree.encoded = tree.total(), 0
                edits = scrub_edits(tree.text, rules)
                tree.edit_all(edits)
                counts.append((before, len(edits), tree.encoded, tree.total()))
                after.append(tree.text)
            columns = [pa.array([c[i] for c in counts], pa.int64()) for i in range(4)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns, pa.array(after, pa.string())], names=schema.names)

    return _texts(docs, id_col, text_col).mapInArrow(run, schema)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
