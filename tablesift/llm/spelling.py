"""Spelling variants of a vocabulary by a bit-sliced position index.

Two words are near if one insertion, deletion or replacement of a code point
turns one into the other.  A word's form is its most frequent near word, if
that is clearly more frequent than the word.

*Index.*  For each place i and letter x, a bitset over the words of a block:
those that have x at i.  A query word u walks through its letters with three
sets, each a row of 64-bit numbers: the words that agree with u so far, those
with one replaced letter so far, and those with one letter more so far.  One
step is a few AND and OR operations for 64 words at once; the set with a
letter more reads the bitsets of the next place.  An error enters at the first
letter that differs, so each near word is met once.  Words with one letter
less are met from their own side.

*Blocks.*  A word is cut into ``PIECES`` pieces, and the one error of a pair
lies in one of them; the rest of both words is equal and makes a key.  Words
that share a key are in one block of the index.  A word has a key per piece
for its own length and, as the longer word of a pair, for a length less.  A
block holds the words of many keys of one piece.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesift.llm.order_minhash import Folder

PIECES = 4
# rows of a block on average, and query words worked on together
BLOCK_ROWS = 32768
QUERY_ROWS = 256
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lowered(text: Column) -> Column:
    """A-Z lower-cased, other letters as they are."""
    return F.translate(text, UPPER, LOWER)


def counted(words: DataFrame, min_chars: int, min_count: int) -> DataFrame:
    """(word, n) of the words with ``min_chars`` code points and ``min_count`` rows, or more."""
    long = words.where(F.char_length("word") >= min_chars)
    return long.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def keyed(vocabulary: DataFrame) -> DataFrame:
    """Rows word, n, size, piece, key: of each word its keys as a word of ``size`` letters, its own length or one less.

    Of a word one letter longer than ``size`` the key leaves out a piece one letter longer, so words with one letter
    added to that piece have the key of the shorter word.
    """
    chars = F.char_length("word")
    roles = vocabulary.select("word", "n", F.explode(F.array(chars, chars - 1)).alias("size")).where("size > 0")
    rows = roles.select("*", F.explode(F.sequence(F.lit(0), F.lit(PIECES - 1))).alias("piece"))
    lo = F.floor(F.col("size") * F.col("piece") / PIECES).cast("int")
    hi = F.floor(F.col("size") * (F.col("piece") + 1) / PIECES).cast("int")
    rest = F.substring("word", hi + 1 + (chars - F.col("size")), F.col("size"))
    return rows.withColumn("key", F.xxhash64("size", "piece", F.substring("word", F.lit(1), lo), rest))


class Index:
    """Bitsets over words of ``size`` or ``size`` + 1 letters: those with letter x at place i."""

    def __init__(self, words: list[str], size: int):
        self.size, self.n = size, len(words)
        self.words = -(-self.n // 64)
        lengths = np.array([len(w) for w in words])
        letters = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4").astype(np.int64)
        row = np.repeat(np.arange(self.n), lengths)
        place = np.arange(len(letters)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        self.keys, at = np.unique((place << 21) | letters, return_inverse=True)
        # the last row is of letters that no word has at the place
        self.bits = np.zeros((len(self.keys) + 1, self.words), dtype=np.uint64)
        np.bitwise_or.at(self.bits, (at, row // 64), np.uint64(1) << (row % 64).astype(np.uint64))
        self.long, self.whole = self._pack(lengths == size + 1), self._pack(lengths == size)
        self.short = np.flatnonzero(lengths == size)
        self.letters = letters[np.repeat(lengths == size, lengths)].reshape(-1, size)

    def _pack(self, flags: np.ndarray) -> np.ndarray:
        out = np.zeros(self.words * 64, dtype=np.uint8)
        out[: self.n] = flags
        return np.packbits(out, bitorder="little").view("<u8")

    def having(self, place: int, letters: np.ndarray) -> np.ndarray:
        key = (place << 21) | letters
        at = np.searchsorted(self.keys, key)
        return self.bits[np.where(self.keys[np.minimum(at, len(self.keys) - 1)] == key, at, len(self.keys))]

    def near(self, letters: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        """Bitsets (one row per query of ``size`` letters) of the words with one replaced and with one added letter.

        The error is at one of the places lo to hi - 1, or for an added letter at the end if hi = size.
        """
        same = np.broadcast_to(self.whole | self.long, (len(letters), self.words))
        changed = added = np.zeros((len(letters), self.words), dtype=np.uint64)
        for i in range(self.size):
            here, after = self.having(i, letters[:, i]), self.having(i + 1, letters[:, i])
            changed = changed & here
            if lo <= i < hi:
                wrong = same & ~here
                changed, added = changed | wrong, added | wrong
            added, same = added & after, same & here
        if hi == self.size:
            added = added | same
        return changed & self.whole, added & self.long


def _places(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and place of the bits that are set."""
    row, word = np.nonzero(bits)
    flags = np.unpackbits(bits[row, word].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    at, bit = np.nonzero(flags)
    return row[at], word[at] * 64 + bit


def _near_in_block(table: pa.Table) -> pa.Table:
    """For each word with near words in the block: how many, the most frequent, and its number of rows."""
    piece = table["piece"][0].as_py()
    words, n, size = table["word"].to_pylist(), table["n"].to_numpy(), table["size"].to_numpy()
    pairs = []
    for s in np.unique(size).tolist():
        rows = np.flatnonzero(size == s)
        index = Index([words[i] for i in rows], s)
        for i in range(0, len(index.short), QUERY_ROWS):
            mine = rows[index.short[i : i + QUERY_ROWS]]
            changed, added = index.near(index.letters[i : i + QUERY_ROWS], s * piece // PIECES, s * (piece + 1) // PIECES)
            row, other = _places(changed)
            pairs.append((mine[row], rows[other]))
            row, other = _places(added)
            pairs += [(mine[row], rows[other]), (rows[other], mine[row])]
    empty = np.empty(0, dtype=np.int64)
    one, two = (np.concatenate(x) for x in zip((empty, empty), *pairs, strict=True))
    # words in code-point order break ties
    rank = np.empty(len(words), dtype=np.int64)
    rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    order = np.lexsort((rank[two], -n[two], rank[one]))
    one, two = one[order], two[order]
    first = np.flatnonzero(np.concatenate([[True], rank[one][1:] != rank[one][:-1]])) if len(one) else empty
    many = np.diff(np.concatenate([first, [len(one)]]))
    return pa.table(
        {
            "word": pa.array([words[i] for i in one[first]], pa.string()),
            "n_near": pa.array(many, pa.int64()),
            "best": pa.array([words[i] for i in two[first]], pa.string()),
            "best_n": pa.array(n[two[first]], pa.int64()),
        }
    )


def near_words(vocabulary: DataFrame) -> DataFrame:
    """Rows word, n_near, best, best_n for the words (distinct, with ``n``) that have near words."""
    rows = keyed(vocabulary)
    # a word has two keys per piece
    n_blocks = -(-2 * vocabulary.count() // BLOCK_ROWS) or 1
    blocked = rows.withColumn("block", F.col("piece") * n_blocks + F.pmod("key", F.lit(n_blocks)))
    schema = "word string, n_near long, best string, best_n long"
    found = blocked.select("block", "piece", "size", "word", "n").groupBy("block").applyInArrow(_near_in_block, schema)
    best = F.min(F.struct((-F.col("best_n")).alias("rank"), "best")).alias("b")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", F.col("b.best").alias("best"), (-F.col("b.rank")).alias("best_n"))


def variants(words: DataFrame, min_chars: int = 5, min_count: int = 3, ratio: int = 2) -> DataFrame:
    """One row per word of the vocabulary: word, n, n_near, form, form_n, root.

    ``words`` has a column ``word``, a row per occurrence.  The vocabulary is
    the words of at least ``min_chars`` code points with ``min_count`` rows.
    ``n_near`` counts the near words; ``form`` is the one of largest ``n``
    (ties: the smallest in code-point order) if that is at least ``ratio``
    times the word's, else null; ``root`` is the end of the chain of forms.

    A chain of forms multiplies ``n`` by ``ratio`` at each step, so it has at
    most log(largest n) steps, and doubling the steps ends after the
    logarithm of that.

    Defined results: null words are not counted; repeated rows count each;
    an empty table gives an empty result; other columns are not read.
    """
    folder = Folder(words.sparkSession)
    vocabulary = folder.cut(counted(words.select(F.col("word").cast("string").alias("word")), min_chars, min_count))
    found = vocabulary.join(near_words(vocabulary), "word", "left")
    is_form = F.col("best_n") >= ratio * F.col("n")
    forms = folder.cut(
        found.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n"),
        )
    )
    return forms.join(roots(forms, folder), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def roots(forms: DataFrame, folder: Folder) -> DataFrame:
    """(word, root) of the words that have a form."""
    at = folder.cut(forms.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    while True:
        onward = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        ahead = at.join(onward, "root", "left")
        if ahead.where("further IS NOT NULL").isEmpty():
            return at
        at = folder.cut(ahead.select("word", F.coalesce("further", "root").alias("root")))


def letter_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, word): each maximal run of letters A-Z, a-z and U+00C0 to U+00FF of the texts, A-Z lower-cased; null texts have none."""
    runs = F.regexp_extract_all(F.col(text_col).cast("string"), F.lit("([A-Za-zÀ-ÿ]+)"), F.lit(1))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.explode(runs).alias("word"))
    return rows.select("doc_id", lowered(F.col("word")).alias("word"))
