from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tablesift.llm import queries, spelling


def near(u: str, v: str) -> bool:
    """Exactly one inserted, deleted or replaced code point."""
    if len(u) > len(v):
        u, v = v, u
    if len(u) == len(v):
        return sum(a != b for a, b in zip(u, v, strict=True)) == 1
    return len(v) == len(u) + 1 and any(v[:i] + v[i + 1 :] == u for i in range(len(v)))


def brute(count: dict[str, int]) -> list[tuple]:
    forms, out = {}, []
    close = {w: [v for v in count if near(w, v)] for w in count}
    for w, n in count.items():
        best = min(close[w], key=lambda v: (-count[v], v), default=None)
        forms[w] = best if best and count[best] >= 2 * n else None
    for w, n in count.items():
        root = w
        while forms[root]:
            root = forms[root]
        out.append((w, forms[w], root, n, len(close[w]), count[forms[w]] if forms[w] else None))
    return sorted(out)


def vocabulary(rng: random.Random) -> dict[str, int]:
    """Words of few letters and their misspellings, long chains, long words, ambiguous insertions."""
    count = {}
    for _ in range(60):
        w = "".join(rng.choices("abéz", k=rng.randint(5, 11)))
        count[w] = rng.randint(3, 200)
        for _ in range(3):
            i = rng.randrange(len(w))
            count.setdefault(rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice("abñ") + w[i:], w[:i] + "c" + w[i + 1 :]]), rng.randint(3, 30))
    count |= {"aaaaa": 3, "aaaaaa": 7, "aaaaaaa": 15, "aaaaaaaa": 40, "bbbbb": 9, "bbbbbb": 9}
    count |= {"x" * 3000: 5, "x" * 2999 + "y": 50, "x" * 3001: 4}
    return {w: n for w, n in count.items() if len(w) >= 5}


def as_tuples(rows) -> list[tuple]:
    return sorted((r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows.collect())


@pytest.mark.parametrize("block_rows", [40, 32768])
def test_variants_equal_brute_force(spark, monkeypatch, block_rows):
    monkeypatch.setattr(spelling, "BLOCK_ROWS", block_rows)
    count = vocabulary(random.Random(block_rows))
    rows = spark.createDataFrame([(w, n, 0) for w, n in count.items()], "word string, times int, n int").repartition(3)
    got = as_tuples(spelling.variants(rows.select("word", "n", F.explode(F.sequence(F.lit(1), "times")))))
    assert got == brute(count)
    assert any(r[1] and r[2] != r[1] for r in got)


def test_query_equals_brute_force(spark, tmp_dir):
    rng = random.Random(6)
    base = ["Straße", "naïve", "kitten", "mittens", "sitting", "bittern", "Ünder", "wonder", "yonder", "founder"]
    texts = [" 9".join(rng.choices(base, k=rng.randint(0, 120))) + "x-" + rng.choice(base).upper() for _ in range(60)]
    texts += [None, "", "12 34", texts[0]]
    rows = [(i, t, 5, "q") for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, n int, `root.form` string").write.parquet(f"{tmp_dir}/documents.parquet")
    got = as_tuples(queries.op13_spelling_variants(spark, tmp_dir))
    count: Counter = Counter()
    lower = str.maketrans(spelling.UPPER, spelling.LOWER)
    for i, t, *_ in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = w.translate(lower)
            h = zlib.crc32(f"{i}:{w}".encode())
            count[w if h % 97 else w[: h % len(w)] + w[h % len(w) + 1 :]] += 1
    want = brute({w: n for w, n in count.items() if len(w) >= 5 and n >= 3})
    assert got == want and any(r[1] for r in got)


def test_edges(spark):
    empty = spark.createDataFrame([], "word string, `w.x` int")
    assert spelling.variants(empty).collect() == []
    none = spark.createDataFrame([(None, 1), (None, 1), (None, 1), ("alone", 1), ("alone", 1), ("alone", 1)], "word string, `w.x` int")
    assert as_tuples(spelling.variants(none)) == [("alone", None, "alone", 3, 0, None)]
