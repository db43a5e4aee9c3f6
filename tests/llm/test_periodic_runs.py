from __future__ import annotations

import hashlib
import random
import re
import time
import zlib

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tablesift.llm import periodic_runs as pr
from tablesift.llm import queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(w: list) -> tuple[list[tuple], list]:
    """Every run by comparing the words at every lag, and the words no run drops."""
    n, out = len(w), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and w[j] == w[j + q]:
                j += 1
            long = j - i + q >= max(12, 2 * q)
            if long and not any(all(w[k] == w[k + p] for k in range(i, j + q - p)) for p in range(1, q)):
                out.append((i, j - i + q, q))
            i = max(j, i + 1)
    dropped = {k for s, n_, q in out for k in range(s + q, s + n_)}
    return sorted(out, key=lambda r: (r[0], r[2])), [x for i, x in enumerate(w) if i not in dropped]


def found(texts: list[str]) -> list[tuple]:
    rows = pr._runs_of_block(pa.array(range(len(texts))), pa.array(texts, pa.string())).to_pylist()
    return [([(r["start"], r["length"], r["period"]) for r in row["runs"]], row["collapsed"]) for row in rows]


words = st.lists(st.sampled_from("a b c ab é x1".split()), max_size=40)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(words, words, st.integers(0, 9), words), min_size=1, max_size=4))
def test_runs_equal_brute_force(parts):
    texts = [a + b * k + c for a, b, k, c in parts]
    assert found([" ".join(t) for t in texts]) == [(r, " ".join(k)) for r, k in map(brute, texts)]


def test_nested_and_long_periods():
    rng = random.Random(2)
    inner = ["a", "b"] * 9
    outer = (inner + [f"u{i}" for i in range(7)]) * 4
    long = [f"v{rng.randrange(40)}" for _ in range(333)]
    texts = [outer, long * 2 + long[:100], long + outer + long, ["z"] * 11, ["z"] * 12, outer * 3]
    got = found(["\n".join(t) for t in texts])
    assert got == [(r, " ".join(k)) for r, k in map(brute, texts)]
    # a run of the outer period and one of the inner period in each of its turns
    assert [r[2] for r in got[0][0]].count(2) == 4 and (0, 100, 25) in got[0][0]


def test_very_long_texts():
    """Half a million words: one word only, all distinct, a long period, random ones."""
    rng, n = random.Random(3), 500_000
    texts = ["w " * n, " ".join(map(str, range(n))), " ".join(str(i % 50_003) for i in range(n)), " ".join(str(rng.randrange(300)) for _ in range(n))]
    start = time.time()
    got = [r for r, _ in found(texts)]
    assert got[:3] == [[(0, n, 1)], [], [(0, n, 50_003)]]
    assert time.time() - start < 60


def planted(doc_id: int, w: list) -> list:
    h, n = zlib.crc32(str(doc_id).encode()), len(w)
    if h % 10 or not n:
        return w
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return w[:a] + [w[a + (i - a) % p] for i in range(a, n)]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    texts = [" ".join(f"w{rng.randrange(60)}" for _ in range(rng.randint(0, 150))) for _ in range(120)]
    texts += ["", None, " \n\t ", "é ü " * 20, texts[5], "same line\n" * 40]
    return [(i, t, 1, "x") for i, t in enumerate(texts)] + [(5, texts[5], 1, "x")]


def test_query_equals_brute_force(spark, rows, tmp_dir):
    spark.createDataFrame(rows, "doc_id long, text string, runs int, collapsed string").repartition(3).write.parquet(f"{tmp_dir}/documents.parquet")
    got = sorted(tuple(r) for r in queries.op11_periodic_runs(spark, tmp_dir).collect())
    want = []
    for i, t, *_ in rows:
        w = planted(i, WORD.findall(t or ""))
        runs, kept = brute(w)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        first = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        want.append((i, len(w), len(runs), *first, digest(lines), digest(" ".join(kept))))
    assert got == sorted(want)
    assert sum(r[2] > 0 for r in got) > 10


def test_edges(spark):
    schema = "doc_id long, text string, `a.b` string, n_words string"
    assert pr.periodic_runs(spark.createDataFrame([], schema)).collect() == []
    rows = pr.periodic_runs(spark.createDataFrame([(None, "a " * 12, "q", "r"), (None, None, "q", "r")], schema)).collect()
    assert sorted((r["doc_id"], r["n_words"], len(r["runs"]), r["collapsed"]) for r in rows) == [(None, 0, 0, ""), (None, 12, 1, "a")]
