from __future__ import annotations

import random
import re

import numpy as np
import pytest

from tablesift.llm import ngram_join as nj
from tablesift.llm import order_minhash, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text: str | None) -> frozenset:
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + 3]) for i in range(len(w) - 2)) or (frozenset([tuple(w)]) if w else frozenset())


def components(sets: list[frozenset], percent: int) -> list[int]:
    parent = list(range(len(sets)))

    def top(i):
        return i if parent[i] == i else top(parent[i])

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                one, two = top(i), top(j)
                parent[max(one, two)] = min(one, two)
    return [top(i) for i in range(len(sets))]


def edited(rng: random.Random, words: list[str], share: float) -> list[str]:
    out = []
    for w in words:
        r = rng.random()
        out += [] if r < share / 3 else [w, f"n{rng.randrange(999)}"] if r < share * 2 / 3 else [f"e{rng.randrange(999)}"] if r < share else [w]
    return out


def corpus(seed: int) -> list[str | None]:
    """Families of near copies about the threshold, of many sizes; short texts; a passage in many texts; one long pair."""
    rng = random.Random(seed)
    out: list = []
    for n in (8, 11, 12, 13, 19, 28, 40, 62, 63, 120, 300):
        base = [f"w{rng.randrange(500)}" for _ in range(n)]
        out += [" ".join(edited(rng, base, s)) for s in (0, 0.01, 0.01, 0.02, 0.02, 0.03, 0.03, 0.04) for _ in range(2)]
    passage = " ".join(f"p{i}" for i in range(40))
    out += [f"{passage} " + " ".join(f"w{rng.randrange(500)}" for _ in range(rng.randint(0, 12))) for _ in range(30)]
    out += ["a b c", "A  b\nC", "a b", "b a", "a", "a a a a a a", None, "", " \n", out[3], out[3]]
    long = [f"w{rng.randrange(3000)}" for _ in range(30_000)]
    out += [" ".join(long), " ".join(edited(rng, long, 0.01))]
    return out


@pytest.mark.parametrize(("seed", "percent"), [(1, 90), (2, 90), (3, 75)])
def test_components_equal_brute_force(spark, seed, percent):
    texts = corpus(seed)
    rows = spark.createDataFrame([(i, t, 1, 2) for i, t in enumerate(texts)], "doc_id long, text string, node int, `n.keys` int").repartition(4)
    got = {r["doc_id"]: r for r in nj.similar_classes(rows, percent=percent).collect()}
    sets = [shingles(t) for t in texts]
    assert {i: r["n_shingles"] for i, r in got.items()} == {i: len(s) for i, s in enumerate(sets)}
    want = components(sets, percent)
    assert [got[i]["component_id"] for i in range(len(texts))] == want
    assert [got[i]["component_size"] for i in range(len(texts))] == [want.count(c) for c in want]


def test_linked_sets_share_a_key():
    """Sets that differ as much as the bound allows, and sizes on both sides of a level's bounds."""
    rng = np.random.default_rng(5)
    for _ in range(400):
        n = int(rng.integers(9, 400))
        a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        keep = a[rng.permutation(len(a))[: int(np.ceil(0.9 * len(a)))]]
        more = np.unique(rng.integers(0, 2**63, int(rng.integers(0, 3)), dtype=np.uint64))
        b = np.unique(np.concatenate([keep, more]))
        if 100 * len(np.intersect1d(a, b)) < 90 * len(np.union1d(a, b)):
            continue
        keys, n_keys = nj.block_keys(np.concatenate([a, b]), np.array([len(a), len(b)]), 90)
        assert len(a) == len(b) == len(keep) or set(keys[: n_keys[0]]) & set(keys[n_keys[0] :])


def test_product_equals_set_overlap():
    rng = np.random.default_rng(6)
    base = np.unique(rng.integers(0, 1 << 40, 700, dtype=np.uint64))
    sets = [np.sort(rng.permutation(base)[: rng.integers(500, 700)]) for _ in range(60)]
    one, two = np.arange(40), np.arange(20, 60)
    apart = one[:, None] != two[None, :]
    got = {tuple(p) for p in nj.product_links(sets, one, two, apart, 80).tolist()}
    size = lambda i, j: (len(np.intersect1d(sets[i], sets[j])), len(np.union1d(sets[i], sets[j])))
    want = {(i, j) for i in range(40) for j in range(20, 60) if i != j and 100 * size(i, j)[0] >= 80 * size(i, j)[1]}
    assert got == want and 0 < len(want) < 1000


def test_unresolved_blocks_are_multiplied(spark, monkeypatch):
    """A chain of near copies in which few are near the row that a block compares first, in blocks of a few rows."""
    monkeypatch.setattr(order_minhash, "BLOCK", 4)
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(words[i * 3 : i * 3 + 200]) for i in range(60)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in nj.similar_classes(rows).collect()}
    assert [got[i] for i in range(60)] == components([shingles(t) for t in texts], 90)


def test_query_and_edges(spark, tmp_dir):
    texts = corpus(7)[:40] + [None, ""]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(0, texts[0], "x"), (None, texts[0], "x"), (None, None, "x")]
    spark.createDataFrame(rows, "doc_id long, text string, component_id string").write.parquet(f"{tmp_dir}/documents.parquet")
    got = queries.op12_ngram_join(spark, tmp_dir).collect()
    assert len(got) == len(rows)
    want = components([shingles(t) for _, t, _ in rows], 90)
    expected = sorted((str(i), len(shingles(t)), str(rows[c][0])) for (i, t, _), c in zip(rows, want, strict=True))
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in got) == expected
    assert nj.similar_classes(spark.createDataFrame([], "doc_id long, text string")).collect() == []
