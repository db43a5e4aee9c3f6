"""Maximal n-ary INDs: against brute force and the level-wise search, passes and plan size."""

from __future__ import annotations

import itertools
import random
import time

import pytest

from tablesift.operators import attributes as A
from tablesift.operators.nary import nary_inds
from tablesift.operators.nary_cliques import CliqueSearch, maximal_cliques, maximal_nary_inds, without
from tests.test_nary import as_rows, brute, frames, unary


def split(rows):
    """INDs as (tables, set of column pairs)."""
    return {
        (r[0], r[2], frozenset(zip(r[1].split(", "), r[3].split(", "), strict=True))) for r in rows
    }


def choices(maximal):
    """Every choice of two or more column pairs."""
    return {
        (dt, rt, frozenset(some))
        for dt, rt, parts in maximal
        for n in range(2, len(parts) + 1)
        for some in itertools.combinations(parts, n)
    }


def is_antichain(found):
    return not any(a[:2] == b[:2] and a[2] < b[2] for a in found for b in found)


@pytest.mark.parametrize("seed", [3, 11, 12, 13])
def test_equal_brute_force_with_nulls_and_blanks(spark, seed):
    rng = random.Random(seed)
    domain = ["1", "2", " 1", "", None] if seed % 2 else ["1", "2"]
    tables = {
        "t": {c: [rng.choice(domain) for _ in range(4)] for c in ("a", "b", "c", "d")},
        "u": {c: [rng.choice(["1", "2", "3"]) for _ in range(14)] for c in ("w", "x", "y", "z")},
    }
    want, lower = set(), unary(tables)
    for k in (2, 3, 4):
        lower = brute(tables, k, lower)
        want |= as_rows(lower, k)
    found = split(maximal_nary_inds(spark, frames(spark, tables), A.TRIMMED).collect())
    assert is_antichain(found) and choices(found) == split(want)


@pytest.mark.parametrize("seed", [5, 6])
def test_equal_the_level_wise_search_in_strict(spark, seed):
    rng = random.Random(seed)
    domain = ["1", "2", None, ""]
    tables = {
        "t": {c: [rng.choice(domain) for _ in range(4)] for c in ("a", "b", "c")},
        "u": {c: [rng.choice(domain) for _ in range(30)] for c in ("x", "y", "z")},
    }
    found = split(maximal_nary_inds(spark, frames(spark, tables), A.STRICT).collect())
    want = split(nary_inds(spark, frames(spark, tables), A.STRICT).collect())
    assert is_antichain(found) and choices(found) == want and want


def test_five_columns_take_fewer_passes_than_levels(spark):
    rows = [(f"{i % 7}", f"b{i % 5}", f"c{i}", f"d{i // 2}", f"e{i % 11}") for i in range(60)]
    tables = {
        "part": spark.createDataFrame(rows[:40], "a string, b string, c string, d string, e string"),
        "all": spark.createDataFrame(rows + rows[:9], "v string, w string, x string, y string, z string"),
    }
    search = CliqueSearch(spark, tables, A.TRIMMED)
    found = search.run()
    assert ("part", "all", frozenset(zip("abcde", "vwxyz", strict=True))) in found
    assert search.passes == 3


@pytest.mark.parametrize("lacking", [1, 30])
def test_a_failed_candidate_is_narrowed(spark, lacking):
    # pairs hold everywhere, and the last two columns don't go along with the first three
    rows = [(f"a{i}", f"b{i}", f"c{i}", f"d{i % 2}", f"e{i // 2 % 2}") for i in range(40)]
    wide = [r[:3] + (f"d{x}", f"e{y}") for r in rows for x in (0, 1) for y in (0, 1)]
    gone = {r for r in rows[:lacking]}
    tables = {
        "t": spark.createDataFrame(rows, "a string, b string, c string, d string, e string"),
        "u": spark.createDataFrame([r for r in wide if r not in gone], "v string, w string, x string, y string, z string"),
    }
    found = {f for f in CliqueSearch(spark, tables, A.TRIMMED).run() if f[:2] == ("t", "u")}
    whole = list(zip("abcde", "vwxyz", strict=True))
    # rows whose d and e are named together with one of a, b, c are the missing ones
    assert found == {("t", "u", frozenset(whole[:4])), ("t", "u", frozenset(whole[:3] + whole[4:])), ("t", "u", frozenset(whole[3:]))}


def test_hundreds_of_sides_are_planned_in_seconds(spark):
    n = 26
    row = [tuple(str(i) for i in range(n)), tuple(str(i + 100) for i in range(n))]
    search = CliqueSearch(
        spark,
        {
            "t": spark.createDataFrame(row, ", ".join(f"a{i} string" for i in range(n))),
            "u": spark.createDataFrame(row, ", ".join(f"b{i} string" for i in range(n))),
        },
        A.TRIMMED,
    )
    pairs = [(f"a{i}", f"b{i}") for i in range(n)]
    search.whole = {("t", a) for a, _ in pairs}
    began = time.time()
    search.test([("t", "u", frozenset(c)) for c in itertools.combinations(pairs, 2)])
    assert len(search.error) == 325 and set(search.error.values()) == {0.0}
    assert time.time() - began < 60


def test_tables_without_rows_or_inds(spark):
    empty = {"t": spark.createDataFrame([], "a string, b string"), "u": spark.createDataFrame([("1", "2")], "x string, y string")}
    assert maximal_nary_inds(spark, empty).count() == 0
    assert maximal_nary_inds(spark, {}).count() == 0


def test_cliques_and_splits():
    rng = random.Random(1)
    for _ in range(20):
        nodes = [(f"n{i}", "x") for i in range(7)]
        near = {n: set() for n in nodes}
        for p, q in itertools.combinations(nodes, 2):
            if rng.random() < 0.6:
                near[p].add(q)
                near[q].add(p)
        every = [frozenset(s) for k in range(1, 8) for s in itertools.combinations(nodes, k)]
        cliques = [s for s in every if all(q in near[p] for p, q in itertools.combinations(s, 2))]
        assert set(maximal_cliques(nodes, near)) == {s for s in cliques if not any(s < c for c in cliques)}
        failed = rng.sample([s for s in every if len(s) > 1], 4)
        free = [s for s in every if not any(f <= s for f in failed)]
        assert without(frozenset(nodes), failed) == {s for s in free if not any(s < c for c in free)}


def mixed(spark):
    """A pair that holds and two that lack most tuples, of single columns that are all included."""
    rows = [(f"a{i}", f"b{i}", f"c{i}") for i in range(300)]
    refs = [(f"a{i}", f"b{i}", f"c{(i + 1) % 300}") for i in range(300)]
    return {"t": spark.createDataFrame(rows, "a string, b string, c string"), "u": spark.createDataFrame(refs, "x string, y string, z string")}


def test_only_candidates_without_a_missing_tuple_in_a_slice_meet_all_tuples(spark, monkeypatch):
    met = []
    measured = CliqueSearch.measured
    monkeypatch.setattr(CliqueSearch, "measured", lambda self, todo, whole: met.extend(todo if whole else []) or measured(self, todo, whole))
    found = CliqueSearch(spark, mixed(spark), A.TRIMMED).run()
    holds = ("t", "u", frozenset([("a", "x"), ("b", "y")]))
    assert holds in found and ("u", "t", frozenset([("x", "a"), ("y", "b")])) in found and len(found) == 2
    assert sorted(met) == sorted(found)
