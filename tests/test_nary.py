"""n-ary INDs against a brute-force tuple-set check (levels 2 and 3)."""

from __future__ import annotations

import itertools
import random

import pytest

from pyspark.sql import types as T

from tablesift.operators import attributes as A
from tablesift.operators.nary import nary_inds

WS = "".join(chr(i) for i in range(0x21))


def frames(spark, tables):
    out = {}
    for t, cols in tables.items():
        names = list(cols)
        n = len(next(iter(cols.values())))
        rows = [tuple(cols[c][i] for c in names) for i in range(n)]
        out[t] = spark.createDataFrame(rows, T.StructType([T.StructField(c, T.StringType()) for c in names]))
    return out


def norm(v):
    if v is None:
        return None
    v = v.strip(WS)
    return v or None


def tuples(tables, t, cols):
    data = tables[t]
    n = len(data[cols[0]])
    out = set()
    for i in range(n):
        vals = tuple(norm(data[c][i]) for c in cols)
        if all(v is not None for v in vals):
            out.add(vals)
    return out


def unary(tables):
    vals = {}
    for t, cols in tables.items():
        for c, vs in cols.items():
            vals[(t, c)] = {norm(v) for v in vs} - {None}
    return {
        (dt, (dc,), rt, (rc,))
        for (dt, dc), dv in vals.items()
        for (rt, rc), rv in vals.items()
        if (dt, dc) != (rt, rc) and dv and dv <= rv
    }


def brute(tables, k, lower):
    """Level-k INDs whose tuples are contained and whose (k-1)-column
    projections are all in ``lower``."""
    found = set()
    for dt, dcols_all in tables.items():
        for dcols in itertools.combinations(sorted(dcols_all), k):
            dep = tuples(tables, dt, dcols)
            if not dep:
                continue
            for rt, rcols_all in tables.items():
                for rcols in itertools.permutations(sorted(rcols_all), k):
                    if (dt, dcols) == (rt, rcols):
                        continue
                    projections = {
                        (dt, dcols[:i] + dcols[i + 1 :], rt, rcols[:i] + rcols[i + 1 :]) for i in range(k)
                    }
                    if projections <= lower and dep <= tuples(tables, rt, rcols):
                        found.add((dt, dcols, rt, rcols))
    return found


def as_rows(found, k):
    return {(dt, ", ".join(d), rt, ", ".join(r), k) for dt, d, rt, r in found}


def test_levels_two_and_three_against_brute_force(spark):
    rng = random.Random(3)
    domain = ["1", "2", " 1", "", None]
    tables = {
        "t": {c: [rng.choice(domain) for _ in range(6)] for c in ("a", "b", "c", "d")},
        "u": {c: [rng.choice(["1", "2", "3"]) for _ in range(8)] for c in ("x", "y", "z")},
    }
    got = {tuple(r) for r in nary_inds(spark, frames(spark, tables), A.TRIMMED, max_level=3).collect()}
    two = brute(tables, 2, unary(tables))
    three = brute(tables, 3, two)
    assert got == as_rows(two, 2) | as_rows(three, 3)
    assert three


def test_star_level_two(spark):
    from tests.conftest import SF_MID
    from tablesift.sources.tables import STAR_TABLES, read_tables

    tables = read_tables(spark, SF_MID, STAR_TABLES)
    from tablesift.operators.nary import level_one, next_candidates

    assert next_candidates(level_one(spark, tables, A.TRIMMED), 1).count() == 47
    got = {tuple(r) for r in nary_inds(spark, tables).collect()}
    assert got == {
        ("lineitem", "l_linenumber, l_linestatus", "orders", "o_custkey, o_orderstatus", 2),
        ("lineitem", "l_linenumber, l_tax", "lineitem", "l_suppkey, l_discount", 2),
    }


@pytest.mark.parametrize("seed", [5, 6, 7])
def test_strict_levels_equal_plain_containment(spark, seed):
    """With null as a value nothing is dropped, so tuple containment is
    closed under projection and level-wise search equals plain containment
    (a column is never paired with itself, as at level one)."""
    rng = random.Random(seed)
    domain = ["1", "2", None, ""]
    tables = {
        "t": {c: [rng.choice(domain) for _ in range(5)] for c in ("a", "b", "c")},
        "u": {c: [rng.choice(domain) for _ in range(7)] for c in ("x", "y")},
    }

    def raw_tuples(t, cols):
        data = tables[t]
        return {tuple(data[c][i] for c in cols) for i in range(len(data[cols[0]]))}

    expected = set()
    for dt, dcols_all in tables.items():
        for dcols in itertools.combinations(sorted(dcols_all), 2):
            dep = raw_tuples(dt, dcols)
            for rt, rcols_all in tables.items():
                for rcols in itertools.permutations(sorted(rcols_all), 2):
                    if dt == rt and any(a == b for a, b in zip(dcols, rcols)):
                        continue
                    if dep <= raw_tuples(rt, rcols):
                        expected.add((dt, ", ".join(dcols), rt, ", ".join(rcols), 2))
    got = {tuple(r) for r in nary_inds(spark, frames(spark, tables), A.STRICT, max_level=2).collect()}
    assert got == expected


def test_search_goes_on_until_a_level_is_empty(spark):
    rows = [(i, i * 10, i * 100, "x") for i in range(1, 5)]
    tables = {
        "d": spark.createDataFrame([r[:3] for r in rows[:3]], "a int, b int, c int"),
        "r": spark.createDataFrame(rows, "a2 int, b2 int, c2 int, z string"),
    }
    got = {(r.dependent_columns, r.referenced_columns, r.arity) for r in nary_inds(spark, tables, A.TRIMMED).collect()}
    assert ("a, b, c", "a2, b2, c2", 3) in got and {g[2] for g in got} == {2, 3}


def test_a_slice_refutes_before_all_tuples_are_met(spark, monkeypatch):
    from tablesift.operators import nary

    rows = [(f"a{i}", f"b{i}", f"c{i}") for i in range(300)]
    refs = [(f"a{i}", f"b{i}", f"c{(i + 1) % 300}") for i in range(300)]
    tables = {"t": spark.createDataFrame(rows, "a string, b string, c string"), "u": spark.createDataFrame(refs, "x string, y string, z string")}
    met, unrefuted = [], nary._unrefuted

    def spy(spark, tables, options, cands, k, whole=False):
        if whole:
            met.extend((r.dt, *r.dcols) for r in cands.collect())
        return unrefuted(spark, tables, options, cands, k, whole)

    monkeypatch.setattr(nary, "_unrefuted", spy)
    found = nary.nary_inds(spark, tables, A.TRIMMED).collect()
    assert sorted(met) == [("t", "a", "b"), ("u", "x", "y")]
    assert sorted((r.dependent_table, r.dependent_columns) for r in found) == [("t", "a, b"), ("u", "x, y")]
