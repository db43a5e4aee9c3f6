"""Unary IND semantics: hand-made cases for both presets, properties, and
brute-force set checks on random tables (including more than 64 attributes,
so masks span several words)."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import types as T

from tablesift.operators import attributes as A
from tablesift.operators import ind

JAVA_WS = "".join(chr(i) for i in range(0x21))


def frames(spark, tables):
    """{table: {col: [values]}} -> {table: DataFrame} with text columns."""
    out = {}
    for t, cols in tables.items():
        names = list(cols)
        n = max(len(v) for v in cols.values())
        rows = [tuple(cols[c][i] if i < len(cols[c]) else None for c in names) for i in range(n)]
        schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
        out[t] = spark.createDataFrame(rows, schema)
    return out


def found(spark, tables, preset):
    space = A.AttributeSpace.build(spark, frames(spark, tables), A.PRESETS[preset])
    rows = ind.unary_inds(space).collect()
    if preset == "trimmed":
        return {(r.dependent, r.referenced) for r in rows}
    return {(f"{r.dependent_table}.{r.dependent_column}", f"{r.referenced_table}.{r.referenced_column}") for r in rows}


def single(**cols):
    """Each attribute in a table of its own, named after the column."""
    return {f"t{c}": {c: v} for c, v in cols.items()}


CASES = [
    # name, tables, trimmed result, strict result (strict labels are t<c>.<c>)
    ("equal", single(a=["1", "2"], b=["1", "2"]), {("a", "b"), ("b", "a")}, {("ta.a", "tb.b"), ("tb.b", "ta.a")}),
    ("subset", single(a=["1"], b=["1", "2"]), {("a", "b")}, {("ta.a", "tb.b")}),
    ("null in dependent", single(a=["1", None], b=["1", "2"]), {("a", "b")}, set()),
    ("null in both", single(a=["1", None], b=["1", "2", None]), {("a", "b")}, {("ta.a", "tb.b")}),
    ("blank in dependent", single(a=["1", ""], b=["1", "2"]), {("a", "b")}, set()),
    ("null versus blank", single(a=["1", None], b=["1", ""]), {("a", "b"), ("b", "a")}, set()),
    ("spaces and tabs", single(a=[" 1", "2\t"], b=["1", "2"]), {("a", "b"), ("b", "a")}, set()),
    ("all null or blank", single(a=[None, ""], b=["1"]), set(), set()),
    ("all null, other with null", single(a=[None], b=[None, "1"]), set(), {("ta.a", "tb.b")}),
    ("no overlap", single(a=["1"], b=["2"]), set(), set()),
    ("text equality only", single(a=["1"], b=["1.0", "01"]), set(), set()),
    (
        "same header in two files",
        {"f": {"k": ["1"]}, "g": {"k": ["2", None], "m": ["1", "2"]}},
        {("k", "m"), ("m", "k")},
        {("f.k", "g.m")},
    ),
]


@pytest.mark.parametrize("name,tables,trimmed,strict", CASES, ids=[c[0] for c in CASES])
def test_fixture_cases(spark, name, tables, trimmed, strict):
    assert found(spark, tables, "trimmed") == trimmed
    assert found(spark, tables, "strict") == strict


def test_same_header_strict_full_rows(spark):
    # g.k holds {2}: with rows of equal length it is included in g.m as well.
    tables = {"f": {"k": ["1"]}, "g": {"k": ["2"], "m": ["1"]}}
    tables["g"] = {"k": ["2", "2"], "m": ["1", "2"]}
    assert found(spark, tables, "strict") == {("f.k", "g.m"), ("g.k", "g.m")}


def test_all_blank_attribute_profile(spark):
    tables = frames(spark, single(a=[None, ""], b=["1"]))
    for preset, expected in (("trimmed", 0), ("strict", 2)):
        space = A.AttributeSpace.build(spark, tables, A.PRESETS[preset])
        prof = {r[0] if preset == "trimmed" else r[1]: r.n_distinct for r in A.attribute_profile(space).collect()}
        assert prof["a"] == expected


def test_chain_and_cycle_implied(spark):
    chain = frames(spark, single(a=["1"], b=["1", "2"], c=["1", "2", "3"]))
    space = A.AttributeSpace.build(spark, chain, A.TRIMMED)
    assert {tuple(r) for r in ind.unary_inds(space).collect()} == {("a", "b"), ("b", "c"), ("a", "c")}
    assert {tuple(r) for r in ind.ind_implied(space).collect()} == {("a", "c")}
    cycle = frames(spark, single(a=["1", "2"], b=["2", "1"], c=["1", "2", "3"]))
    space = A.AttributeSpace.build(spark, cycle, A.TRIMMED)
    inds = {tuple(r) for r in ind.unary_inds(space).collect()}
    assert inds == {("a", "b"), ("b", "a"), ("a", "c"), ("b", "c")}
    assert {tuple(r) for r in ind.ind_implied(space).collect()} == {("a", "c"), ("b", "c")}


def test_grouped_lines(spark):
    space = A.AttributeSpace.build(spark, frames(spark, single(a=["1"], c=["1", "2"], b=["1", "2"])), A.TRIMMED)
    lines = sorted(r.line for r in ind.ind_lines_grouped(space).collect())
    assert lines == ["a < b, c", "b < c", "c < b"]


def test_pair_lines(spark):
    tables = {"x.csv": {"a": ["1"]}, "y.tbl.csv": {"b": ["1", "2"]}}
    space = A.AttributeSpace.build(spark, frames(spark, tables), A.STRICT)
    assert [r.line for r in ind.ind_lines_pairs(space).collect()] == ["x -> y: [a] c [b]"]


# ----------------------------------------------------------- brute force
def brute(tables, preset):
    sets = {}
    for t, cols in tables.items():
        for c, vals in cols.items():
            if preset == "trimmed":
                key = c
                vs = {v.strip(JAVA_WS) for v in vals if v is not None}
                vs.discard("")
            else:
                key = f"{t}.{c}"
                vs = set(vals)
            sets.setdefault(key, set()).update(vs)
    return {
        (a, b)
        for a in sets
        for b in sets
        if a != b and sets[a] and sets[a] <= sets[b]
    }, sets


def random_tables(rng, n_tables, n_cols, n_rows, domain):
    tables = {}
    for t in range(n_tables):
        cols = {}
        for c in range(n_cols):
            # Shared names across tables exercise the trimmed name merge.
            name = f"c{rng.randrange(n_cols * n_tables)}"
            while name in cols:
                name = name + "x"
            cols[name] = [rng.choice(domain) for _ in range(n_rows)]
        tables[f"t{t}"] = cols
    return tables


DOMAIN = ["1", "2", "3", " 1", "2\t", "", None, "x", "01"]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_against_brute_force(spark, seed):
    rng = random.Random(seed)
    tables = random_tables(rng, 3, 4, rng.randrange(1, 6), DOMAIN)
    for preset in ("trimmed", "strict"):
        expected, _ = brute(tables, preset)
        assert found(spark, tables, preset) == expected, preset


def test_wide_masks_against_brute_force(spark):
    rng = random.Random(7)
    # 70 columns: two 64-bit mask words.
    cols = {f"a{i:02d}": [rng.choice(["1", "2", "3", "4", None]) for _ in range(5)] for i in range(70)}
    tables = {"wide": cols}
    for preset in ("trimmed", "strict"):
        expected, _ = brute(tables, preset)
        assert found(spark, tables, preset) == expected


def test_wide_overlap_against_brute_force(spark):
    rng = random.Random(8)
    cols = {f"a{i:02d}": [rng.choice(["1", "2", "3", None]) for _ in range(4)] for i in range(70)}
    space = A.AttributeSpace.build(spark, frames(spark, {"wide": cols}), A.TRIMMED)
    _, sets = brute({"wide": cols}, "trimmed")
    got = {(r.dependent, r.referenced): (r.n_common, r.n_dependent) for r in A.attribute_overlap(space).collect()}
    expected = {
        (a, b): (len(sets[a] & sets[b]), len(sets[a]))
        for a in sets
        for b in sets
        if a != b and sets[a] & sets[b]
    }
    assert got == expected


def test_overlap_count_form_agrees(spark):
    rng = random.Random(11)
    tables = random_tables(rng, 2, 5, 6, DOMAIN)
    space = A.AttributeSpace.build(spark, frames(spark, tables), A.TRIMMED)
    overlap = A.attribute_overlap(space).collect()
    _, sets = brute(tables, "trimmed")
    for r in overlap:
        assert r.n_common == len(sets[r.dependent] & sets[r.referenced])
        assert r.n_dependent == len(sets[r.dependent])
    pairs = {(r.dependent, r.referenced) for r in overlap if r.n_common == r.n_dependent}
    assert pairs == found(spark, tables, "trimmed")


def test_check_and_candidates(spark):
    tables = frames(spark, single(a=["1", "2"], b=["1", "2", "3"], c=["3"]))
    space = A.AttributeSpace.build(spark, tables, A.TRIMMED)
    rows = {(r.dependent, r.referenced): r for r in ind.ind_check(space, [("a", "b"), ("b", "a"), ("c", "a")]).collect()}
    assert rows[("a", "b")].is_ind and rows[("a", "b")].n_missing == 0
    assert rows[("b", "a")].n_missing == 1 and not rows[("b", "a")].is_ind
    assert rows[("c", "a")].n_dependent == 1 and rows[("c", "a")].n_missing == 1
    strict = A.AttributeSpace.build(spark, tables, A.STRICT)
    cands = ind.ind_candidates(strict).collect()
    assert len(cands) == 6
    assert all((r.n_dependent <= r.n_referenced) == r.size_ok for r in cands)


def test_transitive_and_no_self_pair(spark):
    from tests.conftest import SF_SMALL
    from tablesift.sources.tables import STAR_TABLES, read_tables

    space = A.AttributeSpace.build(spark, read_tables(spark, SF_SMALL, STAR_TABLES), A.TRIMMED)
    pairs = {tuple(r) for r in ind.unary_inds(space).collect()}
    assert len(pairs) == 95 and len({d for d, _ in pairs}) == 16
    assert all(d != r for d, r in pairs)
    for a, b in pairs:
        for b2, c in pairs:
            if b == b2 and a != c:
                assert (a, c) in pairs


def test_strict_equals_trimmed_without_nulls_blanks_spaces(spark):
    from tests.conftest import SF_SMALL
    from tablesift.sources.tables import STAR_TABLES, read_tables

    tables = read_tables(spark, SF_SMALL, STAR_TABLES)
    trimmed = {tuple(r) for r in ind.unary_inds(A.AttributeSpace.build(spark, tables, A.TRIMMED)).collect()}
    strict = {
        (r.dependent_column, r.referenced_column)
        for r in ind.unary_inds(A.AttributeSpace.build(spark, tables, A.STRICT)).collect()
    }
    assert strict == trimmed


def test_bit_and_equals_array_intersect_form(spark):
    """Cross-check: per attribute, intersect the attribute sets of its values
    with ``array_intersect`` over collected sets (fine on a small fixture)."""
    from pyspark.sql import functions as F

    rng = random.Random(21)
    tables = random_tables(rng, 2, 5, 8, ["1", "2", "3", "4", None])
    space = A.AttributeSpace.build(spark, frames(spark, tables), A.TRIMMED)
    pairs = space.unpivot(space.id_payload)
    per_value = pairs.groupBy("v").agg(F.array_sort(F.collect_set("attr_id")).alias("s"))
    per_attr = per_value.select(F.explode("s").alias("dep"), "s").groupBy("dep").agg(F.collect_list("s").alias("ss"))
    inter = per_attr.select(
        "dep", F.aggregate("ss", F.element_at("ss", 1), lambda acc, x: F.array_intersect(acc, x)).alias("refs")
    )
    labels = {a.id: a.label for a in space.attributes}
    via_arrays = {
        (labels[r.dep], labels[x]) for r in inter.collect() for x in r.refs if x != r.dep
    }
    assert via_arrays == found(spark, tables, "trimmed")


try:
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    VALUES = st.sampled_from(["1", "2", "3", " 1", "1\t", "", None, "01", "x"])

    @settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
    @given(
        st.lists(
            st.lists(st.lists(VALUES, min_size=3, max_size=3), min_size=1, max_size=5),
            min_size=1,
            max_size=3,
        )
    )
    def test_generated_tables_against_brute_force(spark, table_rows):
        tables = {}
        for t, rows in enumerate(table_rows):
            names = [f"c{(t * 2 + j) % 5}" for j in range(3)]
            names = [n if names.index(n) == j else f"{n}_{j}" for j, n in enumerate(names)]
            tables[f"t{t}"] = {n: [r[j] for r in rows] for j, n in enumerate(names)}
        for preset in ("trimmed", "strict"):
            expected, _ = brute(tables, preset)
            assert found(spark, tables, preset) == expected, preset

except ImportError:  # hypothesis is optional
    pass


def test_columns_without_text_form_are_not_skipped_silently(spark):
    tables = {"t": spark.createDataFrame([(1, [1])], "a int, b array<int>")}
    with pytest.raises(ValueError, match="b of t"):
        A.AttributeSpace.build(spark, tables, A.STRICT)
    assert len(A.AttributeSpace.build(spark, tables, A.STRICT, {"t": ["a"]}).attributes) == 1
