"""Unary inclusion dependencies (INDs) and the operators around them.

``A < B`` (A is included in B) holds when every value of attribute A is also
a value of attribute B.  Discovery follows the SINDY idea (Kruse,
Papenbrock, Naumann, BTW 2015): group all cells by value, so that every value
yields the set of attributes holding it; A < B holds iff B is in every set
that holds A.  Here that intersection is a ``bit_and`` aggregate per
attribute over the *distinct* attribute sets (see ``attributes.py``), so the
plan never builds pair lists inside a set and never collects a group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesift.functions.text import bracket_list, file_stem
from tablesift.operators.attributes import AttributeSpace, attribute_profile_ids, distinct_sets
from tablesift.plans.partitioning import materialize

def reference_masks(space: AttributeSpace) -> DataFrame:
    """``(dep, w0..wK)``: for every attribute with at least one value, the
    intersection of all attribute sets holding it (its own bit included)."""
    sets = distinct_sets(space)
    per_dep = sets.select(F.explode(space.members()).alias("dep"), *space.word_cols)
    return per_dep.groupBy("dep").agg(*[F.bit_and(w).alias(w) for w in space.word_cols])


def _ref_only_masks(space: AttributeSpace) -> DataFrame:
    """Reference masks without the attribute's own bit."""
    return reference_masks(space).select("dep", *space.clear_own_bit("dep"))


def unary_ind_ids(space: AttributeSpace) -> DataFrame:
    """``(dep, ref)`` attribute ids of every unary IND."""
    masks = _ref_only_masks(space)
    return masks.select("dep", F.explode(space.members()).alias("ref"))


def unary_inds(space: AttributeSpace) -> DataFrame:
    """Every unary IND as one row: ``dependent[_table, _column]``,
    ``referenced[_table, _column]``."""
    return unary_ind_ids(space).select(
        *space.label_columns("dep", "dependent"), *space.label_columns("ref", "referenced")
    )


def ind_lines_grouped(space: AttributeSpace) -> DataFrame:
    """One text line per dependent: ``DEP < REF1, REF2`` with the referenced
    attributes in name order (attribute ids follow name order)."""
    masks = _ref_only_masks(space)
    labels = space.label_array()
    refs = F.transform(space.members(), lambda i: F.element_at(labels, i + 1))
    line = F.concat(F.element_at(labels, F.col("dep") + 1), F.lit(" < "), F.array_join(refs, ", "))
    return masks.where(F.size(space.members()) > 0).select(line.alias("line"))


def ind_lines_pairs(space: AttributeSpace) -> DataFrame:
    """One text line per IND in the record format
    ``depFile -> refFile: [depCol] c [refCol]`` (file name cut at its first dot).

    Needs (table, column) identity (preset ``strict``)."""
    if not space.by_position:
        raise ValueError("pair lines need attributes keyed by (table, column)")
    pairs = unary_ind_ids(space).select(
        *space.label_columns("dep", "d"), *space.label_columns("ref", "r")
    )
    line = F.concat(
        file_stem(F.col("d_table")),
        F.lit(" -> "),
        file_stem(F.col("r_table")),
        F.lit(": "),
        bracket_list(F.array(F.col("d_column"))),
        F.lit(" c "),
        bracket_list(F.array(F.col("r_column"))),
    )
    return pairs.select(line.alias("line"))


def ind_candidates(space: AttributeSpace, profile: DataFrame | None = None) -> DataFrame:
    """All ordered attribute pairs but self pairs (the task list of a
    pairwise tester), with each side's distinct-value count and the cheap
    necessary condition ``n_dependent <= n_referenced``.

    The pair list is generated per attribute by ``explode`` over the other
    attribute ids, so the work is one row per output pair; counts come from a
    single aggregate over the data.
    """
    # One row per attribute, read twice below (dependent and referenced side).
    counts = materialize(attribute_profile_ids(space) if profile is None else profile)
    all_ids = F.array(*[F.lit(a.id) for a in space.attributes]) if space.size else F.array().cast("array<int>")
    deps = counts.select(F.col("attr_id").alias("dep"), F.col("n_distinct").alias("n_dependent"))
    pairs = deps.select(
        "dep", "n_dependent", F.explode(F.filter(all_ids, lambda r: r != F.col("dep"))).alias("ref")
    )
    refs = space.small(counts.select(F.col("attr_id").alias("ref"), F.col("n_distinct").alias("n_referenced")))
    joined = pairs.join(refs, "ref", "left")
    n_ref = F.coalesce(F.col("n_referenced"), F.lit(0)).cast("long")
    return joined.select(
        *space.label_columns("dep", "dependent"),
        *space.label_columns("ref", "referenced"),
        F.col("n_dependent").cast("long").alias("n_dependent"),
        n_ref.alias("n_referenced"),
        (F.col("n_dependent") <= n_ref).alias("size_ok"),
    )


def ind_check(space: AttributeSpace, pairs: list[tuple[str, str]]) -> DataFrame:
    """Test named (dependent, referenced) pairs: distinct dependent values
    and how many of them the referenced attribute lacks.

    All pairs are settled by one value-grouping pass over only the columns
    involved (``AttributeSpace.restrict``), not by one anti join per pair.
    """
    labels = sorted({lbl for pair in pairs for lbl in pair})
    sub = space.restrict(labels)
    sets = distinct_sets(sub)
    aggs = []
    for i, (d, r) in enumerate(pairs):
        dep, ref = sub.find(d), sub.find(r)
        has_dep = sub.bit_test(dep.id)
        lacks_ref = ~sub.bit_test(ref.id)
        aggs.append(F.sum(F.when(has_dep, F.col("n_values"))).alias(f"d{i}"))
        aggs.append(F.sum(F.when(has_dep & lacks_ref, F.col("n_values"))).alias(f"m{i}"))
    totals = sets.agg(*aggs)
    rows = F.array(
        *[
            F.struct(
                F.lit(d).alias("dependent"),
                F.lit(r).alias("referenced"),
                F.coalesce(F.col(f"d{i}"), F.lit(0)).cast("long").alias("n_dependent"),
                F.coalesce(F.col(f"m{i}"), F.lit(0)).cast("long").alias("n_missing"),
            )
            for i, (d, r) in enumerate(pairs)
        ]
    )
    out = totals.select(F.inline(rows))
    return out.withColumn("is_ind", (F.col("n_missing") == 0) & (F.col("n_dependent") > 0))


def ind_implied(space: AttributeSpace) -> DataFrame:
    """INDs ``a < c`` implied by a third attribute ``b`` with ``a < b`` and
    ``b < c`` (the transitivity shortcut of a pairwise tester).

    Works on reference masks: OR of ``refs(b)`` over ``b`` in ``refs(a)``, so
    the join emits one row per IND, never per path.
    """
    # One row per attribute, read twice below (edges and lookup side).
    masks = materialize(_ref_only_masks(space))
    edges = masks.select("dep", F.explode(space.members()).alias("mid"))
    nxt = space.small(masks.select(F.col("dep").alias("mid"), *space.word_cols))
    reach = edges.join(nxt, "mid").groupBy("dep").agg(*[F.bit_or(w).alias(w) for w in space.word_cols])
    implied = reach.select("dep", F.explode(space.members()).alias("ref")).where(F.col("ref") != F.col("dep"))
    return implied.select(*space.label_columns("dep", "dependent"), *space.label_columns("ref", "referenced"))


def ind_records(inds: DataFrame) -> DataFrame:
    """INDs as records ``struct(dependent_table, dependent_columns array,
    referenced_table, referenced_columns array)``, deduplicated.

    Takes the output of ``unary_inds`` over a (table, column) space; records
    compare by value (tables and column lists), so ``dropDuplicates`` is the
    set semantics of the record type.
    """
    rec = F.struct(
        F.col("dependent_table").alias("dependent_table"),
        F.array("dependent_column").alias("dependent_columns"),
        F.col("referenced_table").alias("referenced_table"),
        F.array("referenced_column").alias("referenced_columns"),
    )
    return inds.select(rec.alias("ind")).dropDuplicates(["ind"])
