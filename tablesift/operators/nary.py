"""n-ary inclusion dependencies, level by level.

``T(a1..ak) < U(b1..bk)``: every value *tuple* of columns a1..ak of table T
(rows where every part is kept by the preset) is a tuple of columns b1..bk
of table U, and every (k-1)-column projection is itself an IND (for k = 2:
both unary INDs hold).  With nulls dropped per tuple the tuple condition
alone is not closed under projection, so the projection condition is part
of the definition; level-wise search is exact for it.  Dependent columns
are in name order; referenced columns align with them position by
position.

Level k+1 candidates come from pairs of valid level-k INDs with the same
tables and the same first k-1 columns on both sides (a DataFrame join over
the IND list).  Each candidate is then tested by the same value-grouping plan
as unary INDs, only with tuples as values: every *side* (a column tuple of
one table) is a bit, ``groupBy(tuple)`` + ``bit_or`` gives each tuple's side
set, the distinct sets are ``bit_and``-ed per dependent side, and a candidate
holds when its referenced side's bit survives.

Most candidates fail, and most of those on any part of their tuples.  So a
level is tested twice: all candidates on the tuples of one slice of the hash
space, where a tuple that the referenced side lacks is one it lacks
altogether, then the candidates that are left on all tuples.

The list of sides is collected to build the projections: it is bounded by
the schema (column tuples named by candidates), not by the data.
"""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesift.functions.text import quote_name
from tablesift.operators.attributes import (
    BITS_PER_WORD,
    BROADCAST_ATTRIBUTE_LIMIT,
    JAVA_TRIM_SQL,
    TRIMMED,
    AttributeSpace,
    IndOptions,
    inline_chunks,
    needs_trim,
    sql_string,
)
from tablesift.operators.ind import unary_inds
from tablesift.plans.partitioning import materialize, spread


# the tuples looked at first are about one in this many
FIRST_SLICE = 64
# sides per unpivot: what one row of a table becomes should be compiled as one method
SIDES_CHUNK = 8


def _by_position(options: IndOptions) -> IndOptions:
    return replace(options, name=options.name + "_by_position", merge_same_names=False)


def _value_sql(options: IndOptions, df: DataFrame, col: str) -> str:
    v = f"CAST({quote_name(col)} AS STRING)"
    if options.trim and needs_trim(df.schema[col].dataType):
        v = f"trim(BOTH {JAVA_TRIM_SQL} FROM {v})"
    return v


def _keep_sql(options: IndOptions, col: str) -> str:
    c = quote_name(col)
    conds = ["true"]
    if options.drop_null:
        conds.append(f"{c} IS NOT NULL")
    if options.drop_blank:
        conds.append(f"coalesce({c} <> '', {'false' if options.drop_null else 'true'})")
    if options.missing is not None:
        conds.append(f"NOT ({c} <=> {sql_string(options.missing)})")
    return "(" + " AND ".join(conds) + ")"


def level_one(spark: SparkSession, tables: dict[str, DataFrame], options: IndOptions) -> DataFrame:
    """Unary INDs as ``(dt, dcols, rt, rcols)`` with one-element arrays."""
    space = AttributeSpace.build(spark, tables, _by_position(options))
    u = unary_inds(space)
    return u.select(
        F.col("dependent_table").alias("dt"),
        F.array("dependent_column").alias("dcols"),
        F.col("referenced_table").alias("rt"),
        F.array("referenced_column").alias("rcols"),
    )


def next_candidates(inds: DataFrame, k: int) -> DataFrame:
    """Level k+1 candidates from level k INDs (arrays of length k)."""
    a, b = inds.alias("a"), inds.alias("b")
    cond = (F.col("a.dt") == F.col("b.dt")) & (F.col("a.rt") == F.col("b.rt"))
    if k > 1:
        cond = cond & (F.slice("a.dcols", 1, k - 1) == F.slice("b.dcols", 1, k - 1))
        cond = cond & (F.slice("a.rcols", 1, k - 1) == F.slice("b.rcols", 1, k - 1))
    x, z = F.element_at("a.dcols", k), F.element_at("b.dcols", k)
    y, w = F.element_at("a.rcols", k), F.element_at("b.rcols", k)
    cond = cond & (x < z) & (y != w) & ~F.array_contains(F.col("a.rcols"), w)
    cands = a.join(b, cond).select(
        F.col("a.dt").alias("dt"),
        F.concat(F.col("a.dcols"), F.array(z)).alias("dcols"),
        F.col("a.rt").alias("rt"),
        F.concat(F.col("a.rcols"), F.array(w)).alias("rcols"),
    )
    # The two generating INDs are the projections without the last and the
    # second-to-last column; every other k-column projection must be a
    # level-k IND as well (semi joins on the small IND list).
    for i in range(1, k):
        drop_d = F.concat(F.slice("dcols", 1, i - 1), F.slice("dcols", i + 1, k + 1 - i)) if i > 1 else F.slice("dcols", 2, k)
        drop_r = F.concat(F.slice("rcols", 1, i - 1), F.slice("rcols", i + 1, k + 1 - i)) if i > 1 else F.slice("rcols", 2, k)
        proj = cands.select("*", drop_d.alias("pd"), drop_r.alias("pr"))
        known = inds.select(F.col("dt").alias("kdt"), F.col("dcols").alias("pd"), F.col("rt").alias("krt"), F.col("rcols").alias("pr"))
        cands = proj.join(
            known,
            (proj["dt"] == known["kdt"]) & (proj["rt"] == known["krt"]) & (proj["pd"] == known["pd"]) & (proj["pr"] == known["pr"]),
            "left_semi",
        ).select("dt", "dcols", "rt", "rcols")
    return cands


def in_slice_sql(cols) -> str:
    """Condition on the normalised columns of a side: its tuple is of the slice that is looked at first."""
    return f"pmod(xxhash64({', '.join(quote_name(c) for c in cols)}), {FIRST_SLICE}) = 0"


def test_candidates(
    spark: SparkSession, tables: dict[str, DataFrame], options: IndOptions, cands: DataFrame, k: int
) -> DataFrame:
    """Keep the candidates whose dependent tuples all occur as referenced
    tuples: those that the first slice doesn't refute are tested on all tuples."""
    left = materialize(_unrefuted(spark, tables, options, cands, k))
    return _unrefuted(spark, tables, options, left, k, whole=True)


def _unrefuted(
    spark: SparkSession, tables: dict[str, DataFrame], options: IndOptions, cands: DataFrame, k: int, whole: bool = False
) -> DataFrame:
    """One value-grouping pass for all candidates of the level, over the first slice or over all tuples.
    Without a dependent tuple a candidate stays open in a slice, and fails on the whole."""
    # The candidates are read twice (side list, then the test): materialise
    # them once, in the shared checkpoint folder when the session names one.
    cands = materialize(cands)
    sides_rows = (
        cands.select(F.col("dt").alias("t"), F.col("dcols").alias("cols"))
        .union(cands.select(F.col("rt").alias("t"), F.col("rcols").alias("cols")))
        .distinct()
        .collect()
    )
    sides = sorted((r["t"], tuple(r["cols"])) for r in sides_rows)
    if not sides:
        return cands.limit(0)
    n_words = -(-len(sides) // BITS_PER_WORD)
    words = [f"w{j}" for j in range(n_words)]
    vals = [f"v{i}" for i in range(k)]

    def bits(side_id):
        word, bit = divmod(side_id, BITS_PER_WORD)
        return "".join(
            f"'{wc}', " + (f"shiftleft(1L, {bit}), " if j == word else "0L, ") for j, wc in enumerate(words)
        )

    parts = []
    for table, df in tables.items():
        mine = [(sid, cols) for sid, (t, cols) in enumerate(sides) if t == table]
        if not mine:
            continue
        used = sorted({c for _, cols in mine for c in cols})
        # Normalise each used column once; the tuple structs then only
        # reference plain columns (keeps generated code small).
        norm = spread(df.selectExpr(*[f"{_value_sql(options, df, c)} AS {quote_name(c)}" for c in used]))
        entries = []
        for sid, cols in mine:
            keep = " AND ".join([_keep_sql(options, c) for c in cols] + ([] if whole else [in_slice_sql(cols)]))
            values = "".join(f", '{vals[i]}', {quote_name(c)}" for i, c in enumerate(cols))
            entries.append(f"named_struct({bits(sid)}'keep', {keep}{values})")
        parts.extend(inline_chunks(norm, entries, SIDES_CHUNK))
    tuples = reduce(DataFrame.unionByName, parts).where(F.col("keep")).drop("keep")
    sets = (
        tuples.groupBy(*vals)
        .agg(*[F.bit_or(wc).alias(wc) for wc in words])
        .groupBy(*words)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    warr = "array(" + ", ".join(words) + ")"
    members = F.expr(
        f"filter(sequence(0, {len(sides) - 1}), "
        f"a -> (shiftright({warr}[cast(a div {BITS_PER_WORD} as int)], a % {BITS_PER_WORD}) & 1) = 1)"
    )
    masks = sets.select(F.explode(members).alias("dep_side"), *words).groupBy("dep_side").agg(
        *[F.bit_and(wc).alias(wc) for wc in words]
    )
    # Built JVM-side from literals (no Python workers for a handful of rows).
    side_rows = ", ".join(
        f"named_struct('sid', {i}, 't', {sql_string(t)}, 'cols', array({', '.join(sql_string(c) for c in cols)}))"
        for i, (t, cols) in enumerate(sides)
    )
    side_ids = spark.range(1).select(F.expr(f"inline(array({side_rows}))"))
    dep_ids = side_ids.select(F.col("sid").alias("dep_side"), F.col("t").alias("dt"), F.col("cols").alias("dcols"))
    ref_ids = side_ids.select(F.col("sid").alias("ref_side"), F.col("t").alias("rt"), F.col("cols").alias("rcols"))
    # Side tables have one row per column tuple named by a candidate, a
    # schema-bounded size; broadcast below the same bound as attribute frames.
    small = (lambda d: F.broadcast(d)) if len(sides) <= BROADCAST_ATTRIBUTE_LIMIT else (lambda d: d)
    tagged = cands.join(small(dep_ids), ["dt", "dcols"]).join(small(ref_ids), ["rt", "rcols"])
    tested = tagged.join(masks, "dep_side", "inner" if whole else "left")
    holds = F.expr(
        f"(shiftright({warr}[cast(ref_side div {BITS_PER_WORD} as int)], ref_side % {BITS_PER_WORD}) & 1) = 1"
    )
    return tested.where(holds if whole else F.coalesce(holds, F.lit(True))).select("dt", "dcols", "rt", "rcols")


def nary_inds(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    options: IndOptions = TRIMMED,
    max_level: int | None = None,
) -> DataFrame:
    """INDs of arity 2 and up: ``dependent_table``, ``dependent_columns``,
    ``referenced_table``, ``referenced_columns`` (columns comma-joined),
    ``arity``.  The search ends with the first level that has none, or after
    ``max_level``, if the caller names one.

    Each level is planned after the previous level's result is known; that
    result is small (bounded by the number of column tuples) and is
    materialised (checkpointed to the shared folder named by
    ``spark.checkpoint.dir``, else cached) before it is joined with itself
    or returned, so no level is computed twice.
    """
    if max_level is not None and max_level < 2:
        raise ValueError("max_level must be at least 2")
    current = materialize(level_one(spark, tables, options))
    found = []
    k = 1
    while max_level is None or k < max_level:
        cands = next_candidates(current, k)
        if cands.isEmpty():
            break
        current = materialize(test_candidates(spark, tables, options, cands, k + 1))
        if current.isEmpty():
            break
        k += 1
        found.append(current.withColumn("arity", F.lit(k)))
    if not found:
        found = [current.limit(0).withColumn("arity", F.lit(2))]
    out = reduce(DataFrame.unionByName, found)
    return out.select(
        F.col("dt").alias("dependent_table"),
        F.array_join("dcols", ", ").alias("dependent_columns"),
        F.col("rt").alias("referenced_table"),
        F.array_join("rcols", ", ").alias("referenced_columns"),
        F.col("arity"),
    )
