"""Maximal n-ary inclusion dependencies by cliques of compatible unary ones.

The definition is that of ``nary.py``: the tuples of the dependent columns
are tuples of the referenced ones, and so for every choice of fewer columns.
That makes the INDs between two tables a family closed under leaving columns
out, which its maximal members describe.  They are found from above, not
level by level (Koeller and Rundensteiner's cliques, De Marchi and Petit's
use of the error):

1. Unary INDs are nodes and binary INDs are edges; a larger IND is a clique,
   so the maximal cliques are the first candidates.
2. All candidates, whatever their arity, are tested in one pass, which also
   gives their error: the share of dependent tuples that are missing.
3. A failed candidate with a small error is replaced by its parts with one
   pair less.  One with a large error is held back, while its parts of three
   pairs (then four, and so on) are tested; any that fail split it.
4. The search ends when every candidate holds.  A table of five columns that
   all belong together takes three passes (one, two, five columns), not five.

A pass unpivots each column tuple (a *side*) to ``(side, digest of the
tuple)``, groups by digest into the set of sides that hold the tuple (bits, by
``bit_or``, so a tuple is sent once a map task), counts the distinct sets, and
joins them with the list of candidates.  It looks at one slice of the tuples'
hash space first: a tuple that is missing there refutes its candidate, and the
slice tells the error; only candidates without one meet all tuples.  Plan text
grows linearly with the sides.  What the driver holds (unary and binary INDs,
candidates, their errors) is bounded by the schema.
"""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesift.functions.text import quote_name
from tablesift.operators.attributes import BITS_PER_WORD, TRIMMED, UNPIVOT_CHUNK, IndOptions, inline_chunks, sql_string
from tablesift.operators.nary import SIDES_CHUNK, _keep_sql, _value_sql, in_slice_sql, level_one
from tablesift.plans.partitioning import spread

# a candidate that misses at most this share of its dependent tuples is narrowed from above
NARROW = 0.1

Pair = tuple[str, str]  # dependent column, referenced column
Parts = frozenset[Pair]


def maximal_cliques(nodes: Iterable[Pair], near: dict[Pair, set[Pair]]) -> list[Parts]:
    """Every maximal clique of a graph given by neighbours."""
    found = []
    stack = [(frozenset(), set(nodes), set())]
    while stack:
        clique, open_, done = stack.pop()
        if not open_ and not done:
            found.append(clique)
            continue
        # cliques without the busiest node's neighbours hold the node itself or a stranger of it
        busiest = max(sorted(open_ | done), key=lambda n: len(near[n] & open_))
        for n in sorted(open_ - near[busiest]):
            stack.append((clique | {n}, open_ & near[n], done & near[n]))
            open_ = open_ - {n}
            done = done | {n}
    return found


def without(parts: Parts, failed: Iterable[Parts]) -> set[Parts]:
    """The maximal subsets of ``parts`` that include none of ``failed``."""
    kept = {parts}
    for f in failed:
        hit = {p for p in kept if f <= p}
        if hit:
            smaller = {p - {one} for p in hit for one in f}
            kept = kept - hit
            kept |= {p for p in smaller if not any(p <= k for k in kept)}
            kept = {p for p in kept if not any(p < k for k in kept)}
    return kept


class CliqueSearch:
    """One search over a set of tables; ``passes`` counts its passes over the data, the unary one included."""

    def __init__(self, spark: SparkSession, tables: dict[str, DataFrame], options: IndOptions):
        self.spark, self.tables, self.options = spark, tables, options
        self.passes = 0
        # (dependent table, referenced table, pairs) -> share of dependent tuples that are missing; None without tuples
        self.error: dict[tuple[str, str, Parts], float | None] = {}
        self.whole: set[tuple[str, str]] = set()

    def find_whole_columns(self, columns: dict[str, set[str]]) -> None:
        """Notes the (table, column) of which the preset keeps every cell."""
        parts = []
        for table, used in columns.items():
            kept = [F.expr(f"coalesce(bool_and({_keep_sql(self.options, c)}), true)").alias(f"k{i}") for i, c in enumerate(sorted(used))]
            norm = self.normalised(table, used)
            entries = [f"named_struct('t', {sql_string(table)}, 'c', {sql_string(c)}, 'k', k{i})" for i, c in enumerate(sorted(used))]
            parts.extend(inline_chunks(norm.agg(*kept), entries))
        rows = reduce(DataFrame.unionByName, parts).where("k").collect()
        self.whole = {(r["t"], r["c"]) for r in rows}

    def normalised(self, table: str, columns: Iterable[str]) -> DataFrame:
        df = self.tables[table]
        return df.selectExpr(*[f"{_value_sql(self.options, df, c)} AS {quote_name(c)}" for c in sorted(columns)])

    def to_test(self, dt: str, parts: Parts) -> set[Parts]:
        """The column choices whose containment makes all of ``parts`` an IND.

        A row lacks only cells of columns that aren't whole, so each choice of
        those is tested beside the whole ones, and smaller ones follow.
        """
        whole = frozenset(p for p in parts if (dt, p[0]) in self.whole)
        rest = sorted(parts - whole)
        chosen = itertools.chain.from_iterable(itertools.combinations(rest, n) for n in range(len(rest) + 1))
        return {c for c in (whole | frozenset(some) for some in chosen) if len(c) > 1}

    def error_of(self, dt: str, rt: str, parts: Parts) -> float | None:
        """The largest error of the tests of ``parts``; None where no dependent row has all its cells."""
        if self.error[dt, rt, parts] is None:
            return None
        # choices of one pair are unary INDs, which hold
        return max((self.error[dt, rt, c] or 0.0) for c in self.to_test(dt, parts) | {parts})

    def holds(self, dt: str, rt: str, parts: Parts) -> bool:
        return self.error_of(dt, rt, parts) == 0

    def test(self, wanted: Iterable[tuple[str, str, Parts]]) -> None:
        """Fills ``error`` for the candidates and the choices they depend on, in one pass."""
        todo = {(dt, rt, c) for dt, rt, parts in wanted for c in self.to_test(dt, parts) | {parts}} - set(self.error)
        if not todo:
            return
        self.passes += 1
        first = self.measured(todo, whole=False)
        self.error |= {c: error for c, error in first.items() if error}
        self.error |= self.measured([c for c, error in first.items() if not error], whole=True)

    def measured(self, todo: Iterable[tuple[str, str, Parts]], whole: bool) -> dict[tuple[str, str, Parts], float | None]:
        """The share of dependent tuples that are missing, of all or of those in the first slice; None without tuples."""
        if not todo:
            return {}
        listed = sorted((dt, rt, tuple(sorted(parts))) for dt, rt, parts in todo)
        ends = [((dt, tuple(a for a, _ in parts)), (rt, tuple(b for _, b in parts))) for dt, rt, parts in listed]
        side_ids = {side: i for i, side in enumerate(sorted({s for both in ends for s in both}))}
        by_table = defaultdict(list)
        for (table, cols), i in side_ids.items():
            by_table[table].append((i, cols))
        rows = []
        for table, sides in sorted(by_table.items()):
            norm = spread(self.normalised(table, {c for _, cols in sides for c in cols}))
            entries = []
            for i, cols in sides:
                keep = " AND ".join([_keep_sql(self.options, c) for c in cols] + ([] if whole else [in_slice_sql(cols)]))
                # a list as JSON tells null from text and where each cell ends
                key = f"unhex(sha2(to_json(array({', '.join(quote_name(c) for c in cols)})), 256))"
                word, bit = divmod(i, BITS_PER_WORD)
                entries.append(f"named_struct('word', {word}, 'bits', shiftleft(1L, {bit}), 'key', if({keep}, {key}, NULL))")
            rows.extend(inline_chunks(norm, entries, min(UNPIVOT_CHUNK, max(SIDES_CHUNK, len(entries) // 8))))
        tuples = reduce(DataFrame.unionByName, rows).where("key IS NOT NULL")
        words = [f"w{j}" for j in range(-(-len(side_ids) // BITS_PER_WORD))]
        bits = [F.coalesce(F.bit_or(F.when(F.col("word") == j, F.col("bits"))), F.lit(0)).alias(w) for j, w in enumerate(words)]
        sets = tuples.groupBy("key").agg(*bits).groupBy(*words).agg(F.count("*").alias("n"))
        bit_of = f"shiftright(array({', '.join(words)})[cast(a div {BITS_PER_WORD} as int)], a % {BITS_PER_WORD}) & 1"
        sets = sets.select("n", F.expr(f"filter(sequence(0, {len(side_ids) - 1}), a -> ({bit_of}) = 1)").alias("sides"))
        candidates = self.spark.createDataFrame([(i, side_ids[d], side_ids[r]) for i, (d, r) in enumerate(ends)], "candidate int, dep int, ref int")
        met = sets.select("sides", "n", F.explode("sides").alias("dep")).join(candidates, "dep")
        lacking = F.when(~F.array_contains("sides", F.col("ref")), F.col("n")).otherwise(0)
        found = met.groupBy("candidate").agg(F.sum("n").alias("n"), F.sum(lacking).alias("lacking")).collect()
        shares = {r["candidate"]: r["lacking"] / r["n"] for r in found}
        return {(dt, rt, frozenset(parts)): shares.get(i) for i, (dt, rt, parts) in enumerate(listed)}

    def run(self) -> list[tuple[str, str, Parts]]:
        """Every maximal IND of arity 2 and up."""
        unary = defaultdict(set)
        self.passes += 1
        for r in level_one(self.spark, self.tables, self.options).collect():
            unary[r["dt"], r["rt"]].add((r["dcols"][0], r["rcols"][0]))
        edges = [
            (dt, rt, frozenset([p, q]))
            for (dt, rt), nodes in unary.items()
            for p, q in itertools.combinations(sorted(nodes), 2)
            if p[0] != q[0] and p[1] != q[1]
        ]
        if not edges:
            return []
        columns = defaultdict(set)
        for dt, _, parts in edges:
            columns[dt] |= {a for a, _ in parts}
        self.find_whole_columns(columns)
        self.test(edges)
        near = {ends: {n: set() for n in nodes} for ends, nodes in unary.items()}
        for dt, rt, parts in edges:
            if self.holds(dt, rt, parts):
                p, q = parts
                near[dt, rt][p].add(q)
                near[dt, rt][q].add(p)
        open_ = {ends: {c for c in maximal_cliques(nodes, near[ends]) if len(c) > 1} for ends, nodes in unary.items()}
        # held back: candidate -> pairs of the parts that are tested in its place
        held: dict[tuple[str, str, Parts], int] = {}
        while True:
            wanted = set()
            for (dt, rt), candidates in open_.items():
                for c in candidates:
                    if (dt, rt, c) in held:
                        wanted |= {(dt, rt, frozenset(s)) for s in itertools.combinations(sorted(c), held[dt, rt, c])}
                    else:
                        wanted.add((dt, rt, c))
            self.test(wanted)
            changed = False
            for (dt, rt), candidates in open_.items():
                failed = []
                for w in wanted:
                    if w[:2] == (dt, rt) and w not in held and not self.holds(*w):
                        error, small = self.error_of(*w), len(w[2]) <= 4
                        if w[2] in candidates and not small and (error is None or error > NARROW):
                            held[w] = 3
                            changed = True
                        else:
                            failed.append(w[2])
                for c in [c for c in candidates if (dt, rt, c) in held]:
                    if not any(f <= c for f in failed) and all((dt, rt, frozenset(s)) in self.error for s in itertools.combinations(sorted(c), held[dt, rt, c])):
                        # its parts of that many pairs hold: on to larger ones, at last to those with one pair less
                        held[dt, rt, c] += 1
                        changed = True
                        if held[dt, rt, c] == len(c):
                            failed.append(c)
                if failed:
                    changed = True
                    parts = set().union(*[without(c, sorted(failed, key=len)) for c in candidates])
                    open_[dt, rt] = {p for p in parts if len(p) > 1 and not any(p < q for q in parts)}
            if not changed:
                break
        return [(dt, rt, c) for (dt, rt), candidates in sorted(open_.items()) for c in sorted(candidates, key=sorted)]


def maximal_nary_inds(spark: SparkSession, tables: dict[str, DataFrame], options: IndOptions = TRIMMED) -> DataFrame:
    """Maximal INDs of arity 2 and up, in the columns of ``nary.nary_inds``.

    Every IND of ``nary_inds`` is one of these with columns left out, and every
    choice of two or more columns of these is one of ``nary_inds``.  Defined
    results: tables without rows, or columns of which no cell is kept, have no
    INDs; a column never refers to itself; repeated rows count once.
    """
    rows = []
    for dt, rt, parts in CliqueSearch(spark, tables, options).run():
        pairs = sorted(parts)
        rows.append((dt, ", ".join(a for a, _ in pairs), rt, ", ".join(b for _, b in pairs), len(pairs)))
    schema = "dependent_table string, dependent_columns string, referenced_table string, referenced_columns string, arity int"
    return spark.createDataFrame(rows, schema)
