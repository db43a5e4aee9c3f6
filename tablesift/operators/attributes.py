"""Attribute catalogue and the value-grouping plan behind every IND operator.

An *attribute* is a column seen as the set of its distinct (text) values.
Two presets decide what counts as an attribute and as a value:

* ``TRIMMED`` - attribute = bare column name (same-named columns of several
  tables merge into one attribute); values are cast to text, trimmed like
  Java's ``String.trim``; nulls and blanks are dropped.
* ``STRICT`` - attribute = (table, column); raw text; null is one value of
  its own and blank is kept.

Plan shape (one lazy DataFrame plan, three shuffles):

1. one scan per table, ``inline(array(named_struct(word, bits, v)))`` (SQL
   text of a fixed shape) unpivots every cell to (value, attribute bit);
2. ``groupBy(value)`` + one ``bit_or`` per mask word (pivoting ``bits`` by
   ``word``) -> the attribute set of every value (hash aggregate with map-side
   partial aggregation, so a value that sits in a third of all rows still
   costs one row per map task);
3. ``groupBy(mask words)`` + ``count`` -> distinct attribute sets with the
   number of values having exactly that set.  This table is tiny in practice
   (it is bounded by the number of distinct values, not by rows) and every
   later step works on it.

Attributes are bits in ``bigint`` words, 64 per word; the number of words
grows with the number of attributes, so wide schemas only add aggregate
columns, and the plan text grows linearly with the number of attributes.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesift.functions.text import quote_name
from tablesift.plans.partitioning import spread

BITS_PER_WORD = 64

# Frames with one row per attribute are bounded by the schema width, not by
# the data; up to this many attributes they are broadcast, beyond it the
# planner chooses (shuffle join).
BROADCAST_ATTRIBUTE_LIMIT = 200_000

# Structs per ``inline`` call.  One generated method per unpivot must stay
# under the JVM's code-size limits; wider tables are split into several
# selects of the same table, each reading only its own columns.
UNPIVOT_CHUNK = 64


def inline_chunks(df: DataFrame, entries: list[str], size: int = UNPIVOT_CHUNK) -> list[DataFrame]:
    """``df.select(inline(array(*entries)))`` split into chunks; entries are
    ``named_struct`` SQL texts of one shape."""
    return [
        df.select(F.expr("inline(array(" + ", ".join(entries[i : i + size]) + "))"))
        for i in range(0, len(entries), size)
    ]


def sql_string(text: str) -> str:
    """A Spark SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


# Fixed value: Java's trim set (chars U+0000..U+0020) as a SQL literal.
JAVA_TRIM_SQL = "'" + "".join(f"\\u{i:04x}" for i in range(0x21)) + "'"


@dataclass(frozen=True)
class IndOptions:
    """How columns become attributes and cells become values."""

    name: str
    merge_same_names: bool  # attribute identity: bare name (True) or (table, column)
    trim: bool  # Java-style trim of both ends
    drop_null: bool
    drop_blank: bool  # blank = empty string after the optional trim
    missing: str | None = None  # text that stands for a cell that isn't there, dropped by every preset


TRIMMED = IndOptions("trimmed", merge_same_names=True, trim=True, drop_null=True, drop_blank=True)
STRICT = IndOptions("strict", merge_same_names=False, trim=False, drop_null=False, drop_blank=False)
PRESETS = {"trimmed": TRIMMED, "strict": STRICT}


def is_profilable(dtype: T.DataType) -> bool:
    """Atomic types whose text form is a meaningful value (no arrays, maps,
    structs, binaries or vectors)."""
    return isinstance(
        dtype,
        (
            T.StringType,
            T.NumericType,
            T.BooleanType,
            T.DateType,
            T.TimestampType,
            T.TimestampNTZType,
        ),
    )


def needs_trim(dtype: T.DataType) -> bool:
    """Only text can carry outer whitespace: numbers, dates, timestamps and
    booleans cast to text never start or end with a char <= U+0020."""
    return isinstance(dtype, T.StringType)


@dataclass(frozen=True)
class Attribute:
    id: int
    table: str | None  # None when the attribute merges columns of several tables
    column: str
    sources: tuple[tuple[str, str], ...]  # (table, column) occurrences

    @property
    def label(self) -> str:
        return self.column if self.table is None else f"{self.table}.{self.column}"


@dataclass
class AttributeSpace:
    """The attributes of a set of tables under one preset.

    Built from table schemas only (driver-side metadata, one entry per
    column); the data itself is only touched by the plans below.
    """

    spark: SparkSession
    tables: dict[str, DataFrame]
    options: IndOptions
    attributes: list[Attribute] = field(default_factory=list)

    @classmethod
    def build(
        cls,
        spark: SparkSession,
        tables: dict[str, DataFrame],
        options: IndOptions = TRIMMED,
        columns: dict[str, list[str]] | None = None,
    ) -> "AttributeSpace":
        occurrences: dict[tuple, list[tuple[str, str]]] = {}
        for table, df in tables.items():
            wanted = None if columns is None else set(columns.get(table, ()))
            for f in df.schema.fields:
                if wanted is not None and f.name not in wanted:
                    continue
                if not is_profilable(f.dataType):
                    raise ValueError(
                        f"column {f.name} of {table} is {f.dataType.simpleString()}, which has no text form to compare: "
                        "cast it, or name the columns to profile"
                    )
                key = (f.name,) if options.merge_same_names else (table, f.name)
                occurrences.setdefault(key, []).append((table, f.name))
        attrs = []
        # Ids follow name order, so decoding a mask in bit order lists
        # attributes sorted by name (used by the grouped text lines).
        for i, key in enumerate(sorted(occurrences)):
            srcs = tuple(occurrences[key])
            if options.merge_same_names:
                table = srcs[0][0] if len({t for t, _ in srcs}) == 1 else None
                attrs.append(Attribute(i, table, key[0], srcs))
            else:
                attrs.append(Attribute(i, key[0], key[1], srcs))
        if options.merge_same_names:
            # With merged names the label is the bare column name.
            attrs = [Attribute(a.id, None, a.column, a.sources) for a in attrs]
        return cls(spark, tables, options, attrs)

    # ------------------------------------------------------------------ meta
    @property
    def size(self) -> int:
        return len(self.attributes)

    @property
    def n_words(self) -> int:
        return max(1, -(-self.size // BITS_PER_WORD))

    @property
    def word_cols(self) -> list[str]:
        return [f"w{j}" for j in range(self.n_words)]

    @property
    def by_position(self) -> bool:
        return not self.options.merge_same_names

    def small(self, df: DataFrame) -> DataFrame:
        """Broadcast hint for a frame with at most one row per attribute."""
        return F.broadcast(df) if self.size <= BROADCAST_ATTRIBUTE_LIMIT else df

    def find(self, label: str) -> Attribute:
        for a in self.attributes:
            if a.label == label:
                return a
        raise KeyError(f"unknown attribute {label!r}")

    def restrict(self, labels) -> "AttributeSpace":
        """A space holding only the named attributes (fewer columns scanned)."""
        keep = {self.find(lbl).label for lbl in labels}
        cols: dict[str, list[str]] = {}
        for a in self.attributes:
            if a.label in keep:
                for t, c in a.sources:
                    cols.setdefault(t, []).append(c)
        tables = {t: df for t, df in self.tables.items() if t in cols}
        return AttributeSpace.build(self.spark, tables, self.options, cols)

    def label_array(self, field_name: str = "label") -> Column:
        """Literal array of one label field per attribute id (one SQL
        expression, not one literal column per attribute)."""
        values = [getattr(a, field_name) for a in self.attributes]
        if not values:
            return F.array().cast("array<string>")
        return F.expr("array(" + ", ".join(sql_string(v) for v in values) + ")")

    def label_columns(self, id_col: str, prefix: str) -> list[Column]:
        """Output columns naming an attribute id: ``prefix`` for merged names,
        ``prefix_table`` and ``prefix_column`` for (table, column) identity."""
        idx = F.col(id_col) + 1
        if self.by_position:
            return [
                F.element_at(self.label_array("table"), idx).alias(f"{prefix}_table"),
                F.element_at(self.label_array("column"), idx).alias(f"{prefix}_column"),
            ]
        return [F.element_at(self.label_array("column"), idx).alias(prefix)]

    def label_schema(self, prefix: str) -> list[T.StructField]:
        if self.by_position:
            return [
                T.StructField(f"{prefix}_table", T.StringType()),
                T.StructField(f"{prefix}_column", T.StringType()),
            ]
        return [T.StructField(prefix, T.StringType())]

    # ---------------------------------------------------------------- values
    def value_sql(self, table: str, col: str) -> str:
        """SQL text of the normalised value of one column."""
        v = f"CAST({quote_name(col)} AS STRING)"
        if self.options.trim and needs_trim(self.tables[table].schema[col].dataType):
            v = f"trim(BOTH {JAVA_TRIM_SQL} FROM {v})"
        return v

    def keep_condition(self, v: Column) -> Column | None:
        conds = []
        if self.options.drop_null:
            conds.append(v.isNotNull())
        if self.options.drop_blank:
            conds.append(F.coalesce(v != F.lit(""), F.lit(not self.options.drop_null)))
        if not conds:
            return None
        return reduce(lambda a, b: a & b, conds)

    def unpivot(self, payload, keep_all: bool = False) -> DataFrame:
        """Every cell of every attribute as one row ``(*payload(attr), v)``.

        ``payload(attr)`` returns ``(name, sql)`` pairs of constants for the
        attribute.  One scan per table reads exactly the attribute columns of
        that table.  The structs are SQL text, so a wide table costs one
        expression per chunk rather than one per literal.  Rows the preset
        drops are filtered out unless ``keep_all``; then a boolean ``kept``
        column is added instead.
        """
        parts = []
        for table, df in self.tables.items():
            entries = []
            used = []
            for a in self.attributes:
                for t, c in a.sources:
                    if t == table:
                        fields = "".join(f"{sql_string(n)}, {e}, " for n, e in payload(a))
                        entries.append(f"named_struct({fields}'v', {self.value_sql(t, c)})")
                        used.append(c)
            if entries:
                base = spread(df.select(*[quote_name(c) for c in dict.fromkeys(used)]))
                parts.extend(inline_chunks(base, entries))
        if not parts:
            return self._empty_unpivot(payload)
        rows = reduce(DataFrame.unionByName, parts)
        if self.options.missing is not None:
            rows = rows.where(~F.col("v").eqNullSafe(F.lit(self.options.missing)))
        cond = self.keep_condition(F.col("v"))
        if keep_all:
            return rows.withColumn("kept", cond if cond is not None else F.lit(True))
        return rows if cond is None else rows.where(cond)

    def _empty_unpivot(self, payload) -> DataFrame:
        probe = Attribute(0, None, "", ())
        return self.spark.range(0).selectExpr(
            *[f"{e} AS {quote_name(n)}" for n, e in payload(probe)], "CAST(NULL AS STRING) AS v"
        )

    # ------------------------------------------------------------ bit masks
    def bit_payload(self, attr: Attribute) -> list[tuple[str, str]]:
        """The attribute's bit as (mask word index, bit) constants (SQL text).
        A fixed shape whatever the number of words, so a wide schema adds
        expressions linearly, not quadratically."""
        word, bit = divmod(attr.id, BITS_PER_WORD)
        return [("word", str(word)), ("bits", f"shiftleft(1L, {bit})")]

    def word_aggregates(self, fn: str = "bit_or") -> list[Column]:
        """``fn`` per mask word over ``(word, bits)`` rows (pivot into words)."""
        if self.n_words == 1:
            return [F.expr(f"{fn}(bits)").alias("w0")]
        return [F.expr(f"{fn}(CASE WHEN word = {j} THEN bits ELSE 0L END)").alias(w) for j, w in enumerate(self.word_cols)]

    def id_payload(self, attr: Attribute) -> list[tuple[str, str]]:
        return [("attr_id", str(attr.id))]

    def members(self, words: list[str] | None = None) -> Column:
        """Attribute ids whose bit is set in the given mask word columns."""
        words = words or self.word_cols
        if self.size == 0:
            return F.array().cast("array<int>")
        warr = "array(" + ", ".join(f"`{w}`" for w in words) + ")"
        return F.expr(
            f"filter(sequence(0, {self.size - 1}), "
            f"a -> (shiftright({warr}[cast(a div {BITS_PER_WORD} as int)], a % {BITS_PER_WORD}) & 1) = 1)"
        )

    def bit_test(self, attr_id: int, words: list[str] | None = None) -> Column:
        words = words or self.word_cols
        word, bit = divmod(attr_id, BITS_PER_WORD)
        return F.shiftright(F.col(words[word]), bit).bitwiseAND(F.lit(1).cast("long")) == F.lit(1)

    def clear_own_bit(self, id_col: str) -> list[Column]:
        """Mask words with the bit of the row's own attribute cleared."""
        out = []
        for j, w in enumerate(self.word_cols):
            out.append(
                F.expr(
                    f"`{w}` & ~(CASE WHEN cast(`{id_col}` div {BITS_PER_WORD} as int) = {j} "
                    f"THEN shiftleft(1L, cast(`{id_col}` % {BITS_PER_WORD} as int)) ELSE 0L END)"
                ).alias(w)
            )
        return out


# ---------------------------------------------------------------- plans
def attribute_values(space: AttributeSpace) -> DataFrame:
    """Distinct (attribute, value) pairs after the preset's normalisation."""
    rows = space.unpivot(space.id_payload)
    return rows.distinct().select(*space.label_columns("attr_id", "attribute"), F.col("v").alias("value"))


def attribute_profile_ids(space: AttributeSpace) -> DataFrame:
    """``(attr_id, n_rows, n_values, n_distinct)`` per attribute.

    ``n_rows`` counts cells, ``n_values`` the cells the preset keeps and
    ``n_distinct`` their distinct values; in ``strict`` null is a value, so it
    adds one to the distinct count.  One aggregate: Spark expands the distinct
    count into a partial aggregation on (attribute, value) first.
    """
    rows = space.unpivot(space.id_payload, keep_all=True)
    kept = F.col("kept")
    return rows.groupBy("attr_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(kept).alias("n_values"),
        (
            F.count_distinct(F.when(kept, F.col("v")))
            + F.max(F.when(kept & F.col("v").isNull(), F.lit(1)).otherwise(F.lit(0)))
        )
        .cast("long")
        .alias("n_distinct"),
    )


def attribute_profile(space: AttributeSpace) -> DataFrame:
    """Per attribute: cells, kept cells and distinct kept values."""
    return attribute_profile_ids(space).select(
        *space.label_columns("attr_id", "attribute"), "n_rows", "n_values", "n_distinct"
    )


def value_sets(space: AttributeSpace) -> DataFrame:
    """``(v, w0..wK)``: the attribute set of every distinct value."""
    rows = space.unpivot(space.bit_payload)
    return rows.groupBy("v").agg(*space.word_aggregates("bit_or"))


def distinct_sets(space: AttributeSpace) -> DataFrame:
    """``(w0..wK, n_values)``: each distinct attribute set and how many
    values have exactly that set."""
    return value_sets(space).groupBy(*space.word_cols).agg(F.count(F.lit(1)).alias("n_values"))


def attribute_sets(space: AttributeSpace) -> DataFrame:
    """Distinct attribute sets as sorted, comma-joined labels."""
    labels = space.label_array()
    names = F.transform(space.members(), lambda i: F.element_at(labels, i + 1))
    return distinct_sets(space).select(
        F.array_join(F.array_sort(names), ",").alias("attributes"),
        F.col("n_values").cast("long").alias("n_values"),
    )


def attribute_overlap(space: AttributeSpace) -> DataFrame:
    """Number of common distinct values for every ordered pair of attributes
    that share at least one value, with the dependent's distinct count.

    Computed per (dependent, mask word) as 64 bit-weighted sums over the
    distinct sets, so no pair list is ever built inside a set and the
    aggregate has a fixed width whatever the number of attributes; the
    output has one row per sharing pair.
    """
    sets = distinct_sets(space)
    per_dep = sets.select(
        F.explode(space.members()).alias("dep"),
        "n_values",
        F.array(*[F.col(w) for w in space.word_cols]).alias("ws"),
    )
    per_word = per_dep.select("dep", "n_values", F.posexplode("ws").alias("word", "bits")).where(F.col("bits") != 0)
    sums = per_word.groupBy("dep", "word").agg(
        *[
            F.expr(f"CAST(sum(CASE WHEN (shiftright(bits, {b}) & 1L) = 1L THEN n_values END) AS BIGINT)").alias(f"c{b}")
            for b in range(BITS_PER_WORD)
        ]
    )
    cells = F.expr(
        "array("
        + ", ".join(f"named_struct('ref', word * {BITS_PER_WORD} + {b}, 'n', c{b})" for b in range(BITS_PER_WORD))
        + ")"
    )
    long_form = sums.select("dep", F.inline(cells)).where(F.col("n") > 0)
    # The dependent's own distinct count is its (dep, dep) cell; a window per
    # dependent (at most one row per attribute) carries it to the pair rows
    # without a second pass over the plan.
    per_dep = Window.partitionBy("dep")
    own = F.max(F.when(F.col("ref") == F.col("dep"), F.col("n"))).over(per_dep)
    pairs = long_form.withColumn("n_dependent", own).where(F.col("ref") != F.col("dep"))
    return pairs.select(
        *space.label_columns("dep", "dependent"),
        *space.label_columns("ref", "referenced"),
        F.col("n").alias("n_common"),
        F.col("n_dependent"),
    )
