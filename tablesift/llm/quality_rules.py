"""Quality rules: a threshold table compiled into one Spark projection.

``quality_metrics`` adds the measures (length, symbol, stop-word, line and
repetition figures) as plain column expressions; ``quality_rules`` compiles a
list of ``Rule`` rows into one more projection with the names of the failed
rules and the verdict.  No user function, no shuffle: every row is judged
where it is read.

Defined results: a null text counts as empty (zero words, so the shortest-text
rule rejects it); repeated rows are judged one by one; an empty table gives an
empty result; only the id and text columns are read, so extra columns of any
name do no harm.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed by the contract: the white space between words, the symbols counted, the window of the repetition measure.
SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\f\r"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

# Frequent function words of the four languages of the corpus.
STOP_WORDS = {
    "en": "a an and are as at be by for from in is it of on or that the this to was were with",
    "de": "als auf das dem den der des die ein eine für im in ist mit nicht sich und von zu",
    "fr": "au aux avec dans de des du en est et la le les par pas pour que qui sur un une",
    "es": "al con de del el en es la las lo los no para por que se su un una y",
}


@dataclass(frozen=True)
class Rule:
    """Reject when ``measure`` is outside [low, high]; judged only from ``min_words`` words on."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None
    min_words: int = 0


# Thresholds on ratios are wide: prose of any language passes, markup, shouting and boilerplate do not.
DEFAULT_RULES = (
    Rule("mean_word_length", "mean_word_chars", low=2, high=20),
    Rule("symbols_per_word", "symbol_ratio", high=0.25),
    Rule("exclamations_per_word", "exclamation_ratio", high=0.5),
    Rule("digit_share", "digit_ratio", high=0.4),
    Rule("duplicate_lines", "dup_line_ratio", high=0.5),
    Rule("no_stop_words", "stop_word_ratio", low=0.005, min_words=200),
)


def words_of(text: Column) -> Column:
    """Words of a text, in order; none for a null or blank text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE, -1), "")


def _shift(col: Column, by: int) -> Column:
    return F.slice(col, F.lit(by + 1), F.greatest(F.size(col) - by, F.lit(0)))


def _combine(hashes: Column, by: int) -> Column:
    """Hash of each element and the one ``by`` places on."""
    return F.zip_with(hashes, _shift(hashes, by), lambda a, b: F.xxhash64(a, b))


def _ratio(num: str, den: str) -> Column:
    return F.when(F.col(den) > 0, F.col(num) / F.col(den)).otherwise(F.lit(0.0))


def quality_metrics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id and every measure.

    A window is WINDOW consecutive words.  Windows are compared by a 64-bit
    hash built from the words' hashes by doubling (1, 2, 4, 8 words), so the
    work is linear in the words, plus one sort of the windows of a text that
    repeats any.  Two different windows of one text of 20,000 words share a
    hash with a probability of about 1e-11.
    """
    base = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    step = base.withColumn("__words", words_of(F.col("__text"))).withColumn(
        "__lines", F.filter(F.split("__text", "\n", -1), lambda x: F.btrim(x, F.lit(SPACE_CHARS)) != "")
    )
    step = step.withColumn("__h1", F.transform("__words", lambda w: F.xxhash64(w)))
    for k in (1, 2, 4):
        step = step.withColumn(f"__h{2 * k}", _combine(F.col(f"__h{k}"), k))
    step = step.withColumn(
        "__windows", F.slice(F.col(f"__h{WINDOW}"), F.lit(1), F.greatest(F.size("__words") - (WINDOW - 1), F.lit(0)))
    )
    # windows in hash order; equal neighbours are repeats
    step = step.withColumn(
        "__sorted",
        F.when(
            F.size(F.array_distinct("__windows")) < F.size("__windows"),
            F.sort_array(F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("p")))),
        ),
    )
    step = step.withColumn(
        "__starts",
        F.sort_array(
            F.array_distinct(
                F.flatten(
                    F.filter(
                        F.zip_with(
                            F.col("__sorted"),
                            _shift(F.col("__sorted"), 1),
                            lambda a, b: F.when(a["h"] == b["h"], F.array(a["p"], b["p"])),
                        ),
                        lambda x: x.isNotNull(),
                    )
                )
            )
        ),
    )
    covered = F.aggregate(
        F.zip_with(F.col("__starts"), _shift(F.col("__starts"), 1), lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW)))),
        F.lit(0).cast("long"),
        lambda acc, x: acc + x,
    )
    # stop words are met by their hash, in lower case and with a capital
    stop = sorted({v for s in STOP_WORDS.values() for w in s.split() for v in (w, w.capitalize())})
    stop_hashes = [F.xxhash64(F.lit(w)) for w in stop]
    step = step.select(
        F.col(id_col),
        F.size("__words").cast("long").alias("n_words"),
        F.length(F.array_join("__words", "")).cast("long").alias("word_chars"),
        F.regexp_count("__text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("__lines").cast("long").alias("n_lines"),
        F.size(F.filter("__h1", lambda h: h.isin(*stop_hashes))).cast("long").alias("n_stop_words"),
        F.regexp_count("__text", F.lit("!")).cast("long").alias("n_exclamations"),
        F.regexp_count("__text", F.lit("[0-9]")).cast("long").alias("n_digits"),
    )
    return step.select(
        "*",
        _ratio("word_chars", "n_words").alias("mean_word_chars"),
        _ratio("n_symbols", "n_words").alias("symbol_ratio"),
        _ratio("n_exclamations", "n_words").alias("exclamation_ratio"),
        _ratio("n_digits", "word_chars").alias("digit_ratio"),
        _ratio("n_dup_lines", "n_lines").alias("dup_line_ratio"),
        _ratio("n_stop_words", "n_words").alias("stop_word_ratio"),
    )


def compile_rules(rules: tuple[Rule, ...] | list[Rule]) -> Column:
    """Names of the rules a row of measures breaks, in table order."""
    tests = []
    for r in rules:
        m = F.col(r.measure)
        out = F.lit(False)
        if r.low is not None:
            out = out | (m < r.low)
        if r.high is not None:
            out = out | (m > r.high)
        tests.append(F.when((F.col("n_words") >= r.min_words) & out, F.lit(r.name)))
    if not tests:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*tests))


def quality_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rules: tuple[Rule, ...] | list[Rule] = DEFAULT_RULES,
) -> DataFrame:
    """Measures, ``base_failed``, ``failed_rules`` and ``kept`` per row."""
    judged = quality_metrics(docs, id_col, text_col).withColumn("failed_rules", compile_rules(rules)).withColumn(
        "base_failed",
        (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
    )
    return judged.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))


def keep_good(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rules: tuple[Rule, ...] | list[Rule] = DEFAULT_RULES,
) -> DataFrame:
    """The rows of ``docs`` that pass, as they are; no join, so null and repeated ids stay too."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")
    rows = docs.select(whole, F.col(text_col).alias("__source"))
    judged = quality_rules(rows, "__row", "__source", rules)
    # a filter on a deterministic column is moved down the projections, with all measures written out in it again and again
    return judged.select("__row", (F.col("kept") & (F.spark_partition_id() >= 0)).alias("kept")).where("kept").select("__row.*")
