"""Mixing sources to target weights by soft domain membership.

1. A classifier is fitted on the labelled rows (a bounded sample of them).  It
   sees the telling words a text has, that is words far more frequent in one
   domain than in the others, and its shape (shares of symbols, of capitals
   and of repeated words).  Frequent words and words a text lacks count for
   nothing, so its language and length don't decide.
2. One projection gives every document its posterior over the domains.
3. Nonnegative rates are fitted by projected-gradient least squares: the
   expected domain totals, sum of rate * tokens * posterior, must meet the
   targets.  Each step is one distributed aggregate of K sums and the K x K
   Gram matrix of the documents with a positive rate (K domains); only those
   few numbers reach the driver.  The gradient is scaled by that matrix's
   inverse, so a few steps do; every step is a column expression
   ``max(0, rate - posterior . step)``.

Only DataFrame functions are used.  Nothing is dropped or sampled besides the
documented bound on labelled rows (``max_labelled``).

Defined results: a null text counts as empty (no tokens, the posterior of a
text without words); repeated rows each get their own, equal, rate; a null
label or a label of an unknown document is ignored; without labelled
documents there is one domain, ``all``; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesift.session import checkpoint_dir

SPACE = r"[\x20\x09-\x0D]+"
# letters and digits make words here; everything else in ASCII parts them
_PARTS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# each domain keeps at least this share of a mark's probability
_SMOOTH = 0.5
# a telling word: twice its information on the domains, in documents, and its odds in its domain against the others
_TELLS, _ODDS = 30.0, 4.0
# bytes and words that short texts count as having besides their own
_BYTES, _WORDS = 64, 8


def _words(text: Column) -> Column:
    return F.array_distinct(F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), _PARTS, -1), ""))


def _shape(text: Column, n_tokens: Column, words: Column) -> list[Column]:
    """Marks of the shares of symbols, capitals and repeated words of a text; short texts have those of an ordinary one."""
    text = F.coalesce(text, F.lit(""))
    size = F.octet_length(text) + _BYTES
    symbols = F.ceil(F.log2(1 + 100 * F.regexp_count(text, F.lit(r"[#*$%&|<>!]")) / size))
    capitals = F.floor(F.log2(1 + 100 * F.regexp_count(text, F.lit(r"\p{Lu}")) / size))
    repeats = F.least(F.lit(4), F.greatest(F.lit(0), F.round(F.log2((n_tokens + _WORDS) / (F.size(words) + _WORDS)))))
    return [x.cast("int").cast("string") for x in (symbols, capitals, repeats)]


def _marks(text: Column, n_tokens: Column, words: Column, telling: dict[str, int], n_domains: int) -> Column:
    """The shape of a text, and for each domain how many of its telling words it has (3 for more)."""
    counts = []
    for k in range(n_domains):
        own = [F.lit(w) for w, d in telling.items() if d == k]
        counts.append(F.least(F.lit(3), F.size(F.array_intersect(words, F.array(*own)))).cast("string") if own else F.lit("0"))
    return F.array(*_shape(text, n_tokens, words), *counts)


def _n_tokens(text: Column) -> Column:
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE, -1), "")).cast("long")


@dataclass
class Model:
    """Domains with their log shares, the domain of each telling word, and log odds of marks.

    ``single`` has them by place and value of a mark, ``joint`` by all marks of
    a text; the latter lean on the former the more, the fewer labelled texts
    have these marks.  Everything is bounded by the sample of labelled rows.
    """

    domains: list[str]
    prior: list[float]
    telling: dict[str, int]
    single: dict[str, list[float]]
    joint: dict[str, list[float]]


def fit_classifier(
    docs: DataFrame, labels: DataFrame, domain: Column, id_col: str, text_col: str, max_labelled: int, vocabulary: int
) -> Model:
    """The classifier of the domains, of at most ``vocabulary`` telling words.

    The sample is the ``max_labelled`` labelled ids with the smallest hash.
    """
    known = labels.select(F.col("doc_id").alias("__id"), domain.alias("__domain")).dropna().distinct()
    sample = known.orderBy(F.xxhash64("__id"), "__id", "__domain").limit(max_labelled)
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).join(F.broadcast(sample), "__id")
    rows = rows.select("__domain", "__text", _n_tokens(F.col("__text")).alias("__n"), _words(F.col("__text")).alias("__words"))
    checkpoint_dir(docs.sparkSession)
    rows = rows.checkpoint()
    sizes = {r["__domain"]: r["n"] for r in rows.groupBy("__domain").agg(F.count("*").alias("n")).collect()}
    domains = sorted(sizes)
    if not domains:
        return Model(["all"], [0.0], {}, {}, {})
    counts = rows.select("__domain", F.explode("__words").alias("word")).groupBy("word").agg(
        *[F.count_if(F.col("__domain") == d).alias(f"n{k}") for k, d in enumerate(domains)]
    )
    total = sum(sizes.values())
    n_word = sum((F.col(f"n{k}") for k in range(len(domains))), F.lit(0))

    def term(n: Column, n_domain: int, n_with: Column) -> Column:
        return F.when(n > 0, n * F.log(n * total / (n_with * n_domain))).otherwise(F.lit(0.0))

    info, odds = F.lit(0.0), []
    for k, d in enumerate(domains):
        n = F.col(f"n{k}")
        info = info + term(n, sizes[d], n_word) + term(F.lit(sizes[d]) - n, sizes[d], F.lit(total) - n_word)
        odds.append((n + _SMOOTH) / (sizes[d] + 2 * _SMOOTH) * (total - sizes[d] + 2 * _SMOOTH) / (n_word - n + _SMOOTH))
    best = counts.withColumn("info", F.round(2 * info, 9)).withColumn("odds", F.array(*odds)).withColumn("top", F.array_max("odds"))
    best = best.where((F.col("info") >= _TELLS) & (F.col("top") >= _ODDS)).orderBy(F.desc("info"), "word").limit(vocabulary)
    telling = {r["word"]: r["odds"].index(r["top"]) for r in best.collect()}

    marks = _marks(F.col("__text"), F.col("__n"), F.col("__words"), telling, len(domains))
    seen = rows.select("__domain", marks.alias("marks")).groupBy("__domain", "marks").agg(F.count("*").alias("n")).collect()
    alone, together = {}, {}
    for r in seen:
        k, marks = domains.index(r["__domain"]), [f"{i} {m}" for i, m in enumerate(r["marks"])]
        for key, table in [(m, alone) for m in marks] + [(" ".join(r["marks"]), together)]:
            table.setdefault(key, [0] * len(domains))[k] += r["n"]
    size = [sizes[d] for d in domains]
    values = [sum(m.startswith(f"{i} ") for m in alone) for i in range(3 + len(domains))]
    single = {m: [math.log((x + _SMOOTH) / (z + _SMOOTH * (values[int(m.split()[0])] + 1))) for x, z in zip(n, size, strict=True)] for m, n in alone.items()}
    joint = {}
    for key, n in together.items():
        lean = [sum(single[f"{i} {m}"][k] for i, m in enumerate(key.split())) for k in range(len(domains))]
        joint[key] = [math.log((x + math.exp(a)) / (z + 1)) for x, a, z in zip(n, lean, size, strict=True)]
    return Model(domains, [math.log(z / total) for z in size], telling, single, joint)


def _table(of: dict[str, list[float]]) -> Column:
    return F.create_map(*[x for w, a in sorted(of.items()) for x in (F.lit(w), F.array(*[F.lit(v) for v in a]))])


def posteriors(docs: DataFrame, model: Model, id_col: str, text_col: str, keep: list[str] = ()) -> DataFrame:
    """``keep`` columns, doc_id, n_tokens and ``posterior`` (array in the domains' order)."""
    text = F.col("__seen")
    rows = docs.select(*keep, F.col(id_col).alias("__id"), F.col(text_col).alias("__seen"))
    if not model.joint:
        rows = rows.select(*keep, "__id", _n_tokens(text).alias("__n"))
        return rows.withColumn("__posterior", F.array(*[F.lit(math.exp(a)) for a in model.prior]))
    rows = rows.select(*keep, "__id", "__seen", _n_tokens(text).alias("__n"), _words(text).alias("__words"))
    marks = _marks(text, F.col("__n"), F.col("__words"), model.telling, len(model.domains))
    rows = rows.select(*keep, "__id", "__n", marks.alias("__marks"))
    rows = rows.withColumn("__joint", F.try_element_at(_table(model.joint), F.array_join("__marks", " ")))
    singles, none = _table(model.single), F.array(*[F.lit(0.0) for _ in model.domains])
    keys = F.transform("__marks", lambda m, i: F.concat(i.cast("string"), F.lit(" "), m))
    lean = F.aggregate(
        keys, none, lambda acc, m: F.zip_with(acc, F.coalesce(F.try_element_at(singles, m), none), lambda a, b: a + b)
    )
    # without a labelled text of all these marks, each counts for itself
    scores = F.coalesce("__joint", lean)
    prior = F.array(*[F.lit(a) for a in model.prior])
    rows = rows.withColumn("__scores", F.zip_with(scores, prior, lambda a, b: a + b))
    rows = rows.withColumn("__exp", F.transform("__scores", lambda s: F.exp(s - F.array_max("__scores"))))
    total = F.aggregate("__exp", F.lit(0.0), lambda a, x: a + x)
    rows = rows.withColumn("__sum", total)
    return rows.select(*keep, "__id", "__n", F.transform("__exp", lambda x: x / F.col("__sum")).alias("__posterior"))


def _solve(matrix: list[list[float]], right: list[float]) -> list[float]:
    """Solution of a small positive semidefinite system (ridge for domains nothing is left of)."""
    n = len(right)
    ridge = 1e-9 * max([matrix[i][i] for i in range(n)] + [1e-300])
    a = [[*matrix[i], right[i]] for i in range(n)]
    for i in range(n):
        a[i][i] += ridge
    for i in range(n):
        p = max(range(i, n), key=lambda r: abs(a[r][i]))
        a[i], a[p] = a[p], a[i]
        for r in range(n):
            if r != i and a[i][i]:
                f = a[r][i] / a[i][i]
                a[r] = [x - f * y for x, y in zip(a[r], a[i], strict=True)]
    return [a[i][n] / a[i][i] if a[i][i] else 0.0 for i in range(n)]


def fit_rates(
    rows: DataFrame, targets: list[float], total_tokens: float | None = None, steps: int = 30, tolerance: float = 1e-7
) -> tuple[Column, list[float], list[float]]:
    """Column of the rates, the targets in tokens and the totals met.

    ``targets`` are shares.  ``total_tokens`` None: the total for which
    the domain of the largest target keeps its tokens; scarcer ones are repeated.
    """
    k = len(targets)
    p = [F.element_at("__posterior", i + 1) for i in range(k)]
    n = F.col("__n").cast("double")
    rate = F.lit(1.0)

    def sums(rate: Column) -> tuple[list[float], list[list[float]]]:
        live = F.when(rate > 0, n).otherwise(F.lit(0.0))
        totals = [F.sum(rate * n * p[i]).alias(f"t{i}") for i in range(k)]
        gram = [F.sum(live * p[i] * p[j]).alias(f"g{i}_{j}") for i in range(k) for j in range(i, k)]
        r = rows.agg(*totals, *gram).first()
        return [r[f"t{i}"] or 0.0 for i in range(k)], [[r[f"g{min(i, j)}_{max(i, j)}"] or 0.0 for j in range(k)] for i in range(k)]

    have, gram = sums(rate)
    weight = [t if h > 0 else 0.0 for t, h in zip(targets, have, strict=True)]
    if not sum(weight):
        return rate, have, have
    weight = [w / sum(weight) for w in weight]
    if total_tokens is None:
        total_tokens = max((w, h / w) for h, w in zip(have, weight, strict=True) if w)[1]
    goal = [w * total_tokens for w in weight]
    for _ in range(steps):
        error = [h - g for h, g in zip(have, goal, strict=True)]
        if max(abs(e) for e in error) <= tolerance * total_tokens:
            break
        step = _solve(gram, error)
        move = sum((F.lit(float(s)) * x for s, x in zip(step, p, strict=True)), F.lit(0.0))
        rate = F.greatest(F.lit(0.0), rate - move)
        have, gram = sums(rate)
    return rate, goal, have


def mix(
    docs: DataFrame,
    labels: DataFrame,
    domain: Column,
    targets: dict[str, float],
    id_col: str = "doc_id",
    text_col: str = "text",
    max_labelled: int = 20_000,
    vocabulary: int = 256,
    total_tokens: float | None = None,
    keep: list[str] = (),
) -> tuple[DataFrame, list[str]]:
    """Rows of ``docs`` with ``__id``, ``__n`` (tokens), ``__posterior`` and ``__rate``; and the domains.

    A domain without a target has target 0.
    """
    checkpoint_dir(docs.sparkSession)
    model = fit_classifier(docs, labels, domain, id_col, text_col, max_labelled, vocabulary)
    # the steps read ids, counts and posteriors again and again, no texts
    rows = posteriors(docs, model, id_col, text_col, keep).checkpoint()
    domains = model.domains
    shares = [targets.get(d, 0.0) for d in domains] if domains != ["all"] else [1.0]
    rate, _, _ = fit_rates(rows, shares, total_tokens)
    return rows.withColumn("__rate", rate), domains


def drawn(id_: Column, rate: Column) -> Column:
    """Copies of a document at its rate: the whole part, and one more with the odds of the rest, by a hash of its id."""
    chance = F.pmod(F.xxhash64(id_, F.lit("draw")), F.lit(1 << 40)) / float(1 << 40)
    return (F.floor(rate) + F.when(chance < rate - F.floor(rate), 1).otherwise(0)).cast("int")


def mixed(docs: DataFrame, labels: DataFrame, domain: Column, targets: dict[str, float], id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` as often as their fitted rates draw them, with all their columns.

    Takes the options of ``mix``.  Rates are fitted on ids, counts and
    posteriors; the texts are read once more to apply them, without a join.
    """
    checkpoint_dir(docs.sparkSession)
    total_tokens = options.pop("total_tokens", None)
    model = fit_classifier(docs, labels, domain, id_col, text_col, options.pop("max_labelled", 20_000), options.pop("vocabulary", 256))
    shares = [targets.get(d, 0.0) for d in model.domains] if model.domains != ["all"] else [1.0]
    rate, _, _ = fit_rates(posteriors(docs, model, id_col, text_col).checkpoint(), shares, total_tokens)
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"))
    whole = whole.select("__row", F.col("__row").getField(id_col).alias("__doc"), F.col("__row").getField(text_col).alias("__text"))
    rows = posteriors(whole, model, "__doc", "__text", ["__row"])
    # Spark infers a filter from explode; on a deterministic column it would be moved down with the posteriors written out in it
    rows = rows.select("__row", (drawn(F.col("__id"), rate) + F.least(F.spark_partition_id(), F.lit(0))).alias("__copies"))
    return rows.select(F.explode(F.array_repeat("__row", F.col("__copies"))).alias("__row")).select("__row.*")
