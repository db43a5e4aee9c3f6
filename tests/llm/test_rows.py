from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tablesift.llm.ctw import score
from tablesift.llm.license_scan import BASE_PHRASES, license_digest, license_scan
from tablesift.llm.mixing import mix, mixed
from tablesift.llm.packing import pack_documents
from tablesift.llm.quality_rules import keep_good, quality_rules
from tablesift.llm.tokens import default_tokenizer

WORD = r"[^\x20\x09-\x0D]+"


def corpus() -> list[tuple]:
    """Texts with license phrases, repeats, symbols, a long one, repeated rows, nulls; columns with names used inside."""
    rng = random.Random(3)
    words = "the of a is data table Größe niño mit license apache gnu general public cc by nc # * end, MIT-License x1".split()
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 90))) for _ in range(40)]
    texts += ["the same line is here\n" * 30, "w " * 5000, "GNU General Public License version 3, CC-BY cc by", texts[0], "", None, " \n", "!!!"]
    return [(i, t, "kept", 0) for i, t in enumerate(texts)] + [(2, texts[2], "kept", 0)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), "doc_id long, text string, kept string, n_words int").repartition(3)


def table(rows, *columns) -> list[tuple]:
    return sorted(tuple(r[c] for c in columns) for r in rows.collect())


def test_license_base_equals_brute_force(docs):
    want = []
    for i, t, *_ in corpus():
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        hits = [(s, label) for p, label in BASE_PHRASES for s in range(len(w)) if w[s : s + len(p.split())] == p.split()]
        starts = [s for s, _ in hits]
        want.append((i, len(w), len(hits), min(starts, default=-1), max(starts, default=-1), ",".join(sorted({x for _, x in hits}))))
    got = license_digest(license_scan(docs)).na.fill(-1, ["first_word", "last_word"])
    assert table(got, "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels") == sorted(want)
    for r in got.collect():
        assert 0 <= r["score"] <= 1 and set(r["base_labels"].split(",")) <= {*r["labels"].split(","), ""}


def test_quality_base_equals_brute_force(docs):
    want = []
    for i, t, *_ in corpus():
        w = re.findall(WORD, t or "")
        windows = [tuple(w[s : s + 8]) for s in range(len(w) - 7)]
        count = Counter(windows)
        again = {s + k for s, x in enumerate(windows) if count[x] > 1 for k in range(8)}
        lines = [x for x in (t or "").split("\n") if re.search(WORD, x)]
        failed = len(w) < 20 or 100 * len(again) > 30 * len(w)
        symbols = len(re.findall(r"[#*$%&|<>]", t or ""))
        want.append((i, len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(again), failed))
    judged = quality_rules(docs)
    assert table(judged, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed") == sorted(want)
    good = keep_good(docs)
    assert good.columns == docs.columns
    assert table(good, "doc_id") == table(judged.where("kept"), "doc_id")


def test_kept_rows_are_judged_once(docs):
    """The filter on the verdict doesn't write the measures out again."""
    plan = keep_good(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") <= 2


def test_packing_is_an_exact_round_trip(docs):
    tokenizer = Tokenizer.from_file(default_tokenizer())
    pieces = pack_documents(docs.where("doc_id <> 2"), capacity=256).toPandas()
    by_doc = dict(list(pieces.groupby("doc_id")))
    rows = {i: t for i, t, *_ in corpus() if i != 2}
    assert by_doc.keys() == rows.keys()
    for i, t in rows.items():
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4")
        at = 0
        for k, p in enumerate(by_doc[i].sort_values("piece").itertuples()):
            assert (p.piece, p.start) == (k, at) and (p.length <= 256 and (k == 0 or p.length == 256))
            assert p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    for _, s in pieces.groupby("sequence_id"):
        s = s.sort_values("offset")
        assert list(s.offset) == [0, *np.cumsum(s.length)[:-1]] and s.length.sum() <= 256
    assert pieces.sequence_id.nunique() <= math.ceil(pieces.length.sum() / 256) + 1


def test_rates_meet_the_targets(spark, docs):
    labels = spark.createDataFrame([(i, "short" if i % 2 else "long") for i in range(40)], "doc_id long, label string")
    rows, domains = mix(docs, labels, F.col("label"), {"short": 0.3, "long": 0.7})
    share = [0.0, 0.0]
    for r in rows.collect():
        assert r["__rate"] >= 0 and abs(sum(r["__posterior"]) - 1) < 1e-9
        share = [s + r["__rate"] * r["__n"] * p for s, p in zip(share, r["__posterior"], strict=True)]
    assert domains == ["long", "short"] and abs(share[0] / sum(share) - 0.7) < 1e-4
    drawn = mixed(docs, labels, F.col("label"), {"short": 0.3, "long": 0.7})
    assert drawn.columns == docs.columns and drawn.select("doc_id").distinct().subtract(docs.select("doc_id")).isEmpty()
    empty = docs.limit(0)
    assert mixed(empty, labels, F.col("label"), {"short": 1.0}).count() == 0


def test_clean_documents_keep_their_rate_in_each_language_and_length(spark):
    """Labels of one half; of the other half, clean documents of a rare language or few words aren't dropped."""
    rng = random.Random(5)
    words = {x: ["".join(rng.choices(letters, k=rng.randint(2, 6))) for _ in range(300)] for x, letters in (("en", "abcdefgh"), ("fr", "ijklmnop"))}
    rows, labels = [], []
    for i in range(1200):
        lang = "fr" if i % 8 == 0 else "en"
        text = rng.choices(words[lang], [1 / (r + 1) for r in range(300)], k=rng.choice([8, 60, 400]))
        kind = rng.choices(["good", "poor", "toxic"], [76, 13, 11])[0]
        if kind == "poor":
            text = [w + "$$$" for w in text] if i % 3 else ["as"] * 100
        if kind == "toxic":
            text[rng.randrange(len(text))] = rng.choice(["scumbag", "moronic", "trashy"])
        rows.append((i, " ".join(text), lang, len(text), kind))
        if i % 16 < 8:
            labels.append((i, kind))
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, words int, kind string")
    labels = spark.createDataFrame(labels, "doc_id long, label string")
    got, domains = mix(table, labels, F.col("label"), {"good": 0.97, "poor": 0.02, "toxic": 0.01}, keep=["lang", "words", "kind"])
    held = got.where("__id % 16 >= 8 and kind = 'good'").select("lang", "words", "__rate", F.col("__posterior")[domains.index("good")].alias("p")).toPandas()
    for _, part in [*held.groupby("lang"), *held.groupby("words")]:
        assert part.p.mean() > 0.95 and 0.9 < part["__rate"].mean() < 1.1 and (part["__rate"] < 0.5).mean() < 0.02


def test_scores_equal_brute_force_base_and_compress_held_out_texts(docs):
    got = score(docs, F.col("doc_id") % 3 != 0)
    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    tokens = [(i, [*re.findall(WORD, lower(t)), None]) for i, t, *_ in corpus()]
    count = Counter(x for i, ws in tokens if i % 3 for x in ws)
    n, v = sum(count.values()), len(count)
    want = sorted((i, len(ws), sum(count[x] > 0 for x in ws), n, sum(math.log10((count[x] + 1) / (n + v + 1)) for x in ws)) for i, ws in tokens)
    have = table(got, "doc_id", "n_tokens", "n_known", "train_tokens", "base_score")
    assert [h[:4] for h in have] == [w[:4] for w in want]
    assert np.allclose([h[4] for h in have], [w[4] for w in want])
    held = got.where("doc_id % 3 = 0 and n_tokens > 20").agg(F.sum("score").alias("s"), F.sum("n_bytes").alias("b")).first()
    assert -held["s"] / math.log10(2) / held["b"] < 4  # bits a byte; 8 without a model


def test_empty_tables(docs):
    empty = docs.limit(0)
    assert license_digest(license_scan(empty)).count() == quality_rules(empty).count() == pack_documents(empty).count() == 0
    assert score(empty, F.lit(True)).count() == 0
