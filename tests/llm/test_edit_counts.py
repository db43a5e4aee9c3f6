from __future__ import annotations

import random
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tablesift.llm import edit_counts as ec
from tablesift.llm.tokens import default_tokenizer, encoder

PIECES = ["word", " ", "  ", "\n", "\n\n", "'", "re", "s ", "x'", "12 345", "é", "日本", " ", "\t", "<|endoftext|>", "a" * 300, "tail. "]


def whole_count(text):
    t = Tokenizer.from_file(default_tokenizer())
    t.encode_special_tokens = True
    return len(t.encode(text, add_special_tokens=False).ids)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=400), st.integers(0, 10**6))
def test_tree_equals_whole_count_after_each_edit(pieces, seed):
    rng = random.Random(seed)
    tree = ec.CountTree("".join(pieces), encoder(default_tokenizer()))
    for _ in range(5):
        start = rng.randint(0, len(tree.text))
        stop = min(len(tree.text), start + rng.choice([0, 1, 5, 700]))
        tree.edit(start, stop, "".join(rng.choices(PIECES, k=rng.choice([0, 1, 3, 300]))))
        assert tree.sums[1, 0] == len(tree.text)
        assert tree.total() == whole_count(tree.text)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=400), st.integers(0, 10**6))
def test_edits_of_one_sweep_equal_whole_count(pieces, seed):
    rng = random.Random(seed)
    text = "".join(pieces)
    tree = ec.CountTree(text, encoder(default_tokenizer()))
    for _ in range(2):
        places = sorted(rng.choices(range(len(text) + 1), k=2 * rng.choice([1, 4, 40])))
        edits = [(a, b, "".join(rng.choices(PIECES, k=rng.choice([0, 1, 3, 30])))) for a, b in zip(places[::2], places[1::2], strict=True)]
        # two insertions at one place have no order
        edits = [e for i, e in enumerate(edits) if i == 0 or e[0] > edits[i - 1][0]]
        parts, at = [], 0
        for a, b, new in edits:
            parts += [text[at:a], new]
            at = b
        text = "".join([*parts, text[at:]])
        tree.edit_all(rng.sample(edits, len(edits)))
        assert tree.text == text
        assert tree.sums[1, 0] == len(text)
        assert tree.total() == whole_count(text)
        assert (tree.sums[1 : tree.width] == tree.sums[2::2] + tree.sums[3::2]).all()


@given(st.text(alphabet="ab \n\t\u00a0", max_size=200), st.integers(1, 9))
def test_runs_end_at_the_first_cut_after_enough_characters(text, least):
    cuts = [i for i in range(1, len(text)) if text[i] in " \n" and not text[i - 1].isspace()]
    want, upto = [], 0
    for c in cuts:
        if c >= upto + least:
            want.append(c)
            upto = c
    assert ec.runs(text, least) == [*want, len(text)]


def test_overlapping_and_misplaced_edits_are_errors():
    tree = ec.CountTree("some words", encoder(default_tokenizer()))
    for edits in ([(0, 3, ""), (2, 4, "")], [(3, 2, "")], [(0, 11, "")], [(-1, 2, "")]):
        with pytest.raises(ValueError):
            tree.edit_all(edits)
    tree.edit_all([])
    assert tree.text == "some words"


def test_many_edits_of_a_long_line_take_seconds():
    text = "some words of one line " * 700_000  # 16 MB without a line feed
    began = time.time()
    ends = ec.runs(text, ec.LEAF_CHARS)
    assert len(ends) > 50_000 and time.time() - began < 5
    text = text[: 7_000_000]
    tree = ec.CountTree(text, encoder(default_tokenizer()))
    began = time.time()
    tree.edit_all([(i * 70, i * 70 + 4, "other") for i in range(100_000)])
    assert time.time() - began < 60
    assert len(tree.text) == len(text) + 100_000
    assert tree.total() == ec.CountTree(tree.text, encoder(default_tokenizer())).total()


def test_only_the_region_is_encoded_again():
    tree = ec.CountTree("some words " * 5000, encoder(default_tokenizer()))
    tree.encoded = 0
    tree.edit(20_000, 20_004, "other")
    assert 0 < tree.encoded < 1500
    assert tree.total() == whole_count(tree.text)


def test_edits_table(spark):
    docs = spark.createDataFrame([(1, "one two three", "x"), (2, None, "x"), (None, "no id", "x"), (1, "one two three", "x")], "doc_id long, text string, tree string")
    edits = spark.createDataFrame([(1, 4, 7, "2"), (1, 0, 3, None), (2, 0, 0, "new text"), (9, 0, 0, "x"), (None, 0, 0, "x")], "doc_id long, start long, stop long, text string")
    rows = ec.apply_edits(ec.build_trees(docs), edits).collect()
    assert sorted((r["doc_id"] or 0, r["text"], r["n_tokens"]) for r in rows) == sorted(
        (i, t, whole_count(t)) for i, t in [(0, "no id"), (1, " 2 three"), (1, " 2 three"), (2, "new text")]
    )


def test_scrubbed_counts(spark):
    texts = ["mail a.b@c.org or +49 30 1234567 now", None, "", "clean " * 3000, "a.b@c.org", "x" * 5000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumnRenamed("text", "body")
    rows = {r["doc_id"]: r for r in ec.scrubbed_counts(docs, text_col="body").collect()}
    assert rows[0]["text_after"] == "mail [email] or [number] now" and rows[0]["n_edits"] == 2
    for i, t in enumerate(texts):
        assert rows[i]["n_tokens"] == whole_count(t or "")
        assert rows[i]["n_tokens_after"] == whole_count(rows[i]["text_after"])
    assert rows[3]["n_encoded"] == 0
    assert ec.scrubbed_counts(docs.limit(0), text_col="body").count() == 0
