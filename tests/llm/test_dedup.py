from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from tablesift.llm import order_minhash as om
from tablesift.llm.exact_dedup import exact_dedup, keep_first
from tablesift.llm.lz_dedup import duplicate_spans
from tablesift.llm.rlbwt_dedup import StringNames, duplicate_bytes, offset_ranges

WORD = r"[^\x20\x09-\x0D]+"


def corpus() -> list[tuple]:
    """Texts with exact and near copies, a shared passage, nulls, empty and repeated rows."""
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    text = lambda n: rng.choices(vocabulary, k=n)
    passage = text(60)
    rows = []
    for i in range(30):
        rows.append(text(rng.randint(1, 40)) + (passage if i % 3 == 0 else []) + text(rng.randint(0, 200)))
    base = text(150)
    for i in range(12):
        near = list(base)
        for _ in range(i % 5):
            near[rng.randrange(len(near))] = rng.choice(vocabulary)
        rows.append(near)
    rows += [rows[3], rows[3], rows[7], text(3), text(1), ["a"] * 300, ["a"] * 290]
    texts = [" ".join(r) for r in rows] + [None, "", " \n ", rows[3][0] + "\n\n" + " ".join(rows[3][1:]), " ".join(rows[4]).upper()]
    return [(i, t, "en") for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), "doc_id long, text string, node string").repartition(3)


def lcs(x: list, y: list) -> int:
    row = [0] * (len(y) + 1)
    for a in x:
        last = 0
        for j, b in enumerate(y, 1):
            last, row[j] = row[j], last + 1 if a == b else max(row[j], row[j - 1])
    return row[-1]


def labelled(text: str | None) -> list:
    w = re.findall(WORD, (text or "").lower())
    grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)] or ([tuple(w)] if w else [])
    seen: dict = {}
    out = []
    for g in grams:
        seen[g] = seen.get(g, 0) + 1
        out.append((g, seen[g]))
    return out


def test_near_classes_equal_brute_force(docs):
    rows = corpus()
    shingles = [labelled(t) for _, t, _ in rows]
    parent = list(range(len(rows)))

    def top(i):
        return i if parent[i] == i else top(parent[i])

    for i, a in enumerate(shingles):
        for j in range(i):
            b = shingles[j]
            same = lcs(a, b) if a and b else 0
            if a == b or (same and same >= 0.8 * (len(a) + len(b) - same) - 1e-9):
                one, two = top(i), top(j)
                parent[max(one, two)] = min(one, two)
    got = {r["doc_id"]: r for r in om.near_classes(docs).collect()}
    assert {i: r["class_id"] for i, r in got.items()} == {i: top(i) for i in range(len(rows))}
    assert sum(r["kept"] for r in got.values()) == len({top(i) for i in range(len(rows))})
    kept = om.keep_first_of_class(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({top(i) for i in range(len(rows))})


def test_near_classes_of_empty_table_null_and_repeated_ids(spark):
    schema = "doc_id long, text string"
    assert om.near_classes(spark.createDataFrame([], schema)).count() == 0
    text = "one two three four five six seven"
    rows = [(None, text), (5, text), (5, text), (4, "other words that are here now")]
    got = om.near_classes(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r["class_id"], r["class_size"], r["kept"]) for r in got) == [(4, 1, True), (5, 3, False), (5, 3, False), (5, 3, True)]
    assert om.keep_first_of_class(spark.createDataFrame(rows, schema)).count() == 2


def test_bands_of_texts_of_more_than_a_million_words():
    """A word put in changes no band key but those that sample it, wherever the places lie."""
    rng = np.random.default_rng(7)
    shingles = rng.integers(1, 1 << 63, 3 << 20, dtype=np.uint64)
    later = np.insert(shingles, (1 << 20) + 5, np.uint64(5))
    one, two = (om.sketches(x, np.array([0]), np.array([len(x)]), 4, 2) for x in (shingles, later))
    assert (one == two).all()
    # a text on its own and among others, on both sides of the limit
    short = shingles[: 1 << 10]
    alone = om.sketches(short, np.array([0]), np.array([len(short)]), 4, 2)
    both = om.sketches(np.concatenate([shingles, short]), np.array([0, len(shingles)]), np.array([len(shingles), len(short)]), 4, 2)
    assert (both[0] == one).all() and (both[1] == alone).all()


def hot_bands() -> tuple[list, list]:
    """(key, node) and (node, root): a band of strangers, a joined one with a stranger, one of two large roots and some strangers, small ones."""
    banded = [(1, n) for n in range(300)] + [(2, n) for n in range(1000, 1501)] + [(3, n) for n in range(2000, 2130)]
    banded += [(k, n) for k in range(4, 60) for n in (3000 + 2 * k, 3001 + 2 * k)]
    roots = [(n, 1000) for n in range(1000, 1500)] + [(n, 2000 + n % 2) for n in range(2000, 2120)]
    return banded, roots


def test_hot_bands_are_dealt_to_tasks_of_a_fixed_size(spark, monkeypatch):
    monkeypatch.setattr(om, "BLOCK", 8)
    banded, roots = hot_bands()
    frames = spark.createDataFrame(banded, "key long, node long"), spark.createDataFrame(roots, "node long, root long")
    rows = om.dealt(*frames, om.Folder(spark)).toPandas()
    assert rows.groupby(["part", "low", "high"]).size().max() <= 6 * 8
    # each node of the joined band meets the stranger, not its like
    assert len(rows[rows.key == 2]) <= 2 * 501
    top, meet = dict(roots), set()
    for (_, low, high), g in rows.groupby(["key", "low", "high"]):
        for a in g.itertuples():
            for b in g.itertuples():
                if a.node < b.node and a.root != b.root and (low == high or a.block != b.block):
                    meet.add((a.key, a.node, b.node))
    by_key: dict[int, list[int]] = {}
    for k, n in banded:
        by_key.setdefault(k, []).append(n)
    assert meet == {(k, a, b) for k, ns in by_key.items() for a in ns for b in ns if a < b and top.get(a, a) != top.get(b, b)}


def test_links_in_hot_bands_equal_brute_force(spark, monkeypatch):
    """Nodes of equal text in one band are joined, whatever the blocks."""
    monkeypatch.setattr(om, "BLOCK", 8)
    banded, roots = hot_bands()
    group = {n: n % 7 for _, n in banded}
    rng = np.random.default_rng(3)
    texts = rng.integers(1, 1 << 63, (7, 40), dtype=np.uint64)
    signs = om.signatures(texts.reshape(-1), np.arange(7) * 40, np.full(7, 40))
    prints = [(n, 40, bytearray(signs[g].tobytes()), bytearray((texts[g] >> np.uint64(32)).astype("<u4").tobytes())) for n, g in group.items()]
    frames = [spark.createDataFrame(banded, "key long, node long"), spark.createDataFrame(roots, "node long, root long")]
    frames.append(spark.createDataFrame(prints, "node long, n long, signature binary, shingles binary"))
    links = om.unresolved(*frames, om.Folder(spark), 0.8).collect()
    parent = {n: n for n in group}

    def find(n: int) -> int:
        while parent[n] != n:
            n = parent[n]
        return n

    def components(pairs) -> set:
        parent.update({n: n for n in group})
        for a, b in pairs:
            parent[find(a)] = find(b)
        out: dict[int, set] = {}
        for n in group:
            out.setdefault(find(n), set()).add(n)
        return {frozenset(x) for x in out.values()}

    seen: dict[tuple, int] = {}
    known = [(n, r) for n, r in roots]
    want = components(known + [(seen.setdefault((k, group[n]), n), n) for k, n in banded])
    assert components(known + [(r["node"], r["pivot"]) for r in links]) == want


def test_banded_alignment_equals_the_whole_table():
    rng = random.Random(1)
    for _ in range(200):
        x = [rng.randrange(6) for _ in range(rng.randint(1, 40))]
        y = [rng.randrange(6) for _ in range(rng.randint(1, 40))]
        assert om.banded_lcs(x, y, 80) == lcs(x, y)
        one, two = np.unique(x).astype("<u4"), np.unique(y).astype("<u4")
        rng.shuffle(one), rng.shuffle(two)
        same = lcs(list(one), list(two))
        assert om.is_near(one, two, 0.8) == (same >= 0.8 * (len(one) + len(two) - same) - 1e-9)


def test_exact_dedup_equals_brute_force(docs):
    groups: dict[str, list[int]] = {}
    for i, t, _ in corpus():
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(i)
    want = {i: (min(g), len(g), i == min(g), hashlib.sha256(t.encode()).hexdigest()) for t, g in groups.items() for i in g}
    got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in exact_dedup(docs).collect()}
    assert got == want
    assert sorted(r["doc_id"] for r in keep_first(docs).collect()) == sorted(min(g) for g in groups.values())


def test_substring_dedup_equals_brute_force(docs):
    first: dict[tuple, int] = {}
    words = {i: re.findall(WORD, t or "") for i, t, _ in corpus()}
    for i in sorted(words):
        for s in range(len(words[i]) - 12):
            first.setdefault(tuple(words[i][s : s + 13]), i)
    want = {}
    for i, w in words.items():
        gone = set()
        for s in range(len(w) - 12):
            if first[tuple(w[s : s + 13])] < i:
                gone.update(range(s, s + 13))
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        want[i] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in duplicate_spans(docs).collect()}
    assert got == want


def test_suffix_dedup_equals_brute_force(docs):
    raw = {i: (t or "").encode() for i, t, _ in corpus()}
    seen: set[bytes] = set()
    want = {}
    for i in sorted(raw):
        gone = np.zeros(len(raw[i]) + 1, dtype=bool)
        for s in range(len(raw[i]) - 99):
            window = raw[i][s : s + 100]
            if window in seen:
                gone[s : s + 100] = True
            seen.add(window)
        kept = bytes(b for b, g in zip(raw[i], gone, strict=False) if not g)
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        want[i] = (len(raw[i]), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in duplicate_bytes(docs).collect()}
    assert got == want


def odd_rows() -> list[tuple]:
    """Null ids, ids that repeat with one text and with several, null and empty texts, a long text of copies."""
    rng = random.Random(11)
    passage = " ".join(f"p{rng.randrange(900)}" for _ in range(40))
    other = " ".join(f"q{rng.randrange(900)}" for _ in range(40))
    rows = [(None, passage), (None, passage + " end"), (7, passage), (7, "x " + passage), (7, other), (7, other), (-3, passage + " " + other)]
    rows += [(i, f"a{i} {other} b{i} {passage}") for i in range(20, 40)] + [(50, None), (51, ""), (52, (passage + " ") * 200)]
    return rows


def later_than(a, b) -> bool:
    """Id ``a`` comes after ``b``; nulls last."""
    return (a is None, a if a is not None else 0) > (b is None, b if b is not None else 0)


def words_removed(rows: list[tuple]) -> list[tuple]:
    first: dict[tuple, object] = {}
    cut = [(i, re.findall(WORD, t or "")) for i, t in rows]
    for i, w in cut:
        for s in range(len(w) - 12):
            key = tuple(w[s : s + 13])
            if key not in first or later_than(first[key], i):
                first[key] = i
    out = []
    for i, w in cut:
        gone = {p for s in range(len(w) - 12) if later_than(i, first[tuple(w[s : s + 13])]) for p in range(s, s + 13)}
        out.append((i, len(w), len(gone)))
    return sorted(out, key=str)


def bytes_removed(rows: list[tuple]) -> list[tuple]:
    first: dict[bytes, tuple] = {}
    raw = [(i, (t or "").encode()) for i, t in rows]
    place = lambda i, s: (i is None, i if i is not None else 0, s)
    for i, r in raw:
        for s in range(len(r) - 99):
            first[r[s : s + 100]] = min(first.get(r[s : s + 100], place(i, s)), place(i, s))
    out = []
    for i, r in raw:
        gone = np.zeros(len(r), dtype=bool)
        for s in range(len(r) - 99):
            if first[r[s : s + 100]] < place(i, s):
                gone[s : s + 100] = True
        out.append((i, len(r), int(gone.sum())))
    return sorted(out, key=str)


@pytest.mark.parametrize("id_type", ["long", "string"])
def test_spans_with_null_and_repeated_ids(spark, id_type):
    # text ids in the order of the numbers
    name = (lambda i: i) if id_type == "long" else (lambda i: None if i is None else f"{i + 100:05d}")
    rows = [(name(i), t, "clash") for i, t in odd_rows()]
    docs = spark.createDataFrame(rows, f"doc_id {id_type}, text string, batch string").repartition(4)
    got = [(r["doc_id"], r["n_words"], r["n_removed"]) for r in duplicate_spans(docs, batch_bytes=4000, bucket_bytes=4000).collect()]
    want = [(name(i), *rest) for i, *rest in words_removed(odd_rows())]
    assert sorted(got, key=str) == sorted(want, key=str)
    got = [(r["doc_id"], r["n_bytes"], r["n_removed"]) for r in duplicate_bytes(docs, batch_bytes=4000, bucket_bytes=4000).collect()]
    want = [(name(i), *rest) for i, *rest in bytes_removed(odd_rows())]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_dedup_of_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    for operator in (duplicate_spans, duplicate_bytes, exact_dedup, keep_first, om.keep_first_of_class):
        assert operator(empty).count() == 0


def test_names_and_ranges_of_strings():
    rng = np.random.default_rng(2)
    sizes = np.array([100, 130, 168, 111])
    text = rng.integers(0, 2, sizes.sum()).astype(np.uint8)
    text[100:230] = text[230 + 20 : 230 + 150]  # the second piece is part of the third
    base = np.cumsum(sizes) - sizes
    of = np.repeat(np.arange(4), sizes - 99)
    nth = np.concatenate([np.arange(n - 99) for n in sizes])
    one, two = StringNames(text, sizes, 100).at(base[of] + nth, nth)
    raw = [text[s : s + 100].tobytes() for s in base[of] + nth]
    assert [(raw[i] == raw[j]) for i in range(len(raw)) for j in range(i)] == [(one[i] == one[j]) for i in range(len(raw)) for j in range(i)]
    assert len(set(two.tolist())) == len(set(raw))
    offset, windows = np.array([5, 68, 30, 5]), np.array([6, 69, 10, 1])
    ranges = offset_ranges(offset, windows, 8)
    assert [o for a, b in ranges for o in range(a, b + 1)] == list(range(69))


def test_kept_rows_keep_columns_of_any_name(spark):
    schema = "doc_id long, text string, `a.b` long, __sha string, sha string, key string, __near_key string, `row` int, keep_id int"
    text = "one two three four five six seven"
    rows = [(2, text, 1, "s", "t", "k", "n", 5, 6), (1, text, 2, "s2", "t2", "k2", "n2", 7, 8), (3, None, 3, None, None, None, None, 9, 0)]
    docs = spark.createDataFrame(rows, schema)
    for kept in (keep_first(docs), om.keep_first_of_class(docs)):
        assert kept.columns == docs.columns
        assert sorted(tuple(r) for r in kept.collect()) == sorted(rows[1:])
