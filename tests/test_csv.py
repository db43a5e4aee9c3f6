"""CSV front end and the folder job: hand-written files, and a round trip
of the star tables through ``;`` CSV compared with the parquet path."""

from __future__ import annotations

import os

import pytest

from tablesift.operators import attributes as A
from tablesift.operators import ind
from tablesift.plans.jobs import discover_folder, folder_space
from tablesift.sources.csv import MISSING_CELL, PLAIN_CSV, STRICT_CSV, TRIMMED_CSV, CsvOptions, read_csv
from tablesift.sources.folder import InputFolderError, list_files, load_folder, load_layouts, readable
from tablesift.sources.sinks import line_order, write_lines
from tablesift.sources.tables import STAR_TABLES, read_tables
from tests.conftest import SF_SMALL


def write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        f.write(text)


def test_quotes_blanks_and_short_rows(spark, tmp_dir):
    write(tmp_dir, "t.csv", 'A;B;C\n"a;b";"c\\"d";x\n;"";y\n1;2\n4;5;6;7\n')
    rows = [tuple(r) for r in read_csv(spark, os.path.join(tmp_dir, "t.csv"), STRICT_CSV).collect()]
    assert rows[0] == ("a;b", 'c"d', "x")
    assert rows[1] == (None, "", "y")  # empty cell is null, quoted empty is blank
    assert rows[2] == ("1", "2", MISSING_CELL)  # a short row's missing cell
    assert rows[3] == ("4", "5", "6")  # extra cell dropped
    trimmed = [tuple(r) for r in read_csv(spark, os.path.join(tmp_dir, "t.csv"), TRIMMED_CSV).collect()]
    assert trimmed[1][:2] == (None, None)
    assert trimmed[2] == ("1", "2", None)  # short row null-filled


def test_no_header_and_named_columns(spark, tmp_dir):
    write(tmp_dir, "g.csv", "1,ann,pw,ACGT\n2,bob,pw2,CGTA\n")
    df = read_csv(spark, os.path.join(tmp_dir, "g.csv"), PLAIN_CSV)
    assert df.columns == ["Attr_1", "Attr_2", "Attr_3", "Attr_4"]
    named = read_csv(spark, os.path.join(tmp_dir, "g.csv"), PLAIN_CSV, names=["ID", "Name", "Password", "Gene"])
    assert named.columns == ["ID", "Name", "Password", "Gene"]
    assert named.count() == 2


def test_duplicate_and_dotted_headers(spark, tmp_dir):
    write(tmp_dir, "d.csv", "A;A;x.y\n1;2;1\n2;1;2\n")
    tables = load_folder(spark, tmp_dir, TRIMMED_CSV)
    space = A.AttributeSpace.build(spark, tables, A.TRIMMED)
    assert space.size == 3
    pairs = {tuple(r) for r in ind.unary_inds(space).collect()}
    names = tables["d.csv"].columns
    assert names[2] == "x.y"
    assert (names[0], "x.y") in pairs and ("x.y", names[1]) in pairs


def test_folder_listing_ignores_subfolders(spark, tmp_dir):
    write(tmp_dir, "a.csv", "k\n1\n")
    write(os.path.join(tmp_dir, "sub"), "b.csv", "k\n2\n")
    files = list_files(spark, tmp_dir)
    assert [os.path.basename(f) for f in files] == ["a.csv"]


def test_missing_and_empty_folder(spark, tmp_dir):
    missing = os.path.join(tmp_dir, "nope")
    assert discover_folder(spark, missing, "trimmed").count() == 0
    with pytest.raises(InputFolderError):
        discover_folder(spark, missing, "strict")
    empty = os.path.join(tmp_dir, "empty")
    os.makedirs(empty)
    assert discover_folder(spark, empty, "trimmed").count() == 0
    with pytest.raises(InputFolderError):
        discover_folder(spark, empty, "strict")


def test_output_replaced_even_when_empty(spark, tmp_dir):
    data = os.path.join(tmp_dir, "data")
    out = os.path.join(tmp_dir, "out")
    write(data, "t.csv", "a;b\n1;1\n2;2\n")
    discover_folder(spark, data, "trimmed", output=out)
    first = spark.read.text(out).collect()
    assert sorted(r.value for r in first) == ["a < b", "b < a"]
    write(data, "t.csv", "a;b\n1;2\n")
    discover_folder(spark, data, "trimmed", output=out)
    assert spark.read.text(out).count() == 0


def test_strict_blank_versus_null_through_csv(spark, tmp_dir):
    write(tmp_dir, "t.csv", 'a;b\n1;1\n;""\n')
    lines = {r.line for r in discover_folder(spark, tmp_dir, "strict").collect()}
    assert lines == set()  # a holds null, b holds blank: different values
    trimmed = {r.line for r in discover_folder(spark, tmp_dir, "trimmed").collect()}
    assert trimmed == {"a < b", "b < a"}


def _write_star_csv(spark, folder):
    from pyspark.sql import functions as F

    os.makedirs(folder, exist_ok=True)
    for name, df in read_tables(spark, SF_SMALL, STAR_TABLES).items():
        text = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns]).toPandas()
        text.to_csv(os.path.join(folder, f"{name}.csv"), sep=";", index=False)


def test_csv_round_trip_equals_parquet(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "star")
    _write_star_csv(spark, folder)
    parquet = read_tables(spark, SF_SMALL, STAR_TABLES)
    for preset, lines_of in (("trimmed", ind.ind_lines_grouped), ("strict", ind.ind_lines_pairs)):
        expected = {r.line for r in lines_of(A.AttributeSpace.build(spark, parquet, A.PRESETS[preset])).collect()}
        got = {r.line for r in discover_folder(spark, folder, preset).collect()}
        assert got == expected, preset
        assert len(got) == (16 if preset == "trimmed" else 95)


def test_folder_listing_sibling_and_path_forms(spark, tmp_dir):

    write(os.path.join(tmp_dir, "a"), "x.csv", "k\n1\n")
    write(os.path.join(tmp_dir, "ba"), "y.csv", "k\n2\n")
    folder = os.path.join(tmp_dir, "a")
    assert [os.path.basename(f) for f in list_files(spark, folder)] == ["x.csv"]
    assert [os.path.basename(f) for f in list_files(spark, folder + "/")] == ["x.csv"]
    assert [os.path.basename(f) for f in list_files(spark, "file:" + folder)] == ["x.csv"]


def test_quoted_header_comma_file(spark, tmp_dir):
    # Same shape as the reference's toy input: quoted header, commas, no final newline.
    from tablesift.sources.csv import CsvOptions

    write(tmp_dir, "toy.csv", '"Name","Age"\n1,2\n3,4\n5,6')
    opts = CsvOptions(sep=",")
    tables = load_folder(spark, tmp_dir, opts)
    assert tables["toy.csv"].columns == ["Name", "Age"]
    assert [tuple(r) for r in tables["toy.csv"].collect()] == [("1", "2"), ("3", "4"), ("5", "6")]
    assert discover_folder(spark, tmp_dir, "trimmed", csv=opts).count() == 0
    write(tmp_dir, "more.csv", '"Id"\n3\n5')
    lines = {r.line for r in discover_folder(spark, tmp_dir, "trimmed", csv=opts).collect()}
    assert lines == {"Id < Name"}


def test_every_plain_file_of_a_folder_counts(spark, tmp_dir):
    for name in ("a.csv", "_b.csv", ".c.csv", "q[1].csv"):
        with open(os.path.join(tmp_dir, name), "w") as f:
            f.write(f"x\n{name}\n")
    for sub in ("p=1", os.path.join("p=x", "q=2")):
        os.makedirs(os.path.join(tmp_dir, sub))
        with open(os.path.join(tmp_dir, sub, "d.csv"), "w") as f:
            f.write("x\n1\n")
    tables = load_folder(spark, tmp_dir)
    assert {n: [r.x for r in t.collect()] for n, t in tables.items()} == {n: [n] for n in ("a.csv", "_b.csv", ".c.csv", "q[1].csv")}


def test_sorted_parts_and_their_manifest(spark, tmp_dir):
    out = os.path.join(tmp_dir, "lines")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        # a third of all lines are one line
        lines = spark.range(3000).selectExpr("if(id % 3 = 0, 'same', sha2(string(id), 256)) as line").repartition(5)
        write_lines(lines, out)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    names = sorted(n for n in os.listdir(out) if n.startswith("part-"))
    assert len(names) > 1
    texts = [open(os.path.join(out, n), encoding="utf-8").read().splitlines() for n in names]
    want = sorted(r.line for r in lines.collect())
    assert [t for part in texts for t in part] == want
    assert spark.read.text(out).count() == 3000
    manifest = sorted(tuple(r) for r in line_order(spark, out).collect())
    assert manifest == [(n, len(t), t[0], t[-1]) for n, t in zip(names, texts, strict=True) if t]
    write_lines(lines.where("false"), out)
    assert spark.read.text(out).count() == 0 and line_order(spark, out).count() == 0


def test_short_records_add_nothing_in_strict(spark, tmp_dir):
    # a: 1, 4, x and nothing else; b lacks the short records' cells; c has an empty (null) cell
    write(tmp_dir, "t.csv", 'A;B;C\n1;"";x\n4\n\n"p;q";;y\n7;8;9;10\n')
    df = read_csv(spark, os.path.join(tmp_dir, "t.csv"), STRICT_CSV)
    assert [tuple(r) for r in df.collect()] == [
        ("1", "", "x"),
        ("4", MISSING_CELL, MISSING_CELL),
        ("p;q", None, "y"),
        ("7", "8", "9"),
    ]
    # a scan of one column still sees which records are short
    assert [r.B for r in df.select("B").collect()] == ["", MISSING_CELL, None, "8"]
    space = folder_space(spark, tmp_dir, "strict")
    values = {(r.attribute_column, r.value) for r in A.attribute_values(space).select("attribute_column", "value").collect()}
    assert values == {("A", "1"), ("A", "4"), ("A", "p;q"), ("A", "7"), ("B", ""), ("B", None), ("B", "8"), ("C", "x"), ("C", "y"), ("C", "9")}
    # a record with line breaks inside quotes is a short one, too
    several = CsvOptions(keep_blank=True, mark_missing=True, multi_line=True)
    write(os.path.join(tmp_dir, "m"), "m.csv", 'A;B\n"1\n2"\n3;"4\n5"\n')
    rows = [tuple(r) for r in read_csv(spark, os.path.join(tmp_dir, "m", "m.csv"), several).collect()]
    assert rows == [("1\n2", MISSING_CELL), ("3", "4\n5")]


def test_short_records_change_inclusion(spark, tmp_dir):
    # by null filling, b would hold a null that c doesn't have
    write(tmp_dir, "t.csv", "a;b\n1;2\n3\n")
    write(tmp_dir, "u.csv", "c\n2\n")
    assert {r.line for r in discover_folder(spark, tmp_dir, "strict").collect()} == {
        "t -> u: [b] c [c]",
        "u -> t: [c] c [b]",
    }


HEADERS = ["a;b;c", "a;A;b", ";x;", '"q;r";s', "a;a;a", "x.y;z`w", "only", '"";k', ' lead;trail ', '"open']


def test_headers_of_a_folder_are_those_of_the_reader(spark, tmp_dir):
    for i, line in enumerate(HEADERS):
        write(tmp_dir, f"f {i}%20[{i}].csv", f"\n{line}\n1;2;3\n")
    write(tmp_dir, "none.csv", "")
    write(tmp_dir, "blank.csv", "\n\n")
    for options in (TRIMMED_CSV, STRICT_CSV, CsvOptions(header=False, sep=";"), CsvOptions(ignore_leading_whitespace=True)):
        got = load_folder(spark, tmp_dir, options)
        want = {os.path.basename(f): read_csv(spark, readable(spark, f), options) for f in list_files(spark, tmp_dir)}
        assert {n: t.columns for n, t in got.items()} == {n: t.columns for n, t in want.items()}
        for n in want:
            assert sorted(map(tuple, got[n].collect()), key=str) == sorted(map(tuple, want[n].collect()), key=str), n


def test_jobs_of_a_folder_do_not_grow_with_its_files(spark, tmp_dir):
    def jobs(n):
        folder = os.path.join(tmp_dir, str(n))
        for i in range(n):
            write(folder, f"{i:04}.csv", f"k{i % 3};v\n{i};{i + 1}\n")
        group = f"folder-{n}"
        spark.sparkContext.setJobGroup(group, group)
        try:
            files, layouts = load_folder(spark, folder), load_layouts(spark, folder)
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert len(files) == n and len(layouts) == 3
        assert sorted(int(r.v) for t in layouts.values() for r in t.collect()) == list(range(1, n + 1))
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    # two jobs a read of the headers; Spark lists more than 32 paths by one more job a scan
    assert jobs(10) == 4
    assert jobs(100) == jobs(120) == 9


def test_equal_headers_share_a_scan(spark, tmp_dir):
    for i in range(4):
        write(tmp_dir, f"part{i}.csv", f"a;b\n{i};{i}\n")
    write(tmp_dir, "other.csv", "c\n0\n1\n2\n3\n")
    space = folder_space(spark, tmp_dir, "trimmed")
    assert sorted(t.columns for t in space.tables.values()) == [["a", "b"], ["c"]]
    lines = {r.line for r in discover_folder(spark, tmp_dir, "trimmed").collect()}
    assert lines == {"a < b, c", "b < a, c", "c < a, b"}
