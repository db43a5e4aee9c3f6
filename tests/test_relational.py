"""Relational operators: null handling, ties, fills, parse filters, counters."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tablesift.operators import relational as R

PEOPLE = "name string, company string, salary double, id long"


def people(spark):
    rows = [
        ("Berget", "Apple", 10.0, 1),
        ("Bianka", "Apple", 12.0, 2),
        ("Cally", "Microsoft", 12.0, 3),
        ("Dora", "Microsoft", 12.0, 4),
        (None, "Apple", 1.0, 5),
        ("Eve", "Other", 3.0, 6),
    ]
    return spark.createDataFrame(rows, PEOPLE)


def test_membership_with_nulls(spark):
    df = people(spark)
    names = ["Berget", "Bianka", "Cally"]
    assert {r.id for r in R.filter_members(df, "name", names).collect()} == {1, 2, 3}
    assert {r.id for r in R.filter_members(df, "name", names, negate=True).collect()} == {4, 5, 6}
    assert [r.id for r in R.filter_equals(df, "name", names[1]).collect()] == [2]
    lst = spark.createDataFrame([(n,) for n in names + [None]], "n string")
    assert {r.id for r in R.filter_members(df, "name", lst).collect()} == {1, 2, 3}
    assert {r.id for r in R.filter_members(df, "name", lst, negate=True).collect()} == {4, 5, 6}


def test_group_top_ties(spark):
    top = {r.company: (r.name, r.salary) for r in R.group_top(people(spark), "company", "salary", ["name"], "id").collect()}
    assert top == {"Apple": ("Bianka", 12.0), "Microsoft": ("Cally", 12.0), "Other": ("Eve", 3.0)}


def test_top_k_tie_at_edge(spark):
    rows = R.top_k(people(spark), [F.col("salary").desc(), F.col("id")], 2).collect()
    assert [r.id for r in rows] == [2, 3]


def test_counters_and_observation(spark):
    df = people(spark)
    conds = {"apple": F.col("company") == "Apple", "microsoft": F.col("company") == "Microsoft"}
    row = R.conditional_counts(df, conds).collect()[0]
    assert (row.apple, row.microsoft) == (3, 2)
    observed, obs = R.observe_counts(df, conds)
    assert observed.count() == 6
    assert obs.get == {"apple": 3, "microsoft": 2}


def test_fill_only_string_columns(spark):
    df = spark.createDataFrame(
        [(1, None, None, None), (2, dt.date(2024, 1, 1), dt.datetime(2024, 1, 1, 1), "x")],
        "id long, d date, ts timestamp, s string",
    )
    out = {r.id: r for r in R.fill_and_flag_nulls(df, "unset", ["d", "ts", "s"]).collect()}
    assert out[1].d is None and out[1].ts is None and out[1].s == "unset"
    assert out[2].s == "x"


def test_parse_filter_drops_non_numbers(spark):
    df = spark.createDataFrame([("4",), ("2",), ("x",), (None,), ("10",)], "sem string")
    assert {r.sem for r in df.where(R.parse_filter(F.col("sem"), 3)).collect()} == {"4", "10"}


def test_linear_and_text_maps(spark):
    df = spark.range(5)
    assert [r.v for r in df.select(R.linear_map(F.col("id")).alias("v")).collect()] == [0.5, 2.5, 4.5, 6.5, 8.5]
    t, back = R.text_and_int(F.col("id"))
    assert df.select(t.alias("t"), back.alias("b")).collect()[3] == ("3", 3)
