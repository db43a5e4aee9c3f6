"""End-to-end job: a folder of CSV files -> unary INDs -> a text file.

Preset ``trimmed``: ``;`` files with header, attributes by bare column name,
trimmed values, nulls and blanks dropped; one line per dependent
(``DEP < REF1, REF2``).  A missing or empty folder gives an empty result.
Files with equal headers are one table, read by one scan.

Preset ``strict``: same files, attributes by (file, column), raw values with
null and blank kept apart, cells that a short record lacks left out; one line per IND (``depFile -> refFile: [dep] c
[ref]``).  A missing or empty folder is an error.

Either way an existing output is replaced, also by an empty result.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tablesift.operators import ind
from tablesift.operators.attributes import PRESETS, AttributeSpace
from tablesift.sources.csv import MISSING_CELL, STRICT_CSV, TRIMMED_CSV, CsvOptions
from tablesift.sources.folder import load_folder, load_layouts
from tablesift.sources.sinks import write_lines


def folder_space(spark: SparkSession, path: str, preset: str = "trimmed", csv: CsvOptions | None = None) -> AttributeSpace:
    options = PRESETS[preset]
    strict = preset == "strict"
    csv = csv or (STRICT_CSV if strict else TRIMMED_CSV)
    if csv.mark_missing:
        options = replace(options, missing=MISSING_CELL)
    tables = load_folder(spark, path, csv, missing_ok=False) if strict else load_layouts(spark, path, csv)
    return AttributeSpace.build(spark, tables, options)


def discover_folder(
    spark: SparkSession,
    path: str,
    preset: str = "trimmed",
    output: str | None = None,
    csv: CsvOptions | None = None,
) -> DataFrame:
    """Run IND discovery over every file of ``path``; return the text lines
    and, with ``output``, write them there (sorted, one file)."""
    space = folder_space(spark, path, preset, csv)
    if space.size == 0:
        lines = spark.createDataFrame([], T.StructType([T.StructField("line", T.StringType())]))
    elif preset == "strict":
        lines = ind.ind_lines_pairs(space)
    else:
        lines = ind.ind_lines_grouped(space)
    if output is not None:
        write_lines(lines, output, single_file=True)  # bounded by the attribute pairs
    return lines
