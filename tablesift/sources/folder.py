"""A folder of CSV files as a set of tables.

Files are listed through the Hadoop file system of the folder's path, so local
disks, HDFS and object stores are alike.  Every plain file directly in the
folder counts, also one whose name begins with ``_`` or ``.``; sub-folders are
ignored.  One job reads the header lines of all files, so the number of jobs
doesn't grow with the number of files; files with equal headers can be read by
one scan (``load_layouts``).
"""

from __future__ import annotations

import os
import posixpath
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesift.session import checkpoint_dir
from tablesift.sources.csv import END_MARK, TRIMMED_CSV, CsvOptions, read_csv, record_cells


class InputFolderError(ValueError):
    """The input folder is missing or holds no file."""


def _file_system(spark: SparkSession, path: str):
    """The path as Hadoop has it, its file system and the configuration."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(conf), conf


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Paths of the plain files directly in ``path``, sorted; none if the folder is missing."""
    # a local path is one even if the default file system is another
    if "://" not in path and not path.startswith("file:") and os.path.isdir(path):
        path = "file:" + os.path.abspath(path)
    where, fs, _ = _file_system(spark, path)
    if not fs.exists(where):
        return []
    return sorted(s.getPath().toString() for s in fs.listStatus(where) if s.isFile())


def readable(spark: SparkSession, file: str) -> str:
    """A path that Spark's readers take for this one file.

    They read a path as a glob, so its special characters are escaped, and
    skip names that begin with ``_`` or ``.``, so such a file is copied to the
    shared checkpoint folder under a name of its own.
    """
    if posixpath.basename(file).startswith(("_", ".")):
        source, fs, conf = _file_system(spark, file)
        copy = f"{checkpoint_dir(spark)}/shown-{uuid.uuid4().hex}/file-{posixpath.basename(file)}"
        target, target_fs, _ = _file_system(spark, copy)
        spark._jvm.org.apache.hadoop.fs.FileUtil.copy(fs, source, target_fs, target, False, conf)
        file = copy
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", file)


# One file a task while header lines are read: splits of this many bytes, and
# every file counted as that long when files are packed into tasks.
_WHOLE_FILE = 1 << 40


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]):
    """Session settings that hold inside the block."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _first_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first line that isn't blank, of a task that reads one file from its start; the rest is not read."""
    for batch in batches:
        found = batch.filter(pc.and_(pc.equal(batch.column("start"), 0), pc.not_equal(pc.utf8_trim_whitespace(batch.column("line")), "")))
        if found.num_rows:
            yield found.slice(0, 1).select(["file", "line"])
            return
        if batch.num_rows and batch.column("start")[0].as_py() > 0:
            return


def first_lines(spark: SparkSession, files: list[str]) -> dict[str, str]:
    """First line that isn't blank by file name, for the files (names are distinct) that have one.

    One job with a task for each file, which stops after the first lines.
    """
    if not files:
        return {}
    # a few lines at a time, so a task reads no more of its file than it needs
    values = {"maxPartitionBytes": str(_WHOLE_FILE), "openCostInBytes": str(_WHOLE_FILE)}
    values = {f"spark.sql.files.{k}": v for k, v in values.items()} | {"spark.sql.execution.arrow.maxRecordsPerBatch": "16"}
    with _settings(spark, values):
        lines = spark.read.text(files).select(
            F.col("value").alias("line"), F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("start")
        )
        rows = lines.mapInArrow(_first_lines, "file string, line string").collect()
    # Spark gives names as in a URL
    return {unquote(r["file"]): r["line"] for r in rows}


def header_names(spark: SparkSession, lines: set[str], options: CsvOptions) -> dict[str, list[str] | None]:
    """Column names of each header line, by the rules of Spark's CSV reader; None for a line that ends inside a quoted cell.

    A cell without text is named ``_c`` and its place; of names that are equal
    (letter case apart, unless the session minds it) each has its place added.
    """
    if not lines:
        return {}
    width = max(line.count(options.sep) for line in lines) + 1
    rows = spark.createDataFrame([(line,) for line in sorted(lines)], "line string")
    rows = rows.select("line", record_cells(F.col("line"), width, options).alias("cells"))
    exact = spark.conf.get("spark.sql.caseSensitive") == "true"
    out = {}
    for line, cells in rows.collect():
        if END_MARK not in cells:
            out[line] = None
            continue
        cells = cells[: cells.index(END_MARK)]
        seen = Counter(c if exact else c.lower() for c in cells if c)
        out[line] = [
            f"_c{i}" if not c else f"{c}{i}" if seen[c if exact else c.lower()] > 1 else c for i, c in enumerate(cells)
        ]
    return out


def _headers(spark: SparkSession, files: dict[str, str], options: CsvOptions) -> dict[str, list[str] | None]:
    """Column names by file name; empty for a file without a line, None where only Spark's own reader of the one file tells.

    That is so for inferred types, records with line breaks, encodings other
    than UTF-8, and header lines that end inside a quoted cell.
    """
    if options.infer_schema or options.multi_line or options.encoding.upper().replace("-", "") != "UTF8":
        return dict.fromkeys(files)
    lines = first_lines(spark, list(files.values()))
    # the copy of a hidden file has a name of its own
    lines = {name: lines.get(posixpath.basename(re.sub(r"\\(.)", r"\1", f))) for name, f in files.items()}
    names = header_names(spark, {v for v in lines.values() if v is not None}, options)
    return {name: [] if line is None else names[line] for name, line in lines.items()}


def _listed(spark: SparkSession, path: str, missing_ok: bool) -> dict[str, str]:
    """File name -> path that Spark's readers take."""
    files = list_files(spark, path)
    if not files and not missing_ok:
        raise InputFolderError(f"input folder {path} does not exist or is empty")
    return {posixpath.basename(f): readable(spark, f) for f in files}


def _read(spark: SparkSession, files: str | list[str], options: CsvOptions, header: list[str] | None) -> DataFrame:
    if header is not None and not header:
        return spark.createDataFrame([], T.StructType([]))
    return read_csv(spark, files, options, header=header)


def load_folder(
    spark: SparkSession,
    path: str,
    options: CsvOptions = TRIMMED_CSV,
    missing_ok: bool = True,
) -> dict[str, DataFrame]:
    """File name -> DataFrame for every file in the folder; one without a line has no columns.

    With ``missing_ok`` a missing or empty folder gives no tables (an empty
    result downstream); otherwise it raises ``InputFolderError``.
    """
    files = _listed(spark, path, missing_ok)
    headers = _headers(spark, files, options)
    return {name: _read(spark, f, options, headers[name]) for name, f in files.items()}


def load_layouts(
    spark: SparkSession,
    path: str,
    options: CsvOptions = TRIMMED_CSV,
    missing_ok: bool = True,
) -> dict[str, DataFrame]:
    """Layout -> DataFrame over all files of the folder with equal column names in equal order, one scan each.

    A layout is named by its first file.  Files without a line have no layout.
    """
    files = _listed(spark, path, missing_ok)
    headers = _headers(spark, files, options)
    layouts: dict[tuple, list[str]] = {}
    for name in files:
        header = headers[name]
        layouts.setdefault((name,) if header is None else (None, *header), []).append(name)
    return {
        names[0]: _read(spark, [files[n] for n in names], options, headers[names[0]])
        for key, names in layouts.items()
        if key != (None,)
    }
