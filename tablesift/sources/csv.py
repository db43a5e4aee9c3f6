"""CSV front end for profiling: every column read as text.

``CsvOptions`` carries the reader settings a profiling run needs (header,
charset, separator, quote, escape, leading-whitespace handling, whether a
quoted empty cell stays a blank distinct from null, whether the cells a short
record lacks are told from empty ones, multi-line records).  Everything maps
to Spark's own CSV reader and ``from_csv``; no parsing of our own.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesift.functions.text import column

# Private marker for a quoted empty cell (``""``) while reading; it is
# turned back into ``""`` right after the scan, so an unquoted empty cell
# (null) and a quoted one (blank) stay apart.
_BLANK_MARK = "\u0000tablesift-blank\u0000"
# Private marker of a cell that a short record doesn't have; it stays in the
# column, and the value plan drops it (``IndOptions.missing``).
MISSING_CELL = "\u0000tablesift-missing\u0000"
# Private cell put after the last one of a record, to find where it ends.
END_MARK = "\u0000tablesift-end\u0000"


@dataclass(frozen=True)
class CsvOptions:
    header: bool = True
    encoding: str = "UTF-8"
    sep: str = ";"
    quote: str = '"'
    escape: str = "\\"
    ignore_leading_whitespace: bool = False
    keep_blank: bool = False  # quoted "" -> "" (else null like an empty cell)
    mark_missing: bool = False  # cells past the end of a short record hold MISSING_CELL (else null)
    multi_line: bool = False  # records with quoted line breaks (stops file splitting)
    infer_schema: bool = False

    def reader_options(self) -> dict[str, str]:
        opts = {
            "header": str(self.header).lower(),
            "encoding": self.encoding,
            "sep": self.sep,
            "quote": self.quote,
            "escape": self.escape,
            "ignoreLeadingWhiteSpace": str(self.ignore_leading_whitespace).lower(),
            "ignoreTrailingWhiteSpace": "false",
            "inferSchema": str(self.infer_schema).lower(),
            "multiLine": str(self.multi_line).lower(),
            "mode": "PERMISSIVE",
        }
        if self.keep_blank:
            opts["emptyValue"] = _BLANK_MARK
        return opts

    def record_options(self) -> dict[str, str]:
        """The options that matter for one record that is parsed by itself."""
        opts = self.reader_options()
        return {k: opts[k] for k in ("sep", "quote", "escape", "ignoreLeadingWhiteSpace", "ignoreTrailingWhiteSpace", "mode")}


# Reader settings of the two IND presets: ``;``-separated, header line, all
# text.  ``STRICT_CSV`` also keeps quoted blanks apart from empty (null) cells,
# and both from cells that a short record doesn't have.
TRIMMED_CSV = CsvOptions()
STRICT_CSV = CsvOptions(keep_blank=True, mark_missing=True)
# Comma-separated, no header (records with names given by the caller).
PLAIN_CSV = CsvOptions(header=False, sep=",")


def generated_names(n: int) -> list[str]:
    """Names for a file without header: ``Attr_1 .. Attr_n``."""
    return [f"Attr_{i + 1}" for i in range(n)]


def text_schema(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def record_cells(record: Column, width: int, options: CsvOptions) -> Column:
    """The first ``width`` cells of a record, then the end mark where the record ends among them, as an array of ``width + 1``."""
    names = [f"c{i}" for i in range(width + 1)]
    ended = F.concat(record, F.lit(options.sep + END_MARK))
    parsed = F.from_csv(ended, ", ".join(f"{n} string" for n in names), options.record_options())
    return F.array(*[parsed.getField(n) for n in names])


def cell_count(record: Column, width: int, options: CsvOptions) -> Column:
    """Cells of a record, ``width`` at most.

    A record that swallows the end mark (an open quote, an escape at its end)
    counts as a full one.
    """
    at = F.array_position(record_cells(record, width, options), END_MARK)
    return F.when(at > 0, at - 1).otherwise(F.lit(width))


def _unused_name(names: list[str]) -> str:
    """A column name that is none of ``names``."""
    name = "_record"
    while name.lower() in {n.lower() for n in names}:
        name += "_"
    return name


def _with_missing_marked(df: DataFrame, names: list[str], record: str, options: CsvOptions) -> DataFrame:
    """``MISSING_CELL`` in the cells past the end of a short record.

    Spark keeps the text of a record whose cells are not as many as the
    columns; only those records are parsed a second time.
    """
    n_cells = F.when(column(record).isNotNull(), cell_count(column(record), len(names), options))
    # the count beside the record, so it's computed once
    counted = df.select(*[column(c) for c in names], n_cells.alias(record))
    marked = [
        F.when(column(record) <= F.lit(i), F.lit(MISSING_CELL)).otherwise(column(c)).alias(c) for i, c in enumerate(names)
    ]
    return counted.select(*marked)


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    options: CsvOptions = TRIMMED_CSV,
    names: list[str] | None = None,
    header: list[str] | None = None,
) -> DataFrame:
    """Read one CSV file, or a folder or list of same-layout files.

    Without a header the columns are ``Attr_1..`` unless ``names`` is given.
    A caller who knows the header line (``header``) spares the job that reads
    it.  Short records are null-filled, or hold ``MISSING_CELL`` with
    ``mark_missing``; extra cells are dropped (Spark's permissive mode).
    """
    reader = spark.read.options(**options.reader_options())
    mark = options.mark_missing and not options.infer_schema
    if header is None and not options.infer_schema and (mark or options.keep_blank):
        # a blank header cell has no mark in its name
        header = spark.read.options(**replace(options, keep_blank=False).reader_options()).csv(path).columns
    if header is None:
        df = reader.csv(path)
    elif mark:
        record = _unused_name(header)
        schema = text_schema([*header, record])
        # a scan of some columns still splits whole records, or it would not see which are short
        reader = reader.option("columnNameOfCorruptRecord", record).option("columnPruning", "false")
        df = reader.schema(schema).csv(path)
        df = _with_missing_marked(df, header, record, options)
    else:
        df = reader.schema(text_schema(header)).csv(path)
    if names is not None:
        df = df.toDF(*names)
    elif not options.header:
        df = df.toDF(*generated_names(len(df.columns)))
    if options.keep_blank and not options.infer_schema:
        df = df.select(*[F.when(column(c) == F.lit(_BLANK_MARK), F.lit("")).otherwise(column(c)).alias(c) for c in df.columns])
    return df


def read_typed_csv(spark: SparkSession, path: str, schema=None, options: CsvOptions | None = None) -> DataFrame:
    """Header CSV with typed columns: an explicit schema (preferred at
    scale, no inference pass) or inferred types."""
    opts = options or CsvOptions(sep=",", infer_schema=schema is None)
    reader = spark.read.options(**opts.reader_options())
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)
