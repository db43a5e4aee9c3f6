"""License scan by ordered signature rules.

A text is reduced to its words (lower case, single spaces, one space at each
end), so a rule is a regular expression over words.  Rules are gated: a rule
runs on a text only if the text has the rule's keyword as a word, and texts
with no keyword run none.  Detections are word intervals.  They are put in
order (start, longest first, priority) and one that lies inside an interval of
the same or a higher priority is suppressed.

Everything is one Spark projection of built-in functions: no shuffle, no
Python, nothing kept beside the row.

Defined results: a null text counts as empty (no words, no labels, score 0);
repeated rows are judged one by one; only the id and text columns are read.
``lower`` also folds letters beyond A-Z; no word boundary and no signature
depends on those.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Fixed by the contract: phrase and label.
BASE_PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)


@dataclass(frozen=True)
class Signature:
    """``pattern`` is matched over whole words; higher ``priority`` wins; ``weight`` is its confidence (0 to 1)."""

    label: str
    keyword: str
    pattern: str
    priority: int
    weight: float


# Word patterns.  {v} stands for each version of the row, {w} for the same version as words (a dot parts words).
_V = r"(?: (?:version|v|ver))? v?{w}"
_LATER = r"(?: or (?:at your option )?(?:any )?(?:later|newer|higher)(?: version)?)"

# label | keyword | pattern | versions | priority | weight
_FAMILIES = (
    ("gpl-{v}-or-later", "gnu", r"gnu general public licen[sc]e" + _V + _LATER, "1 1.0 2 2.0 3 3.0", 5, 1.0),
    ("gpl-{v}", "gnu", r"gnu general public licen[sc]e" + _V, "1 1.0 2 2.0 3 3.0", 4, 1.0),
    ("gpl-{v}", "gnu", r"gnu gpl" + _V, "1 1.0 2 2.0 3 3.0", 4, 0.95),
    ("gpl-{v}", "gpl", r"gpl" + _V, "1 1.0 2 2.0 3 3.0", 3, 0.8),
    ("gpl-{v}", "gplv{n}", r"gplv{n}", "1 2 3", 3, 0.8),
    ("gpl", "gnu", r"gnu (?:gpl|general public licen[sc]e)", "", 2, 0.7),
    ("lgpl-{v}-or-later", "gnu", r"gnu (?:lesser|library) general public licen[sc]e" + _V + _LATER, "2 2.0 2.1 3 3.0", 5, 1.0),
    ("lgpl-{v}", "gnu", r"gnu (?:lesser|library) general public licen[sc]e" + _V, "2 2.0 2.1 3 3.0", 4, 1.0),
    ("lgpl-{v}", "lgpl", r"(?:gnu )?lgpl" + _V, "2 2.0 2.1 3 3.0", 3, 0.8),
    ("lgpl", "gnu", r"gnu (?:lgpl|(?:lesser|library) general public licen[sc]e)", "", 2, 0.7),
    ("agpl-{v}-or-later", "affero", r"(?:gnu )?affero general public licen[sc]e" + _V + _LATER, "1 1.0 3 3.0", 5, 1.0),
    ("agpl-{v}", "affero", r"(?:gnu )?affero general public licen[sc]e" + _V, "1 1.0 3 3.0", 4, 1.0),
    ("agpl-{v}", "agpl", r"(?:gnu )?agpl" + _V, "1 1.0 3 3.0", 3, 0.8),
    ("agpl", "affero", r"(?:gnu )?affero general public licen[sc]e", "", 2, 0.7),
    ("gfdl-{v}", "gnu", r"gnu free documentation licen[sc]e" + _V, "1.1 1.2 1.3", 4, 1.0),
    ("gfdl", "gnu", r"gnu free documentation licen[sc]e", "", 2, 0.7),
    ("apache-{v}", "apache", r"apache(?: software)? licen[sc]e" + _V, "1 1.0 1.1 2 2.0", 4, 1.0),
    ("apache-{v}", "apache", r"apache" + _V, "1.0 1.1 2.0", 3, 0.7),
    ("apache", "apache", r"apache(?: software)? licen[sc]e", "", 2, 0.7),
    ("mit", "mit", r"(?:the )?mit licen[sc]e(?: mit)?", "", 3, 0.9),
    ("mit", "mit", r"(?:licen[sc]ed|released|distributed|available) under(?: the)?(?: terms of(?: the)?)? mit(?: licen[sc]e)?", "", 4, 1.0),
    ("mit", "permission", r"permission is hereby granted free of charge to any person obtaining a copy", "", 4, 1.0),
    ("bsd-2-clause", "bsd", r"(?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd)(?: licen[sc]e)?", "", 4, 0.95),
    ("bsd-3-clause", "bsd", r"(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd)(?: licen[sc]e)?", "", 4, 0.95),
    ("bsd-4-clause", "bsd", r"(?:bsd 4 clause|4 clause bsd|original bsd)(?: licen[sc]e)?", "", 4, 0.95),
    ("0bsd", "0bsd", r"(?:bsd )?0bsd(?: licen[sc]e)?", "", 4, 0.9),
    ("bsd", "bsd", r"bsd(?: style)? licen[sc]e", "", 2, 0.7),
    ("bsd", "redistribution", r"redistribution and use in source and binary forms with or without modification", "", 3, 0.9),
    ("cc-by-nc-nd-{v}", "cc", r"cc by nc nd" + _V, "1.0 2.0 2.5 3.0 4.0", 5, 1.0),
    ("cc-by-nc-sa-{v}", "cc", r"cc by nc sa" + _V, "1.0 2.0 2.5 3.0 4.0", 5, 1.0),
    ("cc-by-nc-{v}", "cc", r"cc by nc" + _V, "1.0 2.0 2.5 3.0 4.0", 4, 1.0),
    ("cc-by-nd-{v}", "cc", r"cc by nd" + _V, "1.0 2.0 2.5 3.0 4.0", 4, 1.0),
    ("cc-by-sa-{v}", "cc", r"cc by sa" + _V, "1.0 2.0 2.5 3.0 4.0", 4, 1.0),
    ("cc-by-{v}", "cc", r"cc by" + _V, "1.0 2.0 2.5 3.0 4.0", 3, 1.0),
    ("cc-by-nc-nd", "cc", r"cc by nc nd", "", 4, 0.8),
    ("cc-by-nc-sa", "cc", r"cc by nc sa", "", 4, 0.8),
    ("cc-by-nc", "cc", r"cc by nc", "", 3, 0.8),
    ("cc-by-nd", "cc", r"cc by nd", "", 3, 0.8),
    ("cc-by-sa", "cc", r"cc by sa", "", 3, 0.8),
    ("cc-by", "cc", r"cc by", "", 2, 0.7),
    ("cc-by-nc-nd-{v}", "creative", r"creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?(?: licen[sc]e)?" + _V, "1.0 2.0 2.5 3.0 4.0", 5, 1.0),
    ("cc-by-nc-sa-{v}", "creative", r"creative commons attribution non ?commercial share ?alike(?: licen[sc]e)?" + _V, "1.0 2.0 2.5 3.0 4.0", 5, 1.0),
    ("cc-by-nc-{v}", "creative", r"creative commons attribution non ?commercial(?: licen[sc]e)?" + _V, "1.0 2.0 2.5 3.0 4.0", 4, 1.0),
    ("cc-by-nd-{v}", "creative", r"creative commons attribution no ?deriv(?:ative)?s?(?: works)?(?: licen[sc]e)?" + _V, "1.0 2.0 2.5 3.0 4.0", 4, 1.0),
    ("cc-by-sa-{v}", "creative", r"creative commons attribution share ?alike(?: licen[sc]e)?" + _V, "1.0 2.0 2.5 3.0 4.0", 4, 1.0),
    ("cc-by-{v}", "creative", r"creative commons attribution(?: licen[sc]e)?" + _V, "1.0 2.0 2.5 3.0 4.0", 3, 1.0),
    ("cc", "creative", r"creative commons(?: attribution)?(?: licen[sc]e)?", "", 1, 0.6),
    ("cc0-1.0", "cc0", r"cc0(?: 1 0)?(?: universal)?", "", 3, 0.9),
    ("cc0-1.0", "creative", r"creative commons (?:cc0|zero)(?: 1 0)?(?: universal)?", "", 4, 1.0),
    ("mpl-{v}", "mozilla", r"mozilla public licen[sc]e" + _V, "1.0 1.1 2.0", 4, 1.0),
    ("mpl-{v}", "mpl", r"mpl" + _V, "1.0 1.1 2.0", 3, 0.8),
    ("mpl", "mozilla", r"mozilla public licen[sc]e", "", 2, 0.7),
    ("epl-{v}", "eclipse", r"eclipse public licen[sc]e" + _V, "1.0 2.0", 4, 1.0),
    ("epl", "eclipse", r"eclipse public licen[sc]e", "", 2, 0.7),
    ("edl-1.0", "eclipse", r"eclipse distribution licen[sc]e(?: (?:version|v))?(?: 1 0)?", "", 4, 0.9),
    ("cddl-{v}", "distribution", r"common development and distribution licen[sc]e" + _V, "1.0 1.1", 4, 1.0),
    ("cddl-{v}", "cddl", r"cddl" + _V, "1.0 1.1", 3, 0.8),
    ("cpl-1.0", "common", r"common public licen[sc]e(?: (?:version|v))? 1 0", "", 4, 0.9),
    ("eupl-{v}", "european", r"european union public licen[sc]e" + _V, "1.0 1.1 1.2", 4, 1.0),
    ("eupl-{v}", "eupl", r"eupl" + _V, "1.0 1.1 1.2", 3, 0.8),
    ("osl-{v}", "open", r"open software licen[sc]e" + _V, "1.0 1.1 2.0 2.1 3.0", 4, 1.0),
    ("afl-{v}", "academic", r"academic free licen[sc]e" + _V, "1.1 1.2 2.0 2.1 3.0", 4, 1.0),
    ("artistic-{v}", "artistic", r"artistic licen[sc]e" + _V, "1.0 2.0", 4, 1.0),
    ("artistic", "artistic", r"artistic licen[sc]e", "", 2, 0.7),
    ("bsl-{v}", "boost", r"boost software licen[sc]e" + _V, "1.0", 4, 1.0),
    ("bsl", "boost", r"boost software licen[sc]e", "", 2, 0.7),
    ("busl-1.1", "business", r"business source licen[sc]e(?: (?:version|v))?(?: 1 1)?", "", 4, 0.9),
    ("ms-pl", "microsoft", r"microsoft public licen[sc]e", "", 4, 0.9),
    ("ms-rl", "microsoft", r"microsoft reciprocal licen[sc]e", "", 4, 0.9),
    ("odbl-1.0", "database", r"open database licen[sc]e(?: (?:version|v))?(?: 1 0)?", "", 4, 0.9),
    ("ofl-1.1", "font", r"(?:sil )?open font licen[sc]e(?: (?:version|v))?(?: 1 1)?", "", 4, 0.9),
    ("isc", "isc", r"isc licen[sc]e", "", 4, 0.9),
    ("zlib", "zlib", r"zlib(?: libpng)? licen[sc]e", "", 4, 0.9),
    ("unlicense", "unlicense", r"the unlicense", "", 4, 0.9),
    ("unlicense", "unencumbered", r"free and unencumbered software released into the public domain", "", 4, 1.0),
    ("public-domain", "domain", r"(?:in|into|to) the public domain", "", 2, 0.8),
    ("wtfpl", "wtfpl", r"wtfpl(?: v?2)?", "", 4, 0.9),
    ("postgresql", "postgresql", r"postgresql licen[sc]e", "", 4, 0.9),
    ("python-{v}", "python", r"python(?: software foundation)? licen[sc]e" + _V, "2 2.0", 4, 0.9),
    ("psf", "python", r"python software foundation licen[sc]e", "", 2, 0.7),
    ("php-{v}", "php", r"php licen[sc]e" + _V, "3.0 3.01", 4, 0.9),
    ("openssl", "openssl", r"openssl licen[sc]e", "", 4, 0.9),
    ("lppl-{v}", "latex", r"latex project public licen[sc]e" + _V, "1.0 1.1 1.2 1.3", 4, 0.9),
    ("ncsa", "ncsa", r"(?:university of illinois )?ncsa(?: open source)? licen[sc]e", "", 4, 0.9),
    ("proprietary", "proprietary", r"proprietary (?:licen[sc]e|and confidential|software)", "", 3, 0.8),
    ("all-rights-reserved", "reserved", r"all rights reserved", "", 1, 0.6),
    ("spdx-tag", "spdx", r"spdx licen[sc]e identifier", "", 1, 0.6),
)


def _words(version: str) -> str:
    return version.replace(".", " ")


def signatures() -> list[Signature]:
    """The rule table: every family once for each of its versions."""
    out = []
    for label, keyword, pattern, versions, priority, weight in _FAMILIES:
        for v in versions.split() or [""]:
            fill = lambda s: s.replace("{v}", v).replace("{w}", _words(v)).replace("{n}", v)  # noqa: E731,B023
            # a version ends where no further number follows ("2" is not a prefix of "2 1")
            tail = r"(?! \d)" if v else ""
            name = fill(label)
            if v and "." not in v and v != "":
                name = name.replace(f"-{v}", f"-{v}.0", 1)
            out.append(Signature(name, fill(keyword), fill(pattern) + tail, priority, weight))
    return out


def word_string(text: Column) -> Column:
    """' w1 w2 ... wn ': the lower-case words between single spaces."""
    plain = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), NOT_WORD, " ")
    return F.concat(F.lit(" "), F.btrim(plain, F.lit(" ")), F.lit(" "))


def _places(words: Column, pattern: Column | str) -> Column:
    """Word intervals of a pattern's matches: array of (start, end), end included."""
    # marks are control characters, which no word has; each is tied to the first or last word of a match
    marked = F.split(F.btrim(F.regexp_replace(words, pattern, F.lit("\x01$0\x02")), F.lit(" ")), " ")
    starts = F.filter(F.transform(marked, lambda w, i: F.when(F.startswith(w, F.lit("\x01")), i)), lambda x: x.isNotNull())
    ends = F.filter(F.transform(marked, lambda w, i: F.when(F.endswith(w, F.lit("\x02")), i)), lambda x: x.isNotNull())
    return F.zip_with(starts, ends, lambda s, e: F.struct(s.alias("s"), e.alias("e")))


def _bounded(pattern: str) -> str:
    return f"(?<= )(?:{pattern})(?= )"


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: list[Signature] | None = None) -> DataFrame:
    """One row per input row.

    doc_id, n_words, ``base`` (array of start, end, label of the contract's
    phrases, all of them), ``detections`` (array of start, end, label, weight
    after suppression, in text order).
    """
    rules = signatures() if rules is None else rules
    keywords = sorted({r.keyword for r in rules})
    base_words = sorted({p.split()[0] for p, _ in BASE_PHRASES})
    hits = lambda names: F.array_compact(F.array(*[F.when(F.contains(F.col("__words"), F.lit(f" {k} ")), F.lit(k)) for k in names]))
    table = F.array(
        *[
            F.struct(
                F.lit(r.keyword).alias("keyword"), F.lit(_bounded(r.pattern)).alias("pattern"), F.lit(r.label).alias("label"),
                F.lit(r.priority).alias("priority"), F.lit(r.weight).alias("weight"),
            )
            for r in rules
        ]
    )
    rows = docs.select(F.col(id_col).alias("doc_id"), word_string(F.col(text_col)).alias("__words"))
    rows = rows.withColumn("__hits", hits(sorted({*keywords, *base_words})))
    n_words = F.length("__words") - F.length(F.replace(F.col("__words"), F.lit(" "), F.lit(""))) - 1
    rows = rows.withColumn("n_words", F.when(F.length("__words") > 2, n_words).otherwise(F.lit(0)).cast("long"))

    def labelled(label: str):
        return lambda p: F.struct(p["s"].alias("start"), p["e"].alias("end"), F.lit(label).alias("label"))

    base = F.concat(*[F.transform(_places(F.col("__words"), F.lit(_bounded(p))), labelled(label)) for p, label in BASE_PHRASES])
    found = F.flatten(
        F.transform(
            F.filter(table, lambda r: F.array_contains(F.col("__hits"), r["keyword"])),
            lambda r: F.transform(
                _places(F.col("__words"), r["pattern"]),
                # in this order: start, longest first, highest priority first
                lambda p: F.struct(
                    p["s"].alias("start"), (-p["e"]).alias("minus_end"), (-r["priority"]).alias("minus_priority"),
                    r["label"].alias("label"), r["weight"].alias("weight"),
                ),
            ),
        )
    )
    any_hit = F.size("__hits") > 0
    rows = rows.withColumn("base", F.when(any_hit, base)).withColumn("__found", F.when(any_hit, F.sort_array(found)))
    # sweep in order, with the furthest end so far of each priority and above
    top = max([r.priority for r in rules], default=1)
    start = F.struct(
        F.array_repeat(F.lit(-1), top + 1).alias("ends"),
        F.expr("cast(array() as array<struct<start:int,end:int,label:string,weight:double>>)").alias("kept"),
    )

    def step(acc: Column, d: Column) -> Column:
        end, priority = -d["minus_end"], -d["minus_priority"]
        inside = F.element_at(acc["ends"], priority + 1) >= end
        one = F.array(F.struct(d["start"].alias("start"), end.alias("end"), d["label"].alias("label"), d["weight"].alias("weight")))
        return F.struct(
            F.transform(acc["ends"], lambda e, p: F.when((p <= priority) & (e < end), end).otherwise(e)).alias("ends"),
            F.when(inside, acc["kept"]).otherwise(F.concat(acc["kept"], one)).alias("kept"),
        )

    kept = F.aggregate("__found", start, step, lambda acc: acc["kept"])
    return rows.select("doc_id", "n_words", "base", F.when(F.size("__found") > 0, kept).alias("detections"))


def license_digest(scan: DataFrame) -> DataFrame:
    """The contract's columns from ``license_scan``'s result."""
    joined = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    none = F.array().cast("array<string>")
    base = F.coalesce(F.col("base.label"), none)
    more = F.coalesce(F.col("detections.label"), none)
    starts = F.col("base.start")
    return scan.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.concat(base, more)).alias("labels"),
        F.coalesce(F.array_max(F.col("detections.weight")), F.lit(0.0)).alias("score"),
        F.coalesce(F.size(more), F.lit(0)).cast("long").alias("n_detections"),
    )
