"""Licence scans: canonical digests of whole texts, joined with those of known licences.

The canonical form of a text is what remains when case, punctuation and white space are taken away, lines that
state a copyright are left out, and equivalent spellings are made one.  A whole text, and each of its lines as a text of its
own, is a known licence if the digest of its canonical form is one.  Notices that follow a copyright statement, up to the end of its
line, are looked up too; only as many characters before that end are tried as the longest known notice can take.  Marks that make
lines comments are no part of them, and a comment ends where they do.  The entire texts in ``license_texts`` are known as whole texts, and inside longer ones by their blocks (what
stands between blank lines, with or without a first line, which may be a title): a text that has all blocks of one holds
it.  Everything is column expressions and one join.

Edge cases.  Null and empty texts match nothing (as does all that is empty in canonical form).  Only letters and digits
of ASCII count, so texts in other scripts match nothing.  Repeated rows each have a row.  Only id and text are read.
"""

from __future__ import annotations

import string
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Notices by which texts commonly state their licence.
NOTICES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "Licensed under the GNU GPL v3."),
    ("GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-only"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0",
     "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "SPDX-License-Identifier: CC0-1.0"),
    ("all-rights-reserved", "All rights reserved."),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""),
]
# Spellings that mean the same, as they are after case and punctuation are gone.
SPELLINGS = [("licence", "license"), ("licenced", "licensed"), ("acknowledgement", "acknowledgment"),
             ("sub license", "sublicense"), ("non commercial", "noncommercial"),
             ("organisation", "organization"), ("merchantibility", "merchantability"), ("per cent", "percent")]
VERSION = " v *([0-9])"
COPYRIGHT_LINE = r"(^|\n)[ \t]*(copyright|\(c\)|©)[^\n]*"
# The entire texts as (licence, text); of one licence there may be several, in other layouts.
TEXTS = [(path.stem.removesuffix(".2"), path.read_text()) for path in sorted(
    (Path(__file__).parent / "license_texts").glob("*.txt"))] + [NOTICES[-1]]
APPENDICES = ("APPENDIX: How to apply", "How to Apply These Terms to Your")   # a licence may stand without what follows
TEXTS += [(name, text[:text.index(mark)]) for name, text in TEXTS for mark in APPENDICES if mark in text]
LINE_CUE = "warrant|licen[sc]e|reserved"   # in every notice, so lines without it are not looked up
LONGEST = 2 * max(len(text) for _, text in NOTICES)   # separators and spellings take less than a notice's length again
LEADER = r"[ \t]*(?:/\*+|//+|\*+/?|#+|--+|;+|%+|<!--)"
CUE = "warrant|licen[sc]e"   # in every entire text, so texts without it are not cut in blocks
TITLE_WORDS = 8        # shorter blocks, such as titles and headings, may be missing
BLANK_LINES = r"\n(?:[ \t\r\f]*\n)+"
TITLE_LINE = r"(?i)^\s*(?=[^\n]*licen[sc]e)[^\n]{0,60}\n"
COPYRIGHT_HEAD = r"^(\s*(copyright|\(c\)|©)[^\n]*(\n|$))+"   # inside a block such a line may be one that was wrapped
ENDORSEMENT = "neither the names? .{1,100}? nor the names of (its|their|other) contributors"


def canonical(text: str | Column, copyright: str = COPYRIGHT_LINE) -> Column:
    """The canonical form of a text; null is empty."""
    text = F.col(text) if isinstance(text, str) else text
    plain = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    plain = F.regexp_replace(plain, copyright, "\n")
    plain = F.concat(F.lit(" "), F.regexp_replace(plain, "[^a-z0-9]+", "  "), F.lit(" "))
    plain = F.regexp_replace(plain, VERSION, " version  $1")
    for other, same in SPELLINGS:
        plain = F.replace(plain, F.lit(f" {other.replace(' ', '  ')} "), F.lit(f" {same} "))
    return F.trim(F.regexp_replace(plain, " +", " "))


def digest(text: str | Column) -> Column:
    """The digest of a text's canonical form; null if that is empty."""
    form = canonical(text)
    return F.when(form != "", F.sha2(form.cast("binary"), 256))


def block_form(text: Column) -> Column:
    """The canonical form of a block, without a list number before it and the holder's name in the endorsement clause."""
    plain = F.regexp_replace(canonical(text, COPYRIGHT_HEAD), "^[0-9]+ ", "")
    return F.regexp_replace(plain, ENDORSEMENT, "neither the name of the holder nor the names of its contributors")


def blocks(text: Column) -> Column:
    """The distinct canonical blocks of a text, each also without its first line; none without ``CUE`` in the text."""
    parts = F.split(text, BLANK_LINES)
    rest = F.transform(parts, lambda part: F.regexp_replace(part, r"^\s*[^\n]*(\n|$)", ""))
    found = F.array_distinct(F.transform(F.concat(parts, rest), block_form))
    return F.when(text.rlike(f"(?i){CUE}"), F.filter(found, lambda form: form != "")).otherwise(
        F.array().cast("array<string>"))


def long_blocks(text: Column) -> Column:
    """The distinct canonical blocks of a text that are longer than a title, in order."""
    forms = F.array_distinct(F.transform(F.split(text, BLANK_LINES), block_form))
    return F.filter(forms, lambda form: F.size(F.split(form, " ")) >= TITLE_WORDS)


def sha256(form: Column) -> Column:
    return F.sha2(form.cast("binary"), 256)


def after_copyright(line: Column) -> Column:
    """What may be a notice after the copyright statement of a line: all that follows a full stop, comma or semicolon.

    At most ``LONGEST`` characters (other signs and blanks in a row as one), so a line costs no more than in proportion to its length.
    """
    plain = F.regexp_replace(F.regexp_replace(line, "[^A-Za-z0-9.,;]+", " "), "[.,; ]{2,}", ". ")
    # A value of its own to the function inside, which would else split the line again for each rest.
    cut = F.when(line.rlike(r"(?i)^[ \t]*(copyright|\(c\)|©)"), F.array(F.split(F.right(plain, F.lit(LONGEST)), r"[.,;] "))
                 ).otherwise(F.array().cast("array<array<string>>"))
    several = F.filter(cut, lambda parts: F.size(parts) > 1)
    return F.flatten(F.transform(several, lambda parts: F.transform(
        F.sequence(F.lit(2), F.size(parts)), lambda at: F.array_join(F.slice(parts, at, LONGEST), ". "))))


def uncommented(text: Column) -> Column:
    """The text without the marks of comment lines, with a blank line after a comment."""
    apart = F.regexp_replace(text, rf"(?m)^({LEADER}[^\n]*\n)(?!{LEADER})", "$1\n")
    return F.regexp_replace(apart, f"(?m)^{LEADER}", "")


def known(spark: SparkSession, notices: list[tuple[str, str]] = NOTICES) -> DataFrame:
    """The known licences as (digest, license), one row per digest."""
    return _digests(spark, notices).groupBy("digest").agg(F.min("license").alias("license"))


def _digests(spark: SparkSession, notices: list[tuple[str, str]]) -> DataFrame:
    rows = F.inline(F.array(*[F.struct(F.lit(name).alias("license"), F.lit(text).alias("text"))
                              for name, text in notices]))
    return spark.range(1).select(rows).select(digest("text").alias("digest"), "license")


def entire(spark: SparkSession, texts: list[tuple[str, str]] = TEXTS) -> tuple[DataFrame, list[tuple[str, int]]]:
    """The entire texts' blocks as (digest, number of the text, licence), and each text's licence and how many blocks it has.

    A row with a licence and no number stands for all blocks of a text together.
    """
    rows = F.inline(F.array(*[F.struct(F.lit(i).alias("entire"), F.lit(text).alias("text"),
                                       F.lit(without_title(text)).alias("body")) for i, (_, text) in enumerate(texts)]))
    forms = spark.range(1).select(rows).select(
        "entire", long_blocks(F.col("text")).alias("titled"), long_blocks(F.col("body")).alias("forms"))
    found = forms.select("entire", F.array(*[sha256(F.array_join(c, " ")) for c in ("titled", "forms")]).alias("full"),
                         F.transform("forms", sha256).alias("digests")).collect()   # bounded by TEXTS
    counts = {r["entire"]: len(r["digests"]) for r in found}
    digests = [(d, r["entire"], None) for r in found for d in r["digests"]]
    digests += [(d, None, texts[r["entire"]][0]) for r in found for d in r["full"]]
    return (spark.createDataFrame(digests, "digest string, entire int, full string"),
            [(name, counts[i]) for i, (name, _) in enumerate(texts)])


def without_title(text: str) -> str:
    """The text from the first block on that is longer than a title."""
    parts = text.strip().split("\n\n")
    start = next(i for i, part in enumerate(parts) if len(part.split()) >= TITLE_WORDS)
    return "\n\n".join(parts[start:])


def scan(docs: DataFrame, licenses: DataFrame | None = None, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Each row's (id, digest, license, n_lines, licenses).

    ``digest`` is that of the whole canonical text and ``license`` what is known by it; ``n_lines`` counts lines that are a
    known licence by themselves or after a copyright statement, and ``licenses`` lists them all, sorted, without
    repetition (the whole text's too, and entire texts inside it).  With ``licenses`` given, only these are looked for.
    """
    spark, counts = docs.sparkSession, []
    if licenses is None:
        parts, counts = entire(spark)
        titled = [(name, form) for name, full in TEXTS for form in (full, without_title(full))]
        rows = known(spark, [*NOTICES, *titled]).withColumn("entire", F.lit(None).cast("int")).unionByName(
            parts, allowMissingColumns=True)
        licenses = F.broadcast(rows.groupBy("digest").agg(   # as many as NOTICES and blocks of TEXTS at most
            F.min("license").alias("license"), F.min("full").alias("full"), F.collect_set("entire").alias("entire")))
    else:
        licenses = licenses.select("digest", "license", F.lit(None).cast("string").alias("full"),
                                   F.array().cast("array<int>").alias("entire"))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text).alias("text"))
    given = F.coalesce("text", F.lit(""))
    cue = LINE_CUE if counts else ""   # given digests may be of lines without it
    lines = F.when(given.rlike(f"(?i){cue}"), F.filter(F.split(given, "\n"), lambda line: (line != "") & line.rlike(
        f"(?i){cue}"))).otherwise(F.array().cast("array<string>"))
    marked = given.rlike(f"(?i){CUE}") & given.rlike(f"(?m)^{LEADER}")
    bare = F.when(marked, uncommented(given))
    both = F.when(marked, F.concat(given, F.lit("\n\n"), bare)).otherwise(given)

    def unit(kind: str, at: Column, value: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), at.cast("int").alias("line"), value.alias("digest"))

    units = rows.select("row", "id", F.explode(F.concat(
        F.array(unit("whole", F.lit(-1), digest("text"))),
        F.transform(lines, lambda line, i: unit("line", i, digest(line))),
        F.flatten(F.transform(lines, lambda line, i: F.transform(
            after_copyright(F.regexp_replace(line, f"^{LEADER}", "")), lambda rest: unit("line", i, digest(rest))))),
        F.when(given.rlike(f"(?i){CUE}"), F.array(*[unit("full", F.lit(-1), sha256(F.array_join(long_blocks(of), " ")))
                                                for of in (given, F.regexp_replace(given, TITLE_LINE, ""))]))
        .otherwise(F.array()),
        F.when(marked, F.array(*[unit("full", F.lit(-1), sha256(F.array_join(long_blocks(of), " ")))
                                 for of in (bare, F.regexp_replace(bare, TITLE_LINE, ""))])).otherwise(F.array()),
        F.transform(blocks(both), lambda form: unit("block", F.lit(-1), sha256(form))))).alias("unit"))
    found = units.select("row", "id", "unit.*").join(licenses, "digest", "left")
    whole, line, full, block = (F.col("kind") == kind for kind in ("whole", "line", "full", "block"))
    sums = found.groupBy("row").agg(
        F.first("id").alias(id_col), F.max(F.when(whole, F.col("digest"))).alias("digest"),
        F.coalesce(F.max(F.when(whole, F.col("license"))), F.max(F.when(full, F.col("full")))).alias("license"),
        F.size(F.collect_set(F.when(line & F.col("license").isNotNull(), F.col("line"))))
        .cast("long").alias("n_lines"),
        F.collect_set(F.when(whole | line, F.col("license"))).alias("names"),
        F.flatten(F.collect_list(F.when(block, F.col("entire")))).alias("entire"))
    inside = F.array_compact(F.array(*[
        F.when(F.size("entire") - F.size(F.array_remove("entire", i)) >= count, F.lit(name))
        for i, (name, count) in enumerate(counts)])) if counts else F.array().cast("array<string>")
    return sums.select(id_col, "digest", "license", "n_lines",
                       F.concat_ws(",", F.sort_array(F.array_union("names", inside))).alias("licenses"))
