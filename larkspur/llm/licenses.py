"""Operator 5, licence scans: entire texts looked up among known licence texts by digest.

Two texts are the same licence if they agree after normalisation: case,
punctuation, copyright lines, layout and equivalent spellings do not count. What is
looked up is the whole document and, for documents that quote a notice, each of
its lines. Only DataFrame functions.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.llm.common import llm_query, table
from larkspur.llm.license_list import DIGESTS, TEXTS

#: The texts of short licences and of the notices that stand for long ones.
MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
    "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
    "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
    "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
    "substantial portions of the Software. "
)
AS_IS = (
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
    "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR "
    "ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH "
    "THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
    "the above copyright notice and this permission notice appear in all copies. "
)
ZERO = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. "
ISC_TAIL = (
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES "
    "OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR "
    "ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS "
    "ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "This work is licensed under the Apache License, Version 2.0"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Licensed under the MIT License"),
    ("MIT", "This project is licensed under the terms of the MIT license"),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0-only", "Licensed under the GNU General Public License, version 3"),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2"),
    ("LGPL-3.0-only", "This work is licensed under the GNU Lesser General Public License, version 3"),
    ("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0"),
    ("CC0-1.0", "Licensed under CC0 1.0"),
)
LICENSES: tuple[tuple[str, str], ...] = (
    ("MIT", MIT + AS_IS), ("MIT", "The MIT License\n" + MIT + AS_IS), ("MIT", "MIT License\n" + MIT + AS_IS),
    ("ISC", ISC + ISC_TAIL), ("0BSD", ZERO + ISC_TAIL), *NOTICES,
)
#: Spellings that count as the same word, from the matching rules that licence lists publish.
SPELLINGS: Mapping[str, str] = {
    "acknowledgement": "acknowledgment", "analogue": "analog", "analyse": "analyze", "artefact": "artifact", "authorisation": "authorization",
    "authorised": "authorized", "calibre": "caliber", "cancelled": "canceled", "capitalisations": "capitalizations", "catalogue": "catalog",
    "categorise": "categorize", "centre": "center", "copyright owner": "copyright holder", "emphasised": "emphasized", "favour": "favor",
    "favourite": "favorite", "fulfil": "fulfill", "fulfilment": "fulfillment", "https": "http", "initialise": "initialize",
    "judgement": "judgment", "labelling": "labeling", "labour": "labor", "licence": "license", "licenced": "licensed", "maximise": "maximize",
    "modelled": "modeled", "modelling": "modeling", "non commercial": "noncommercial", "offence": "offense", "optimise": "optimize",
    "organisation": "organization", "organise": "organize", "owner": "holder", "per cent": "percent", "practise": "practice",
    "programme": "program", "realise": "realize", "recognise": "recognize", "signalling": "signaling", "sub license": "sublicense",
    "sub licence": "sublicense", "utilisation": "utilization", "whilst": "while", "wilful": "willful",
}
#: Everything in ASCII but letters and digits, and the usual marks outside ASCII; a line break is kept.
BROADCAST_ROWS = 100_000
MARKS = "[\\x00-\\x09\\x0B-\\x2F\\x3A-\\x60\\x7B-\\x7F\\u00A0\\u00A9\\u00AE\\u2010-\\u2015\\u2018-\\u201F\\u2022\\u2026\\u2122]+"
COPYRIGHT = "(?m)^[ ]*((portions )?(copyright )+([0-9]{4}|yyyy|year |c )|all rights reserved|c [0-9]{4})[^\\n]*$"
#: Copyright lines open with the word and a sign or a year (or its place in a form), or with the sign and a year; "c" is what is
#: left of a sign. A line of a licence that is wrapped before the word "copyright" is none.


def normal_lines(text: Column) -> Column:
    """The text lower-cased, without marks and copyright lines; line breaks stay."""
    plain = F.regexp_replace(F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("©"), F.lit(" copyright c "))), MARKS, " ")
    return F.regexp_replace(plain, COPYRIGHT, "")


def normal_unit(lines: Column) -> Column:
    """One unit (a line or a whole text) with single blanks and one spelling of each word."""
    out = F.concat(F.lit(" "), F.trim(F.regexp_replace(lines, "[ \\n]+", " ")), F.lit(" "))
    for other, usual in SPELLINGS.items():
        out = F.replace(out, F.lit(f" {other} "), F.lit(f" {usual} "))
    return F.trim(out)


#: Characters of a normalised unit that are looked at first, and of the unit before respelling that decide them.
HEAD, AHEAD = 20, 100


def known_digests(spark: SparkSession, licenses: tuple[tuple[str, str], ...] = LICENSES + TEXTS, digests: tuple = DIGESTS) -> DataFrame:
    """license, digest, n_chars and head of each known normalised text; texts that normalise alike keep the first name.

    ``digests`` holds such rows of texts that are too long to be kept here.
    """
    known = spark.createDataFrame(list(licenses), "license string, text string")
    unit = known.withColumn("unit", normal_unit(normal_lines(F.col("text")))).where("unit <> ''")
    rows = unit.select("license", F.sha2("unit", 256).alias("digest"), F.length("unit").alias("n_chars"), F.substring("unit", 1, HEAD).alias("head"))
    rows = rows.unionByName(spark.createDataFrame(list(digests), "license string, digest string, n_chars int, head string"))
    return rows.groupBy("digest").agg(F.min("license").alias("license"), F.max("n_chars").alias("n_chars"), F.min("head").alias("head"))


def license_scan(docs: DataFrame, known: DataFrame, key: str = "doc_id") -> DataFrame:
    """Look up every document of ``docs`` (``key``, text) among ``known`` (see ``known_digests``).

    Returns key, license (of the whole text, else null), notices (sorted names of
    the licences that are a whole line; empty if none) and n_notices (such lines).
    Null and empty texts match nothing. Rows with the same key are one document
    and add up; a text known under two names keeps the first. Extra columns are
    not read. No documents, no rows.

    Texts and lines are hashed where they are read and meet the known digests in
    a hash join; per document only one row is shuffled. Units over twice as long
    as every known text are not hashed: respelling cannot halve a text, so they
    match none. Nor are units that begin as no known text does.
    """
    limit, count = known.agg(F.coalesce(2 * F.max("n_chars"), F.lit(0)), F.count("*")).first()
    heads = [r[0] for r in known.select("head").distinct().collect()] if count <= BROADCAST_ROWS else None
    known = known.select(F.col("digest").alias("_digest"), F.col("license").alias("_license"))
    known = F.broadcast(known) if count <= BROADCAST_ROWS else known
    lines = docs.select(key, normal_lines(F.col("text")).alias("_lines"))
    short = lambda x: F.length(x) <= limit
    flat = lines.select(key, F.split("_lines", "\n").alias("_parts"), F.when(
        F.length(F.replace("_lines", F.lit(" "), F.lit(""))) <= limit, F.col("_lines")).alias("_whole"))
    units = flat.select(key, F.explode(F.concat(
        F.array(F.struct(F.lit(True).alias("whole"), F.coalesce("_whole", F.lit("")).alias("unit"))),
        F.transform(F.filter("_parts", lambda x: short(F.trim(x)) & (F.trim(x) != "")), lambda x: F.struct(F.lit(False).alias("whole"), x.alias("unit"))),
    )).alias("u")).select(key, "u.*")
    begin = F.substring(normal_unit(F.substring(F.trim(F.regexp_replace("unit", "[ \\n]+", " ")), 1, AHEAD)), 1, HEAD)
    maybe = begin != "" if heads is None else begin.isin(heads)
    units = units.withColumn("_digest", F.when(maybe, F.sha2(normal_unit(F.col("unit")), 256))).drop("unit")
    found = units.join(known, "_digest", "left")
    line = F.when(~F.col("whole"), F.col("_license"))
    return found.groupBy(key).agg(
        F.min(F.when(F.col("whole"), F.col("_license"))).alias("license"),
        F.sort_array(F.collect_set(line)).alias("notices"), F.count(line).alias("n_notices"))


def _sql_unit(x: str) -> str:
    out = f"' ' || trim(regexp_replace({x}, '[ \\n]+', ' ', 'g')) || ' '"
    for other, usual in SPELLINGS.items():
        out = f"replace({out}, ' {other} ', ' {usual} ')"
    return f"trim({out})"


def _sql_lines(x: str) -> str:
    marks = MARKS.replace("\\u", "\\x{").replace("]+", "]+")
    for code in ("00A0", "00A9", "00AE", "2010", "2015", "2018", "201F", "2022", "2026", "2122"):
        marks = marks.replace("\\x{" + code, "\\x{" + code + "}")
    return f"regexp_replace(regexp_replace(lower(replace(coalesce({x}, ''), '©', ' copyright c ')), '{marks}', ' ', 'g'), '{COPYRIGHT}', '', 'g')"


_SQL = f"""
WITH known(license, digest) AS (SELECT min(l), h FROM (
    SELECT l, sha256({_sql_unit(_sql_lines("t"))}) AS h
    FROM (VALUES {", ".join("('%s', '%s')" % (n, t.replace("'", "''")) for n, t in LICENSES + TEXTS)}) AS k(l, t)
    UNION ALL SELECT * FROM (VALUES {", ".join("('%s', '%s')" % row[:2] for row in DIGESTS)}) AS g(l, h)) GROUP BY h),
d AS (SELECT doc_id, {_sql_lines("text")} AS lines FROM documents),
whole AS (SELECT doc_id, sha256({_sql_unit("lines")}) AS digest FROM d),
part AS (SELECT doc_id, sha256({_sql_unit("line")}) AS digest FROM (SELECT doc_id, unnest(string_split(lines, chr(10))) AS line FROM d)),
hit AS (SELECT doc_id, list_sort(list(DISTINCT license)) AS notices, count(*) AS n_notices FROM part JOIN known USING (digest) GROUP BY 1)
SELECT doc_id, known.license, coalesce(array_to_string(notices, ' '), '') AS notices, coalesce(n_notices, 0) AS n_notices
FROM whole LEFT JOIN known USING (digest) LEFT JOIN hit USING (doc_id)"""


@llm_query("op5_license_scans", _SQL)
def op5_license_scans(spark, sf_dir):
    found = license_scan(table(spark, sf_dir, "documents"), known_digests(spark))
    return found.select("doc_id", "license", F.array_join("notices", " ").alias("notices"), "n_notices")
