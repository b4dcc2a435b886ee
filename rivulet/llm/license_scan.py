"""Licence scan by digest: canonical texts are looked up among the digests of known licences.

A text is brought to a canonical form: lower case, copyright lines dropped, every run of characters other than letters,
digits and line ends turned into one space, equivalent spellings replaced by one of them. The SHA-256 of the whole
canonical text is hash-joined to the digests of the known licences (the build side is the list of known texts, whose
length does not depend on the data). The same lookup is made for every line of the text, which finds licence notices
inside longer documents. Only Spark expressions are used, and no row of the input is shuffled.

Defined results: null and empty texts have the digest of the empty text and match nothing; a text that is only
punctuation or copyright lines is empty as well. One row per input row, repeated rows included. Columns other than the
key and the text are dropped, so none can clash. Line ends are ``\\n``; lines that are empty in canonical form match
nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.llm.common import table

# SPDX identifiers and the texts or notices that stand for them.
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and
this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED
"AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT
HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS
PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES
OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
SOFTWARE."""
KNOWN = (
    ("MIT", _MIT), ("MIT", "MIT License\n" + _MIT), ("MIT", "The MIT License (MIT)\n" + _MIT),
    ("ISC", _ISC), ("ISC", "ISC License\n" + _ISC),
    ("MIT", "Released under the MIT License."), ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License").'),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "Licensed under the GNU General Public License, version 3."),
    ("GPL-2.0-only", "Licensed under the GNU General Public License, version 2."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."), ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("MIT", "SPDX-License-Identifier: MIT"), ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-only"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
)
# Spellings taken as equal, after punctuation has become spaces.
EQUIVALENT = (("licence", "license"), ("sub license", "sublicense"), ("non commercial", "noncommercial"),
              ("organisation", "organization"), ("favour", "favor"), ("acknowledgement", "acknowledgment"),
              ("behaviour", "behavior"), ("merchantibility", "merchantability"))
COPYRIGHT_LINE = r"(?m)^[ \t]*(?:copyright|\(c\)|©)[^\n]*$"
NOT_TEXT = r"[^\p{L}\p{N}\n]+"


def canonical_lines(text: Column) -> Column:
    """The canonical form, line ends kept."""
    out = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), COPYRIGHT_LINE, "")
    out = F.regexp_replace(out, NOT_TEXT, " ")
    for other, one in EQUIVALENT:
        out = F.replace(out, F.lit(other), F.lit(one))
    return out


def whole(lines: Column) -> Column:
    return F.trim(F.regexp_replace(lines, r"[ \n]+", " "))


def digest(canonical: Column) -> Column:
    return F.sha2(canonical.cast("binary"), 256)


def known_digests(spark: SparkSession, known=KNOWN) -> DataFrame:
    """One row (known_digest, license) per distinct canonical text of ``known``; of several identifiers for one text,
    the least."""
    texts = spark.createDataFrame(list(known), "license string, text string")
    return (texts.select(digest(whole(canonical_lines(F.col("text")))).alias("known_digest"), "license")
            .groupBy("known_digest").agg(F.min("license").alias("license")))


def scan_licenses(df: DataFrame, key: str = "doc_id", text: str = "text", known=KNOWN) -> DataFrame:
    """key, digest (hex, of the whole canonical text), license (of the whole text, else null), line_licenses (sorted
    distinct identifiers of whole lines, joined by commas) and license_lines (how many lines matched)."""
    names = known_digests(df.sparkSession, known)
    by_line = F.create_map(*[F.lit(x) for r in names.collect() for x in (r["known_digest"], r["license"])])
    lines = F.filter(F.transform(F.split("canonical", "\n"), lambda x: F.element_at(by_line, digest(F.trim(x)))),
                     lambda x: x.isNotNull())
    rows = (df.select(F.col(key).alias("key"), canonical_lines(F.col(text)).alias("canonical"))
            .select("key", digest(whole(F.col("canonical"))).alias("digest"), lines.alias("lines")))
    return (rows.join(F.broadcast(names), F.col("digest") == F.col("known_digest"), "left")
            .select(F.col("key").alias(key), "digest", "license",
                    F.concat_ws(",", F.array_sort(F.array_distinct("lines"))).alias("line_licenses"),
                    F.size("lines").cast("long").alias("license_lines")))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents", "doc_id", "text"))


def _sql_lines(text: str) -> str:
    out = f"regexp_replace(lower(coalesce({text}, '')), '{COPYRIGHT_LINE}', '', 'g')"
    out = f"regexp_replace({out}, '{NOT_TEXT}', ' ', 'g')"
    for other, one in EQUIVALENT:
        out = f"replace({out}, '{other}', '{one}')"
    return out


def _sql_known() -> str:
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    return ", ".join(f"({quote(name)}, {quote(text)})" for name, text in KNOWN)


SQL = rf"""
WITH known_texts(license, text) AS (VALUES {_sql_known()}),
known AS (SELECT sha256(trim(regexp_replace({_sql_lines('text')}, '[ \n]+', ' ', 'g'))) AS known_digest,
                 min(license) AS license FROM known_texts GROUP BY 1),
canonical AS (SELECT doc_id, {_sql_lines('text')} AS lines FROM documents),
whole AS (SELECT row_number() OVER () AS row_no, doc_id, lines,
                 sha256(trim(regexp_replace(lines, '[ \n]+', ' ', 'g'))) AS digest FROM canonical),
found AS (SELECT row_no, string_agg(DISTINCT license, ',' ORDER BY license) AS line_licenses, count(*) AS license_lines
          FROM (SELECT row_no, sha256(trim(unnest(string_split(lines, chr(10))))) AS line_digest FROM whole)
          JOIN known ON line_digest = known_digest GROUP BY row_no)
SELECT doc_id, digest, k.license AS license, coalesce(line_licenses, '') AS line_licenses,
       coalesce(license_lines, 0)::BIGINT AS license_lines
FROM whole LEFT JOIN known k ON digest = known_digest LEFT JOIN found USING (row_no)
"""
