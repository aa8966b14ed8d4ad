"""Licence scan by canonical digest lookup (DataFrame functions only).

A text is brought to a canonical form: ASCII lower case, typographic quotes and
dashes as plain ones, copyright lines dropped, equivalent spellings unified,
everything but letters and digits reduced to single blanks.  The SHA-256 of that
form is joined with the digests of known licence texts, for two kinds of unit:
the whole text of a document, and each of its lines (licence notices are
whole lines).  No text is compared with another; the join is an equi-join on
digests against a fixed table.

Defined cases: a null or empty text, or one that is nothing but copyright
lines, has the digest of the empty text, which is no licence; repeated rows of
one id and text give one row; extra columns are ignored; null ids are kept.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import table, text_frame

# Licence texts and notices as published by their stewards.
_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
    "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
    "notice and this permission notice shall be included in all copies or substantial portions of the Software. THE "
    "SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
    "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_ISC_GRANT = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted")
_ISC_KEEP = ", provided that the above copyright notice and this permission notice appear in all copies"
_ISC_END = (
    ". THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING "
    "ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
    "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
    "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE "
    "OR PERFORMANCE OF THIS SOFTWARE.")
_BSD_GRANT = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
    "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
    "with the distribution. ")
_BSD_THIRD = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission. ")
_BSD_END = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
KNOWN = [
    ("MIT", _MIT_GRANT),
    ("MIT", "The MIT License " + _MIT_GRANT),
    ("MIT", "MIT License " + _MIT_GRANT),
    ("ISC", _ISC_GRANT + _ISC_KEEP + _ISC_END),
    ("ISC", "ISC License " + _ISC_GRANT + _ISC_KEEP + _ISC_END),
    ("0BSD", _ISC_GRANT + _ISC_END),
    ("BSD-2-Clause", _BSD_GRANT + _BSD_END),
    ("BSD-3-Clause", _BSD_GRANT + _BSD_THIRD + _BSD_END),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under CC BY-SA 4.0."),
    ("MPL-2.0", "SPDX-License-Identifier: MPL-2.0"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
]
EQUIVALENT = [
    ("licenc", "licens"),
    ("sub licens", "sublicens"),
    ("non infringement", "noninfringement"),
    ("non commercial", "noncommercial"),
    ("merchantibility", "merchantability"),
    ("acknowledgement", "acknowledgment"),
    ("per cent", "percent"),
    ("copyright owner", "copyright holder"),
    ("https", "http"),
]
_FROM = string.ascii_uppercase + "“”‘’–—"
_TO = string.ascii_lowercase + "\"\"''--"
_COPYRIGHT = r"(^|\n)[ \t*#/;-]*(copyright[ \t]*([(]c[)]|©|[0-9])|[(]c[)]|©|all rights reserved)[^\n]*"
_OTHER = r"[^a-z0-9\n\x{80}-\x{10FFFF}]+"


def canonical_lines(text: Column) -> Column:
    """Canonical form of every line, lines kept apart."""
    c = F.translate(F.coalesce(text, F.lit("")), _FROM, _TO)
    c = F.regexp_replace(c, F.lit(_COPYRIGHT), F.lit("\n"))
    c = F.regexp_replace(c, F.lit(_OTHER), F.lit(" "))
    for a, b in EQUIVALENT:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def whole(lines: Column) -> Column:
    return F.trim(F.regexp_replace(lines, F.lit(r"[ \n]+"), F.lit(" ")))


def digest(c: Column) -> Column:
    return F.sha2(c.cast("binary"), 256)


def known_digests(spark: SparkSession, known: list[tuple[str, str]] | None = None) -> DataFrame:
    """(digest, license_id): as many rows as ``known`` has, at most."""
    rows = spark.createDataFrame(KNOWN if known is None else known, "license_id string, text string")
    return (rows.select(digest(whole(canonical_lines(F.col("text")))).alias("digest"), "license_id")
            .groupBy("digest").agg(F.min("license_id").alias("license_id")))


def license_scan(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(doc_id, text_digest, license_id, n_notices, notice_ids) for every row:
    the licence the whole text is, and the licences its lines are notices of."""
    known = known_digests(docs.sparkSession) if known is None else known
    small = F.broadcast(known)  # a fixed list of licence texts, not data
    lines = text_frame(docs).select("doc_id", canonical_lines(F.col("text")).alias("lines"))
    units = lines.select("doc_id", digest(whole(F.col("lines"))).alias("text_digest"),
                         F.posexplode(F.split("lines", "\n")).alias("at", "line"))
    hits = (units.withColumn("digest", digest(F.trim("line"))).filter("trim(line) != ''")
            .join(small, "digest").select("doc_id", "text_digest", "at", "license_id").distinct()
            .groupBy("doc_id", "text_digest").agg(F.count("*").alias("n_notices"),
                                                  F.concat_ws(",", F.array_sort(F.collect_set("license_id"))).alias("notice_ids")))
    rows = lines.select("doc_id", digest(whole(F.col("lines"))).alias("text_digest")).distinct()
    out = rows.join(small, rows["text_digest"] == known["digest"], "left").select("doc_id", "text_digest", "license_id")
    hits = hits.select(F.col("doc_id").alias("_id"), F.col("text_digest").alias("_digest"), "n_notices", "notice_ids")
    return (out.join(hits, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_digest") == F.col("_digest")), "left")
            .select("doc_id", "text_digest", "license_id", F.coalesce("n_notices", F.lit(0)).alias("n_notices"),
                    F.coalesce("notice_ids", F.lit("")).alias("notice_ids")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))


def _oracle() -> str:
    q = lambda s: "'" + s.replace("'", "''") + "'"
    canon = "coalesce(text, '')"
    canon = f"translate({canon}, {q(_FROM)}, {q(_TO)})"
    canon = f"regexp_replace({canon}, {q(_COPYRIGHT)}, chr(10), 'g')"
    canon = f"regexp_replace({canon}, {q(_OTHER)}, ' ', 'g')"
    for a, b in EQUIVALENT:
        canon = f"replace({canon}, {q(a)}, {q(b)})"
    whole_sql = "sha256(trim(regexp_replace(lines, '[ \\n]+', ' ', 'g'), ' '))"
    values = ", ".join(f"({q(i)}, {q(t)})" for i, t in KNOWN)
    return f"""
WITH known AS (SELECT {whole_sql} AS digest, min(license_id) AS license_id
    FROM (SELECT license_id, {canon} AS lines FROM (VALUES {values}) v(license_id, text)) GROUP BY 1),
docs AS (SELECT doc_id, {canon} AS lines FROM documents),
hits AS (SELECT doc_id, text_digest, count(*) AS n_notices, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS notice_ids
    FROM (SELECT DISTINCT doc_id, text_digest, line_no, license_id FROM (
        SELECT doc_id, text_digest, unnest(parts) AS line, generate_subscripts(parts, 1) AS line_no
        FROM (SELECT doc_id, {whole_sql} AS text_digest, string_split(lines, chr(10)) AS parts FROM docs)) u
        JOIN known k ON sha256(trim(u.line, ' ')) = k.digest WHERE trim(u.line, ' ') <> '') GROUP BY 1, 2)
SELECT r.doc_id, r.text_digest, k.license_id, coalesce(h.n_notices, 0) AS n_notices, coalesce(h.notice_ids, '') AS notice_ids
FROM (SELECT DISTINCT doc_id, {whole_sql} AS text_digest FROM docs) r
LEFT JOIN known k ON r.text_digest = k.digest
LEFT JOIN hits h ON r.doc_id IS NOT DISTINCT FROM h.doc_id AND r.text_digest = h.text_digest
"""


ORACLE_SQL = _oracle()
