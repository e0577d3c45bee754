"""Licence texts found by a digest of their canonical form. DataFrame functions only."""

from __future__ import annotations

from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Known licence texts, as published, and the notices that stand for a licence.
_MIT_BODY = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
    "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
    "persons to whom the Software is furnished to do so, subject to the following conditions:\n\nThe above copyright notice "
    "and this permission notice shall be included in all copies or substantial portions of the Software.\n\nTHE SOFTWARE IS "
    "PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
    "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT "
    "HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
    "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_ISC_TERMS = (
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL "
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN "
    "ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF "
    "THIS SOFTWARE."
)
_BSD_OPEN = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer.\n\n2. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution.\n\n"
)
_BSD_THIRD = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission.\n\n"
)
_BSD_CLOSE = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER "
    "IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
    "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
LICENSES = (
    ("MIT", "MIT License\n\nCopyright (c) 2020 Someone\n\n" + _MIT_BODY),
    ("MIT", _MIT_BODY),
    ("ISC", "ISC License\n\nPermission to use, copy, modify, and/or distribute this software for any purpose with or without "
            "fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
            "\n\n" + _ISC_TERMS),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
             "granted.\n\n" + _ISC_TERMS),
    ("BSD-2-Clause", "BSD 2-Clause License\n\n" + _BSD_OPEN + _BSD_CLOSE),
    ("BSD-2-Clause", _BSD_OPEN + _BSD_CLOSE),
    ("BSD-3-Clause", "BSD 3-Clause License\n\n" + _BSD_OPEN + _BSD_THIRD + _BSD_CLOSE),
    ("BSD-3-Clause", _BSD_OPEN + _BSD_THIRD + _BSD_CLOSE),
    ("MIT", "Released under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
)
#: Spellings that licence matching treats alike.
SPELLINGS = (
    ("licence", "license"), ("licenced", "licensed"), ("sublicence", "sublicense"), ("organisation", "organization"),
    ("acknowledgement", "acknowledgment"), ("favour", "favor"), ("fulfil", "fulfill"), ("judgement", "judgment"),
    ("labour", "labor"), ("noncommercial", "non commercial"), ("merchantibility", "merchantability"),
    ("whilst", "while"), ("wilful", "willful"), ("per cent", "percent"), ("copyright owner", "copyright holder"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


#: Copyright notices: lines that name a year or carry a sign, wherever they are, and those at a paragraph's start that go on
#: with a holder. Lines of wrapped bodies that happen to begin with these words stay.
NOTICE = r"(?m)^[ \t/*#;-]*((copyright|\(c\)|©)[ \t:,]*(\(c\)|©|[0-9]{4}|[\[<{])|all rights reserved)[^\n]*$"
HOLDER = (r"(?m)(?:\A|^[ \t/*#;-]*\n)[ \t/*#;-]*(copyright|©)(?![ \t]+(notices?|holders?|owners?|laws?|licen[cs]es?|statements?|and|or|the|in|on|"
          r"of|to|is|as|that|interests?|treaty|disclaimers?|protection|ownership|applies)\b)[^\n]*$")


def canonical(text: Column) -> Column:
    """Lower-case ASCII words without copyright notices, punctuation and variant spellings, one space apart."""
    out = F.translate(text, UPPER, LOWER)
    out = F.regexp_replace(F.regexp_replace(out, NOTICE, " "), HOLDER, " ")
    out = F.concat(F.lit(" "), F.regexp_replace(out, r"[\x00-\x2F\x3A-\x60\x7B-\x7F“”‘’–—]+", " "), F.lit(" "))
    for other, usual in SPELLINGS:
        out = F.replace(out, F.lit(f" {other} "), F.lit(f" {usual} "))
    return F.trim(out)


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def shipped() -> list[tuple[str, str]]:
    """(licence, text) of the whole licences that come with this package."""
    folder = resources.files("loyalscope.llm") / "licenses"
    return sorted((f.name.removesuffix(".txt"), f.read_text(encoding="utf-8")) for f in folder.iterdir())


def known(spark: SparkSession, licenses=None) -> DataFrame:
    """Rows (license_digest, license_id), one for each digest; of two ids with one digest the smaller stays."""
    licenses = [*LICENSES, *shipped()] if licenses is None else list(licenses)
    rows = spark.createDataFrame(licenses, "license_id string, body string")
    return rows.groupBy(digest(F.col("body")).alias("license_digest")).agg(F.min("license_id").alias("license_id"))


def scan(docs: DataFrame, licenses: DataFrame | None = None) -> DataFrame:
    """One row per document: doc_id, n_canonical (bytes of the canonical text), license_digest, license_id (null: no known
    licence), is_license.

    Whole texts are compared by digest. Null and empty texts, and those of copyright lines and punctuation alone, have an
    empty canonical text, which is never a licence. Other columns are left behind, repeated rows stay, an empty table gives
    no rows. The digest table is hash-joined; the planner broadcasts it if it is small.
    """
    licenses = licenses if licenses is not None else known(docs.sparkSession)
    rows = docs.select("doc_id", canonical(F.coalesce(F.col("text"), F.lit(""))).alias("body"))
    rows = rows.select("doc_id", F.octet_length("body").cast("long").alias("n_canonical"), F.sha2("body", 256).alias("license_digest"))
    return rows.join(licenses, "license_digest", "left").select(
        "doc_id", "n_canonical", "license_digest",
        F.when(F.col("n_canonical") > 0, F.col("license_id")).alias("license_id"),
        ((F.col("n_canonical") > 0) & F.col("license_id").isNotNull()).alias("is_license"))


def oracle() -> str:
    """The same scan as DuckDB SQL."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"

    def form(text: str) -> str:
        out = f"translate({text}, '{UPPER}', '{LOWER}')"
        out = rf"regexp_replace({out}, '(?m)^[ \t/*#;-]*(copyright|\(c\)|©|all rights reserved)[^\n]*$', ' ', 'g')"
        out = rf"' ' || regexp_replace({out}, '[\x00-\x2F\x3A-\x60\x7B-\x7F“”‘’–—]+', ' ', 'g') || ' '"
        for other, usual in SPELLINGS:
            out = f"replace({out}, ' {other} ', ' {usual} ')"
        return f"trim({out}, ' ')"

    bodies = ", ".join(f"({quote(i)}, {quote(b)})" for i, b in LICENSES)
    return f"""WITH k AS (SELECT sha256({form('body')}) AS license_digest, min(license_id) AS license_id
FROM (VALUES {bodies}) AS v(license_id, body) GROUP BY 1),
d AS (SELECT doc_id, {form("coalesce(text, '')")} AS body FROM documents)
SELECT d.doc_id, cast(strlen(d.body) AS bigint) AS n_canonical, sha256(d.body) AS license_digest,
CASE WHEN strlen(d.body) > 0 THEN k.license_id END AS license_id,
strlen(d.body) > 0 AND k.license_id IS NOT NULL AS is_license
FROM d LEFT JOIN k ON k.license_digest = sha256(d.body)"""
