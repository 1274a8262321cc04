"""Licence scans: canonical forms of entire texts, looked up by digest."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from payloom.llm.common import UPPER, ascii_lower

# Equivalent spellings, each followed by the one that stands for both.
SPELLINGS = (
    ("https://", "http://"), ("licence", "license"), ("sub-license", "sublicense"), ("non-infringement", "noninfringement"),
    ("non-commercial", "noncommercial"), ("acknowledgement", "acknowledgment"), ("authoris", "authoriz"), ("organis", "organiz"),
    ("recognis", "recogniz"), ("utilis", "utiliz"), ("initialis", "initializ"), ("favour", "favor"), ("fulfilment", "fulfillment"),
    ("judgement", "judgment"), ("labour", "labor"), ("wilful", "willful"), ("whilst", "while"), ("per cent", "percent"),
    ("programme", "program"), ("copyright owner", "copyright holder"),
)
# Lines that name holders and years; not the mention of a copyright notice in a sentence.
COPYRIGHT_LINE = r"(^|\n)[ \t]*((copyright|\(c\)|©)[ \t]*(\(c\)|©|[0-9<\[{])|all rights reserved)[^\n]*"
PUNCTUATION = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Before lower case, as a name is told from a sentence that goes on by its capital. (c) also numbers paragraphs, so it needs more.
HOLDER_LINE = (r"(?<![^\n])[ \t]*(?:(?:Copyright|COPYRIGHT|©)[ \t]*:?|copyright[ \t]*:?(?=[ \t]+\p{Lu}))[ \t]+(?!(?i:notices?|holders?|owners?|laws?|licen[cs]es?|"
               r"statements?|interests?|permissions?|disclaimers?|treaty|protection|infringement|claims?|rights?|and|or|in|of|on|is|are|to|as|for|that|which)\b)\S[^\n]*")
# What other scripts and word processors write for ASCII punctuation and blanks, and marks without width.
DASHES = r"[\p{Pd}\u2212\u2022\u00B7]"
QUOTES = r"[\p{Pi}\p{Pf}\u201A\u201E\u2026]"
WIDTHLESS = r"[\p{Cf}\uFEFF]"
TERMS_END = "END OF TERMS AND CONDITIONS"

# Texts of public licences and usual notices.
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

"""
_ISC_END = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

"""
_BSD_NAMES = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.

"""
_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution."""
KNOWN = (
    ("MIT", _MIT), ("MIT", f"MIT License\n\n{_MIT}"), ("MIT", f"The MIT License (MIT)\n\n{_MIT}"),
    ("ISC", _ISC + _ISC_END), ("ISC", f"ISC License\n\n{_ISC}{_ISC_END}"),
    ("0BSD", _ISC.split(", provided")[0] + ".\n\n" + _ISC_END),
    ("BSD-2-Clause", _BSD + _BSD_END), ("BSD-3-Clause", _BSD + _BSD_NAMES + _BSD_END),
    ("Zlib", _ZLIB), ("Zlib", f"zlib License\n\n{_ZLIB}"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."), ("MIT", "Released under the MIT License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
)


def canonical(text: Column) -> Column:
    """Lower case, no copyright lines, ASCII punctuation, one spelling, words with single blanks between them."""
    out = F.replace(F.coalesce(text, F.lit("")), F.lit("\r\n"), F.lit("\n"))
    for pattern, one in ((WIDTHLESS, ""), (r"[\r\u2028\u2029\x{85}]", "\n"), (r"\p{Zs}", " "), (DASHES, "-"), (QUOTES, "'"), (HOLDER_LINE, "")):
        out = F.regexp_replace(out, pattern, one)
    out = F.regexp_replace(F.regexp_replace(ascii_lower(out), COPYRIGHT_LINE, ""), r"\s+", " ")  # spellings of two words also across lines
    for other, one in SPELLINGS:
        out = F.replace(out, F.lit(other), F.lit(one))
    return F.trim(F.regexp_replace(out, PUNCTUATION, " "))


def canonical_sql(text: str) -> str:
    """The same as an SQL expression for DuckDB, for texts with ASCII punctuation and with years or marks in copyright lines."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    out = f"regexp_replace(translate(coalesce({text}, ''), '{UPPER}', '{UPPER.lower()}'), {quoted(COPYRIGHT_LINE)}, '', 'g')"
    for other, one in SPELLINGS:
        out = f"replace({out}, {quoted(other)}, {quoted(one)})"
    return f"trim(regexp_replace({out}, {quoted(PUNCTUATION)}, ' ', 'g'), ' ')"


def bundled_texts() -> list[tuple[str, str]]:
    """(licence, text) of the full texts beside this module, whole and without what follows the end of their terms."""
    whole = [(p.stem, p.read_text(encoding="utf-8")) for p in sorted((Path(__file__).parent / "licence_texts").glob("*.txt"))]
    return whole + [(n, t.split(TERMS_END)[0] + TERMS_END) for n, t in whole if TERMS_END in t]


def licence_folder(spark: SparkSession, folder: str) -> DataFrame:
    """(licence, text) of a folder with a text file for each licence, named by it."""
    return spark.read.text(folder, wholetext=True).select(F.regexp_extract(F.input_file_name(), r"([^/]+?)(\.txt)?$", 1).alias("licence"), F.col("value").alias("text"))


def known_licences(spark: SparkSession, texts=None) -> DataFrame:
    """(digest, licence) of given texts; a digest that several names share has the first of them.

    texts: pairs or a table (licence, text), such as `licence_folder` reads;
    without it, KNOWN and the bundled full texts.
    """
    rows = texts if isinstance(texts, DataFrame) else spark.createDataFrame(list(texts if texts is not None else [*KNOWN, *bundled_texts()]), "licence string, text string")
    return rows.groupBy(F.sha2(canonical(F.col("text")).cast("binary"), 256).alias("digest")).agg(F.min("licence").alias("licence"))


def scan_licences(docs: DataFrame, known: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Which documents are, as a whole, a known licence: (id, n_words, canonical_sha256, licence).

    Entire texts are brought to a canonical form, and its SHA-256 is joined to
    the digests of known texts. Only digests take part in the join; Spark
    broadcasts the known ones where their size allows it, or else splits a
    digest that very many documents share.

    Null and empty texts, and those of nothing but copyright lines and
    punctuation, have no words, the digest of the empty text and no licence. Null ids and
    repeated rows get a row each. Other columns are not read.
    """
    form = docs.select(F.col(f"`{doc_id}`").alias("doc"), canonical(F.col(f"`{text}`")).alias("form"))
    rows = form.select("doc", F.when(F.col("form") == "", 0).otherwise(F.length("form") - F.length(F.replace("form", F.lit(" "))) + 1).cast("long").alias("n_words"),
                       F.sha2(F.col("form").cast("binary"), 256).alias("digest"))
    licence = F.when(F.col("n_words") > 0, F.col("licence"))
    return rows.join(known, "digest", "left").select(F.col("doc").alias(doc_id), "n_words", F.col("digest").alias("canonical_sha256"), licence.alias("licence"))
