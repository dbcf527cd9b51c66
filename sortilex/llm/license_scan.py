"""License scans: canonical digests of entire texts, joined to known ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# License texts and notices as their authors word them.
_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
    'and associated documentation files (the "Software"), to deal in the Software without '
    "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
    "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
    "Software is furnished to do so, subject to the following conditions: The above copyright notice "
    "and this permission notice shall be included in all copies or substantial portions of the "
    'Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, '
    "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE "
    "AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
    "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
    "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_ISC_END = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS '
    "SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE "
    "AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
    "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
    "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE "
    "OF THIS SOFTWARE."
)
_BSD_TERMS = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met: "
    "{}Redistributions of source code must retain the above copyright notice, this list of conditions "
    "and the following disclaimer. "
    "{}Redistributions in binary form must reproduce the above copyright notice, this list of "
    "conditions and the following disclaimer in the documentation and/or other materials provided "
    "with the distribution. "
)
_BSD_NAMES = (
    "{}Neither the name of the copyright holder nor the names of its contributors may be used to endorse "
    "or promote products derived from this software without specific prior written permission. "
)
_BSD_END = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR '
    "IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND "
    "FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT {} OR "
    "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL "
    "DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, "
    "DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER "
    "IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT "
    "OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)


def _bsd():
    """BSD texts with and without a title and numbers, and by holder or owner."""
    for name, title in (("BSD-2-Clause", "BSD 2-Clause License "), ("BSD-3-Clause", "BSD 3-Clause License ")):
        for head in ("", title):
            for marks in (("1. ", "2. ", "3. "), ("* ", "* ", "* ")):
                for liable in ("HOLDER", "OWNER", "HOLDERS"):
                    names = _BSD_NAMES.format(marks[2]) if name == "BSD-3-Clause" else ""
                    yield name, head + _BSD_TERMS.format(*marks) + names + _BSD_END.format(liable)


KNOWN_LICENSES = (
    ("MIT", "MIT License " + _MIT_GRANT),
    ("MIT", _MIT_GRANT),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this permission "
        "notice appear in all copies. " + _ISC_END,
    ),
    (
        "0BSD",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted. " + _ISC_END,
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    *_bsd(),
)
# Canonical digests of long texts as their authors publish them; where
# there is an appendix on how to apply them, also of the text up to its terms' end.
KNOWN_DIGESTS = (
    ("Apache-2.0", "75acde0fb516a7ba4597dfc23680cf78281f7fae7f3b74a78e06ef83c1c375c6"),
    ("Apache-2.0", "f9138026e58bdb767e6c6e974637ff9aacbaedf2695e30fef144e5d7d84448ff"),
    ("Apache-2.0", "6fb8411669deea22294b6190fad00b8e39899d0b7b6c5cf97a3b15b47e129c38"),
    ("GPL-2.0", "efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821"),
    ("GPL-2.0", "e1270b653c300290e7c039142bccb8776f9b5d14e8a05bc4e87dc7d1614a3b34"),
    ("GPL-2.0", "6d332dc4c3c5293a73c6c9da402f9bbc970b3bb1eb472f577e00580573469808"),
    ("GPL-3.0", "eaab5d82fdcca441d83a1913bbf07e4de3a739e190578c0bffde24f84e93bb2a"),
    ("GPL-3.0", "ac6b52d57c0104e687039148f7b8e370e04c9bb5705bb786f8ef814eb65e8636"),
    ("GPL-3.0", "092a7f3b82e6c22949b46388bca99e725b6e756f1c2b1e3f575447fbd44b6191"),
    ("LGPL-2.0", "61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908"),
    ("LGPL-2.0", "504542bce5421b0f5a7e63ddb55443ccb300b27a65ba6bfc1370fed16a3af260"),
    ("LGPL-2.0", "430627da7218a92ab4a6d75d5140cdb70ee750be7a53f913299b37e0d1b0eea2"),
    ("LGPL-2.1", "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891"),
    ("LGPL-2.1", "48d2010e70a815a564f914b0c7c1e80d7a6843793348fed3684c957112fe0aa4"),
    ("LGPL-2.1", "bf2f0c6bf1c47b3b1e3cbedeefecddd1e7db21d1919858d45c2f918efaf426df"),
    ("LGPL-3.0", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-2.0", "cf4fdc07202ec6d5439f2c5b5c7fefab577065eb74b364e6c6166bad4880fc48"),
    ("CC0-1.0", "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f"),
)

# Spellings that count as equal, after lower-casing; the part that a
# text must hold, the pattern and the common spelling.
EQUIVALENT = (
    ("licenc", r"licenc", "licens"),
    ("licens", r"sub[- ]licens", "sublicens"),
    ("acknowledgement", r"acknowledgement", "acknowledgment"),
    ("organis", r"organis", "organiz"),
    ("infring", r"non[- ]infring", "noninfring"),
    ("https:", r"https:", "http:"),
    ("licens", r"\bv(?:er)?\.? ?(?=\d)", "version "),
)
_COPYRIGHT_MARKS = ("copyright", "(c)", "\u00a9", "all rights reserved")
# A notice by its own wording: a mark, a year or a place for one, or the phrase alone.
_NOTICE = (
    r"(?m)^[^\p{L}\p{N}\n]*(?:copyright[^\p{L}\p{N}\n]*(?:\(c\)|©|\d{4}|[<\[{])[^\n]*|\(c\)[ :,]*(?:\d{4}|[<\[{])[^\n]*"
    r"|©[^\n]*|all rights reserved[^\p{L}\p{N}\n]*)$"
)
_STARTS = r"[^\p{L}\p{N}\n]*(?:copyright|\(c\)|©|all rights reserved)[^\n]*"
# Any line with such a start, where a paragraph starts with it, or anywhere: holders
# without a year or mark. A license's own lines can look alike.
_NOTICE_BLOCK = rf"(?:\A|(?<=\n)[^\p{{L}}\p{{N}}\n]*\n)(?:{_STARTS}(?:\n|\z))+"
_LOOSE_NOTICE = rf"(?m)^{_STARTS}$"


def _any_of(text: Column, parts) -> Column:
    found = F.lit(False)
    for part in parts:
        found = found | text.contains(part)
    return found


def _respelt(text: Column) -> Column:
    # Few texts hold what the rules rewrite; the others pass on at the cost of a search.
    rewritten = text
    for _, pattern, spelling in EQUIVALENT:
        rewritten = F.regexp_replace(rewritten, pattern, spelling)
    hints = _any_of(text, [part for part, _, _ in EQUIVALENT])
    return F.regexp_replace(F.when(hints, rewritten).otherwise(text), r"[^\p{L}\p{N}\n]+", " ")


def canonical_lines(text: Column) -> Column:
    """The text in canonical form, with its line breaks still in it.

    Lower case, copyright notices empty, equivalent spellings made one, and every
    run of signs other than letters and digits a single space.
    """
    out = F.lower(text)
    marked = _any_of(out, _COPYRIGHT_MARKS)
    return _respelt(F.when(marked, F.regexp_replace(out, _NOTICE, "")).otherwise(out))


def _loose_forms(text: Column) -> Column:
    """Canonical forms without lines that may be notices or the license's own wording."""
    out = F.lower(text)
    strict = F.regexp_replace(out, _NOTICE, "")
    forms = (F.regexp_replace(strict, _NOTICE_BLOCK, "\n"), F.regexp_replace(strict, _LOOSE_NOTICE, ""))
    return F.when(
        _any_of(out, _COPYRIGHT_MARKS), F.array(*(_whole(_respelt(form)) for form in forms))
    ).otherwise(F.array().cast("array<string>"))


def _whole(lines: Column) -> Column:
    return F.trim(F.regexp_replace(F.translate(lines, "\n", " "), "  +", " "))


def known_digests(spark: SparkSession, licenses=KNOWN_LICENSES) -> DataFrame:
    """Rows ``(license_id, digest)`` of licenses given as ``(id, text)``."""
    rows = spark.createDataFrame(list(licenses), "license_id string, text string")
    digest = F.sha2(_whole(canonical_lines(F.col("text"))), 256)
    rows = rows.select("license_id", digest.alias("digest"))
    if licenses is KNOWN_LICENSES:
        rows = rows.union(spark.createDataFrame(list(KNOWN_DIGESTS), "license_id string, digest string"))
    return rows.distinct()


def scan_licenses(documents: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Rows ``(doc_id, scope, license_id, digest, n)`` of licenses found.

    ``scope`` is ``document`` where the entire text is a known license and
    ``line`` where a line of it is; ``n`` counts the places. A null or empty
    text, or one of signs alone, has no license. Rows that repeat a doc_id are
    counted together, also those of a null doc_id. Only doc_id and text are read.
    The built-in licenses, a fixed list, are broadcast: what is exploded is
    matched at once, and only finds are shuffled. A caller's table is joined as
    its size demands.
    """
    known = F.broadcast(known_digests(documents.sparkSession)) if known is None else known
    text = F.col("text").cast("string")
    # A text is tried with and without the lines that may be notices.
    forms = F.array_distinct(F.concat(F.array(_whole(F.col("lines"))), F.col("loose")))
    units = documents.select(
        "doc_id", canonical_lines(text).alias("lines"), _loose_forms(text).alias("loose")
    ).select(
        "doc_id",
        F.explode(
            F.concat(
                F.transform(forms, lambda body: F.struct(F.lit("document").alias("scope"), body.alias("body"))),
                F.transform(
                    F.split("lines", "\n"),
                    lambda line: F.struct(F.lit("line").alias("scope"), F.trim(line).alias("body")),
                ),
            )
        ).alias("unit"),
    )
    digests = units.filter("unit.body <> ''").select(
        "doc_id", "unit.scope", F.sha2("unit.body", 256).alias("digest")
    )
    found = digests.join(known, "digest")
    return found.groupBy("doc_id", "scope", "license_id", "digest").agg(F.count("*").alias("n"))
