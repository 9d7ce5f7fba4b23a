"""License scan by canonical digest: normalise, hash, and join with the digests of known licence texts.

Normalised are the whole text and each of its lines (a notice line is a whole text
too); both sides pass the same expressions, so equal digests mean equal wording up
to case, punctuation, copyright lines and the listed spellings.  DataFrame functions
only.  The known texts are a parameter; their digests are joined by a broadcast hash
join while they fit ``BROADCAST_ROWS``, and by a shuffled hash join beyond.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plover.llm.common import free_name

BROADCAST_ROWS = 20_000  # known digests: 100 bytes each, 2 MB at most

#: Lines that name a holder or reserve rights are no part of a licence's wording (Java: only \n ends a line).
COPYRIGHT_LINE = r"^[^a-z0-9\n]*(?:(?:copyright|\(c\)|©)[^\n]*[0-9]{4}[^\n]*|all rights reserved[^a-z0-9\n]*)$"

#: Equivalent spellings, replaced in this order (pattern, replacement).
SPELLINGS = [
    ("licenc(e|es|ed|ing)", r"licens$1"), ("sub licens(e|es|ed|ing|able)", r"sublicens$1"),
    ("non commercial", "noncommercial"), ("copyright owner(s?)", "copyright holder$1"), ("favour", "favor"),
    ("organis(e|ed|es|ing|ation|ations)", r"organiz$1"), ("per cent", "percent"), ("acknowledgement", "acknowledgment"),
    ("judgement", "judgment"), ("merchantibility", "merchantability"), ("fulfil", "fulfill"), ("wilful", "willful"),
    ("https", "http"), ("centre", "center"), ("analogue", "analog"), ("whilst", "while"),
]

#: Short public licence and notice texts, by SPDX identifier.
KNOWN = {
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "MIT-notice": "Released under the MIT License.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, "
        "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
        "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
        "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
        "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.\n\nTHE "
        "SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING "
        "ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
        "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR "
        "PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION "
        "WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    "0BSD": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS "
        "SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE "
        "LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM "
        "LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING "
        "OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be "
        "held liable for any damages arising from the use of this software.\n\nPermission is granted to anyone to use "
        "this software for any purpose, including commercial applications, and to alter it and redistribute it freely, "
        "subject to the following restrictions:\n\n1. The origin of this software must not be misrepresented; you must "
        "not claim that you wrote the original software. If you use this software in a product, an acknowledgment in "
        "the product documentation would be appreciated but is not required.\n2. Altered source versions must be plainly "
        "marked as such, and must not be misrepresented as being the original software.\n3. This notice may not be "
        "removed or altered from any source distribution."),
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at\n\nhttp://www.apache.org/licenses/"
        "LICENSE-2.0\n\nUnless required by applicable law or agreed to in writing, software distributed under the "
        "License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or "
        "implied. See the License for the specific language governing permissions and limitations under the License."),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this "
        "list of conditions and the following disclaimer.\n\n2. Redistributions in binary form must reproduce the above "
        "copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution.\n\nTHIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "
        "\"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF "
        "MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
        "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
        "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR "
        "BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR "
        "TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF "
        "THE POSSIBILITY OF SUCH DAMAGE."),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this "
        "list of conditions and the following disclaimer.\n\n2. Redistributions in binary form must reproduce the above "
        "copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution.\n\n3. Neither the name of the copyright holder nor the names of "
        "its contributors may be used to endorse or promote products derived from this software without specific prior "
        "written permission.\n\nTHIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "
        "\"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF "
        "MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
        "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
        "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR "
        "BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR "
        "TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF "
        "THE POSSIBILITY OF SUCH DAMAGE."),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, "
        "for any purpose, commercial or non-commercial, and by any means.\n\nIn jurisdictions that recognize copyright "
        "laws, the author or authors of this software dedicate any and all copyright interest in the software to the "
        "public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs "
        "and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and "
        "future rights to this software under copyright law.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF "
        "ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
        "PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
        "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
        "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.\n\nFor more information, please refer to "
        "<https://unlicense.org>"),
}

#: Title lines that licence files carry above these texts.
TITLES = {
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)"],
    "ISC": ["ISC License", "The ISC License"],
    "0BSD": ["Zero-Clause BSD", "BSD Zero Clause License", "BSD Zero-Clause License (0BSD)"],
    "Zlib": ["zlib License", "The zlib/libpng License"],
    "BSD-2-Clause": ["BSD 2-Clause License", "The BSD 2-Clause License", "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "The BSD 3-Clause License", "New BSD License"],
    "Unlicense": ["Unlicense", "The Unlicense"],
}


def forms(known: dict[str, str], titles: dict[str, list[str]]) -> list[tuple[str, str]]:
    """(licence, text) of every known text, as it is and below each of its titles."""
    return sorted((k, t) for k, text in known.items() for t in [text, *(f"{x}\n\n{text}" for x in titles.get(k, []))])


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def canonical(df: DataFrame, text: Column, out: str) -> DataFrame:
    """``df`` plus ``out``: the normalised text; only texts with such a spelling pay for the replacements."""
    bare = free_name(df, "_bare")
    lowered = F.regexp_replace(lower_ascii(F.coalesce(text, F.lit(""))), "(?md)" + COPYRIGHT_LINE, "")
    got = df.withColumn(bare, F.trim(F.regexp_replace(lowered, "[^a-z0-9]+", " ")))
    spelt = F.col(bare)
    for pattern, replacement in SPELLINGS:
        spelt = F.regexp_replace(spelt, rf"\b{pattern}\b", replacement)
    some = "|".join(p for p, _ in SPELLINGS)
    return got.withColumn(out, F.when(F.col(bare).rlike(rf"\b(?:{some})\b"), spelt).otherwise(F.col(bare))).drop(bare)


def known_digests(spark: SparkSession, known: list[tuple[str, str]]) -> DataFrame:
    """(license, digest) of the known texts, one licence (the first by name) per digest."""
    rows = spark.createDataFrame(known or [("", "")], "license string, text string")
    rows = canonical(rows.filter(F.lit(bool(known))), F.col("text"), "words").filter("words <> ''")
    return rows.groupBy(F.sha2("words", 256).alias("digest")).agg(
        F.min("license").alias("license"))


def license_report(docs: DataFrame, known: dict[str, str], id_col: str = "doc_id", text_col: str = "text",
                   titles: dict[str, list[str]] = TITLES) -> DataFrame:
    """Per document: digest of its canonical text, the licence that it is as a whole, and those of its single lines.

    ``license`` is null where the whole text is no known licence; ``notices`` lists
    the licences of lines, sorted and comma-joined (empty: none).  A known text is also
    known below any of its ``titles``.  Null or empty text
    has the digest of nothing and matches none; repeated rows stay; null ids stay;
    other columns are ignored; an empty table gives no rows.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    texts = forms(known, titles)
    table = known_digests(docs.sparkSession, texts)
    if len(texts) <= BROADCAST_ROWS:
        table = F.broadcast(table)
    whole = canonical(base.withColumn("key", F.sha2("text", 256)), F.col("text"), "words").select(
        "doc_id", "key", F.sha2("words", 256).alias("digest"))
    whole = whole.join(table, "digest", "left")
    lines = base.select(F.sha2("text", 256).alias("key"), F.explode(F.split("text", "\n")).alias("line")).filter("line <> ''")
    # no filter may stand on a digest (Spark would compute it twice); known texts are never empty, so blank lines match none
    lines = canonical(lines, F.col("line"), "words").select(
        "key", F.coalesce(F.sha2("words", 256), F.lit("")).alias("digest"))
    notices = (lines.join(table, "digest").groupBy("key")
               .agg(F.array_join(F.array_sort(F.collect_set("license")), ",").alias("notices")))
    return whole.join(notices, "key", "left").select(
        "doc_id", "digest", "license", F.coalesce("notices", F.lit("")).alias("notices"))
