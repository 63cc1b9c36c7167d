"""License scans: TF-IDF cosine of statements, headers and whole files to templates, then inheritance by directory.

Every text is looked at as a whole (is it a licence text?), by paragraphs (does it carry a licence header?) and by lines
and sentences (does it state a licence?). Each of these units becomes a sparse vector of its terms, as each template does:
(1 + ln tf) * idf, where idf goes by the documents that hold a term; a term that no template has weighs as one that no
document has, so foreign words count against a match. A unit takes the template of the highest cosine that reaches
`LEAST`, and a document its best unit.

No unit is passed over for want of a name. Candidates come from a join on rare terms: going from the commonest term of a
template to the rarest, the common ones are left out as long as their part of the template's vector stays shorter than
`LEAST`. Whatever shares none of the others cannot reach that cosine, whatever its own terms, so only units with one of
those are made at all. Equal units are compared once, however many documents carry them.

A document whose whole text matches, or which is named like a licence file and matches anywhere, also speaks for its
directory; documents without a match of their own inherit from the nearest directory above them that has such a file.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.operators.skew import is_small, lookup
from tidemark.session import checkpointed, stored

LEAST = 0.6
FILE_NAME = r"(?i)^(?:licen[cs]e|copying|copyright|notice|unlicense)(?:[.-][^/]*)?$"

# Fixed texts: customary statements, file headers and whole licence texts, by SPDX identifier.
STATEMENTS = {
    "MIT": ["Released under the MIT License", "Licensed under the MIT license"],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0"],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2"],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3"],
    "LGPL-2.1": ["This library is licensed under the GNU Lesser General Public License, version 2.1"],
    "LGPL-3.0": ["This library is licensed under the GNU Lesser General Public License, version 3"],
    "AGPL-3.0": ["This work is licensed under the GNU Affero General Public License, version 3"],
    "BSD-2-Clause": ["Redistributed under the BSD 2-Clause Simplified License"],
    "BSD-3-Clause": ["Redistributed under the BSD 3-Clause New or Revised License"],
    "MPL-2.0": ["This file is subject to the terms of the Mozilla Public License, v. 2.0"],
    "ISC": ["Released under the ISC License"],
    "EPL-2.0": ["This program is made available under the terms of the Eclipse Public License 2.0"],
    "Unlicense": ["This is free and unencumbered software released into the public domain under the Unlicense"],
    "CC0-1.0": ["Dedicated to the public domain under Creative Commons CC0 1.0 Universal", "Released under CC0 1.0"],
    "CC-BY-4.0": ["Licensed under Creative Commons Attribution CC BY 4.0", "Licensed under CC BY 4.0"],
    "CC-BY-SA-4.0": ["Licensed under Creative Commons Attribution-ShareAlike CC BY-SA 4.0", "Licensed under CC BY-SA 4.0"],
    "CC-BY-NC-4.0": ["Licensed under Creative Commons Attribution-NonCommercial CC BY-NC 4.0", "Licensed under CC BY-NC 4.0"],
    "CC-BY-ND-4.0": ["Licensed under Creative Commons Attribution-NoDerivatives CC BY-ND 4.0", "Licensed under CC BY-ND 4.0"],
}
RESERVED = "All rights reserved"  # by itself the weakest of all: it counts only where nothing else matches

_DISCLAIMER = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_CONDITIONS = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution. "
)
_NAMES = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission. "
)
_GNU = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {0} as published by "
    "the Free Software Foundation, either version {1} of the License, or (at your option) any later version. This program is "
    "distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
    "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {0} for more details. You should have received a copy "
    "of the GNU {0} along with this program. If not, see https://www.gnu.org/licenses/."
)
WORDINGS = {
    "MIT": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "MIT License Copyright (c) Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        'software and associated documentation files (the "Software"), to deal in the Software without restriction, including '
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The "
        "above copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        'Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL "
        "THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
        "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN "
        "THE SOFTWARE.",
    ],
    "BSD-2-Clause": [_CONDITIONS + _DISCLAIMER],
    "BSD-3-Clause": [_CONDITIONS + _NAMES + _DISCLAIMER],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS "
        'PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES '
        "OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR "
        "CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF "
        "CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS "
        "SOFTWARE.",
    ],
    "Zlib": [
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software. Permission is granted to anyone to use this software "
        "for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the "
        "following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote "
        "the original software. If you use this software in a product, an acknowledgment in the product documentation would be "
        "appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be "
        "misrepresented as being the original software. 3. This notice may not be removed or altered from any source "
        "distribution.",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
        "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
        "commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors "
        "of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication "
        "for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to "
        "be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law. "
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE "
        "LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
        "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE. For more information, please "
        "refer to <https://unlicense.org>",
    ],
    "Apache-2.0": [
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the '
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the '
        "specific language governing permissions and limitations under the License.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ],
    "GPL-2.0": [_GNU.format("General Public License", 2)],
    "GPL-3.0": [_GNU.format("General Public License", 3)],
    "LGPL-2.1": [_GNU.format("Lesser General Public License", 2.1)],
    "LGPL-3.0": [_GNU.format("Lesser General Public License", 3)],
    "AGPL-3.0": [_GNU.format("Affero General Public License", 3)],
}
TEMPLATES = [
    *[(name, text) for texts in (STATEMENTS, WORDINGS) for name, several in texts.items() for text in several],
    ("Proprietary", RESERVED),
]
KINDS = ("file", "header", "statement")


def terms_of(text: Column) -> Column:
    """Terms in lower case: runs of letters, digits and hyphens, with dots inside numbers; `v. 2` is `version 2`."""
    plain = F.regexp_replace(F.lower(text), r"\bv(ersion)?\.?\x20*([0-9])", "version $2")
    # Taking the runs is several times faster than replacing what lies between them.
    plain = F.array_join(F.regexp_extract_all(plain, F.lit("[a-z0-9.-]+"), F.lit(0)), " ")
    plain = F.regexp_replace(plain, r"\.([^0-9]|$)", " $1")
    return F.filter(F.split(plain, " "), lambda t: t.rlike("[a-z0-9]"))


def _units(text: Column) -> Column:
    """Array of (kind, at, text): the whole text, its paragraphs, and its lines cut into sentences."""
    lines = F.split(F.regexp_replace(text, r"([.!?;])[\x20\x09]+([A-Z(])", "$1\n$2"), "\n", -1)
    paragraphs = F.split(text, r"\n[\x20\x09\x0D]*\n", -1)

    def listed(kind: int, parts: Column) -> Column:
        return F.transform(parts, lambda p, i: F.struct(F.lit(kind).alias("kind"), i.alias("at"), F.btrim(p).alias("text")))

    return F.concat(listed(0, F.array(text)), listed(1, paragraphs), listed(2, lines))


def _counts(df: DataFrame, key: str, text: str) -> DataFrame:
    rows = df.select(key, F.explode_outer(terms_of(F.col(text))).alias("term")).where("term is not null")
    return rows.groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"))


def template_vectors(docs: DataFrame, templates: list[tuple[str, str]]) -> tuple[DataFrame, DataFrame, float]:
    """(template, license, term, w) as unit vectors, (term, idf) of all their terms, and the idf of any other term.

    `docs` (text) says how many documents hold a term. The templates are a fixed list, so all of this is small.
    """
    spark = docs.sparkSession
    known = [(i, name, text) for i, (name, text) in enumerate(templates)]
    known = spark.createDataFrame(known, "template int, license string, wording string")
    counts = checkpointed(_counts(known, "template", "wording"))
    names = sorted({r["term"] for r in counts.select("term").collect()})
    held = F.array_intersect(terms_of(F.col("text")), F.array(*[F.lit(t) for t in names])) if names else F.array().cast("array<string>")
    # explode() would add a filter on the array's size, and that filter would cut the text into terms once more.
    seen = docs.select(F.explode_outer(held).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    seen = {r["term"]: r["n"] for r in seen.where("term is not null").collect()}
    total = docs.count()
    idf = {t: math.log((1 + total) / (1 + seen.get(t, 0))) + 1 for t in names}
    table = spark.createDataFrame(list(idf.items()), "term string, idf double")
    weighted = counts.join(F.broadcast(table), "term").withColumn("w", (1 + F.log("tf")) * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("template")))
    vectors = weighted.withColumn("w", F.col("w") / norm).join(F.broadcast(known.drop("wording")), "template")
    return checkpointed(vectors.select("template", "license", "term", "idf", "w")), table, math.log(1 + total) + 1


def rare_terms(vectors: DataFrame, least: float = LEAST) -> list[str]:
    """Terms of which a unit must hold one to reach `least` with any template; see above."""
    rows = [(r["template"], r["idf"], r["term"], r["w"]) for r in vectors.collect()]  # the fixed templates' terms
    out: set[str] = set()
    for template in {r[0] for r in rows}:
        common = 0.0
        for _, _, term, w in sorted(r for r in rows if r[0] == template):
            common += w * w
            if common >= (least - 1e-6) ** 2:
                out.add(term)
    return sorted(out)


def match_units(units: DataFrame, vectors: DataFrame, idf: DataFrame, other: float, least: float = LEAST) -> DataFrame:
    """(key, license, cosine) for those of the different texts `units` (key, unit) that reach `least`; of equal cosines the
    first identifier wins. Terms travel with the key, not with the text; terms of no template only add to the norm."""
    counts = _counts(units, "key", "unit").join(F.broadcast(idf), "term", "left")
    a = (1 + F.log("tf")) * F.coalesce("idf", F.lit(other))
    mine = F.when(F.col("idf").isNotNull(), F.struct("term", a.alias("a")))
    rows = counts.groupBy("key").agg(F.sqrt(F.sum(a * a)).alias("norm"), F.collect_list(mine).alias("known"))
    rows = rows.select("key", "norm", F.explode_outer("known").alias("t")).where("t is not null").select("key", "norm", "t.term", "t.a")
    dots = rows.join(F.broadcast(vectors.select("template", "license", "term", "w")), "term")
    dots = dots.groupBy("key", "template", "license").agg(F.sum(F.col("a") * F.col("w")).alias("dot"), F.first("norm").alias("norm"))
    cosines = dots.withColumn("cosine", F.round(F.col("dot") / F.col("norm"), 6))
    best = cosines.groupBy("key").agg(F.min(F.struct((-F.col("cosine")).alias("c"), "license")).alias("b"))
    return best.select("key", F.col("b.license").alias("license"), (-F.col("b.c")).alias("cosine")).where(F.col("cosine") >= least)


def scan(files: DataFrame, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """Licence of every row of `files` (path, text): all columns but text stay as they are; license, cosine, origin are added.

    origin is `statement`, `header`, `file` (what a licence file says itself), `inherited`, or null where there is none.
    Of a document's units the whole text goes before paragraphs and those before lines, then the higher cosine, then the
    first; a mere reservation of rights comes last. Paths are separated by slashes; a null path has no directory. A null
    or empty text matches nothing. Of several licence files in one directory the highest cosine counts, then the first
    path. Repeated rows are judged each, empty tables give none. Columns of the added names go. A text of any length is
    looked at as a whole; its units take about four times its size.
    """
    kept = [c for c in files.columns if c.lower() not in ("license", "cosine", "origin", "text")]
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    vectors, idf, other = template_vectors(files.select(text), templates)
    rare = F.array(*[F.lit(t) for t in rare_terms(vectors)])
    own = F.struct(*([F.col(f"`{c}`") for c in kept] or [F.lit(0).alias("nothing")])).alias("own")
    rows = files.select(own, F.col("path").alias("path"), text, F.monotonically_increasing_id().alias("row"))
    # Texts without a rare term are not cut into units.
    units = F.when(F.arrays_overlap(terms_of(F.col("text")), rare), F.filter(_units(F.col("text")), lambda u: F.arrays_overlap(terms_of(u["text"]), rare)))
    rows = stored(rows.select("own", "path", "row", units.alias("units")), "license-units")

    pieces = rows.select("row", F.explode_outer("units").alias("u")).where("u is not null").select(
        "row", "u.kind", "u.at", F.sha2("u.text", 256).alias("key"), F.col("u.text").alias("unit")
    )
    units = stored(pieces.select("key", "unit").dropDuplicates(["key"]), "license-texts")
    matched = match_units(units, vectors, idf, other)
    matched = lookup(pieces.drop("unit"), matched, "key", "inner", spread_by=("row", "kind", "at"))
    last = (F.col("license") == "Proprietary").cast("int")
    best = F.min(F.struct(last.alias("last"), "kind", (-F.col("cosine")).alias("c"), "at", "license")).alias("b")
    each = stored(matched.groupBy("row").agg(best), "license-matches")
    placed = lookup(rows.drop("units"), each, "row")
    name = F.element_at(F.split("path", "/"), -1)
    named = F.coalesce(F.regexp_like(name, F.lit(FILE_NAME)), F.lit(False))
    is_file = F.col("b").isNotNull() & (named | (F.col("b.kind") == 0))
    folder = F.when(F.col("path").contains("/"), F.regexp_replace("path", r"/[^/]*$", ""))
    placed = placed.select(
        "own", "path", folder.alias("folder"), F.col("b.license").alias("license"), (-F.col("b.c")).alias("cosine"), is_file.alias("is_file"),
        F.get(F.array(*[F.lit(k) for k in KINDS]), F.when(is_file, F.lit(0)).otherwise(F.col("b.kind"))).alias("kind"),
    )
    placed = stored(placed, "licensed")

    speaks = placed.where("is_file and folder is not null").groupBy("folder").agg(F.min(F.struct((-F.col("cosine")).alias("c"), "path", "license")).alias("s"))
    speaks = stored(speaks.select(F.col("folder").alias("up"), F.col("s.license").alias("file_license"), (-F.col("s.c")).alias("file_cosine")), "license-files")
    # Each different directory once, with all directories above it.
    parts = F.split("folder", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.struct(k.alias("depth"), F.array_join(F.slice(parts, F.lit(1), k), "/").alias("up")))
    above = placed.where("folder is not null").select("folder").distinct().select("folder", F.explode_outer(above).alias("a"))
    above = above.select("folder", "a.depth", "a.up").join(F.broadcast(speaks) if is_small(speaks) else speaks, "up")
    nearest = above.groupBy("folder").agg(F.max(F.struct("depth", "file_license", "file_cosine")).alias("near"))
    out = lookup(placed, nearest, "folder", spread_by=("path",))
    origin = F.coalesce("kind", F.when(F.col("near").isNotNull(), F.lit("inherited")))
    return out.select(
        *[F.col(f"own.`{c}`").alias(c) for c in kept],
        F.coalesce("license", "near.file_license").alias("license"),
        F.coalesce("cosine", "near.file_cosine").alias("cosine"),
        origin.alias("origin"),
    )
