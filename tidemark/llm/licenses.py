"""Licence scan by Dice coefficient over word bigrams, with built-in functions only.

Every line, and every whole text of several lines, is a unit. A unit's words are
its lower-cased runs of letters and digits. Its set of word bigrams is compared
with those of the templates whose size allows the threshold.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8
WORD = r"[\p{L}\p{N}]"
NOT_WORD = r"[^\p{L}\p{N}]+"

# Licence notices and texts.
TEMPLATES = {
    "MIT notice": "Released under the MIT License.",
    "MIT notice 2": "Licensed under the MIT License.",
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file
        except in compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software
        distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND,
        either express or implied. See the License for the specific language governing permissions and limitations
        under the License.""",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL header": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation, either version 3 of the License, or (at
        your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY
        WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU
        General Public License for more details.""",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0 notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0 notice":
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "All rights reserved": "All rights reserved.",
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction, including without
        limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
        Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
        The above copyright notice and this permission notice shall be included in all copies or substantial portions of
        the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT
        NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO
        EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN
        ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR
        OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
        hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE
        SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
        IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL,
        DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR
        PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION
        WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met: 1. Redistributions of source code must retain the above
        copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must
        reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation
        and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND
        CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED
        WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE
        COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR
        CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE,
        DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT,
        STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
        SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors
        be held liable for any damages arising from the use of this software. Permission is granted to anyone to use
        this software for any purpose, including commercial applications, and to alter it and redistribute it freely,
        subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not
        claim that you wrote the original software. If you use this software in a product, an acknowledgment in the
        product documentation would be appreciated but is not required. 2. Altered source versions must be plainly
        marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed
        or altered from any source distribution.""",
    "Unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy,
        modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled
        binary, for any purpose, commercial or non-commercial, and by any means.""",
}


def template_bigrams(text: str) -> list[str]:
    """Distinct word bigrams of a template, in order."""
    words = re.findall(r"[^\W_]+", text.lower())
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:], strict=False)))


def size_bounds(size: int, threshold: float) -> tuple[float, float]:
    """Sizes of sets whose Dice coefficient with a set of ``size`` can reach ``threshold``.

    The intersection is at most the smaller set, so 2 * min / (a + b) bounds the coefficient.
    The bounds are eased by what rounding may take from them.
    """
    return size * threshold / (2 - threshold) - 1e-9, size * (2 - threshold) / threshold + 1e-9


def anchor_words(templates: dict[str, str], threshold: float) -> list[str]:
    """Words of which every matching unit holds at least one.

    A match misses at most ``size - size * threshold / (2 - threshold)`` of the
    template's bigrams; a template's anchors are in more of them than that.
    Long words that serve many templates are taken first, then rare short ones.
    """
    chosen: set[str] = set()
    usage: dict[str, int] = {}
    for text in templates.values():
        for word in set(re.findall(r"[^\W_]+", text.lower())):
            usage[word] = usage.get(word, 0) + 1
    for text in templates.values():
        bigrams = [set(pair.split()) for pair in template_bigrams(text)]
        needed = len(bigrams) - size_bounds(len(bigrams), threshold)[0]
        words = sorted({word for pair in bigrams for word in pair}, key=lambda w: (len(w) < 7, usage[w] * (1 if len(w) < 7 else -1), -len(w), w))
        for word in words:
            if sum(bool(pair & chosen) for pair in bigrams) > needed + 1e-9:
                break
            chosen.add(word)
    return sorted(chosen)


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), NOT_WORD), lambda word: word != "")


def _bigrams(words: Column) -> Column:
    pairs = F.zip_with(
        F.slice(words, F.lit(1), F.size(words) - 1),
        F.slice(words, F.lit(2), F.size(words) - 1),
        lambda a, b: F.concat_ws(" ", a, b),
    )
    return F.when(F.size(words) > 1, F.array_distinct(pairs)).otherwise(F.array().cast("array<string>"))


def _strings(values: list[str]) -> Column:
    """A literal array; folded into one constant by the optimiser."""
    return F.split(F.lit("\n".join(values)), "\n")


def scan_licenses(
    docs: DataFrame,
    text: str = "text",
    id_column: str = "doc_id",
    templates: dict[str, str] = TEMPLATES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row for each unit that matches a template: id, line, licence, dice, n_bigrams.

    ``line`` counts from 0; -1 is the whole text, which is a unit if it has a
    line break. The best template is told, on a tie the first by name. Null and
    empty texts match nothing; a repeated row repeats its matches; other columns
    are ignored. No shuffle and no join: templates are literals; texts and units
    without an anchor word are passed over before they are cut into words, and so
    are templates outside the size bounds.
    """
    sets = {name: template_bigrams(body) for name, body in sorted(templates.items())}
    longest = max((size_bounds(len(pairs), threshold)[1] for pairs in sets.values()), default=0)
    anchors = anchor_words(templates, threshold)

    def may_match(unit: str) -> Column:
        return F.lower(unit).rlike(rf"(?<!{WORD})(?:{'|'.join(anchors)})(?!{WORD})") if anchors else F.lit(False)

    rows = docs.select(F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{text}`").alias("body")).where(may_match("body"))
    lines = F.split("body", "\n")
    one = F.struct(F.lit(-1).alias("line"), F.col("body").alias("unit"))
    whole = F.when(F.size(lines) > 1, F.array(one)).otherwise(F.array().cast("array<struct<line:int,unit:string>>"))
    each = F.transform(lines, lambda unit, k: F.struct(k.alias("line"), unit.alias("unit")))
    units = rows.select("doc_id", F.explode(F.concat(whole, each)).alias("u"))
    units = units.where(may_match("u.unit")).select("doc_id", "u.line", _words(F.col("u.unit")).alias("words"))
    units = units.select("doc_id", "line", _bigrams(F.col("words")).alias("pairs")).where(F.size("pairs") <= longest)
    size = F.size("pairs")
    scores = []
    for rank, pairs in enumerate(sets.values()):
        low, high = size_bounds(len(pairs), threshold)
        dice = (2.0 * F.size(F.array_intersect("pairs", _strings(pairs)))) / (size + len(pairs))
        inside = (size >= low) & (size <= high)
        scores.append(F.when(inside, F.struct(dice.alias("dice"), F.lit(-rank).alias("rank"))))
    best = F.array_max(F.filter(F.array(*scores), lambda score: score.dice >= threshold))
    found = units.select("doc_id", "line", size.alias("n_bigrams"), best.alias("best")).where("best IS NOT NULL")
    return found.select(
        "doc_id",
        F.col("line").cast("long").alias("line"),
        F.element_at(_strings(list(sets)), 1 - F.col("best.rank")).alias("license"),
        F.col("best.dice").alias("dice"),
        F.col("n_bigrams").cast("long").alias("n_bigrams"),
    )


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def license_sql(templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> str:
    """The same over ``documents`` by a join of all bigrams, without anchors or size bounds."""
    rows = ", ".join(
        f"({_quoted(name)}, {len(template_bigrams(body))}, {_quoted(pair)})"
        for name, body in sorted(templates.items())
        for pair in template_bigrams(body)
    )
    return f"""
    WITH template(license, size, pair) AS (VALUES {rows}),
    unit AS (
        SELECT row_number() OVER () AS unit_id, doc_id, line, words FROM (
            SELECT doc_id, CAST(k AS BIGINT) - 1 AS line,
                   list_filter(regexp_split_to_array(lower(lines[k]), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '') AS words
            FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents WHERE text IS NOT NULL),
                 LATERAL (SELECT unnest(range(1, len(lines) + 1)) AS k)
            UNION ALL
            SELECT doc_id, -1, list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '')
            FROM documents WHERE contains(text, chr(10)))
    ),
    pair AS (
        SELECT DISTINCT unit_id, doc_id, line, words[k] || ' ' || words[k + 1] AS pair
        FROM unit, LATERAL (SELECT unnest(range(1, len(words))) AS k)
    ),
    sized AS (SELECT unit_id, count(*) AS n_bigrams FROM pair GROUP BY unit_id),
    dice AS (
        SELECT unit_id, doc_id, line, license, n_bigrams,
               CAST(2 * count(*) AS DOUBLE) / CAST(n_bigrams + size AS DOUBLE) AS dice
        FROM pair JOIN template USING (pair) JOIN sized USING (unit_id)
        GROUP BY unit_id, doc_id, line, license, n_bigrams, size
    )
    SELECT doc_id, line, license, dice, n_bigrams FROM dice WHERE dice >= {threshold}
    QUALIFY row_number() OVER (PARTITION BY unit_id ORDER BY dice DESC, license) = 1
    """
