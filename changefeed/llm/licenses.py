"""Licence scans in DataFrame expressions alone.

Texts are normalised (lower case, runs of letters and digits) and cut into sets
of word bigrams. A unit (the whole text, a paragraph or a line) matches a
template when the Dice coefficient 2·|common| / (|unit| + |template|) reaches the
threshold ``t``. Equal sizes can share all they have; sizes further apart than
the factor (2 - t) / t cannot reach ``t``, so each unit is compared only with the
templates listed for its own size.

Templates are the plan's own constants: a short list, whatever the input.

Cases: a null or empty text has no units; a unit of fewer than two words has no
bigrams and matches nothing; a unit may match several templates; repeated rows
and ids are each reported for themselves.
"""

from __future__ import annotations

import json
import math
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8

# Public licence notices and texts, by SPDX name.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all copies "
        "or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, "
        "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
        "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
        "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
        "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    )),
    ("ISC", (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    )),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS "
        "OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
        "limitations under the License."
    )),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."
    )),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    )),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0 Universal."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)


def bigrams(text: str) -> list[str]:
    """Different word bigrams of a template."""
    words = re.findall(r"[^\W_]+", text.lower())
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def by_size(templates, threshold: float) -> list[list[dict]]:
    """For each number of bigrams 0, 1, 2 … the templates a unit of that size may match."""
    sized = [(name, bigrams(text)) for name, text in templates]
    sized = [(name, grams) for name, grams in sized if grams]
    reach = [
        (math.ceil(len(g) * threshold / (2 - threshold) - 1e-9), math.floor(len(g) * (2 - threshold) / threshold + 1e-9))
        for _, g in sized
    ]
    most = max((high for _, high in reach), default=0)
    return [
        [{"name": n, "grams": g} for (n, g), (low, high) in zip(sized, reach) if low <= size <= high]
        for size in range(most + 1)
    ]


_CANDIDATES = "array<array<struct<name:string,grams:array<string>>>>"


def scan_licenses(
    docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD, key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """(key, n_units, matches): matching units of each document.

    ``n_units`` counts the units compared with any template; ``matches`` holds
    (unit, name, dice), unit being 'text', 'paragraph' or 'line'.
    """
    listed = by_size(templates, threshold)
    most = len(listed) - 1
    df = docs.select(F.col(key).alias("key"), F.lower(F.coalesce(text, F.lit(""))).alias("body"))
    units = """
        flatten(array(
            array(struct('text' as kind, body as body)),
            case when contains(body, '\n\n')
                 then transform(split(body, '\\n\\n+'), p -> struct('paragraph' as kind, p as body))
                 else cast(array() as array<struct<kind:string,body:string>>) end,
            case when contains(body, '\n')
                 then transform(split(body, '\n'), l -> struct('line' as kind, l as body))
                 else cast(array() as array<struct<kind:string,body:string>>) end))
    """
    words = r"regexp_extract_all(u.body, '[\\p{L}\\p{N}]+', 0)"
    pairs = (
        "case when size(w.words) < 2 then cast(array() as array<string>) else "
        "array_distinct(transform(slice(w.words, 1, size(w.words) - 1), (x, i) -> concat(x, ' ', w.words[i + 1]))) end"
    )
    df = df.withColumn("units", F.explode(F.expr(f"array({units})")))
    df = df.withColumn("words", F.explode(F.expr(
        f"array(transform(units, u -> named_struct('kind', u.kind, 'words', {words})))"
    ))).drop("units", "body")
    df = df.withColumn("grams", F.explode(F.expr(
        f"array(filter(transform(words, w -> named_struct('kind', w.kind, 'grams', {pairs})), "
        f"g -> size(g.grams) between 1 and {most}))"
    ))).drop("words")
    df = df.withColumn("at", F.from_json(F.lit(json.dumps(listed)), _CANDIDATES))
    df = df.withColumn("compared", F.explode(F.expr(
        "array(filter(grams, g -> size(at[size(g.grams)]) > 0))"
    )))
    scored = (
        "flatten(transform(compared, g -> transform(at[size(g.grams)], c -> named_struct('unit', g.kind, 'name', c.name, "
        "'dice', 2.0D * size(array_intersect(g.grams, c.grams)) / (size(g.grams) + size(c.grams))))))"
    )
    df = df.withColumn("scored", F.explode(F.expr(f"array({scored})")))
    return df.select(
        F.col("key").alias(key), F.size("compared").cast("bigint").alias("n_units"),
        F.expr(f"filter(scored, m -> m.dice >= {threshold}D)").alias("matches"),
    )
