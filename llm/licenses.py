"""Licence scan: normalised text against licence templates by the Dice coefficient of word bigrams.

Each line of a text, and each whole text of several lines, is a segment. Segments and templates are
lower-cased (A-Z), everything but a-z and 0-9 becomes a space, and the set of word bigrams is taken.
dice = 2 * shared / (bigrams of the segment + bigrams of the template). A template whose size differs so much
that the threshold is out of reach is not a candidate, and a segment without a candidate is not broken
compared. The templates are a few hundred strings inside the expression, so nothing is shuffled.

Defined cases. Null and empty texts and segments of fewer than two words match nothing. Equal coefficients
go to the template that comes last by name. Repeated rows give repeated results. An empty table gives no
rows. Other columns are not read.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Public licence notices, by SPDX-like name; several wordings of one licence are numbered.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required "
        'by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, '
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License."
    ),
    "BSD-2-Clause": "This software is released under the BSD 2-Clause License.",
    "BSD-3-Clause": "This software is released under the BSD 3-Clause License.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0 header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more "
        "details."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "LGPL-3.0": "This library is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MIT text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice "
        'and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS '
        'PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "Proprietary": "All rights reserved.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}
THRESHOLD = 0.8


def bigrams(text: str) -> set[str]:
    words = re.sub("[^a-z0-9]+", " ", re.sub("[A-Z]", lambda m: m[0].lower(), text)).split(" ")
    words = [w for w in words if w]
    return {f"{a} {b}" for a, b in zip(words, words[1:], strict=False)}


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, segment (line number from 0; -1 is the whole text), license, dice, n_bigrams, n_template."""
    own = {name: sorted(bigrams(text)) for name, text in templates.items()}
    ratio = threshold / (2 - threshold)
    least = lambda n: n * ratio - 1e-6  # noqa: E731  a size on the bound counts
    most = lambda n: n / ratio + 1e-6
    low, high = least(min(map(len, own.values()))), most(max(map(len, own.values())))
    kept = F.array(
        *[
            F.struct(F.lit(name).alias("license"), F.lit(len(b)).alias("n"), F.lit(b).alias("bigrams"))
            for name, b in sorted(own.items())
        ]
    )
    lowered = lambda x: F.translate(x, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = lambda x: F.split(F.trim(F.regexp_replace(lowered(x), "[^a-z0-9]+", " ")), " ")
    lines = F.split(F.col("text"), "\n", -1)
    numbered = F.transform(lines, lambda x, i: F.struct(i.alias("segment"), x.alias("line")))
    whole = F.when(F.size(lines) > 1, F.array(F.struct(F.lit(-1).alias("segment"), F.col("text").alias("line"))))
    nothing = F.array().cast("array<struct<segment:int,line:string>>")
    # An exploded array of one value is worked out once, however often later steps name it.
    once = lambda x: F.explode(F.array(x))
    segments = docs.select("doc_id", F.explode(F.concat(numbered, F.coalesce(whole, nothing))).alias("s"))
    segments = segments.select("doc_id", "s.segment", once(words(F.col("s.line"))).alias("words"))
    segments = segments.filter(F.size("words") >= 2)
    pairs = F.expr("zip_with(slice(words, 1, size(words) - 1), slice(words, 2, size(words) - 1), (a, b) -> concat(a, ' ', b))")
    segments = segments.select("doc_id", "segment", once(F.array_distinct(pairs)).alias("bigrams"))
    segments = segments.withColumn("n_bigrams", F.size("bigrams")).filter(F.col("n_bigrams").between(low, high))
    within = lambda t: F.col("n_bigrams").between(least(t["n"]), most(t["n"]))
    dice = lambda t: F.struct(
        (F.size(F.array_intersect("bigrams", t["bigrams"])) * 2.0 / (F.col("n_bigrams") + t["n"])).alias("dice"),
        t["license"].alias("license"),
        t["n"].alias("n_template"),
    )
    best = segments.withColumn("best", once(F.array_max(F.transform(F.filter(kept, within), dice))))
    return best.filter(F.col("best.dice") >= threshold).select(
        "doc_id", "segment", "best.license", "best.dice", "n_bigrams", "best.n_template"
    )


def scan_sql(templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> str:
    """The same for DuckDB, without any pruning."""
    own = {name: sorted(bigrams(text)) for name, text in templates.items()}
    values = ", ".join(f"('{n}', {len(b)}, {b!r})" for n, b in sorted(own.items()))
    return f"""
    WITH templates(license, n, bigrams) AS (VALUES {values}),
    numbered AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents WHERE text IS NOT NULL),
    segments AS (
      SELECT doc_id, i - 1 AS segment, lines[i] AS line FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM numbered)
      UNION ALL SELECT doc_id, -1, text FROM numbered WHERE len(lines) > 1),
    worded AS (
      SELECT doc_id, segment, string_split(trim(regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9]+', ' ', 'g')), ' ') AS words
      FROM segments),
    paired AS (
      SELECT doc_id, segment, list_distinct(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) AS bigrams
      FROM worded WHERE len(words) >= 2),
    scored AS (
      SELECT doc_id, segment, license, len(p.bigrams) AS n_bigrams, n AS n_template,
        len(list_intersect(p.bigrams, t.bigrams)) * 2.0::DOUBLE / (len(p.bigrams) + n) AS dice
      FROM paired p, templates t)
    SELECT doc_id, CAST(segment AS INTEGER) AS segment, license, dice, CAST(n_bigrams AS INTEGER) AS n_bigrams, CAST(n_template AS INTEGER) AS n_template
    FROM scored WHERE dice >= {threshold}
    QUALIFY row_number() OVER (PARTITION BY doc_id, segment ORDER BY dice DESC, license DESC) = 1
    """
