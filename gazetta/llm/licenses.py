"""License scan: MinHash bands over overlapping windows retrieve templates, exact containment decides.

A license is found in a document if some window of the template's size holds at
least ``CONTAINMENT`` of the template's five-word shingles.

1. Guard: no text can hold 75 % of a template's shingles without one of the
   template's guard words, since the shingles without a guard word are too few.
   Texts without any guard word have no candidate; the others are searched whole.
2. Windows: for each size class (template of m shingles) windows of m + m/4 - 1
   shingles start every m/4 shingles. One of them covers any occurrence, with a
   Jaccard similarity of at least 0.75 / 1.5 = 0.5 to the template. A window that
   holds an occurrence also holds a guard word, so only those near one are formed.
3. Bands: one MinHash row in each of ``BANDS`` = 12 bands, so an occurrence is
   missed with a probability of at most 0.5 ** 12 = 0.00024 (an exact copy: 3e-9).
4. Candidates are verified by exact intersection of shingle arrays.

Of a template with a version, a window must also hold a shingle with the version's
words that no other version of the license has. Variants of one license ("MIT#2")
are reported by the name before the sign.

The template table is a parameter; up to ``MAX_BANDS`` bands of it are broadcast, more are
joined by a shuffle. Null and empty texts have no license; long ones are searched whole.
Rows that agree in doc_id and text are one document with one result each. Of several
occurrences the first place and the best containment are given. An empty table gives an
empty result; columns beside doc_id and text are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gazetta.llm.common import ascii_lower, same, table, text_key
from gazetta.llm.decontaminate import words_of

BANDS = 12
CONTAINMENT = 75
K = 5
MAX_BANDS = 2_000_000

# Texts of public license notices.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "BSD-source": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "MIT": "Released under the MIT License.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    # variants of the notices, and licenses known by their notices only
    "Apache-2.0#2": "This project is licensed under the Apache License 2.0.",
    "Apache-2.0#3": "SPDX-License-Identifier: Apache-2.0",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "AGPL-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "BSD-2-Clause": "Licensed under the BSD 2-Clause License.",
    "BSD-3-Clause": "Licensed under the BSD 3-Clause License.",
    "BSD-style": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "CC0-1.0#2": "Released under CC0 1.0 Universal.",
    "CC-BY-4.0#2": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0#2": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0#2": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-2.0#2": "Licensed under the GNU GPL v2.",
    "GPL-2.0-header": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "GPL-3.0#2": "Licensed under the GNU GPL v3.",
    "LGPL-2.1": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "LGPL-2.1-header": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "LGPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "MIT#2": "Licensed under the MIT License.",
    "MIT#3": "Distributed under the MIT License.",
    "MIT#4": "SPDX-License-Identifier: MIT License",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
}
# Full texts as their publishers state them.
TEMPLATES |= {f"{p.stem}-full": p.read_text("utf-8") for p in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))}
# Notices by rule: Creative Commons licenses of each version, and SPDX lines of two words or more.
CC_TERMS = {
    "BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives",
    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}
CC_VERSIONS = {"2.0": "Generic", "2.5": "Generic", "3.0": "Unported", "4.0": "International"}
for _code, _terms in CC_TERMS.items():
    for _version, _kind in CC_VERSIONS.items():
        TEMPLATES[f"CC-{_code}-{_version}#notice"] = f"This work is licensed under a Creative Commons {_terms} {_version} {_kind} License."
        TEMPLATES[f"CC-{_code}-{_version}#short"] = f"This work is licensed under CC {_code} {_version}."
SPDX = (
    "AGPL-3.0-only AGPL-3.0-or-later Apache-2.0 Artistic-2.0 BSD-2-Clause BSD-3-Clause BSL-1.0 CC0-1.0 CDDL-1.0 EPL-1.0 EPL-2.0 EUPL-1.2 GPL-2.0-only "
    "GPL-2.0-or-later GPL-3.0-only GPL-3.0-or-later LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0-only LGPL-3.0-or-later MIT-0 MPL-1.1 MPL-2.0 MS-PL OFL-1.1 PSF-2.0 Zlib-acknowledgement"
).split()
TEMPLATES |= {f"{_id}#spdx": f"SPDX-License-Identifier: {_id}" for _id in SPDX}
#: Versions of templates whose names have none.
VERSIONS = {"GPL-header": "3", "AGPL-header": "3"}


def template_words(text: str) -> list[str]:
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return "".join(c if c.isascii() and c.isalnum() or ord(c) > 127 else " " for c in lowered).split(" ")


def guard_words(templates: dict[str, str]) -> list[str]:
    """Words that every text holding CONTAINMENT % of a template's shingles must have one of."""
    out: set[str] = set()
    for text in templates.values():
        words = [w for w in template_words(text) if w]
        grams = {tuple(words[i : i + K]) for i in range(max(1, len(words) - K + 1))}
        need = -(-CONTAINMENT * len(grams) // 100)
        free = {g for g in grams if not out & set(g)}
        while len(free) >= need:
            held = Counter(w for g in free for w in set(g))
            pick = max(held, key=lambda w: (len(w) > 6, held[w], len(w), w))
            out.add(pick)
            free = {g for g in free if pick not in g}
    return sorted(out)


def version_shingles(templates: dict[str, str]) -> dict[str, list[str]]:
    """By template with a version: the K-word shingles with its version's words that no other version of the license has."""
    grams: dict[str, list[tuple[str, ...]]] = {}
    version: dict[str, tuple[str, str]] = {}  # family and version
    for key, text in templates.items():
        words = [w for w in template_words(text) if w]
        grams[key] = [tuple(words[i : i + K]) for i in range(max(1, len(words) - K + 1))]
        m = re.match(r"([^#]*?)-(\d+(?:\.\d+)?)(?![\w.])(?!-Clause)", key)
        if m or key in VERSIONS:
            version[key] = (m[1], m[2]) if m else (re.split("-", key)[0], VERSIONS[key])
    out = {}
    for key, (family, number) in version.items():
        number = re.sub(r"\.0$", "", number)
        long = (number if "." in number else f"{number}.0").split(".")
        short = number.split(".")
        forms = [["version", *long], ["version", *short], ["v", *long], [f"v{short[0]}", *short[1:]], long, short]
        has = lambda g, f: any(list(g[i : i + len(f)]) == f for i in range(len(g) - len(f) + 1))
        own = next(([g for g in grams[key] if has(g, f)] for f in forms if any(has(g, f) for g in grams[key])), [])
        others = {g for k, v in version.items() if v[0] == family and float(v[1]) != float(number) for g in grams[k]}
        own = [g for g in own if g not in others and len(g) == K] or [g for g in own if len(g) == K]
        if own:
            out[key] = sorted({" ".join(g) for g in own})
    return out


def shingles(words: Column) -> Column:
    """Hashes of the K-word shingles in order; a shorter text is one shingle, none has none."""
    n = F.size(words)
    return (
        F.when(
            n >= K,
            F.transform(F.sequence(F.lit(0), n - K), lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(K)])),
        )
        .when(n > 0, F.array(F.xxhash64(F.lit("short"), F.array_join(words, " "))))
        .otherwise(F.array().cast("array<bigint>"))
    )


def _signature(hashes: Column) -> Column:
    """One MinHash for each band."""
    row = lambda b: F.array_min(F.transform(hashes, lambda h: F.xxhash64(F.lit(b), h)))
    return F.array(*[row(b) for b in range(BANDS)])


def template_bands(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    """A row for each template and band: m, license, its shingles, those of its version, band, hash."""
    keys = version_shingles(templates)
    rows = [(k, t, keys.get(k, [])) for k, t in sorted(templates.items())]
    one = lambda text: F.xxhash64(*[F.get(F.split(text, " "), F.lit(j)) for j in range(K)])
    return (
        spark.createDataFrame(rows, "license string, text string, keys array<string>")
        .select("license", F.explode(F.array(words_of(F.col("text")))).alias("words"), F.transform("keys", one).alias("keys"))
        .select("license", F.explode(F.array(F.array_distinct(shingles(F.col("words"))))).alias("own"), "keys")
        .withColumn("m", F.size("own"))
        .filter("m > 0")
        .select("license", "own", "keys", "m", F.posexplode(_signature(F.col("own"))).alias("band", "hash"))
    )


def _windows(m: Column) -> Column:
    """Windows for templates of m shingles that reach a guard word: m, first, own (shingles)."""
    step = F.greatest(F.lit(1), F.floor(m / 4).cast("int"))
    wide = m + step - 1
    # a window of shingles [s, s + wide) has words [s, s + wide + K - 1)
    last = F.floor(F.greatest(F.size("h") - wide + step - 1, F.lit(0)) / step).cast("int")

    def reach(p: Column) -> Column:
        begin = F.floor(F.greatest(p - (wide + K - 1) + step, F.lit(0)) / step).cast("int")
        return F.sequence(F.least(begin, last), F.least(F.floor(p / step).cast("int"), last))

    def one(j: Column) -> Column:
        own = F.slice(F.col("h"), j * step + 1, wide)
        return F.struct(m.alias("m"), (j * step).alias("first"), F.array_distinct(own).alias("own"))

    return F.transform(F.array_distinct(F.flatten(F.transform(F.col("near"), reach))), one)


def scan(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """Occurrences: doc_id, th, license, first (word index of the window), shared (shingles)."""
    templates = TEMPLATES if templates is None else templates
    spark = docs.sparkSession
    bands = template_bands(spark, templates)
    sizes = sorted({r["m"] for r in bands.select("m").distinct().collect()})
    side = F.broadcast(bands) if len(templates) * BANDS <= MAX_BANDS else bands
    guards = guard_words(templates)
    low = ascii_lower(F.col("text"))
    held = F.lit(False)
    for g in guards:
        held = held | F.contains(F.col("low"), F.lit(g))
    # arrays go through explode(array(x)), a barrier: the optimiser would else repeat them inside later lambdas
    words = (
        docs.select("doc_id", "text", low.alias("low"))
        .filter(held)
        .select("doc_id", text_key(F.col("text")).alias("th"), F.explode(F.array(words_of(F.col("text")))).alias("words"))
    )
    near = F.filter(F.transform("words", lambda w, i: F.when(w.isin(guards), i)), lambda i: i.isNotNull())
    ready = words.select("doc_id", "th", F.explode(F.array(F.struct(shingles(F.col("words")).alias("h"), near.alias("near")))).alias("d"))
    ready = ready.select("doc_id", "th", "d.h", "d.near").filter((F.size("near") > 0) & (F.size("h") > 0))
    # a text with fewer shingles than CONTAINMENT % of m holds no such template
    fits = F.filter(F.array(*[F.lit(m) for m in sizes]), lambda m: F.size("h") * 100 >= m * CONTAINMENT)
    keyed = (
        ready.select("doc_id", "th", "h", "near", F.explode(fits).alias("m"))
        .select("doc_id", "th", F.explode(_windows(F.col("m"))).alias("w"))
        .select("doc_id", "th", "w.m", "w.first", F.col("w.own").alias("inside"))
        .filter(F.size("inside") > 0)
        .select("doc_id", "th", "m", "first", "inside", F.posexplode(_signature(F.col("inside"))).alias("band", "hash"))
    )
    shared = F.size(F.array_intersect("inside", "own"))
    return (
        keyed.join(side, ["m", "band", "hash"])
        .withColumn("shared", shared)
        .filter(F.col("shared") * 100 >= F.col("m") * CONTAINMENT)
        .filter((F.size("keys") == 0) | F.arrays_overlap("inside", "keys"))
        .withColumn("license", F.substring_index("license", "#", 1))
        .withColumn("best", F.struct((F.col("shared") / F.col("m")).alias("rate"), "shared", "m"))
        .groupBy("doc_id", "th", "license")
        .agg(F.min("first").alias("first"), F.max("best").alias("best"))
        .select("doc_id", "th", "license", "first", "best.shared", "best.m")
    )


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses of every document: their number, sorted names and the best containment of each."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = (
        scan(docs)
        .groupBy("doc_id", "th")
        .agg(
            F.sort_array(
                F.collect_list(F.struct("license", F.round(F.col("shared") / F.col("m"), 3).alias("containment")))
            ).alias("found")
        )
        .alias("b")
    )
    base = docs.select("doc_id", text_key(F.col("text")).alias("th")).alias("a")
    joined = base.join(found, same((F.col("a.doc_id"), F.col("b.doc_id")), (F.col("a.th"), F.col("b.th"))), "left")
    return joined.select(
        F.col("a.doc_id").alias("doc_id"),
        F.coalesce(F.size("b.found"), F.lit(0)).cast("long").alias("n_licenses"),
        F.coalesce(F.array_join("b.found.license", ","), F.lit("")).alias("licenses"),
        F.coalesce(F.array_join(F.transform("b.found.containment", lambda x: x.cast("string")), ","), F.lit("")).alias(
            "containments"
        ),
    )
