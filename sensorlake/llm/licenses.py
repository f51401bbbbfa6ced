"""Licence scans: normalised texts against licence templates by the Dice coefficient over distinct word bigrams.

A text and a template with m and n bigrams cannot score above 2 * min(m, n) / (m + n), so sizes alone rule templates out. Every
window as long as the template counts, beside the whole text, so a licence inside a longer text is found wherever it stands; windows
that hold too few bigrams of the template to reach the threshold are left out before they are scored.
Everything is an expression over one row: templates are a short list of constants, so nothing is joined or shuffled.

Defined results: a null or empty text, or one word, has no bigrams and no licence; of equal scores the first template in order of
name wins; repeated rows are scanned one by one.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake.llm.shared import ascii_lower, table

THRESHOLD = 0.8

# Notices by which files and documents state their licence.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met"
    ),
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "GPL-2.0-or-later": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version"
    ),
    "GPL-3.0-or-later": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"
    ),
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        "(the Software), to deal in the Software without restriction"
    ),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    # Short notices, one line that names the licence. Windows find them behind other words ('This work is licensed ...').
    "AGPL-3.0-short": "Licensed under the GNU Affero General Public License, version 3",
    "Apache-2.0-short": "Licensed under the Apache License 2.0",
    "BSD-2-Clause-short": "Licensed under the BSD 2-Clause License",
    "BSD-2-Clause-released": "Released under the BSD 2-Clause License",
    "BSD-3-Clause-short": "Licensed under the BSD 3-Clause License",
    "BSD-3-Clause-released": "Released under the BSD 3-Clause License",
    "CC-BY-4.0-short": "Licensed under CC BY 4.0",
    "CC-BY-NC-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    "CC-BY-NC-4.0-short": "Licensed under CC BY-NC 4.0",
    "CC-BY-NC-ND-4.0-short": "Licensed under CC BY-NC-ND 4.0",
    "CC-BY-NC-SA-4.0-short": "Licensed under CC BY-NC-SA 4.0",
    "CC-BY-ND-4.0-short": "Licensed under CC BY-ND 4.0",
    "CC-BY-SA-4.0-short": "Licensed under CC BY-SA 4.0",
    "GPL-2.0-short": "Licensed under the GNU General Public License, version 2",
    "GPL-3.0-short": "Licensed under the GNU General Public License, version 3",
    "ISC-short": "Licensed under the ISC License",
    "ISC-released": "Released under the ISC License",
    "LGPL-2.1-short": "Licensed under the GNU Lesser General Public License, version 2.1",
    "LGPL-3.0-short": "Licensed under the GNU Lesser General Public License, version 3",
    "MIT-short": "Licensed under the MIT License",
    "MIT-released": "Released under the MIT License",
    "MPL-2.0-short": "Licensed under the Mozilla Public License 2.0",
}


def template_words(text: str) -> list[str]:
    return re.findall(r"[a-z0-9]+", text.lower())


def template_bigrams(text: str) -> list[str]:
    words = template_words(text)
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def bigrams(words: Column) -> Column:
    """Bigrams in order; `words` has to be a column, which is read per element."""
    pairs = F.transform(words, lambda w, i: F.concat_ws(" ", w, F.get(words, i + 1)))
    return F.slice(pairs, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0)))


def _once(value: Column, use) -> Column:
    """``use`` of a value that is worked out once, also where it is read per element."""
    return F.get(F.transform(F.array(value), use), 0)


def _dice(found: Column, size: Column, wanted: Column) -> Column:
    """Dice of a list of bigrams with a template, or 0 where sizes rule it out."""
    have = F.size(F.array_distinct(found))
    bound = 2.0 * F.least(have, size) / (have + size)
    return F.when(bound >= THRESHOLD, 2.0 * F.size(F.array_intersect(found, wanted)) / (have + size)).otherwise(0.0)


def _template(name: str, text: str) -> Column:
    """A template as a constant: its bigrams, its length in bigrams, and how many of them a text has to share to reach the threshold."""
    grams = template_bigrams(text)
    need = math.ceil(THRESHOLD * len(grams) / (2 - THRESHOLD) - 1e-9)
    return F.struct(
        F.lit(name).alias("name"), F.array(*[F.lit(g) for g in grams]).alias("grams"), F.lit(len(grams)).alias("size"),
        F.lit(len(template_words(text)) - 1).alias("length"), F.lit(need).alias("need"),
    )


def _starts(pairs: Column, t: Column, hits: Column) -> Column:
    """All starts of windows that hold enough bigrams of the template; any other window is below the threshold. ``hits``: their places."""
    last = F.greatest(F.size(pairs) - t["length"], F.lit(0))

    def around(first: Column, j: Column) -> Column:
        end = F.get(hits, j + t["need"] - 1)
        starts = F.sequence(F.greatest(end - t["length"] + 1, F.lit(0)), F.least(first, last))
        return F.when(end - first < t["length"], starts).otherwise(F.array().cast("array<int>"))

    return F.array_distinct(F.flatten(F.transform(hits, around)))


def _best(pairs: Column, t: Column) -> Column:
    """The best score of the whole text and of its windows with template ``t``."""
    places = F.filter(F.sequence(F.lit(0), F.size(pairs) - 1), lambda i: F.array_contains(t["grams"], F.get(pairs, i)))
    starts = _once(places, lambda hits: _starts(pairs, t, hits))
    windows = F.transform(starts, lambda start: _dice(F.slice(pairs, start + 1, t["length"]), t["size"], t["grams"]))
    return F.greatest(F.array_max(windows), _dice(pairs, t["size"], t["grams"]))


def scan(docs: DataFrame, text: str = "text", templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """Add ``licenses``: (name, score) of every template that the text, or a window of it, reaches with ``THRESHOLD``."""
    known = F.array(*[_template(name, templates[name]) for name in sorted(templates)])
    grams = F.array(*[F.lit(g) for g in sorted({g for t in templates.values() for g in template_bigrams(t)})])

    def reached(pairs: Column, seen: Column) -> Column:
        # A window can only reach the threshold if the text shares enough bigrams with the template at all: most texts stop here.
        near = F.filter(known, lambda t: F.size(F.array_intersect(seen, t["grams"])) >= t["need"])
        hits = F.transform(near, lambda t: F.struct(t["name"].alias("name"), F.round(_best(pairs, t), 6).alias("score")))
        return F.filter(hits, lambda h: h["score"] >= THRESHOLD)

    words = F.filter(F.split(ascii_lower(F.coalesce(F.col(text), F.lit(""))), "[^a-z0-9]+"), lambda w: w != "")
    found = _once(_once(words, bigrams), lambda pairs: _once(F.array_intersect(pairs, grams), lambda seen: reached(pairs, seen)))
    return docs.select(*[F.col(f"`{c}`") for c in docs.columns], found.alias("licenses"))


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document its best licence (null: none), that score, and all licences found."""
    out = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    best = F.array_max(F.transform("licenses", lambda h: F.struct(h["score"].alias("score"), F.lit(0).alias("order"))))
    top = F.get(F.filter("licenses", lambda h: h["score"] == best["score"]), 0)
    names = F.array_join(F.transform("licenses", lambda h: h["name"]), ",")
    return out.select("doc_id", top["name"].alias("license"), F.coalesce(top["score"], F.lit(0.0)).alias("score"), names.alias("licenses"))
