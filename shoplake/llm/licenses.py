"""License scan: MinHash bands over overlapping text windows find templates, exact shingle containment verifies.

Words are lower-cased and stripped of punctuation; shingles have five words.
For a template of t distinct shingles a text is cut into windows of 2t
shingles that start every t shingles, so any t consecutive shingles lie whole
in some window.  Windows and template are compared by ``BANDS`` MinHash bands
of one row: a window is a candidate when one band agrees.  A window that holds
80 % of a template has Jaccard similarity 0.8t / 2.2t > 0.36 at least, so a
band agrees with probability 1 - 0.64^24 > 0.9999.  A candidate is reported
when it holds at least ``CONTAINMENT`` of the template's shingles, counted exactly.

A band of a window can agree with a template's only where the window holds the
template's minimum shingle of that band.  So only windows around such shingles
get a signature; the others cannot agree in any band.

Scale: DataFrame functions only.  The template side is a parameter of a few
dozen texts and its band minima are at most ``BANDS`` rows per template, so it
is broadcast, with a check of its row count and a shuffled join beyond it.  Text is
exploded within its scan task; only candidate windows move.

Edge cases: null and empty texts and templates of fewer than five words match
nothing; repeated rows give one result row per (doc_id, license_id); equal
templates are all reported; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import normal_words, text_of, word_hashes

SHINGLE = 5
BANDS = 24
CONTAINMENT = 0.8
BROADCAST_SEEDS = 100_000
# FIXED VALUES: notices of public licences: statement lines, names, standard header paragraphs and licence bodies.
# They are worded so that under ``CONTAINMENT`` of a template's shingles occur in the templates of any one other
# licence (tests/llm checks it), so a notice of that licence alone is not enough to report the template.  GPL, LGPL and BSD are families,
# reported beside the version when the text names it.
_CC = (("CC-BY", "Attribution"), ("CC-BY-SA", "Attribution-ShareAlike"), ("CC-BY-NC", "Attribution-NonCommercial"),
       ("CC-BY-ND", "Attribution-NoDerivatives"), ("CC-BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
       ("CC-BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"))
_GNU = (("GPL-2.0", "", "2"), ("GPL-3.0", "", "3"), ("LGPL-2.1", "Lesser ", "2.1"), ("LGPL-3.0", "Lesser ", "3"),
        ("AGPL-3.0", "Affero ", "3"))
_USES = ("licensed under", "distributed under", "available under", "provided under", "published under", "terms of",
         "covered by", "subject to")
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the "
                   "License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-3.0", "GNU General Public License, version 3"),
    ("GPL-2.0", "GNU General Public License, version 2"),
    ("GPL", "modify it under the terms of the GNU General Public License"),
    ("LGPL", "Licensed under the GNU Lesser General Public License"),
    ("AGPL-3.0", "GNU Affero General Public License, version 3"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    *(("MIT", f"{use} the MIT License") for use in _USES),
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial "
            "portions of the Software"),
    ("Apache-2.0", "Apache License, Version 2.0"),
    ("Apache-2.0", "the Apache License 2.0"),
    ("Apache-2.0", "the Apache 2.0 License"),
    ("Apache-2.0", "the Apache License v2.0"),
    ("BSD-3-Clause", "the BSD 3-Clause License"),
    ("BSD-3-Clause", "the 3-Clause BSD License"),
    ("BSD-3-Clause", "may be used to endorse or promote products derived from this software without specific prior "
                     "written permission"),
    ("BSD-2-Clause", "the BSD 2-Clause License"),
    ("BSD-2-Clause", "the 2-Clause BSD License"),
    ("BSD-2-Clause", "materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS "
                     "AND CONTRIBUTORS"),
    ("0BSD", "for any purpose with or without fee is hereby granted. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR "
             "DISCLAIMS"),
    *(("ISC", f"{use} the ISC License") for use in ("released under", *_USES)),
    ("MPL-2.0", "Mozilla Public License, version 2.0"),
    ("MPL-2.0", "Mozilla Public License, v. 2.0"),
    ("MPL-2.0", "Mozilla Public License 2.0"),
    ("MPL-2.0", "the Mozilla Public License v2.0"),
    ("EPL-2.0", "Eclipse Public License, version 2.0"),
    ("EPL-2.0", "Eclipse Public License 2.0"),
    ("EPL-2.0", "Eclipse Public License - v 2.0"),
    ("EPL-2.0", "the Eclipse Public License v2.0"),
    ("LGPL", "the terms of the GNU Lesser General Public License"),
    *((name, f"GNU {kind}General Public License, version {v}") for name, kind, v in _GNU if name.startswith("L")),
    *((name, f"GNU {kind}General Public License v{v}") for name, kind, v in _GNU),
    *((name, f"version {v} of the GNU {kind}General Public License") for name, kind, v in _GNU),
    *((name, f"the terms of the GNU {kind}General Public License as published by the Free Software Foundation, "
             f"either version {v} of the License") for name, kind, v in _GNU),
    *((f"{name}-{v}", f"Creative Commons {words} {v} {place}") for name, words in _CC
      for v, place in (("4.0", "International"), ("3.0", "Unported"))),
    *((f"{name}-{v}", f"{use} {name.replace('-', ' ')} {v}") for name, _ in _CC for v in ("4.0", "3.0")
      for use in (("under", "under a", "under the") if name == "CC-BY" else ("",))),
    *((f"{name}-{v}", f"creativecommons.org/licenses/{name[3:].lower()}/{v}") for name, _ in _CC for v in ("4.0", "3.0")),
    ("CC0-1.0", "Creative Commons CC0 1.0 Universal"),
    ("CC0-1.0", "CC0 1.0 Universal Public Domain Dedication"),
    ("CC0-1.0", "creativecommons.org/publicdomain/zero/1.0"),
    *((name, f"SPDX-License-Identifier: {name}") for name in (
        "Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0", "BSD-2-Clause", "BSD-3-Clause", "MPL-2.0",
        "EPL-2.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC0-1.0")),
)


def template_table(spark: SparkSession, templates: tuple = TEMPLATES) -> DataFrame:
    """(template_id, license_id, text) rows of the built-in notices."""
    rows = [F.struct(F.lit(i).alias("template_id"), F.lit(name).alias("license_id"), F.lit(text).alias("text"))
            for i, (name, text) in enumerate(templates)]
    return spark.range(1).select(F.inline(F.array(*rows)))


def _shingles(wh: Column, size: int) -> Column:
    """Hashes of all runs of ``size`` words of an array of word hashes; empty when there are fewer words."""
    n = F.size(wh)
    return F.when(n >= size, F.transform(F.sequence(F.lit(1), n - size + 1), lambda i: F.xxhash64(
        *[F.element_at(wh, i + k) for k in range(size)]))).otherwise(F.array().cast("array<bigint>"))


def _signature(shingles: Column, bands: int) -> Column:
    """Per band the shingle of least hash, as (hash, shingle)."""
    def least(band: int) -> Column:
        return F.array_min(F.transform(shingles, lambda h: F.struct(
            F.xxhash64(h, F.lit(band)).alias("rank"), h.alias("shingle"))))
    return F.array(*[least(b) for b in range(bands)])


def scan_licenses(docs: DataFrame, templates: DataFrame, shingle: int = SHINGLE, bands: int = BANDS,
                  containment: float = CONTAINMENT, broadcast_seeds: int = BROADCAST_SEEDS) -> DataFrame:
    """One row per (document, licence): doc_id, license_id, containment, template_id, bands, start_word, n_windows."""
    t = (templates.select("template_id", "license_id", F.array_distinct(
            _shingles(word_hashes(normal_words(text_of("text"))), shingle)).alias("shingles"))
         .filter(F.size("shingles") > 0)
         .withColumn("step", F.size("shingles"))
         .withColumn("signature", F.transform(_signature(F.col("shingles"), bands), lambda x: x["shingle"])))
    seeds = t.select("template_id", "step", F.explode(F.array_distinct("signature")).alias("shingle"))
    if seeds.count() <= broadcast_seeds:
        seeds, t = F.broadcast(seeds), F.broadcast(t)
    text = docs.select("doc_id", word_hashes(normal_words(text_of("text"))).alias("wh"))
    spots = text.select("doc_id", "wh", F.explode(F.when(
        F.size("wh") >= shingle, F.sequence(F.lit(0), F.size("wh") - shingle))).alias("pos")).select(
        "doc_id", "wh", "pos", F.xxhash64(*[F.get("wh", F.col("pos") + k) for k in range(shingle)]).alias("shingle"))
    hits = spots.join(seeds, "shingle")
    # the windows of 2 * step shingles, every step shingles, that hold the position
    k = F.floor(F.col("pos") / F.col("step")).cast("int")
    windows = hits.select("doc_id", "template_id", "step", "wh", F.explode(
        F.array_distinct(F.array(k, F.greatest(k - 1, F.lit(0))))).alias("k")).select(
        "doc_id", "template_id", (F.col("k") * F.col("step")).alias("start_word"),
        F.slice("wh", F.col("k") * F.col("step") + 1, 2 * F.col("step") + shingle - 1).alias("wh")).distinct()
    near = (windows.join(t.drop("step"), "template_id")
            .withColumn("own", F.array_distinct(_shingles(F.col("wh"), shingle)))
            .withColumn("window_signature", F.transform(_signature(F.col("own"), bands), lambda x: x["shingle"]))
            .withColumn("agree", F.size(F.filter(F.arrays_zip("signature", "window_signature"),
                                                 lambda z: z["signature"] == z["window_signature"])))
            .filter("agree > 0")
            .withColumn("share", F.size(F.array_intersect("own", "shingles")) / F.size("shingles"))
            .filter(F.col("share") >= containment))
    return (near.groupBy("doc_id", "license_id").agg(
                F.max(F.struct("share", (-F.col("template_id")).alias("t"), (-F.col("start_word")).alias("s"),
                               "agree")).alias("b"), F.count("*").alias("n_windows"))
            .select("doc_id", "license_id", F.col("b.share").alias("containment"),
                    (-F.col("b.t")).alias("template_id"), F.col("b.agree").alias("bands"),
                    (-F.col("b.s")).alias("start_word"), "n_windows"))
