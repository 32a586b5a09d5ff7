"""License scans: TF-IDF cosine to templates, then inheritance down the directory tree.

A text that speaks of a license is looked at as one sequence of words, so that neither line breaks
nor comment marks matter. Where a word stands that is rare among the templates, a window is
laid over the words as the template lies around it, of the template's own length. Each window, and
the whole text, which tells licence files from files with a header, is a sparse vector over its
words, weighted by how rare a word is among the templates, and is held against every template by the
cosine. Of the templates from ``SURE`` on the best one names the license; a long template counts for
a little more, since more words agree.
A file whose whole text is such a template, or whose name says so, licenses its directory; files
without a license of their own inherit that of the nearest directory above them.

Template vectors are made from the constants below, so the table that is broadcast is as small
as they are. Ancestors are joined per directory, not per file.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import settle
from tillroll.llm.simhash import text_hash

SURE = 0.75
#: From here on a whole text is nothing but a license.
FILE_SURE = 0.95
#: Rarest words of a template by which windows are laid over a text.
ANCHORS = 2
CUE = r"(?i)licen[cs]e|copyright|spdx|permission\s|redistribution|public\s+domain|cc0|cc by|cc-by"
LICENCE_NAME = r"(?i)(^|/)(licen[cs]e|copying|unlicense)([._-][a-z0-9.-]+)?$"
_WORD = r"[a-z]+|[0-9]+(?:\.[0-9]+)*"

#: Short notices as the licenses themselves propose or commonly appear, by SPDX id.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file "
        "except in compliance with the License. You may obtain a copy of the License at",
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the Software), to deal in the Software "
        "without restriction",
    ),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
    ),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Released under CC0 1.0 Universal, dedicated to the public domain."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("ISC", "Released under the ISC License."),
    ("ISC", "Licensed under the ISC License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted",
    ),
    (
        "BSD-3-Clause",
        "Use of this source code is governed by a BSD-style license that can be found in the "
        "LICENSE file.",
    ),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met",
    ),
    (
        "BSD-3-Clause",
        "may be used to endorse or promote products derived from this software without specific "
        "prior written permission",
    ),
    (
        "GPL-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation; either "
        "version 2 of the License, or (at your option) any later version.",
    ),
    # Without the lines around it, this does not say which version.
    ("GPL", "it under the terms of the GNU General Public License as published by"),
]
TEMPLATES += [(spdx, f"SPDX-License-Identifier: {spdx}") for spdx in dict.fromkeys(name for name, _ in TEMPLATES)]


def template_vectors() -> tuple[list[tuple[int, str, str, float]], dict[str, float], float]:
    """Unit vectors of the templates as rows, the weight of each known word, that of others."""
    counts = [Counter(re.findall(_WORD, text.lower())) for _, text in TEMPLATES]
    seen = Counter(word for count in counts for word in count)
    n = len(TEMPLATES)
    rarity = {word: math.log((1 + n) / (1 + df)) + 1 for word, df in seen.items()}
    rows = []
    for place, ((spdx, _), count) in enumerate(zip(TEMPLATES, counts)):
        length = math.sqrt(sum((tf * rarity[word]) ** 2 for word, tf in count.items()))
        rows += [(place, spdx, word, tf * rarity[word] / length) for word, tf in sorted(count.items())]
    return rows, rarity, math.log(1 + n) + 1


def template_anchors() -> dict[str, list[tuple[int, int]]]:
    """For each anchor word the places it has in a template and the template's length."""
    _, rarity, _ = template_vectors()
    out: dict[str, set[tuple[int, int]]] = {}
    for _, text in TEMPLATES:
        words = re.findall(_WORD, text.lower())
        rarest = sorted(dict.fromkeys(words), key=lambda word: -rarity[word])[:ANCHORS]
        for word in rarest:
            out.setdefault(word, set()).add((words.index(word), len(words)))
    return {word: sorted(places) for word, places in sorted(out.items())}


def template_lengths() -> list[int]:
    return [len(re.findall(_WORD, text.lower())) for _, text in TEMPLATES]


def _words(text: F.Column) -> F.Column:
    return F.regexp_extract_all(F.lower(text), F.lit(_WORD), F.lit(0))


def _parts(files: DataFrame) -> DataFrame:
    """``file, part, whole, words`` of the texts with a cue: windows laid at their anchors, and themselves."""
    cued = files.filter(F.col("text").rlike(CUE)).select("file", _words(F.col("text")).alias("words"))
    anchors = F.create_map(
        *[
            entry
            for word, places in template_anchors().items()
            for entry in (
                F.lit(word),
                F.array(*[F.struct(F.lit(at).alias("at"), F.lit(size).alias("size")) for at, size in places]),
            )
        ]
    )

    def laid(word: F.Column, place: F.Column) -> F.Column:
        return F.transform(
            F.coalesce(F.try_element_at(anchors, word), F.array().cast("array<struct<at:int,size:int>>")),
            lambda a: F.struct(F.greatest(place - a["at"], F.lit(0)).alias("start"), a["size"].alias("size")),
        )

    windows = cued.select("file", "words", F.explode(F.array_distinct(F.flatten(F.transform("words", laid)))).alias("w"))
    windows = windows.select(
        "file",
        F.concat_ws(":", "w.start", "w.size").alias("part"),
        F.lit(False).alias("whole"),
        F.slice("words", F.col("w.start") + 1, F.col("w.size")).alias("words"),
    )
    return windows.union(cued.select("file", F.lit("whole").alias("part"), F.lit(True).alias("whole"), "words"))


def best_templates(files: DataFrame) -> DataFrame:
    """``file, whole, spdx, score``: for lines and for whole texts the best template from ``SURE`` on."""
    spark = files.sparkSession
    rows, rarity, other = template_vectors()
    vectors = spark.createDataFrame(rows, "template int, spdx string, word string, weight double")
    known = spark.createDataFrame(sorted(rarity.items()), "known string, rarity double")
    words = _parts(files).select("file", "part", "whole", F.explode("words").alias("term"))
    counted = words.groupBy("file", "part", "whole", "term").agg(F.count(F.lit(1)).alias("tf"))
    weighed = counted.join(F.broadcast(known), F.col("term") == F.col("known"), "left").withColumn(
        "w", F.col("tf") * F.coalesce("rarity", F.lit(other))
    )
    dots = F.collect_list(F.when(F.col("known").isNotNull(), F.struct("term", "w"))).alias("terms")
    parts = weighed.groupBy("file", "part", "whole").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"), dots)
    terms = parts.select("file", "part", "whole", "norm", F.explode("terms").alias("t"))
    scored = (
        terms.join(F.broadcast(vectors), F.col("t.term") == F.col("word"))
        .groupBy("file", "part", "whole", "template", "spdx")
        .agg((F.sum(F.col("t.w") * F.col("weight")) / F.first("norm")).alias("score"))
        .filter(F.col("score") >= SURE)
    )
    lengths = F.array(*[F.lit(n) for n in template_lengths()])
    rank = F.col("score") * (1 - 1 / (lengths[F.col("template")] + 2.0))
    # Sums of equal terms may differ in the last digits.
    best = F.max(
        F.struct(F.round(rank, 9).alias("rank"), (-F.col("template")).alias("earlier"), "spdx", "score")
    ).alias("best")
    return scored.groupBy("file", "whole").agg(best).select("file", "whole", "best.spdx", "best.score", "best.rank")


def _ancestors(directory: F.Column) -> F.Column:
    """The directory and all above it, up to the root ''."""
    names = F.filter(F.split(directory, "/"), lambda name: name != "")
    upto = F.sequence(F.lit(0), F.size(names))
    return F.transform(upto, lambda n: F.array_join(F.slice(names, F.lit(1), n), "/"))


def inherited(directories: DataFrame, licensed: DataFrame) -> DataFrame:
    """``directory, spdx``: the license of the nearest licensed directory at or above each one.

    ``licensed`` has columns home, spdx; of several licenses of a directory the first by name counts.
    """
    homes = licensed.groupBy("home").agg(F.min("spdx").alias("spdx"))
    up = directories.select("directory", F.explode(_ancestors(F.col("directory"))).alias("above"))
    met = up.join(homes, up["above"] == homes["home"])
    nearest = F.max_by("spdx", F.length("above")).alias("inherited")
    return met.groupBy(F.col("directory").alias("below")).agg(nearest)


def license_scan(files: DataFrame, path: F.Column, id_col: str = "doc_id") -> DataFrame:
    """``doc_id, path, license, score, origin`` per row of ``files`` (texts in ``text``).

    Origin is ``file`` (the whole text is a license, or the name says so), ``header``,
    ``inherited`` or null where nothing licenses the row. A null or empty text has no license of
    its own but may inherit one; a null path lies in the root. Rows with equal path and text are
    scanned alike. An empty table gives no rows. Other columns are ignored.
    """
    named = files.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(path, F.lit("")).alias("path"),
        F.coalesce("text", F.lit("")).alias("text"),
        text_hash("text").alias("text_hash"),
    )
    file = F.struct("path", "text_hash").alias("file")
    found = settle(best_templates(named.select(file, "text")), "license-parts")
    score = F.struct("rank", "spdx", "score")
    own = settle(
        found.groupBy("file").agg(
            F.max(F.when(F.col("whole"), score)).alias("whole"),
            F.max(F.when(~F.col("whole"), score)).alias("header"),
        ).select(
            F.col("file.path").alias("own_path"), F.col("file.text_hash").alias("own_hash"),
            F.coalesce("whole", "header").alias("own"),
            (
                F.coalesce(F.col("whole.score") >= FILE_SURE, F.lit(False))
                | F.col("file.path").rlike(LICENCE_NAME)
            ).alias("is_file"),
        ),
        "licenses",
    )
    slim = named.select("doc_id", "path", "text_hash", _directory(F.col("path")).alias("directory"))
    homes = own.filter("is_file").select(_directory(F.col("own_path")).alias("home"), F.col("own.spdx").alias("spdx"))
    below = settle(inherited(slim.select("directory").distinct(), homes), "inherited-licenses")
    same = (slim["path"] == own["own_path"]) & (slim["text_hash"] == own["own_hash"])
    joined = slim.join(own, same, "left").join(below, F.col("directory") == F.col("below"), "left")
    return joined.select(
        "doc_id",
        "path",
        F.coalesce("own.spdx", "inherited").alias("license"),
        F.col("own.score").alias("score"),
        F.when(F.col("is_file"), "file")
        .when(F.col("own").isNotNull(), "header")
        .when(F.col("inherited").isNotNull(), "inherited")
        .alias("origin"),
    )


def _directory(path: F.Column) -> F.Column:
    """The part before the last slash, without slashes at its ends; '' is the root."""
    return F.regexp_replace(F.regexp_extract(path, r"^(.*)/[^/]*$", 1), r"^/+|/+$", "")


def scan_sql(table: str, path: str, places: int) -> str:
    """The rows of ``license_scan`` for DuckDB, with the score rounded to ``places``."""
    rows, rarity, other = template_vectors()
    vectors = ", ".join(f"({place}, '{spdx}', '{word}', {weight!r}::DOUBLE)" for place, spdx, word, weight in rows)
    known = ", ".join(f"('{word}', {value!r}::DOUBLE)" for word, value in sorted(rarity.items()))
    anchors = ", ".join(f"('{word}', {at}, {n})" for word, places in template_anchors().items() for at, n in places)
    sizes = ", ".join(f"({place}, {n})" for place, n in enumerate(template_lengths()))
    words = f"regexp_extract_all(lower({{0}}), '{_WORD}')".format
    below = f"regexp_replace(regexp_extract({{0}}, '^(.*)/[^/]*$', 1), '^/+|/+$', '', 'g')".format
    return f"""
WITH vectors(template, spdx, word, weight) AS (VALUES {vectors}),
known(word, rarity) AS (VALUES {known}),
anchors(word, place, size) AS (VALUES {anchors}),
sizes(template, size) AS (VALUES {sizes}),
named AS (
  SELECT doc_id, {path} AS path, coalesce(text, '') AS text, {below(path)} AS directory FROM {table}
),
cued AS (SELECT DISTINCT path, text FROM named WHERE regexp_matches(text, '{CUE}')),
worded AS (SELECT path, text, {words("text")} AS w FROM cued),
placed AS (
  SELECT DISTINCT path, text, greatest(i - 1 - a.place, 0) AS start, a.size
  FROM (SELECT path, text, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM worded) t
  JOIN anchors a USING (word)
),
parts AS (
  SELECT path, text, start || ':' || size AS part, false AS whole, list_slice(w, start + 1, start + size) AS w
  FROM placed JOIN worded USING (path, text)
  UNION ALL SELECT path, text, 'whole', true, w FROM worded
),
terms AS (
  SELECT path, text, part, whole, word, count(*) AS tf
  FROM (SELECT path, text, part, whole, unnest(w) AS word FROM parts) GROUP BY ALL
),
weighed AS (
  SELECT t.*, tf * coalesce(rarity, {other!r}::DOUBLE) AS w FROM terms t LEFT JOIN known USING (word)
),
norms AS (SELECT path, text, part, sqrt(sum(w * w)) AS norm FROM weighed GROUP BY ALL),
scored AS (
  SELECT path, text, whole, template, spdx, sum(w * weight) / any_value(norm) AS score
  FROM weighed JOIN norms USING (path, text, part) JOIN vectors USING (word)
  GROUP BY path, text, part, whole, template, spdx
  HAVING sum(w * weight) / any_value(norm) >= {SURE}
),
ranked AS (
  SELECT *, round(score * (1 - 1 / (size + 2.0)), 9) AS rank FROM scored JOIN sizes USING (template)
),
best AS (
  SELECT path, text, whole, max((rank, -template, spdx, score)) AS b FROM ranked GROUP BY ALL
),
best_parts AS (SELECT path, text, whole, b[1] AS rank, b[3] AS spdx, b[4] AS score FROM best),
own AS (
  SELECT path, text, coalesce(max(CASE WHEN whole THEN score END), max(score)) AS score,
    coalesce(max(CASE WHEN whole THEN spdx END), max(spdx)) AS spdx,
    coalesce(max(CASE WHEN whole THEN score END) >= {FILE_SURE}, false)
      OR regexp_matches(path, '{LICENCE_NAME}') AS is_file
  FROM best_parts GROUP BY path, text
),
homes AS (SELECT {below("path")} AS home, min(spdx) AS spdx FROM own WHERE is_file GROUP BY ALL),
inherited AS (
  SELECT directory, arg_max(spdx, length(home)) AS inherited
  FROM (SELECT DISTINCT directory FROM named) JOIN homes
    ON home = '' OR directory = home OR starts_with(directory, home || '/') GROUP BY ALL
)
SELECT doc_id, path, coalesce(spdx, inherited) AS license, round(score, {places}) AS score,
  CASE WHEN is_file THEN 'file' WHEN spdx IS NOT NULL THEN 'header'
       WHEN inherited IS NOT NULL THEN 'inherited' END AS origin
FROM named LEFT JOIN own USING (path, text) LEFT JOIN inherited USING (directory)
"""
