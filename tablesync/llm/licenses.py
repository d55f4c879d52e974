"""License scans: sparse TF-IDF cosine to templates, then inheritance from the nearest licensed directory.

Every line of a file and every run of consecutive lines up to ``WINDOW_WORDS`` words (lines without words, such as bare
comment marks, aside) is a possible header, and the whole file a possible license file; each is compared with
every template by the cosine of TF-IDF vectors, where document frequencies of the templates' words are those of all
files. Only units that hold a word from the templates' cue words can reach the threshold with a template's wording, so
only these are compared, within the task that reads the file. A file whose name marks it as license file gives its license to its directory; any file
without a license of its own takes that of the nearest ancestor directory that has one, by joins on paths.

Defined results: a null or empty text has no license of its own; a null path stands outside all directories;
of equal scores the smaller license name counts; a directory with several license files takes the best
score, then the smaller name; repeated rows get equal results; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stash

# Notices, standard headers and openings of license texts by SPDX identifier.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction.',
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.',
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. <https://fsf.org/> Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed.",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 2 of the License, or (at your option) any later version.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation.",
        "GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1989, 1991 Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed.",
    ],
    "LGPL-3.0": [
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. <https://fsf.org/> Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed.",
    ],
    "LGPL-2.1": [
        "This work is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 2.1 of the License, or (at your option) any later version.",
        "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999 Copyright (C) 1991, 1999 Free Software Foundation, Inc. 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed.",
    ],
    "AGPL-3.0": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007 Copyright (C) 2007 Free Software Foundation, Inc. <https://fsf.org/> Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed.",
    ],
    "BSD-3-Clause": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.", "Licensed under the BSD 3-Clause License."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0.", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under the Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0."],
    "CC0-1.0": ["To the extent possible under law, the author has waived all copyright. Licensed under CC0 1.0."],
}
for _name, _texts in TEMPLATES.items():  # tags; GNU licenses have two more forms
    _texts.extend(f"SPDX-License-Identifier: {_name}{end}" for end in (("", "-only", "-or-later") if "GPL" in _name else ("",)))
CUES = ["licensed", "license", "licence", "released", "permission", "redistribution", "redistribute", "spdx", "waived", "copyright"]
FILE_NAMES = ["license", "licence", "copying", "unlicense"]
WINDOW_WORDS = 200  # of a run of lines; more than the longest template

_WORD = r"[\p{L}\p{N}]+(?:[.-][\p{L}\p{N}]+)*"


def words_of(text: Column) -> Column:
    """Lower-cased words; numbers keep their dots, ``by-nc`` its hyphen."""
    return F.regexp_extract_all(F.lower(text), F.lit(_WORD), F.lit(0))


def template_weights(docs: DataFrame) -> tuple[dict[str, float], float, list[tuple[str, dict[str, float]]]]:
    """(idf of the templates' words, idf of a word that no file holds, unit vectors of the templates).

    Document frequencies are counted over all files, of the templates' words only: as many numbers as those have words.
    """
    spark = docs.sparkSession
    notices = [(name, text) for name, texts in TEMPLATES.items() for text in texts]
    rows = spark.createDataFrame(notices, "name string, text string").select("name", words_of(F.col("text")).alias("words")).collect()
    bags = [(r["name"], Counter(r["words"])) for r in rows]
    vocabulary = sorted({w for _, bag in bags for w in bag})
    # a file counts once per word: words of its text that are template words
    held = F.array_intersect(words_of(F.coalesce("text", F.lit(""))), F.array(*map(F.lit, vocabulary)))
    counted = docs.select(F.explode(held).alias("word")).groupBy("word").agg(F.count("*").alias("df")).collect()
    total = docs.count()
    df = {r["word"]: r["df"] for r in counted}
    idf = lambda n: math.log((total + 1) / (n + 1)) + 1
    weights = {w: idf(df.get(w, 0)) for w in vocabulary}
    vectors = []
    for name, bag in bags:
        norm = math.sqrt(sum((n * weights[w]) ** 2 for w, n in bag.items()))
        vectors.append((name, {w: n * weights[w] / norm for w, n in sorted(bag.items())}))
    return weights, idf(0), vectors


class Matcher:
    """Scores of the templates in the units of one file."""

    def __init__(self, weights: dict[str, float], rare: float, vectors: list[tuple[str, dict[str, float]]]):
        # a word outside the templates weighs as the rarest one: its frequency needs no count of all words,
        # and foreign words in a unit lower the cosine as much as they can
        self.names, self.rare = [name for name, _ in vectors], rare
        self.words = {w: (x, x * np.array([v.get(w, 0.0) for _, v in vectors])) for w, x in weights.items()}

    def units(self, lines: list[list[str]], cued: list[bool]):
        """Dot products with the templates and squared length of the lines, runs of lines and the whole file."""
        words = [len(x) for x in lines]
        before = np.concatenate([[0], np.cumsum(words)])
        cues = np.flatnonzero(cued)
        for start in range(len(lines)):
            at = int(np.searchsorted(cues, start))
            if at == len(cues):
                break
            if cues[at] > start and before[cues[at] + 1] - before[start] > WINDOW_WORDS:
                continue  # no run from here reaches a cue word
            yield from self.runs(lines, start, int(cues[at]), lambda end: before[end + 1] - before[start] <= WINDOW_WORDS)
        if len(lines) > 1:
            yield from self.runs(lines, 0, len(lines) - 1, lambda end: True)

    def runs(self, lines, start, first, fits):
        """The runs from ``start`` that end with line ``first`` or a later one, as long as they fit."""
        counts, dots, square = Counter(), np.zeros(len(self.names)), 0.0
        for end in range(start, len(lines)):
            if end > start and not fits(end):
                return
            for word in lines[end]:
                known = self.words.get(word)
                weight = self.rare if known is None else known[0]
                square += (2 * counts[word] + 1) * weight * weight
                counts[word] += 1
                if known is not None:
                    dots += known[1]
            if end >= first:
                yield dots, square

    def best(self, lines: list[list[str]], cued: list[bool]) -> tuple[str | None, float]:
        """The license of the best unit, the smaller name of equal ones, and its score."""
        keep = [k for k, line in enumerate(lines) if line]
        top = np.zeros(len(self.names))
        for dots, square in self.units([lines[k] for k in keep], [cued[k] for k in keep]):
            np.maximum(top, dots / math.sqrt(square), out=top)
        score, name = min((-round(float(x), 9), name) for x, name in zip(top, self.names))
        return name, -score


def own_licenses(docs: DataFrame, threshold: float) -> DataFrame:
    """(file, license, score) of the files whose best unit reaches ``threshold``; ``file`` identifies the row's text."""
    matcher = docs.sparkSession.sparkContext.broadcast(Matcher(*template_weights(docs)))
    cue = r"(?i)(?<!\p{L})(?:" + "|".join(CUES) + r")(?!\p{L})"
    held = docs.where(F.col("text").rlike(cue)).select("file", "text").distinct()
    lines = F.split("text", r"\r?\n|\r")
    held = held.select("file", F.transform(lines, words_of).alias("lines"), F.transform(lines, lambda line: line.rlike(cue)).alias("cued"))

    def match(batches):
        for batch in batches:
            files, names, scores = [], [], []
            for k in range(batch.num_rows):  # one file as Python words at a time
                name, score = matcher.value.best(batch.column("lines")[k].as_py(), batch.column("cued")[k].as_py())
                if score >= threshold:
                    files.append(batch.column("file")[k].as_py())
                    names.append(name)
                    scores.append(score)
            columns = [pa.array(files, pa.int64()), pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["file", "license", "score"])

    return held.mapInArrow(match, "file long, license string, score double")


def directory(path: Column) -> Column:
    """The path without its last part; "" at the top."""
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def scan_licenses(docs: DataFrame, threshold: float = 0.75) -> DataFrame:
    """``docs`` (doc_id, path, text) as (doc_id, path, own_license, score, license, inherited_from).

    ``license`` is the file's own, else that of ``inherited_from``, the nearest ancestor directory with a license file.
    """
    docs = docs.select("doc_id", "path", "text").withColumn("file", F.xxhash64("text"))
    own = stash(own_licenses(docs.select("file", "text"), threshold), "own-licenses").withColumnRenamed("license", "own_license")
    files = stash(docs.drop("text").join(own, "file", "left").drop("file"), "files")
    name = F.lower(F.regexp_replace(F.regexp_extract("path", r"([^/]*)$", 1), r"\.[^.]*$", ""))
    given = files.where(F.col("own_license").isNotNull() & name.isin(FILE_NAMES)).groupBy(directory(F.col("path")).alias("dir"))
    given = given.agg(F.min_by("own_license", F.struct(-F.col("score"), F.col("own_license"))).alias("dir_license"))
    # every directory once, joined with each of its ancestors
    dirs = files.where("path is not null").select(directory(F.col("path")).alias("own_dir")).distinct()
    parts = F.split("own_dir", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
    ancestors = dirs.select("own_dir", F.explode(F.array_distinct(above)).alias("dir"))
    nearest = ancestors.join(given, "dir").groupBy("own_dir").agg(F.max_by(F.struct("dir", "dir_license"), F.length("dir")).alias("near"))
    out = files.withColumn("own_dir", directory(F.col("path"))).join(nearest, "own_dir", "left")
    inherited = F.col("own_license").isNull() & F.col("near").isNotNull()
    return out.select(
        "doc_id",
        "path",
        "own_license",
        "score",
        F.when(inherited, F.col("near.dir_license")).otherwise(F.col("own_license")).alias("license"),
        F.when(inherited, F.col("near.dir")).alias("inherited_from"),
    )
