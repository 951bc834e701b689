"""Licences of files: TF-IDF cosine of headers and licence files to templates, then inheritance from directories.

1. Templates are notices and full texts of licences. Document frequencies of their words are counted over all files;
   a word of no template has the largest inverse frequency.
2. The units of a file are its whole text, each of its lines, and windows of each template's number of words along the
   whole text, an eighth of their length apart; comment marks aren't words, so a header is found over its lines, beside
   code and in the middle of a long line.
3. Products of a unit with a template are differences of running sums. The norm is at least that of words that don't
   repeat, so only units that reach the threshold with this norm get their exact one; nothing else is left out.
4. A file has the licence of its best unit. A file whose whole text is near a template is a licence file, and the
   template nearest to its whole text speaks for its directory; a file without a licence of its own takes that of the
   nearest directory above it, by a join of its parent paths with the licence files' directories.

Edge cases: null and empty texts have no words and so no licence of their own; of equal cosines the first template
by name wins, of several licence files in a directory the best, then the first by name; a null path has no parents;
rows that repeat are scanned like others; an empty table gives an empty result; other columns don't matter.
"""

from __future__ import annotations

import itertools
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airgrid.llm.common import cut

#: Cosine from which a template counts; tasks that the files of one directory are dealt to.
THRESHOLD, SALTS = 0.6, 16
#: Short notices of public licences, as headers give them.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
    ],
    "BSD-3-Clause": ["Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."],
    "CC-BY-4.0": ["This work is licensed under a Creative Commons Attribution 4.0 International License.", "Licensed under CC BY 4.0."],
    "CC-BY-NC-4.0": ["This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "Licensed under CC BY-NC 4.0."],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
    ],
    "LGPL-2.1": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    ],
    "MIT": ["Released under the MIT License.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
}
#: Words that are scored at a time; a longer text is scored at once.
CHUNK = 200_000
WORD = r"[a-z]+|[0-9]+(?:\.[0-9]+)*"


def tokens(text: str) -> list[str]:
    return re.findall(WORD, text.lower())


def with_full_texts(templates: dict[str, list[str]] = TEMPLATES) -> dict[str, list[str]]:
    """The templates and the full texts beside this file, which the driver reads."""
    full = {p.stem: p.read_text() for p in sorted((Path(__file__).parent / "licenses").glob("*.txt"))}
    return {name: [*templates.get(name, []), *([full[name]] if name in full else [])] for name in {**templates, **full}}


def frequencies(files: DataFrame, text: str, vocabulary: list[str]) -> tuple[int, dict[str, int]]:
    """Number of files, and in how many of them each word of the vocabulary stands. Each task counts its own."""
    own = frozenset(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, found = 0, Counter()
        for b in batches:
            n += b.num_rows
            for t in b.column(0).to_pylist():
                found.update(own.intersection(tokens(t or "")))
        yield pa.RecordBatch.from_pydict({"w": ["", *found], "n": pa.array([n, *found.values()], pa.int64())})

    rows = files.select(text).mapInArrow(run, "w string, n long").groupBy("w").agg(F.sum("n").alias("n")).collect()
    count = {r["w"]: r["n"] for r in rows}
    return count.pop("", 0), count


def weights(n: int, df: dict[str, int]) -> tuple[dict[str, float], float]:
    """Inverse frequency of the vocabulary's words, and of all others."""
    return {w: math.log((n + 1) / (c + 1)) + 1 for w, c in df.items()}, math.log(n + 1) + 1


def vectors(templates: dict[str, list[str]], idf: dict[str, float], other: float) -> list[tuple[str, int, dict[str, float]]]:
    """(licence, number of the template, words' weights at norm 1)."""
    out = []
    for name, texts in sorted(templates.items()):
        for i, text in enumerate(texts):
            v = {w: c * idf.get(w, other) for w, c in Counter(tokens(text)).items()}
            norm = math.sqrt(sum(x * x for x in v.values()))
            out.append((name, i, {w: x / norm for w, x in v.items()}))
    return out


class Scorer:
    """Best templates of texts. Words have numbers, those of the templates the first ones."""

    def __init__(self, found: list[tuple[str, int, dict[str, float]]], lengths: list[int], idf: dict[str, float], other: float, threshold: float):
        self.number = {w: i for i, w in enumerate(sorted(idf))}
        self.idf = np.array([*(idf[w] for w in sorted(idf)), other])
        self.threshold = threshold
        self.templates = []
        for (name, _, v), length in zip(found, lengths, strict=True):
            x = np.zeros(len(self.idf))
            x[[self.number[w] for w in v]] = list(v.values())
            self.templates.append((name, length, x))

    def best(self, texts: list[str | None]) -> list[tuple[str | None, float | None, str | None, float | None]]:
        """(licence, score, licence of the whole text, its score) of each text; null where no template is near."""
        out, part, size = [], [], 0
        for t in texts:
            lines = [found for line in (t or "").split("\n") if (found := tokens(line))]
            part.append(lines)
            size += sum(map(len, lines))
            if size >= CHUNK:
                out += self.score(part)
                part, size = [], 0
        return out + self.score(part)

    def score(self, texts: list[list[list[str]]]) -> list[tuple[str | None, float | None, str | None, float | None]]:
        numbers = defaultdict(itertools.count(len(self.idf)).__next__, self.number)
        ids = np.array([numbers[w] for lines in texts for line in lines for w in line], dtype=np.int64)
        own = np.minimum(ids, len(self.idf) - 1)
        weight = self.idf[own]
        line_ends = np.cumsum([len(line) for lines in texts for line in lines], dtype=np.int64)
        ends = np.cumsum([sum(map(len, lines)) for lines in texts], dtype=np.int64)
        starts = np.concatenate([[0], ends])[: len(ends)].astype(np.int64)
        whole = np.flatnonzero(ends > starts)
        line_starts = np.concatenate([[0], line_ends])[: len(line_ends)].astype(np.int64)
        a, b = np.concatenate([starts[whole], line_starts]), np.concatenate([ends[whole], line_ends])
        squares = np.concatenate([[0.0], np.cumsum(weight * weight)])
        least = np.sqrt(squares[b] - squares[a])
        best: list[list] = [[None, None, None, None] for _ in texts]
        for name, length, x in self.templates:
            sums = np.concatenate([[0.0], np.cumsum(x[own] * weight)])
            near = sums[b] - sums[a] >= (self.threshold - 1e-6) * least
            spans = [(int(i), int(j), k < len(whole)) for k, i, j in zip(np.flatnonzero(near), a[near], b[near], strict=True)]
            long = ends - starts >= length
            first = np.concatenate([np.arange(0, max(len(ids) - length + 1, 0), max(1, length // 8)), starts[long], ends[long] - length])
            first = first[np.searchsorted(ends, first, "right") == np.searchsorted(ends, first + length - 1, "right")]
            near = sums[first + length] - sums[first] >= (self.threshold - 1e-6) * np.sqrt(squares[first + length] - squares[first])
            spans += [(i, i + length, False) for i in np.unique(first[near]).tolist()]
            for i, j, all_of_it in spans:
                w, c = np.unique(ids[i:j], return_counts=True)
                y = c * self.idf[np.minimum(w, len(self.idf) - 1)]
                score = round(float((y * x[np.minimum(w, len(self.idf) - 1)]).sum() / np.sqrt((y * y).sum())), 9)
                if score < self.threshold:
                    continue
                at = best[np.searchsorted(ends, i, "right")]
                for k in (0, 2) if all_of_it else (0,):
                    if at[k + 1] is None or (-score, name) < (-at[k + 1], at[k]):
                        at[k : k + 2] = name, score
        return [tuple(x) for x in best]


def scan(files: DataFrame, path: str = "path", text: str = "text", key: str = "doc_id", templates: dict[str, list[str]] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """(key, path, own_license, own_score, is_license_file, license, how) of each file; how is own, inherited or none."""
    templates = with_full_texts() if templates is None else templates
    vocabulary = sorted({w for texts in templates.values() for t in texts for w in tokens(t)})
    n, df = frequencies(files, text, vocabulary)
    idf, other = weights(n, {w: df.get(w, 0) for w in vocabulary})
    lengths = [len(tokens(t)) for _, texts in sorted(templates.items()) for t in texts]
    shared = files.sparkSession.sparkContext.broadcast(Scorer(vectors(templates, idf, other), lengths, idf, other, threshold))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            best = shared.value.best(b.column(2).to_pylist())
            kinds = (pa.string(), pa.float64(), pa.string(), pa.float64())
            new = [pa.array([x[i] for x in best], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*b.columns[:2], *new], names=["k", "p", "own_license", "own_score", "file_license", "file_score"])

    rows = files.select(F.col(key).alias("k"), F.col(path).alias("p"), F.col(text).alias("t"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:2])
    # Without the texts, so narrow; used for the directories and for the files.
    joined = cut(rows.mapInArrow(run, f"{kinds}, own_license string, own_score double, file_license string, file_score double"))

    directory = lambda c: F.regexp_extract(c, r"^(.*)/[^/]*$", 1)
    speaking = joined.where("file_score is not null and p is not null").select(directory(F.col("p")).alias("dir"), "file_license", "file_score", "p")
    by_dir = speaking.groupBy("dir").agg(F.min_by("file_license", F.struct(-F.col("file_score"), F.col("p"))).alias("dir_license"))
    # Distinct directories, not files, look upwards: a directory with very many files is one row here.
    dirs = joined.where("own_license is null and p is not null").select(directory(F.col("p")).alias("of")).distinct()
    parts = F.split("of", "/")
    ups = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.struct(i.alias("depth"), F.when(i == 0, F.lit("")).otherwise(F.concat_ws("/", F.slice(parts, F.lit(1), i))).alias("dir")))
    above = dirs.select("of", F.explode(ups).alias("u")).select("of", "u.depth", "u.dir").join(by_dir, "dir")
    nearest = above.groupBy("of").agg(F.max_by("dir_license", "depth").alias("inherited"))
    # A directory's files are dealt to SALTS tasks, each with its own row of the directory.
    nearest = nearest.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    files_of = joined.withColumn("of", F.when(F.col("p").isNotNull(), directory(F.col("p")))).withColumn("salt", F.pmod(F.xxhash64("k", "p"), F.lit(SALTS)).cast("int"))
    out = files_of.join(nearest, ["of", "salt"], "left")
    return out.select(
        F.col("k").alias(key),
        F.col("p").alias("path"),
        "own_license",
        F.coalesce("own_score", F.lit(0.0)).alias("own_score"),
        F.col("file_score").isNotNull().alias("is_license_file"),
        F.coalesce("own_license", "inherited").alias("license"),
        F.when(F.col("own_license").isNotNull(), "own").when(F.col("inherited").isNotNull(), "inherited").otherwise("none").alias("how"),
    )
