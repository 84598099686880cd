"""Licence scans: TF-IDF cosine of headers and licence files to templates, then inheritance from directories.

Every line, every paragraph, the whole of a text, and every run of as many words as a statement has are units. A unit's vector
holds its words (lower case, ASCII punctuation read as white space) weighted by count times inverse document frequency, counted
over all lines of all texts for the words of the templates; other words weigh as the rarest. The template nearest by cosine names
the unit's licence if it reaches LEAST. Templates are statements (for all units), the paragraphs of whole licence texts (for
paragraphs), and those texts (for texts, from FILE_LEAST on; one that is near enough names the text's licence alone, and is no
statement inside it). A statement that is denied ("not licensed under ...": a word of DENIALS among its unit's words or up to
DENIED words before it, that its template lacks) is none, and a claim of all rights is none beside a licence.

A licence file is one whose name says so, one near a whole licence text, or a text of at least FILE_WORDS words that lie mostly in
licence units. It covers its directory, and a file takes the licence of its nearest ancestor directory that has one, by a join of paths.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandwork.llm.common import salted_join, text_buffer, text_slices, words, written
from strandwork.llm.decontaminate import plain_bytes
from strandwork.llm.licence_texts import TEXTS

LEAST = 0.75
FILE_WORDS, FILE_SHARE, FILE_LEAST = 20, 0.8, 0.9
#: A paragraph of a licence text is a template from so many words on; shorter ones (titles, blanks to fill in) may stand anywhere.
PARAGRAPH_WORDS = 8
DENIALS = ("not", "no", "never", "isn't", "without", "neither", "nor", "cannot", "than")
DENIED = 3
#: The licence that a claim of all rights names.
CLAIM = "Proprietary"
NAMES = r"(?i)(^|/)(licen[cs]es?|copying|unlicense|notice)([-._][^/]*)?$"
#: (licence, typical statement), fixed values: wordings that licences ask for or that are common in headers and first lines.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "The MIT License (MIT)"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License"),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"),
    ("ISC", "Licensed under the ISC License."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC0-1.0", "Licensed under CC0 1.0 Universal Public Domain Dedication."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("Proprietary", "All rights reserved."),
    ("Proprietary", "Copyright (c) all rights reserved. Unauthorized copying of this file is strictly prohibited."),
)


def _terms(text: bytes | str) -> np.ndarray:
    buf, starts = text_buffer(pa.array([text], pa.string()))
    return words(plain_bytes(buf), starts)[0]


@dataclass(frozen=True)
class Templates:
    """The words of all templates, and each template's counts of them: first the statements, then paragraphs, then whole texts."""

    names: tuple[str, ...]
    terms: np.ndarray  # sorted
    count: np.ndarray  # [template, term]
    size: np.ndarray  # words of each template
    statements: int
    texts: int  # the first whole text
    denials: np.ndarray  # sorted words
    denied: np.ndarray  # how many of them each template has

    @classmethod
    @lru_cache(maxsize=1)
    def fixed(cls) -> Templates:
        all_ = [(n, _terms(t)) for n, t in TEMPLATES]
        statements = len(all_)
        known: set[bytes] = set()
        for n, text in TEXTS:
            for x in re.split(r"\n[^\w\n]*\n", text):
                t = _terms(x)
                if len(t) >= PARAGRAPH_WORDS and t.tobytes() not in known:
                    known.add(t.tobytes())
                    all_.append((n, t))
        texts = len(all_)
        all_ += [(n, _terms(t)) for n, t in TEXTS]
        terms = np.unique(np.concatenate([t for _, t in all_]))
        count = np.zeros((len(all_), len(terms)))
        for k, (_, t) in enumerate(all_):
            np.add.at(count[k], np.searchsorted(terms, t), 1)
        denials = np.unique(np.concatenate([_terms(x) for x in DENIALS]))
        denied = np.array([int(np.isin(t, denials).sum()) for _, t in all_])
        return cls(tuple(n for n, _ in all_), terms, count, np.array([len(t) for _, t in all_]), statements, texts, denials, denied)


@dataclass(frozen=True)
class Weighted:
    idf: np.ndarray  # of the templates' words
    other: float  # of all other words
    unit: np.ndarray  # [template, term]: count * idf, normalised, times idf once more for the unit's own weight


def weighted(lines: int, df: np.ndarray) -> Weighted:
    idf = np.log((1 + lines) / (1 + df)) + 1
    v = Templates.fixed().count * idf
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    return Weighted(idf, float(np.log(1 + lines) + 1), v * idf)


def _read(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(term number or -1, word hash, line, paragraph, document) of each word; lines are numbered over all texts in a row."""
    t = Templates.fixed()
    buf, starts = text_buffer(column)
    h, begin, _, doc = words(plain_bytes(buf), starts)
    breaks = np.zeros(len(buf) + 1, np.int64)
    np.cumsum(buf == 10, out=breaks[1:])
    line = breaks[begin] + doc  # a new text is a new line
    at = np.minimum(np.searchsorted(t.terms, h), len(t.terms) - 1)
    term = np.where(t.terms[at] == h, at, -1)
    gap = np.ones(len(h), np.int64)  # lines without words part paragraphs
    gap[1:] = (np.diff(line) > 1) | (np.diff(doc) > 0)
    return term, h, line, np.cumsum(gap), doc


def frequencies(files: DataFrame) -> tuple[int, np.ndarray]:
    """(lines with words, lines that hold each template word), over all texts; one row a word and task is shuffled."""

    def run(batches):
        n_terms = len(Templates.fixed().terms)
        lines, df = 0, np.zeros(n_terms, np.int64)
        for batch in batches:
            text = batch.column("text")
            for i, j in text_slices(text):
                term, _, line, _, _ = _read(text.slice(i, j - i))
                lines += int(np.count_nonzero(np.diff(line))) + (len(line) > 0)  # lines are in order
                some = term >= 0
                held = np.sort(line[some] * n_terms + term[some])
                df += np.bincount(held[np.diff(held, prepend=-1) != 0] % n_terms, minlength=n_terms)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, n_terms)), pa.array(np.append(lines, df))], ["term", "n"])

    out = np.zeros(len(Templates.fixed().terms) + 1, np.int64)
    for r in files.select("text").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        out[r["term"] + 1] = r["n"]
    return int(out[0]), out[1:]


@dataclass(frozen=True)
class Found:
    """Of one text: its licence units (template, line within the text, cosine, words), words in any of them, the whole text it is."""

    units: list[tuple[int, int, float, int]]
    words: int
    whole: tuple[int, float] | None


def licences(column: pa.Array, w: Weighted) -> list[Found]:
    t = Templates.fixed()
    term, h, line, paragraph, doc = _read(column)
    units: list[list[tuple[int, int, float, int]]] = [[] for _ in range(len(column))]
    if not len(h):
        return [Found([], 0, None) for _ in units]
    buf, starts = text_buffer(column)
    first_line = np.append(0, np.cumsum(buf == 10))[starts[:-1]] + np.arange(len(column))
    weight = np.where(term >= 0, w.idf[term], w.other)
    square = np.append(0, np.cumsum(weight**2))
    covered = np.zeros(len(h), bool)
    whole: dict[int, tuple[int, float]] = {}
    stated = (t.count[: t.statements] > 0).any(0)
    some = np.flatnonzero((term >= 0) & stated[term])

    def cosines(a: int, b: int, first: int, last: int) -> np.ndarray:
        """Of the words a to b to the templates first to last; none where even their words of templates are too little."""
        _, one, n = np.unique(h[a:b], return_index=True, return_counts=True)
        x = (weight[a:b][one] * n) ** 2
        own = term[a:b][one]
        norm = x.sum()
        if x[own >= 0].sum() < LEAST**2 * norm:
            return np.zeros(last - first)
        return (w.unit[first:last, own[own >= 0]] * n[own >= 0]).sum(1) / np.sqrt(norm)

    def shared(k: int, a: int, b: int) -> float:
        """How many of the statement's words are among those from a to b: one word many times is no statement."""
        own = term[a:b][term[a:b] >= 0]
        return np.minimum(np.bincount(own, minlength=len(t.terms)), t.count[k]).sum() / t.size[k]

    denial = np.append(0, np.cumsum(np.isin(h, t.denials)))

    def denied(k: int, a: int, b: int) -> bool:
        before = max(a - DENIED, int(np.searchsorted(paragraph, paragraph[a])))
        return denial[b] - denial[before] > t.denied[k]

    def take(k: int, a: int, b: int, cosine: float) -> None:
        d = int(doc[a])
        covered[a:b] = True
        at = int(line[a] - first_line[d])
        if not any(x[1] == at and x[0] == k for x in units[d]):
            units[d].append((k, at, float(min(cosine, 1.0)), b - a))

    for kind, unit in enumerate((line, paragraph, doc)):
        cut = np.flatnonzero(np.diff(unit, prepend=unit[0] - 1))
        size = np.diff(np.append(cut, len(unit)))
        # An upper bound of each unit's cosine: its norm is at least that of its words counted once each time.
        least_norm = np.sqrt(np.add.reduceat(weight**2, cut))
        best = np.zeros(len(cut))
        owner = np.searchsorted(cut, some, "right") - 1
        for k in range(t.statements):
            best = np.maximum(best, np.bincount(owner, w.unit[k][term[some]], len(cut)))
        for u in np.flatnonzero(best >= LEAST * least_norm):
            a, b = int(cut[u]), int(cut[u] + size[u])
            cosine = cosines(a, b, 0, t.statements)
            k = int(cosine.argmax())
            if cosine[k] >= LEAST and not denied(k, a, b):
                take(k, a, b, cosine[k])
        if kind:  # licence texts: all words that are not in templates are lost, the others count together at most
            first, last, least = (t.statements, t.texts, LEAST) if kind == 1 else (t.texts, len(t.names), FILE_LEAST)
            mine = np.add.reduceat(np.where(term >= 0, weight, 0), cut)
            lost = np.add.reduceat(np.where(term >= 0, 0, weight**2), cut)
            for u in np.flatnonzero((mine**2 * (1 - least**2) >= lost * least**2) & (size >= PARAGRAPH_WORDS)):
                a, b = int(cut[u]), int(cut[u] + size[u])
                cosine = cosines(a, b, first, last)
                k = int(cosine.argmax())
                if cosine[k] >= least and kind == 1:
                    take(first + k, a, b, cosine[k])
                elif cosine[k] >= least:
                    covered[a:b] = True
                    whole[int(doc[a])] = (first + k, float(min(cosine[k], 1.0)))
    # Runs of words inside longer units, nearest first, where nothing else was found; a run stays in its paragraph.
    runs: list[tuple[float, int, int, int]] = []
    for k in range(t.statements):
        long = int(t.size[k])
        if long > len(h):
            continue
        total = np.zeros(len(h) + 1)
        own = np.where(term >= 0, w.unit[k][term], 0)
        np.cumsum(own, out=total[1:])
        sums = total[long:] - total[:-long]
        at = np.flatnonzero(sums >= LEAST * np.sqrt(square[long:] - square[:-long]) - 1e-6)
        at = at[(paragraph[at] == paragraph[at + long - 1]) & ~covered[at] & ~covered[at + long - 1]]
        for part in np.split(at, np.flatnonzero(np.diff(at) > 1) + 1) if len(at) else []:
            each = [(float(cosines(int(a), int(a) + long, k, k + 1)[0]), -k, int(a), int(a) + long) for a in part]
            runs += [x for x in each if x[0] >= LEAST and shared(k, x[2], x[3]) >= LEAST]
    for cosine, k, a, b in sorted(runs, key=lambda x: (-x[0], -x[1], x[2])):
        if not covered[a:b].any() and not denied(-k, a, b):
            take(-k, a, b, cosine)
    for found in units:
        if any(t.names[x[0]] != CLAIM for x in found):
            found[:] = [x for x in found if t.names[x[0]] != CLAIM]
    inside = np.bincount(doc, covered, len(column)).astype(np.int64)
    return [Found(x, int(n), whole.get(d)) for d, (x, n) in enumerate(zip(units, inside, strict=True))]


def scan(files: DataFrame, path: Column) -> DataFrame:
    """Licences of ``files`` (doc_id, text, any more columns) at ``path``, a string column with / between directories.

    Returns doc_id, path, licence (nearest template over all units of the whole text, ties to the earlier one; null for none),
    similarity, line (from 0), found (all different licences of the text), licence_file, inherited (of the nearest ancestor
    directory with a licence file, the file's own directory first; null for none or where the text has a licence) and
    inherited_from. Null, empty and wordless texts have none; a null path has no directory; repeated rows each give theirs.
    Several licence files of one directory: the one named first.
    """
    spark = files.sparkSession
    held = spark.sparkContext.broadcast(weighted(*frequencies(files)))
    named = re.compile(NAMES)

    def run(batches):
        names = Templates.fixed().names
        for batch in batches:
            text, key, where = batch.column("text"), batch.column("doc_id"), batch.column("path").to_pylist()
            for i, j in text_slices(text):
                part = text.slice(i, j - i)
                buf, starts = text_buffer(part)
                total = np.bincount(words(plain_bytes(buf), starts)[3], minlength=j - i)
                rows = []
                for k, one in enumerate(licences(part, held.value)):
                    units = [(one.whole[0], 0, one.whole[1], int(total[k]))] if one.whole else one.units
                    top = max(units, key=lambda u: (u[2], -u[0], -u[1]), default=None)
                    share = one.words / max(1, total[k])
                    file = bool(units) and (bool(one.whole) or bool(where[i + k] and named.search(where[i + k])) or (total[k] >= FILE_WORDS and share > FILE_SHARE))
                    rows.append((names[top[0]] if top else None, top[2] if top else None, top[1] if top else None, sorted({names[u[0]] for u in units}), file))
                cols = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [key.slice(i, j - i), pa.array(where[i:j], pa.string()), pa.array(cols[0], pa.string()), pa.array(cols[1], pa.float64()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.list_(pa.string())), pa.array(cols[4], pa.bool_())],
                    ["doc_id", "path", "licence", "similarity", "line", "found", "licence_file"],
                )

    rows = files.select(F.col("doc_id").cast("long").alias("doc_id"), path.alias("path"), "text")
    found = rows.mapInArrow(run, "doc_id long, path string, licence string, similarity double, line long, found array<string>, licence_file boolean")
    parts = F.split("path", "/")
    found = written(found.withColumn("directory", F.array_join(F.slice(parts, 1, F.size(parts) - 1), "/")), "licences")
    covered = found.where("licence_file and directory is not null").groupBy(F.col("directory").alias("ancestor")).agg(F.min_by("licence", F.struct("path", "doc_id")).alias("inherited"))
    own = F.split("directory", "/")
    ups = F.concat(F.when(F.col("directory") != "", F.transform(F.sequence(F.lit(1), F.size(own)), lambda n: F.array_join(F.slice(own, F.lit(1), n), "/"))).otherwise(F.array().cast("array<string>")), F.array(F.lit("")))
    above = found.where("directory is not null").select("directory").distinct().select("directory", F.explode(ups).alias("ancestor"))
    nearest = above.join(covered, "ancestor").groupBy("directory").agg(F.max_by(F.struct("inherited", "ancestor"), F.length("ancestor")).alias("n"))
    # A directory may hold much of the corpus: its files meet their licence in many parts.
    out = salted_join(found.withColumn("at_", F.monotonically_increasing_id()), nearest, "directory", "at_", how="left")
    alone = F.col("licence").isNull()
    return out.select("doc_id", "path", "licence", "similarity", "line", "found", "licence_file", F.when(alone, F.col("n.inherited")).alias("inherited"), F.when(alone, F.col("n.ancestor")).alias("inherited_from"))
