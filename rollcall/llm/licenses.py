"""License scans: sparse TF-IDF cosine of lines and licence files to templates, and inheritance by path."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from importlib import resources

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import broadcast_if_small, small_batches, staged, text_or_empty

# What headers and notices say, in the words of the licences themselves; full texts lie in ``license_texts``.
_GNU = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {0}General Public "
    "License as published by the Free Software Foundation, either version {1} of the License, or (at your option) any later version."
)
_GNU_REST = (
    " This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty "
    "of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {0}General Public License for more details. You should "
    "have received a copy of the GNU {0}General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."
)
_CC = "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."
_APACHE = (
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
    "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
    "that the following conditions are met"
)
_BSD_TWO = (
    ": 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
    "following disclaimer in the documentation and/or other materials provided with the distribution."
)


def _full(name: str) -> str:
    return resources.files(__package__).joinpath("license_texts", f"{name}.txt").read_text(encoding="utf-8")


def _gnu(full: str, kind: str, version: str) -> list[str]:
    short = f"This work is licensed under the GNU {kind}General Public License, version {version}."
    return [short, _GNU.format(kind, version), _GNU.format(kind, version) + _GNU_REST.format(kind), _full(full)]


# No full text of CC BY-NC 4.0.  The GNU versions and Lesser licences keep their notices, which differ
# from those of GPL-3.0 in a word, from being taken for it.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files, to deal in the Software without restriction.",
        _full("MIT"),
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License.",
        _APACHE,
        _APACHE + " Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the "
        "License for the specific language governing permissions and limitations under the License.",
        _full("Apache-2.0"),
    ],
    "GPL-3.0": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License.",
        *_gnu("GPL-3.0", "", "3"),
    ],
    "GPL-2.0": _gnu("GPL-2.0", "", "2"),
    "LGPL-2.1": _gnu("LGPL-2.1", "Lesser ", "2.1"),
    "LGPL-3.0": _gnu("LGPL-3.0", "Lesser ", "3"),
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        _CC,
        _CC + " To view a copy of this license, visit http://creativecommons.org/licenses/by-nc/4.0/ or send a letter to "
        "Creative Commons, PO Box 1866, Mountain View, CA 94042, USA.",
    ],
    "BSD-3-Clause": [_BSD + ".", _BSD + _BSD_TWO, _full("BSD-3-Clause")],
    "Proprietary": ["All rights reserved.", "Copyright (c) 2024 Owner. All rights reserved."],
}
#: What files under any licence say as well: it counts where no other licence is found in the file.
RESERVED = "Proprietary"
SIMILARITY = 0.75

_TERM = re.compile(r"[^\W_]+(?:\.[0-9]+)*")
# Years and owner of a copyright notice, up to its sentence's end or the words that follow: they differ in every file.
_OWNER = re.compile(
    r"(?:copyright[ \t]*(?:\(c\)|©)|(?:copyright|\(c\)|©)(?=[ \t]*(?:[0-9]{4}|[<\[]year|\[yyyy)))"
    r"(?:(?!all rights reserved|[.;]\s|licen[sc]ed|released under|permission is|redistribution and)[^\n]){0,80}"
)


def terms(text: str) -> list[str]:
    low = text.lower()
    if "copyright" in low or "(c)" in low or "©" in low:
        low = _OWNER.sub("copyright ", low)
    return _TERM.findall(low)


class Templates:
    """Template vectors under the corpus's weights, and the share of each that a term makes up."""

    def __init__(self, templates: dict[str, list[str]], document_counts: dict[str, int], documents: int, similarity: float):
        # A term no template has weighs as much as one that a single document has.
        self.rare = math.log((documents + 1) / 1.5) + 1
        self.idf = {t: math.log((documents + 1) / (n + 0.5)) + 1 for t, n in document_counts.items()}
        self.similarity = similarity
        self.vectors: list[tuple[str, dict[str, float]]] = []
        self.sizes: list[int] = []
        for name in sorted(templates):
            for template in templates[name]:
                self.vectors.append((name, self.vector(terms(template))))
                self.sizes.append(len(terms(template)))
        self.ids = {t: i for i, t in enumerate(sorted({t for _, v in self.vectors for t in v}))}
        self.share = np.zeros((len(self.ids), len(self.vectors)))
        for column, (_, vector) in enumerate(self.vectors):
            for term, value in vector.items():
                self.share[self.ids[term], column] = value * value
        self.known = frozenset(self.ids)

    def weight(self, term: str) -> float:
        return self.idf.get(term, self.rare)

    def vector(self, words: list[str]) -> dict[str, float]:
        raw = {t: n * self.weight(t) for t, n in Counter(words).items()}
        norm = math.sqrt(sum(v * v for v in raw.values())) or 1.0
        return {t: v / norm for t, v in raw.items()}

    def best(self, line: str) -> tuple[float, str] | None:
        vector = self.vector(terms(line))
        found = [(sum(v * vector.get(t, 0.0) for t, v in template.items()), name) for name, template in self.vectors]
        near = [(round(s, 9), name) for s, name in found if s >= self.similarity]
        return min(near, key=lambda x: (-x[0], x[1])) if near else None

    def scan(self, text: str) -> list[tuple[str, float, int, str]]:
        """(license, similarity, line, kind) of each line or run of lines near a template, and of the text as one.

        A run is as long as makes it nearest, at most twice its template; it is named by its first
        line.  Of runs of a licence that overlap, the nearest is given.
        """
        low = text.lower()
        held = [self.ids[t] for t in self.known.intersection(terms(low))]
        # No part of a text is nearer to a template than the template's own part that the text's terms make up.
        near = np.flatnonzero(self.share[held].sum(axis=0) >= self.similarity**2 - 1e-9) if held else ()
        return self._matches(low.split("\n"), near) if len(near) else []

    def _matches(self, lines: list[str], near: np.ndarray) -> list[tuple[str, float, int, str]]:
        local: dict[str, int] = {}
        codes, bounds = [], [0]
        for line in lines:
            codes.extend([local.setdefault(t, len(local)) for t in terms(line)])
            bounds.append(len(codes))
        if not codes:
            return []
        code, bound = np.array(codes), np.array(bounds)
        weight = np.array([self.weight(t) for t in local])
        names = [self.vectors[k][0] for k in near]
        values = np.array([[self.vectors[k][1].get(t, 0.0) for k in near] for t in local]) * weight[:, None]
        gains = np.vstack([np.zeros(len(names)), np.cumsum(values[code], axis=0)])
        squares = weight[code] ** 2
        # How often each term stood before: the n-th time adds 2n + 1 squares to the norm of what began before the first.
        order = np.argsort(code, kind="stable")
        first = np.flatnonzero(np.diff(code[order], prepend=-1))
        rank = np.empty(code.size, np.int64)
        rank[order] = np.arange(code.size) - np.repeat(first, np.diff(np.append(first, code.size)))
        limits = np.array([2 * self.sizes[k] + 8 for k in near])
        seen = np.zeros(len(local), np.int64)
        singles, runs = [], []

        def similarities(number: int, last: int) -> np.ndarray:
            """Of the runs from a line to each line until ``last``."""
            at, end = bound[number], bound[last + 1]
            again = rank[at:end] - seen[code[at:end]]
            norms = np.sqrt(np.cumsum((2 * again + 1) * squares[at:end]))
            ends = bound[number + 1 : last + 2]
            return (gains[ends] - gains[at]) / norms[ends - at - 1][:, None]

        whole = np.round(similarities(0, len(lines) - 1)[-1], 9)
        for number in range(len(lines)):
            at, end = bound[number], bound[number + 1]
            if (gains[end] > gains[at]).any():
                last = max(number, int(np.searchsorted(bound, at + limits.max(), "right")) - 2)
                found = similarities(number, last)
                alone = [(-round(float(s), 9), n) for s, n in zip(found[0], names, strict=True) if s >= self.similarity]
                if alone:
                    singles.append((*min(alone), number))
                longer = found[1:]
                longer = np.where(bound[number + 2 : last + 2, None] - at <= limits, longer, 0)
                if longer.size and longer.max() >= self.similarity:
                    for k, name in enumerate(names):
                        step = int(np.argmax(np.round(longer[:, k], 9)))
                        if longer[step, k] >= max(self.similarity, found[0, k] + 1e-9):
                            runs.append((-round(float(longer[step, k]), 9), name, number, number + 1 + step))
            np.add.at(seen, code[at:end], 1)
        taken: list[tuple[str, int, int]] = [(name, number, number) for far, name, number in singles if far == -1]
        out = [(name, -far, number, "header") for far, name, number in singles]
        for far, name, number, last in sorted(runs):
            if not any(name == n and number <= b and a <= last for n, a, b in taken):
                taken.append((name, number, last))
                out.append((name, -far, number, "header"))
        out.sort(key=lambda x: (x[2], -x[1], x[0]))
        best = min((-s, n) for s, n in zip(whole.tolist(), names, strict=True))
        if -best[0] >= self.similarity:
            out.append((best[1], -best[0], -1, "file"))
        return out


def _count_terms(wanted: frozenset[str]):
    """Per batch: how many texts hold each wanted term; the empty term counts texts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts: Counter = Counter({"": len(batch)})
            for text in batch["text"]:
                counts.update(wanted.intersection(terms(text)))
            yield pd.DataFrame({"term": list(counts), "n": list(counts.values())})

    return run


def fit_templates(files: DataFrame, templates: dict[str, list[str]] = TEMPLATES, similarity: float = SIMILARITY) -> Templates:
    """Weights from how many of all files hold each template term: as many figures as templates have terms."""
    wanted = frozenset(t for texts in templates.values() for text in texts for t in terms(text))
    with small_batches(files.sparkSession):
        counted = files.select(text_or_empty().alias("text")).mapInPandas(_count_terms(wanted), "term string, n bigint")
        counts = {r["term"]: r["n"] for r in counted.groupBy("term").agg(F.sum("n").alias("n")).collect()}
    documents = counts.pop("", 0)
    return Templates(templates, {t: counts.get(t, 0) for t in wanted}, documents, similarity)


def scan_files(files: DataFrame, fitted: Templates) -> DataFrame:
    """(doc_id, path, matches) of each row; matches are (license, similarity, line, kind)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [[{"license": a, "similarity": b, "line": c, "kind": d} for a, b, c, d in fitted.scan(t)] for t in batch.pop("text")]
            yield batch.assign(matches=found)

    kind = "doc_id bigint, path string, matches array<struct<license:string,similarity:double,line:int,kind:string>>"
    rows = files.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("path").cast("string").alias("path"), text_or_empty().alias("text"))
    return rows.mapInPandas(run, kind)


def _directory(path: Column) -> Column:
    return F.regexp_replace(path, "/?[^/]*$", "")


def file_licenses(files: DataFrame, is_license_file: Column, templates: dict[str, list[str]] = TEMPLATES, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, path, license, similarity, license_from, evidence) of each file.

    ``files``: doc_id, path, text.  ``is_license_file`` is a condition over path and matches,
    such as a file name.  A line, or a run of lines, of any place in the whole text that is near a
    template is a header.  A file's licence is that of its best header or whole text, reserved
    rights only where there is no other; failing that, that of
    the nearest directory above it with a licence file; else null.  ``evidence`` is own or
    inherited; ``license_from`` is the directory of an inherited one.  Where licence files of
    one directory differ, the most similar counts, then the first by name; so with headers.
    The best similarity of equal lines is that of each.  A null path inherits nothing; null and
    empty texts have no header; repeated rows get equal results.
    """
    fitted = fit_templates(files, templates, similarity)
    with small_batches(files.sparkSession):
        scanned = staged(scan_files(files, fitted), "license-scan")
    ranked = F.transform("matches", lambda m: F.struct((m["license"] == RESERVED).alias("reserved"), (-m["similarity"]).alias("far"), m["license"].alias("license")))
    best = F.element_at(F.array_sort(ranked), 1)
    own = F.struct(best["far"].alias("far"), best["license"].alias("license"))
    scanned = scanned.withColumn("own", F.when(F.size("matches") > 0, own)).withColumn("directory", _directory(F.col("path")))
    licensed = scanned.where(is_license_file & F.col("own").isNotNull() & F.col("path").isNotNull())
    sources = staged(
        licensed.groupBy("directory").agg(F.min("own").alias("own")).select(F.col("directory").alias("ancestor"), F.col("own").alias("given")), "license-sources"
    )
    # Each directory, not each file, looks up its ancestors: itself, then each part less.
    directories = scanned.where("path is not null").select("directory").distinct()
    parts = F.split("directory", "/")
    above = F.transform(F.sequence(F.size(parts), F.lit(0), F.lit(-1)), lambda k: F.array_join(F.slice(parts, 1, k), "/"))
    looked = directories.select("directory", F.explode_outer(F.array_distinct(above)).alias("ancestor"))
    nearest = looked.join(broadcast_if_small(sources), "ancestor").groupBy("directory").agg(
        F.max_by(F.struct("ancestor", "given"), F.length("ancestor")).alias("heir")
    )
    nearest = broadcast_if_small(staged(nearest.select(F.col("directory").alias("_directory"), "heir"), "license-heirs"))
    joined = scanned.join(nearest, scanned["directory"] == nearest["_directory"], "left")
    return joined.select(
        "doc_id",
        "path",
        F.coalesce("own.license", "heir.given.license").alias("license"),
        F.coalesce(-F.col("own.far"), -F.col("heir.given.far")).alias("similarity"),
        F.when(F.col("own").isNull(), F.col("heir.ancestor")).alias("license_from"),
        F.when(F.col("own").isNotNull(), "own").when(F.col("heir").isNotNull(), "inherited").alias("evidence"),
    )
