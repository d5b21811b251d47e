"""License scans: TF-IDF cosine to templates, then nearest-ancestor inheritance.

Terms are lower-case runs of ASCII letters and digits. Templates are one-line
notices, the standard header blocks and whole licence texts. Every line of
every text, every window of consecutive terms as long as a template (headers,
however they are wrapped or embedded) and every whole text (a licence file) is
a sparse TF-IDF vector; its cosine to each template decides, and every licence
that reaches its threshold is returned. SPDX identifiers are read as such.
Document frequencies of the templates' terms count the lines of all documents;
a term in no template weighs as one that occurs in no line. A file without a
licence of its own takes the one of the licence file in its nearest ancestor
directory.
"""

from __future__ import annotations

import math
import re
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._tables import arrow_conf, saved
from ._words import tidy
from .encode import gathered

# Notices and header blocks by which the licences ask to be named.
NOTICES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)
_GNU = ("{0} is free software{4} you can redistribute it and/or modify it under the terms of the GNU {1} as published "
        "by the Free Software Foundation{2} version {3} of the License, or (at your option) any later version. {0} is "
        "distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {1} for more details.")
BLOCKS = (
    *((name, _GNU.format(what, of, ", either" if v > 2.1 else "; either", f"{v:g}", ":" if v > 2.1 else ";"))
      for name, what, of, v in (
          ("GPL-2.0", "This program", "General Public License", 2), ("GPL-3.0", "This program", "General Public License", 3),
          ("LGPL-2.1", "This library", "Lesser General Public License", 2.1),
          ("LGPL-3.0", "This library", "Lesser General Public License", 3),
          ("AGPL-3.0", "This program", "Affero General Public License", 3))),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
     "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
     "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed "
     "on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for "
     "the specific language governing permissions and limitations under the License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
     "MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
)
#: Templates of more terms are not compared with single lines.
LINE_TERMS = 40
#: What an SPDX expression is made of besides identifiers.
SPDX = re.compile(r"SPDX-License-Identifier:[ \t]*([A-Za-z0-9.+() \t-]+)")
HEADER_COSINE = 0.8
FILE_COSINE = 0.5


def default_templates() -> tuple[tuple[str, str], ...]:
    """Notices, header blocks and whole texts; read on the driver."""
    texts = sorted((Path(__file__).parent / "license_texts").glob("*.txt"))
    return (*NOTICES, *BLOCKS, *((f.stem, f.read_text(encoding="utf-8")) for f in texts))


def spdx_ids(text: str) -> list[str]:
    """Identifiers in the SPDX expressions of a text, exceptions left out."""
    found = []
    for expression in SPDX.findall(text):
        expression = re.sub(r"\bWITH\s+\S+", " ", expression)
        for part in re.split(r"[()]|\bAND\b|\bOR\b", expression):
            found += part.split()[:1]
    return [x for x in dict.fromkeys(found) if re.search("[A-Za-z0-9]", x)]


def _terms(lines: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Flat terms of each line, with offsets."""
    clean = pc.replace_substring_regex(pc.ascii_lower(lines), "[^a-z0-9]+", " ")
    lists = pc.split_pattern(clean, " ")
    flat = lists.flatten()
    off = np.concatenate(([0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False)))).astype(np.int64)
    some = np.asarray(pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False), bool)
    return flat.filter(pa.array(some)), np.concatenate(([0], np.cumsum(some)))[off]


def _lines(text: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Lines of all texts, and the offsets of the texts in them."""
    if isinstance(text, pa.ChunkedArray):
        text = text.combine_chunks()
    lists = pc.split_pattern(pc.fill_null(text.cast(pa.large_string()), ""), "\n")
    n = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    return lists.flatten(), np.concatenate(([0], np.cumsum(n))).astype(np.int64)


def template_terms(templates) -> list[str]:
    flat, _ = _terms(pa.array([t for _, t in templates], pa.large_string()))
    return sorted(set(flat.to_pylist()))


def _term_numbers(flat: pa.Array, terms: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """For each term its number among ``terms`` (-1: none), and a number of
    its own in this batch."""
    coded = flat.dictionary_encode()
    known = pc.fill_null(pc.index_in(coded.dictionary, pa.array(terms, coded.dictionary.type)), -1)
    index = coded.indices.to_numpy()
    return known.to_numpy(zero_copy_only=False).astype(np.int64)[index] if len(index) else index, index


def line_frequencies(docs: DataFrame, terms: list[str]) -> tuple[np.ndarray, int]:
    """Lines of all documents that hold each of the terms, and all lines with
    any term. One row per term reaches the driver."""

    def rows(batches):
        total, df = 0, np.zeros(len(terms), np.int64)
        for t in gathered(batches, "text"):
            lines, _ = _lines(t.column("text"))
            flat, off = _terms(lines)
            number, _ = _term_numbers(flat, terms)
            line = np.repeat(np.arange(len(off) - 1), np.diff(off))
            hit = number >= 0
            pairs = np.unique(line[hit] * len(terms) + number[hit])
            df += np.bincount(pairs % len(terms), minlength=len(terms))
            total += int((np.diff(off) > 0).sum())
        yield pa.RecordBatch.from_arrays([pa.array(range(len(terms) + 1), pa.int64()), pa.array([*df, total], pa.int64())],
                                         names=["term", "lines"])

    got = docs.select("text").mapInArrow(tidy(rows), "term long, lines long").groupBy("term").agg(F.sum("lines").alias("lines"))
    by = dict(got.collect())
    return np.array([by.get(i, 0) for i in range(len(terms))], np.int64), int(by.get(len(terms), 0))


class Templates:
    """Unit TF-IDF vectors of the templates, and which terms a line (a text)
    must have at least one of to come near a short (any) one of them."""

    def __init__(self, templates, df: np.ndarray, lines: int, floor: float, header: float):
        self.header = header
        self.names, self.terms = [n for n, _ in templates], template_terms(templates)
        self.idf = np.log((lines + 1) / (df + 1)) + 1
        self.unseen = math.log(lines + 1) + 1
        flat, off = _terms(pa.array([t for _, t in templates], pa.large_string()))
        number, _ = _term_numbers(flat, self.terms)
        tf = np.zeros((len(templates), len(self.terms)))
        np.add.at(tf, (np.repeat(np.arange(len(templates)), np.diff(off)), number), 1)
        w = tf * self.idf
        self.unit = w / np.linalg.norm(w, axis=1, keepdims=True)
        self.length = np.diff(off)
        self.gain = np.pad(self.unit * self.idf, ((0, 0), (0, 1)))  # the last column: terms of no template
        self.square = np.append(self.idf ** 2, self.unseen ** 2)
        # terms may be passed over, lightest first, while they alone cannot reach the floor
        self.anchor, self.text_anchor = np.zeros((2, len(self.terms)), bool)
        for u, n in zip(self.unit, self.length, strict=True):
            order = np.argsort(u, kind="stable")
            reach = np.sqrt(np.cumsum(u[order] ** 2))
            heavy = order[(reach >= floor) & (u[order] > 0)]
            self.text_anchor[heavy] = True
            if n <= LINE_TERMS:
                self.anchor[heavy] = True

    def cosines(self, number: np.ndarray, index: np.ndarray) -> np.ndarray:
        """Cosine of one unit of text to each template."""
        known = number >= 0
        w = np.bincount(number[known], minlength=len(self.terms)) * self.idf
        other = np.unique(index[~known], return_counts=True)[1] * self.unseen
        norm = math.sqrt(float(w @ w) + float(other @ other))
        return self.unit @ w / norm if norm else np.zeros(len(self.names))

    def windows(self, number: np.ndarray, index: np.ndarray) -> np.ndarray:
        """For each template, the best cosine of a window of its own number of
        consecutive terms, where one reaches the header threshold; else 0."""
        n, best = len(number), np.zeros(len(self.names))
        square = self.square[number]
        squares = np.concatenate(([0], np.cumsum(square)))
        keys = None
        for k, length in enumerate(self.length):
            if not 0 < length < n:
                continue  # the whole text is compared anyway
            dots = np.concatenate(([0], np.cumsum(self.gain[k][number])))
            dot = dots[length:] - dots[:-length]
            # terms that repeat only lengthen the vector
            near = dot >= (self.header - 1e-9) * np.sqrt(squares[length:] - squares[:-length])
            if not near.any():
                continue
            if keys is None:
                at = np.arange(n)
                keys = np.sort(index.astype(np.int64) * n + at)
                rank = np.searchsorted(keys, index.astype(np.int64) * n + at)
            group = index.astype(np.int64) * n
            before = rank - np.searchsorted(keys, group + np.maximum(at - (length - 1), 0))
            after = np.searchsorted(keys, group + np.minimum(at + length - 1, n - 1), side="right") - rank - 1
            norm = np.empty(n - length + 1)
            norm[0] = (square * (2 * before + 1))[:length].sum()
            norm[1:] = norm[0] + np.cumsum((square * (2 * before + 1))[length:] - (square * (2 * after + 1))[: n - length])
            c = float((dot[near] / np.sqrt(norm[near])).max())
            best[k] = c if c >= self.header else 0.0
        return best


def own_licenses(docs: DataFrame, templates=None, header_cosine: float = HEADER_COSINE,
                 file_cosine: float = FILE_COSINE) -> DataFrame:
    """``doc_id``, ``directory``, ``own_license`` (of the best line or window,
    else the whole text, that reaches its threshold; else null), ``own_cosine``
    (6 places), ``is_license_file`` and ``own_licenses`` (every licence that
    reaches a threshold or is named by an SPDX identifier, in order of name)
    for every row of ``docs(doc_id, text, directory)``."""
    templates = templates or default_templates()
    model = Templates(templates, *line_frequencies(docs, template_terms(templates)), min(header_cosine, file_cosine),
                      header_cosine)
    known = docs.sparkSession.sparkContext.broadcast(model)  # as large as the templates

    def rows(batches):
        m = known.value
        for t in gathered(batches, "text"):
            lines, loff = _lines(t.column("text"))
            flat, off = _terms(lines)
            number, index = _term_numbers(flat, m.terms)
            near = [np.concatenate(([0], np.cumsum(np.where(number >= 0, x[number], False))))
                    for x in (m.anchor, m.text_anchor)]
            has = near[0][off[1:]] > near[0][off[:-1]]
            starts = off[loff]
            n = t.num_rows
            names, best, whole, every = [None] * n, np.zeros(n), np.zeros(n, bool), [[] for _ in range(n)]
            text = t.column("text").combine_chunks()
            marked = pc.fill_null(pc.match_substring(text, "SPDX-License-Identifier:"), False).to_numpy(zero_copy_only=False)
            for i in np.flatnonzero((near[1][starts[1:]] > near[1][starts[:-1]]) | marked):
                a, b = starts[i], starts[i + 1]
                top = m.windows(number[a:b], index[a:b])
                for j in np.flatnonzero(has[loff[i]: loff[i + 1]]) + loff[i]:
                    top = np.maximum(top, m.cosines(number[off[j]: off[j + 1]], index[off[j]: off[j + 1]]))
                # a text of under half a long template is no copy of it, whatever common words they share
                c = np.where((m.length > LINE_TERMS) & (2 * (b - a) < m.length), 0.0,
                             m.cosines(number[a:b], index[a:b]))
                k, f = int(np.argmax(top)), int(np.argmax(c))
                whole[i] = c[f] >= file_cosine
                ids = spdx_ids(text[int(i)].as_py()) if marked[i] else []
                every[i] = sorted({*ids, *(m.names[x] for x in np.flatnonzero((top >= header_cosine) | (c >= file_cosine)))})
                if ids:
                    names[i], best[i] = ids[0], 1.0
                elif top[k] >= header_cosine:
                    names[i], best[i] = m.names[k], top[k]
                elif whole[i]:
                    names[i], best[i] = m.names[f], c[f]
                else:
                    best[i] = max(top[k], c[f])
            yield pa.RecordBatch.from_arrays(
                [t.column("doc_id").combine_chunks(), t.column("directory").combine_chunks(),
                 pa.array(names, pa.string()), pa.array(np.round(best, 6)), pa.array(whole),
                 pa.array(every, pa.list_(pa.string()))],
                names=["doc_id", "directory", "own_license", "own_cosine", "is_license_file", "own_licenses"])

    return docs.mapInArrow(tidy(rows), "doc_id long, directory string, own_license string, own_cosine double, "
                                 "is_license_file boolean, own_licenses array<string>")


def license_scan(docs: DataFrame, path: Column, templates=None, header_cosine: float = HEADER_COSINE,
                 file_cosine: float = FILE_COSINE) -> DataFrame:
    """Licence of every row of ``docs(doc_id, text)`` whose place in a directory
    tree is ``path`` (directories and a file name, separated by ``/``).

    ``templates`` are (licence, text) pairs (default: :func:`default_templates`).
    Returns ``doc_id``, ``directory``, the columns of :func:`own_licenses`,
    ``license`` (its own, else the inherited one, else null) and
    ``inherited_from`` (the directory that gave it). Of several licence files
    in a directory the one with the largest cosine, then least doc_id, speaks.

    Null and empty texts have no licence of their own; a null path is in no
    directory and inherits nothing; rows with a null or repeated doc_id are
    judged each by itself (a null doc_id comes last among equals). Other
    columns are ignored. An empty table gives an empty result.
    """
    arrow_conf(docs.sparkSession)
    place = F.when(path.contains("/"), F.regexp_replace(path, "/[^/]*$", "")).when(path.isNotNull(), F.lit(""))
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"), place.alias("directory"))
    own = saved(own_licenses(slim, templates, header_cosine, file_cosine), "license_own")
    gives = own.filter("is_license_file and directory is not null").groupBy("directory").agg(F.min(F.struct(
        (-F.col("own_cosine")).alias("c"), F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("d"),
        F.col("own_license").alias("l"))).alias("best"))
    gives = saved(gives.select(F.col("directory").alias("from"), F.col("best.l").alias("given")), "license_dirs")
    # each directory once, however many files it holds
    dirs = own.filter("directory is not null").select("directory").distinct()
    up = dirs.select("directory", F.split("directory", "/").alias("p")) \
        .select("directory", F.posexplode(F.expr(
            "transform(sequence(0, size(p)), n -> array_join(slice(p, 1, n), '/'))")).alias("depth", "from"))
    nearest = up.join(gives, "from").groupBy("directory").agg(F.max(F.struct("depth", "from", "given")).alias("m"))
    nearest = saved(nearest.select("directory", F.col("m.from").alias("from"), F.col("m.given").alias("given")),
                    "license_dirs")
    return own.join(nearest, "directory", "left").select(
        "doc_id", "directory", "own_license", "own_cosine", "is_license_file", "own_licenses",
        F.coalesce("own_license", "given").alias("license"),
        F.when(F.col("own_license").isNull(), F.col("from")).alias("inherited_from"))
