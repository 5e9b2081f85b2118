"""License scans: a generalised suffix automaton over the tokens of license templates.

Texts stream through the automaton; at every token it holds the length of the longest
template substring that ends there (matching statistics). Right-maximal matches of
``MIN_MATCH`` tokens or more are chained per template (text and template places both
rising, gaps of ``MAX_GAP`` tokens at most) into covered spans; a span that covers
``MIN_COVERAGE`` of its template labels the text. The base phrases are templates too:
every state knows which phrases are suffixes of its string, which gives all their places.

A token that no template holds resets the automaton, so only runs of two or more template
tokens are streamed; everything else is found by one table lookup per token.

Defined results: null and empty texts have no words and no labels (score 0). Rows are
scanned one by one, so repeated rows give repeated results, ties don't arise, and extra
columns of the input are left out. Texts are scanned whole, in time linear in their length.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationlake.llm.common import column_bytes, slices, table

# ---- fixed values: base phrases, license notices ------------------------------------------
PHRASES = [("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license")]
TEMPLATES = [
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
            "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
            "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
            "subject to the following conditions:"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial "
            "portions of the Software."),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
               "compliance with the License. You may obtain a copy of the License at "
               "http://www.apache.org/licenses/LICENSE-2.0"),
    ("apache", "Unless required by applicable law or agreed to in writing, software distributed under the License is "
               "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or "
               "implied. See the License for the specific language governing permissions and limitations under the "
               "License."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License as published by the Free Software Foundation, either version 3 of the License, "
            "or (at your option) any later version."),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met:"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
            "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("cc", "Licensed under CC BY-NC 4.0."),
    ("cc", "Licensed under CC BY 4.0."),
    ("cc", "Licensed under CC BY-SA 4.0."),
    ("cc", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
]
# -------------------------------------------------------------------------------------------
MIN_MATCH, MAX_GAP, MIN_COVERAGE, BATCH_BYTES = 3, 20, 0.7, 4 << 20

#: A-Z to lower case; every other ASCII character that is no letter or digit to a space.
BYTE_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
                   for c in range(256))


def words(text: bytes) -> list[bytes]:
    return text.translate(BYTE_TABLE).split()


class SuffixAutomaton:
    """Generalised suffix automaton of token sequences.

    ``step[s]`` transitions, ``link`` suffix links, ``length`` longest string of a state,
    ``ends[s]`` places (sequence, index of the last token), ``phrases[s]`` the numbers of
    whole sequences that are suffixes of the state's strings.
    """

    def __init__(self, sequences: list[list[int]], phrases: int) -> None:
        self.step: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: list[set] = [set()]
        whole: dict[int, list[int]] = {}
        for n, seq in enumerate(sequences):
            last = 0
            for i, token in enumerate(seq):
                last = self._extend(last, token, ends)
                ends[last].add((n, i))
            if n < phrases and seq:
                whole.setdefault(last, []).append(n)
        for s in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            ends[self.link[s]] |= ends[s]
        self.ends = [sorted(x) for x in ends]
        self.phrases: list[list[int]] = [[] for _ in self.link]
        for s in sorted(range(1, len(self.link)), key=self.length.__getitem__):
            # a whole sequence that ends in s may be shorter than the longest string of s
            self.phrases[s] = self.phrases[self.link[s]] + whole.get(s, [])

    def _state(self, length: int, link: int, step: dict[int, int], ends: list[set]) -> int:
        self.step.append(step), self.link.append(link), self.length.append(length)
        ends.append(set())
        return len(self.link) - 1

    def _extend(self, last: int, token: int, ends: list[set]) -> int:
        if token in self.step[last]:
            return self._target(last, token, ends)
        new, s = self._state(self.length[last] + 1, 0, {}, ends), last
        while s >= 0 and token not in self.step[s]:
            self.step[s][token] = new
            s = self.link[s]
        if s >= 0:
            self.link[new] = self._target(s, token, ends)
        return new

    def _target(self, s: int, token: int, ends: list[set]) -> int:
        """The state of (longest string of s) + token, split off where it shares a state with longer ones."""
        t = self.step[s][token]
        if self.length[t] == self.length[s] + 1:
            return t
        split = self._state(self.length[s] + 1, self.link[t], dict(self.step[t]), ends)
        self.link[t] = split
        while s >= 0 and self.step[s].get(token) == t:
            self.step[s][token] = split
            s = self.link[s]
        return split

    def statistics(self, tokens: list[int]) -> Iterator[tuple[int, int]]:
        """(state, length of the longest match that ends here) for every token."""
        step, link, length, s, n = self.step, self.link, self.length, 0, 0
        for token in tokens:
            while s and token not in step[s]:
                s = link[s]
                n = length[s]
            if token in step[s]:
                s = step[s][token]
                n += 1
            else:
                n = 0
            yield s, n


def _apart(chains: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Chains (sorted by last word) without overlap whose covered tokens add up to most."""
    lasts = [c[0] for c in chains]
    total, before = [0], []
    for i, (_, first, _, c) in enumerate(chains):
        before.append(bisect_left(lasts, first, 0, i))
        total.append(max(total[-1], c + total[before[i]]))
    out, i = [], len(chains)
    while i:
        if total[i] == total[i - 1]:
            i -= 1
        else:
            out.append(chains[i - 1])
            i = before[i - 1]
    return out


class Scanner:
    """Templates compiled for scanning: vocabulary, automaton, labels."""

    def __init__(self, phrases=PHRASES, templates=TEMPLATES, min_match=MIN_MATCH, max_gap=MAX_GAP) -> None:
        self.n_phrases, self.min_match, self.max_gap = len(phrases), min_match, max_gap
        self.shortest = min([min_match, *(len(words(p.encode())) for _, p in phrases)])
        self.labels = [label for label, _ in [*phrases, *templates]]
        seqs = [words(text.encode()) for _, text in [*phrases, *templates]]
        self.vocab = {w: i for i, w in enumerate(dict.fromkeys(w for s in seqs for w in s))}
        self.size = [len(s) for s in seqs]
        self.automaton = SuffixAutomaton([[self.vocab[w] for w in s] for s in seqs], self.n_phrases)

    def run(self, tokens: list[int], first: int, places: list, matches: list) -> None:
        """Streams one run of template tokens that starts at word ``first``."""
        a, before = self.automaton, (0, 0)
        for i, now in enumerate(a.statistics(tokens), first):
            for p in a.phrases[now[0]]:
                if self.size[p] <= now[1]:
                    places.append((i - self.size[p] + 1, p))
            if before[1] >= self.min_match and now[1] != before[1] + 1:
                matches.append((i - before[1], i - 1, before[0]))
            before = now
        if before[1] >= self.min_match:
            i = first + len(tokens) - 1
            matches.append((i - before[1] + 1, i, before[0]))

    def spans(self, matches: list[tuple[int, int, int]]) -> list[tuple[int, int, int, float]]:
        """Chains per template: (template, first word, last word, share of the template covered).

        Each match extends the best chain that ends within ``max_gap`` words before it; of all
        chains, those without overlap that cover most template tokens together are kept.
        """
        by: dict[int, list[tuple[int, int, int]]] = {}
        for start, end, state in matches:
            for t, e in self.automaton.ends[state]:
                if t >= self.n_phrases:
                    by.setdefault(t, []).append((end, start, e))
        out = []
        for t, found in by.items():
            chains: list[tuple[int, int, int, int]] = []  # last word, first word, template end, tokens covered
            for end, start, e in sorted(found):
                n = end - start + 1
                best = (end, start, e, n)
                for last, f, e0, c in reversed(chains):
                    if last < start - self.max_gap:
                        break
                    cut = max(0, last + 1 - start, e0 + 1 - (e - n + 1))  # what overlaps counts once
                    if last < end and e0 < e and cut < n and c + n - cut > best[3]:
                        best = (end, f, e, c + n - cut)
                chains.append(best)
            out += [(t, f, last, min(1.0, c / self.size[t])) for last, f, _, c in _apart(chains)]
        return sorted(out, key=lambda x: (x[1], x[0]))

    def scan(self, texts: list[bytes]) -> Iterator[tuple[int, list, list]]:
        """Per text: number of words, phrase places, spans."""
        tokens: list[bytes | None] = [None]
        firsts = []
        for t in texts:
            firsts.append(len(tokens))
            tokens.extend(words(t))
            tokens.append(None)
        ids = np.fromiter(map(self.vocab.get, tokens, repeat(-1)), np.int32, len(tokens))
        known = np.concatenate(([False], ids >= 0, [False]))
        edge = np.flatnonzero(known[1:] != known[:-1])
        starts, ends = edge[::2], edge[1::2]
        long = ends - starts >= self.shortest  # shorter runs hold no phrase and no match
        starts, ends = starts[long], ends[long]
        of = np.searchsorted(np.asarray(firsts), starts, "right") - 1
        runs: dict[int, list[tuple[int, int]]] = {}
        for d, s, e in zip(of.tolist(), starts.tolist(), ends.tolist()):
            runs.setdefault(d, []).append((s, e))
        last = [*firsts[1:], len(tokens)]
        for d, first in enumerate(firsts):
            places: list[tuple[int, int]] = []
            matches: list[tuple[int, int, int]] = []
            for s, e in runs.get(d, ()):
                self.run(ids[s:e].tolist(), s - first, places, matches)
            yield last[d] - first - 1, places, self.spans(matches) if matches else []


SCAN_TYPE = ("n_words bigint, places array<struct<word:bigint,label:string>>, "
             "spans array<struct<label:string,template:int,first_word:bigint,last_word:bigint,coverage:double>>")


def license_scan(docs: DataFrame, phrases=PHRASES, templates=TEMPLATES) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): words, phrase places and template spans."""
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType),
                           *T._parse_datatype_string(SCAN_TYPE).fields])
    place, span = (pa.list_(pa.struct([(f.name, {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(),
                                                 "double": pa.float64()}[f.dataType.simpleString()])
                                       for f in schema[c].dataType.elementType.fields])) for c in ("places", "spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Scanner(phrases, templates)
        for b in slices(batches, "text", BATCH_BYTES):
            n, p, c = [], [], []
            for words_, places, spans in s.scan(column_bytes(b.column(1))):
                n.append(words_)
                p.append([{"word": w, "label": s.labels[k]} for w, k in places])
                c.append([{"label": s.labels[t], "template": t - s.n_phrases, "first_word": f, "last_word": x,
                           "coverage": v} for t, f, x, v in spans])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(p, place),
                                              pa.array(c, span)], ["doc_id", "n_words", "places", "spans"])

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def op1_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    scan = license_scan(table(spark, sf_dir, "documents"))
    covered = F.filter("spans", lambda s: s["coverage"] >= MIN_COVERAGE)
    base = F.array_distinct(F.transform("places", lambda p: p["label"]))
    best = F.coalesce(F.array_max(F.transform("spans", lambda s: s["coverage"])), F.lit(0.0))
    return scan.select(
        "doc_id", "n_words", F.size("places").cast("bigint").alias("n_base"),
        F.array_min(F.transform("places", lambda p: p["word"])).alias("first_word"),
        F.array_max(F.transform("places", lambda p: p["word"])).alias("last_word"),
        F.array_join(F.sort_array(base), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_union(base, F.transform(covered, lambda s: s["label"]))), ",").alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(best).alias("score"))
