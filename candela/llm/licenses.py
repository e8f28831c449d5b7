"""License scans by patience alignment.

For each license template a text can hold, stretches of the text are aligned with it: words that occur once in both
are anchors, the longest increasing subsequence of them is fixed, and the gaps between fixed anchors are aligned
in the same way (a gap without common unique words matches its equal first and last words). Coverage is the number of
aligned words over the template's words and the text words left over between the first and the last aligned one, so
that words a text adds count as much as words it lacks. A template is found where coverage reaches ``threshold``.
Where stretches of two templates share half of the lesser one or more, the closest stays: the one with the most
aligned words less those left over on both sides. A notice without a template of its own can still be near another.

Whole texts are searched. A stretch that reaches the threshold has at most (words of the template) / threshold words,
so windows of that length (and of the template's) at every word of the template hold all of them. A window is passed
over only if it lacks the words, or if it starts in a stretch that its words cannot beat; both lose no match.
Of each template all stretches that do not overlap are returned, chosen by coverage, then from the left.

Words are runs of ASCII letters, digits and characters outside ASCII, A-Z lower-cased.

Defined cases. Null or empty text: nothing is found. Null ids and repeated rows stay rows. A template without words is
refused. Ties between stretches go to the first, between templates to the name that sorts first. No templates: nothing
is found. Further columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from candela.llm.common import pick, texts_of
from candela.llm.decontaminate import NORMAL
from candela.llm.license_templates import TEMPLATES


def increasing(values: list[int]) -> list[int]:
    """Places of a longest increasing subsequence."""
    piles, tops, back = [], [], [-1] * len(values)
    for i, v in enumerate(values):
        k = bisect_left(tops, v)
        back[i] = piles[k - 1] if k else -1
        if k == len(tops):
            tops.append(v)
            piles.append(i)
        else:
            tops[k], piles[k] = v, i
    out, i = [], piles[-1] if piles else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def align(a: list, b: list) -> list[tuple[int, int]]:
    """Aligned places of two word lists."""
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        place_a, place_b = _once(a, a0, a1), _once(b, b0, b1)
        common = sorted((i, place_b[w]) for w, i in place_a.items() if w in place_b)
        fixed = [common[k] for k in increasing([j for _, j in common])]
        if not fixed:
            continue
        last_a, last_b = a0, b0
        for i, j in [*fixed, (a1, b1)]:
            todo.append((last_a, i, last_b, j))
            last_a, last_b = i + 1, j + 1
        out += fixed
    return sorted(out)


def _once(words: list, start: int, stop: int) -> dict:
    """Place of each word that occurs once in the stretch."""
    place: dict = {}
    for i in range(start, stop):
        place[words[i]] = i if words[i] not in place else -1
    return {w: i for w, i in place.items() if i >= 0}


def closest_run(pairs: list[tuple[int, int]], n: int) -> tuple[float, int, int, int]:
    """Coverage of a template of n words by the best run of aligned pairs, its first and last text place and number of pairs."""
    at = np.array([i for i, _ in pairs], np.int64)
    if at[-1] - at[0] + 1 == len(at):
        return len(at) / n, int(at[0]), int(at[-1]), len(at)
    k = np.arange(len(at))
    aligned = k[None, :] - k[:, None] + 1
    extra = at[None, :] - at[:, None] + 1 - aligned
    share = np.where(aligned > 0, aligned / (n + np.maximum(extra, 0)), 0.0)
    i, j = divmod(int(share.argmax()), len(at))
    return float(share[i, j]), int(at[i]), int(at[j]), j - i + 1


def _apart(stretches: list) -> list:
    """The stretches (coverage, first, last, ...) that overlap none before them."""
    first, out = [], []  # sorted by place
    for f in stretches:
        k = bisect_left(first, f[1])
        if (k == 0 or out[k - 1][2] < f[1]) and (k == len(out) or f[2] < out[k][1]):
            first.insert(k, f[1])
            out.insert(k, f)
    return out


class Scanner:
    def __init__(self, templates: dict[str, str], threshold: float):
        self.templates = {n: t.encode().translate(NORMAL).split() for n, t in sorted(templates.items())}
        if not all(self.templates.values()) or not 0 < threshold <= 1:
            raise ValueError("templates need words, the threshold lies above 0 up to 1")
        self.threshold = threshold
        self.known = {w: i for i, w in enumerate(sorted({w for t in self.templates.values() for w in t}))}
        self.count = np.zeros((len(self.known), len(self.templates)), np.int64)
        for k, t in enumerate(self.templates.values()):
            for w in t:
                self.count[self.known[w], k] += 1
        self.need = np.array([threshold * len(t) - 1e-9 for t in self.templates.values()])

    def _stretches(self, words: list, places: dict, k: int, template: list) -> list[tuple[float, int, int, int]]:
        """(coverage, first and last word, aligned words) of stretches that reach the threshold, the closest first."""
        n, wide = len(template), int(len(template) / self.threshold + 1e-9)
        own = {w: places[i] for w in set(template) if (i := self.known[w]) in places}
        starts = np.sort(np.concatenate(list(own.values())))
        most = np.zeros(len(starts), np.int64)  # how many words of the template the window holds
        for w, at in own.items():
            most += np.minimum(np.searchsorted(at, starts + wide) - np.searchsorted(at, starts), self.count[self.known[w], k])
        live = np.flatnonzero(most >= self.need[k])
        found, best = set(), np.zeros(len(starts))  # best: coverage of the best stretch over each start
        for s in live[np.argsort(-most[live], kind="stable")].tolist():
            if best[s] >= most[s] / n:
                continue
            at = int(starts[s])
            for size in sorted({n, wide}):
                pairs = align(words[at : at + size], template)
                if len(pairs) < self.need[k]:
                    continue
                share, first, last, aligned = closest_run(pairs, n)
                if share >= self.threshold - 1e-9:
                    found.add((share, at + first, at + last, aligned))
                    a, b = np.searchsorted(starts, (at + first, at + last + 1))
                    best[a:b] = np.maximum(best[a:b], share)
        return sorted(found, key=lambda f: (-f[0], f[1], f[2]))

    def scan(self, text: bytes) -> list[tuple[str, float, int, int]]:
        """(template, coverage, first and last aligned word of the text) of every stretch found, by template and place."""
        return [f[1:] for f in sorted(self.found(text), key=lambda f: (f[1], f[3]))]

    def found(self, text: bytes) -> list[tuple[int, str, float, int, int]]:
        """As ``scan``, each with its closeness in front; the closest first."""
        words = text.translate(NORMAL).split()
        places: dict = {}
        for i, w in enumerate(words):
            if w in self.known:
                places.setdefault(self.known[w], []).append(i)
        if not places:
            return []
        can = self.count[list(places)].sum(axis=0) >= self.need
        if not can.any():
            return []
        places = {w: np.array(at, np.int64) for w, at in places.items()}
        every = []
        for k, (name, template) in enumerate(self.templates.items()):
            if can[k]:
                for share, first, last, aligned in _apart(self._stretches(words, places, k, template)):
                    every.append((3 * aligned - len(template) - (last - first + 1), name, share, first, last))
        every.sort(key=lambda f: (-f[0], f[1], f[3]))
        longest = max((f[4] - f[3] + 1 for f in every), default=0)
        first, kept, out = [], [], []  # kept: sorted by place
        for f in every:
            near = kept[bisect_left(first, f[3] - longest) : bisect_left(first, f[4] + 1)]
            if not any(g[1] != f[1] and 2 * (min(f[4], g[4]) - max(f[3], g[3]) + 1) >= f[4] - f[3] + 1 for g in near):
                k = bisect_left(first, f[3])
                first.insert(k, f[3])
                kept.insert(k, f)
                out.append(f)
        return out


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, str] | None = None, threshold: float = 0.8) -> DataFrame:
    """Per row: id, matches (array of template, coverage, first_word, last_word; every place, by template and place), license (the closest
    template) and coverage (its own; 0 without a match)."""
    templates = TEMPLATES if templates is None else templates

    def run(batches):
        scanner = Scanner(templates, threshold)
        kind = pa.list_(pa.struct([("template", pa.string()), ("coverage", pa.float64()), ("first_word", pa.int64()), ("last_word", pa.int64())]))
        for batch in batches:
            found = [scanner.found(t) for t in texts_of(batch.column(1))]
            best = [f[0][1:3] if f else (None, 0.0) for f in found]
            rows = [[dict(zip(("template", "coverage", "first_word", "last_word"), m[1:])) for m in sorted(f, key=lambda m: (m[1], m[3]))] for f in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kind), pa.array([b[0] for b in best], pa.string()), pa.array([b[1] for b in best], pa.float64())],
                                             names=[id_col, "matches", "license", "coverage"])

    Scanner(templates, threshold)  # refuse bad parameters before any task
    return pick(docs, **{id_col: "long", text_col: "string"}).mapInArrow(
        run, f"{id_col} long, matches array<struct<template:string,coverage:double,first_word:long,last_word:long>>, license string, coverage double")
