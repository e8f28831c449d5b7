"""License notices: each finds its own template, not that of a sibling."""

import numpy as np
import pytest

from candela.llm import licenses

SIBLINGS = {
    "lgpl-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "agpl-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "agpl-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as "
                       "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl-2.0-header": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as "
                      "published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "cc-by-nc-4.0-notice": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "cc-by-sa-4.0-short": "Licensed under CC BY-SA 4.0.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
               "file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "isc": "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above "
           "copyright notice and this permission notice appear in all copies.",
    "unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or "
                 "distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
}


def test_each_notice_finds_its_own_template():
    scanner = licenses.Scanner(licenses.TEMPLATES, 0.8)
    texts = {name: b" ".join(words).decode() for name, words in scanner.templates.items()}
    assert len(set(texts.values())) == len(texts)
    for name, text in [*texts.items(), *SIBLINGS.items()]:
        found = scanner.found(f"some words before it. {text} And some after it".encode())
        assert found[0][1] == name and found[0][2] > 0.9, (name, found)


@pytest.mark.parametrize("name", SIBLINGS)
def test_sibling_in_the_query(spark, name):
    row = licenses.scan(spark.createDataFrame([(1, SIBLINGS[name])], "doc_id long, text string")).first()
    assert row.license == name and [m.template for m in row.matches] == [name]


def test_words_the_text_adds_count():
    scanner = licenses.Scanner({"x": "one two three four five six seven eight"}, 0.8)
    assert scanner.scan(b"zero one two three four five six seven eight nine") == [("x", 1.0, 1, 8)]
    assert scanner.scan(b"one two three new four five six seven eight") == [("x", 8 / 9, 0, 8)]
    assert scanner.scan(b"one two three some new words here four five six seven eight") == []
    assert scanner.scan(b"eight and much else before one two three four five six seven 8") == [("x", 7 / 8, 5, 11)]


def plain_hits(words, template, threshold):
    """(coverage, first, last) by plain alignment of the stretches at every word offset, nothing passed over."""
    n, out = len(template), set()
    for at in range(len(words)):
        for size in {n, int(n / threshold + 1e-9)}:
            pairs = licenses.align(words[at : at + size], template)
            best = (0.0, 0, 0)
            for i in range(len(pairs)):
                for j in range(i, len(pairs)):
                    share = (j - i + 1) / (n + pairs[j][0] - pairs[i][0] - (j - i))
                    if share > best[0]:
                        best = (share, at + pairs[i][0], at + pairs[j][0])
            if best[0] >= threshold - 1e-9:
                out.add(best)
    return out


def test_scan_against_plain_alignment_at_every_offset():
    r = np.random.default_rng(11)
    templates = {"short": "a b c d e", "repeats": "x y x z y x w v", "long": " ".join(f"l{i % 17}" for i in range(24))}
    for k in range(60):
        name = list(templates)[k % 3]
        template, words = templates[name].encode().split(), []
        for _ in range(r.integers(1, 6)):
            notice = list(template)
            for _ in range(r.integers(0, 3)):
                i = int(r.integers(0, len(notice)))
                notice[i : i + int(r.integers(0, 2))] = [b"other"] * int(r.integers(0, 2))
            words += [bytes(w) for w in r.choice(template + [b"filler"] * 5, r.integers(0, 6))] + notice
        scanner = licenses.Scanner({name: templates[name]}, 0.8)
        got = [m[1:] for m in scanner.scan(b" ".join(words))]
        want = plain_hits(words, template, 0.8)
        chosen = []
        for f in sorted(want, key=lambda f: (-f[0], f[1], f[2])):
            if all(f[2] < g[1] or g[2] < f[1] for g in chosen):
                chosen.append(f)
        assert got == sorted(chosen, key=lambda f: f[1]), (k, words)


def test_every_place_of_a_notice():
    mit, gpl = licenses.TEMPLATES["mit"], licenses.TEMPLATES["gpl-3.0"]
    text = f"{mit} some words {gpl} {mit.upper()} {mit} more words {gpl.replace('work', 'book')}"
    got = licenses.Scanner(licenses.TEMPLATES, 0.8).scan(text.encode())
    assert [(m[0], m[2], m[3]) for m in got] == [("gpl-3.0", 7, 18), ("gpl-3.0", 31, 42), ("mit", 0, 4), ("mit", 19, 23), ("mit", 24, 28)]
    assert [m[1] for m in got] == [1.0, 11 / 13, 1.0, 1.0, 1.0]
