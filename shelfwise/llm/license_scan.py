"""License scans by patience alignment (operator 7).

Words are letter-or-digit runs, lower-cased. A template is *found* where a passage covers at least
``percent`` of its words in order, with at most a quarter as many other words (and two) between a rare word and
the passage's ends as the template has words. (A wider window is no better: words that occur in it once more are no
anchors any longer.) Any such passage holds one of the template's rarest words: of any
``n - ceil(percent * n / 100) + 1`` template places one must be covered. These places are chosen by the
words' counts over all documents, so few windows are looked at. Each window is aligned with the template:
words unique in both are anchors, their longest increasing subsequence is kept, and the gaps between
(after common beginnings and ends) are aligned the same way. Coverage is the matched share of the
template's words.

Cases: null or blank texts and templates match nothing; equal templates are reported under each id; rows
without an id are left out; repeated rows are reported each; of several passages the best coverage, then
the first, is reported; extra columns are ignored; an empty table on either side gives no rows.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Notices and license passages.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "all-rights-reserved": "All rights reserved.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    "ISC-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."),
}
PERCENT = 80
_WORDS = re.compile(r"[^\W_]+")


def words_of(text: str | None) -> list[str]:
    return _WORDS.findall((text or "").lower())


def increasing(values: list[int]) -> list[int]:
    """Indices of a longest increasing subsequence (patience piles)."""
    tops, at, before = [], [], []
    for i, v in enumerate(values):
        k = bisect_left(tops, v)
        before.append(at[k - 1] if k else -1)
        tops[k:k + 1], at[k:k + 1] = [v], [i]
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def patience(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Matched places (in a, in b), increasing in both."""
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        i, i_end, j, j_end = todo.pop()
        while i < i_end and j < j_end and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        while i < i_end and j < j_end and a[i_end - 1] == b[j_end - 1]:
            i_end, j_end = i_end - 1, j_end - 1
            out.append((i_end, j_end))
        if i == i_end or j == j_end:
            continue
        in_a, in_b = Counter(a[i:i_end]), Counter(b[j:j_end])
        place = {w: k for k, w in enumerate(b[j:j_end], j) if in_b[w] == 1}
        unique = [(k, place[w]) for k, w in enumerate(a[i:i_end], i) if in_a[w] == 1 and w in place]
        kept = [unique[k] for k in increasing([q for _, q in unique])]
        if not kept:
            continue
        out += kept
        for (p, q), (p_end, q_end) in zip([(i - 1, j - 1), *kept], [*kept, (i_end, j_end)], strict=True):
            todo.append((p + 1, p_end, q + 1, q_end))
    return sorted(out)


class Templates:
    def __init__(self, templates: dict[str, str], percent: int, counts: dict[str, int]):
        self.words = {k: w for k, t in sorted(templates.items()) if (w := words_of(t))}
        self.percent = percent
        self.seeds: dict[str, list[tuple[str, int]]] = {}  # word: (template, place)
        for name, words in self.words.items():
            room = len(words) - -(-percent * len(words) // 100) + 1
            for place in sorted(range(len(words)), key=lambda p: (counts.get(words[p], 0), words[p], p))[:room]:
                self.seeds.setdefault(words[place], []).append((name, place))

    def scan(self, text: str | None) -> list[tuple[str, int, int, int, int]]:
        """(template, matched, words, first word, end word) of the best passage of each template found."""
        words, best, seen = words_of(text), {}, set()
        for at, word in enumerate(words):
            for name, place in self.seeds.get(word, ()):
                template = self.words[name]
                slack = len(template) // 4 + 2
                begin, end = max(0, at - place - slack), at - place + len(template) + slack
                if (name, at - place) in seen:  # not begin: near the text's start it is 0 for windows with different ends
                    continue
                seen.add((name, at - place))
                match = patience(words[begin:end], template)
                if 100 * len(match) >= self.percent * len(template):
                    found = (-len(match), begin + match[0][0], begin + match[-1][0] + 1)
                    best[name] = min(best.get(name, found), found)
        return [(name, -m, len(self.words[name]), first, end) for name, (m, first, end) in sorted(best.items())]


def _counts(vocabulary: frozenset[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = Counter()
        for batch in batches:
            for text in batch.column(0):
                total.update(w for w in words_of(text.as_py()) if w in vocabulary)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "c"])
    return run


def _scan(templates: Templates):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(i, *found) for i, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True) for found in templates.scan(text.as_py())]
            types = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate(types)], ["doc_id", "license", "matched", "template_words", "first_word", "end_word"])
    return run


def license_scan(documents: DataFrame, templates: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """``doc_id, license, matched, template_words, first_word, end_word``: the best passage of each template found."""
    templates = TEMPLATES if templates is None else templates
    texts = documents.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long"), F.col(text_col))
    vocabulary = frozenset(w for t in templates.values() for w in words_of(t))
    counts = documents.select(F.col(text_col)).mapInArrow(_counts(vocabulary), "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))
    known = {r.word: r.c for r in counts.collect()}  # at most one row per template word
    return texts.mapInArrow(_scan(Templates(templates, percent, known)), "doc_id long, license string, matched long, template_words long, first_word long, end_word long")
