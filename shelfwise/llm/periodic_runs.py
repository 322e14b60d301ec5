"""Periodic runs of words by a suffix automaton with link-cut access (operator 11).

A *run* is a stretch of consecutive words with smallest period ``q`` and a length of at least
``max(least, 2 * q)`` that no neighbouring word extends with the same period. The method, per text:

1. words are appended one by one to a suffix automaton. Its suffix links form a tree; a link-cut
   structure keeps each root path whose states were last seen at one place as one splay tree, coloured
   with the end of that occurrence. Appending word ``i`` *accesses* the new state: the segments of its
   root path are recoloured to ``i``, in all O(n log n) times for a text;
2. a segment with colour ``e`` and lengths ``(l, m]`` says that the suffixes of these lengths ended at
   ``e`` before, and longer ones did not. With ``q = i - e`` and ``l < q <= m`` a square of period ``q`` ends at
   ``i``, and its root is primitive (the root of a power would have been seen later than ``e``). The longest
   common suffix is exactly ``m``, so ``m == q`` holds at the one place where a run's first square ends:
   this gives its start, and comparing on gives its end.

Only words near a repetition go through the automaton. A run of length ``n >= 2 * q`` holds
``n - q - k + 1 >= q - k + 1`` consecutive places whose ``k`` words (``k = least // 2``) stand again at most
``q`` words earlier; numpy finds all places whose last equal ``k`` words are no farther than their stretch of
such places allows, by hashes. Unequal hashes prove that nothing repeats, and equal ones only send
more words to the automaton, which compares the words themselves: no run is lost or made up.

Each text is worked on whole in one task, without a shuffle. Memory: about 12 bytes per byte of the
longest text, and 80 per word that goes through the automaton; a text of 50 MB fits a worker.

Cases: null, empty and blank texts have no words, no runs and an empty collapsed text. Null ids and
rows that share an id are returned like any other row. Extra columns are ignored. An empty table gives
an empty result.
"""

from __future__ import annotations

from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.blocks import mix, prefix_hashes, span_hashes, text_chunks, word_spans

SLICE = 1 << 20
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def runs_of(words: list[int], least: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a list of word numbers, by start, then period."""
    n = len(words)
    size = 2 * n + 2
    blank = array("i", [-1]) * size
    # States: length, suffix link, first transition (most states have one), others in ``more``.
    length, link, symbol, target = array("i", bytes(4 * size)), blank[:], blank[:], blank[:]
    more: dict[int, dict[int, int]] = {}
    # Splay trees of the paths; ``up`` of a tree's root is the state above the path. ``last`` counts at roots.
    left, right, up, last = blank[:], blank[:], blank[:], blank[:]

    def step(state: int, word: int) -> int:
        if symbol[state] == word:
            return target[state]
        others = more.get(state)
        return -1 if others is None else others.get(word, -1)

    def lead(state: int, word: int, to: int) -> None:
        if symbol[state] < 0 or symbol[state] == word:
            symbol[state], target[state] = word, to
        else:
            more.setdefault(state, {})[word] = to

    def rotate(x: int) -> None:
        p = up[x]
        g = up[p]
        if left[p] == x:
            inner = right[x]
            left[p], right[x] = inner, p
        else:
            inner = left[x]
            right[p], left[x] = inner, p
        if inner >= 0:
            up[inner] = p
        up[p], up[x] = x, g
        if g >= 0:
            if left[g] == p:
                left[g] = x
            elif right[g] == p:
                right[g] = x

    def splay(x: int) -> None:
        while (p := up[x]) >= 0 and (left[p] == x or right[p] == x):
            g = up[p]
            if g >= 0 and (left[g] == p or right[g] == p):
                last[x] = last[g]
                rotate(p if (left[p] == x) == (left[g] == p) else x)
            else:
                last[x] = last[p]
            rotate(x)

    out, states, end = [], 1, 0
    for i in range(n):
        word = words[i]
        new, states = states, states + 1
        length[new] = i + 1
        p = end
        while p >= 0 and step(p, word) < 0:
            lead(p, word, new)
            p = link[p]
        if p < 0:
            link[new] = 0
        else:
            q = step(p, word)
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                clone, states = states, states + 1
                length[clone], link[clone] = length[p] + 1, link[q]
                symbol[clone], target[clone] = symbol[q], target[q]
                if q in more:
                    more[clone] = more[q].copy()
                link[q] = link[new] = clone
                while p >= 0 and step(p, word) == q:
                    lead(p, word, clone)
                    p = link[p]
                # The clone was last seen with q and stands right above it on q's path.
                splay(q)
                above = left[q]
                left[clone], up[clone], left[q] = above, q, clone
                if above >= 0:
                    up[above] = clone
        # Access: every path segment above the new state gets the colour i.
        up[new] = link[new]
        child, state = new, link[new]
        segment = None
        while state >= 0:
            splay(state)
            seen, below = last[state], right[state]
            if below >= 0:
                last[below] = seen
            right[state] = child
            if segment is not None and length[state] < segment[0]:
                out.append(segment[1])
            period = i - seen
            # The first square of a run ends here if no shorter suffix than the period was seen as late.
            segment = (period, (i - 2 * period + 1, period)) if length[state] == period else None
            child, state = state, up[state]
        if segment is not None:
            out.append(segment[1])
        last[child] = i
        end = new

    runs = []
    for start, period in out:
        stop = start + 2 * period
        while stop < n and words[stop] == words[stop - period]:
            stop += 1
        if stop - start >= least:
            runs.append((start, stop - start, period))
    return sorted(runs, key=lambda r: (r[0], r[2]))


def _word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each word, some megabytes at a time."""
    out, at = np.zeros(len(start), np.uint64), 0
    while at < len(start):
        stop = max(at + 1, int(np.searchsorted(end, start[at] + SLICE, side="right")))
        low, high = start[at], end[stop - 1]
        out[at:stop] = mix(span_hashes(prefix_hashes(data[low:high]), start[at:stop] - low, end[at:stop] - low), 1)
        at = stop
    return out


def repeated_regions(hashes: np.ndarray, bounds: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Disjoint ranges of words, none across ``bounds``, that hold every run whole."""
    k = max(1, least // 2)
    room = len(hashes) - k + 1
    if room <= 0:
        return []
    grams = hashes[:room].copy()
    for j in range(1, k):
        grams = mix(grams * np.uint64(3) + hashes[j : j + room], 2)
    row = np.searchsorted(bounds, np.arange(room), side="right") - 1
    inside = np.arange(room) + k <= bounds[row + 1]
    grams += mix(row.astype(np.uint64), 3)
    order = np.argsort(grams, kind="stable")
    equal = np.flatnonzero(grams[order[1:]] == grams[order[:-1]])
    at, before = order[equal + 1], order[equal]
    fine = inside[at] & (row[at] == row[before])
    place = np.argsort(at[fine])
    at, gap = at[fine][place], (at[fine] - before[fine])[place]
    for _ in range(4):
        if not len(at):
            return []
        edges = np.flatnonzero((np.diff(at) != 1) | (row[at[1:]] != row[at[:-1]])) + 1
        begins, ends = np.r_[0, edges], np.r_[edges, len(at)]
        keep = gap <= np.repeat(ends - begins, ends - begins) + k - 1
        if keep.all():
            break
        at, gap = at[keep], gap[keep]
    edges = np.flatnonzero((np.diff(at) != 1) | (row[at[1:]] != row[at[:-1]])) + 1 if len(at) else []
    out: list[tuple[int, int]] = []
    for a, b in zip(np.r_[0, edges].astype(int), np.r_[edges, len(at)].astype(int), strict=True):
        if a == b:
            continue
        low = max(int(at[a]) - (b - a + k - 1), int(bounds[row[at[a]]]))
        high = int(at[b - 1]) + k
        while out and out[-1][1] > low and out[-1][0] >= bounds[row[at[a]]]:
            low = min(low, out.pop()[0])
        out.append((low, high))
    return out


def _scan(least: int, view: Callable | None):
    def rows(chunk, ids) -> dict:
        data, offsets = chunk.data, chunk.offsets
        start, end, row = word_spans(data, offsets)
        hashes = _word_hashes(data, start, end)
        bounds = np.searchsorted(row, np.arange(len(chunk.ids) + 1))
        views = {}
        if view is not None:  # the same words in another order
            parts = []
            for r in range(len(chunk.ids)):
                a, n = int(bounds[r]), int(bounds[r + 1] - bounds[r])
                if n and (own := view(ids[r], n)) is not None:
                    views[r] = own
                parts.append(a + views[r] if r in views else np.arange(a, a + n))
            if views:
                index = np.concatenate(parts)
                start, end, hashes = start[index], end[index], hashes[index]
                bounds = np.r_[0, np.cumsum([len(p) for p in parts])]
        found: dict[int, list] = {}
        text = data.tobytes()
        for low, high in repeated_regions(hashes, bounds, least):
            numbers: dict[bytes, int] = {}
            words = [numbers.setdefault(text[a:b], len(numbers)) for a, b in zip(start[low:high].tolist(), end[low:high].tolist(), strict=True)]
            r = int(np.searchsorted(bounds, low, side="right")) - 1
            shift = low - int(bounds[r])
            found.setdefault(r, []).extend((s + shift, n, q) for s, n, q in runs_of(words, least))
        out = {"n_words": np.diff(bounds).tolist(), "runs": [], "collapsed": []}
        for r in range(len(chunk.ids)):
            runs = sorted(found.get(r, ()), key=lambda x: (x[0], x[2]))
            if runs or r in views:
                a, n = int(bounds[r]), int(bounds[r + 1] - bounds[r])
                gone = np.zeros(n + 1, np.int64)
                for s, size, q in runs:
                    gone[s + q] += 1
                    gone[s + size] -= 1
                kept = a + np.flatnonzero(np.cumsum(gone)[:n] == 0)
                out["collapsed"].append(b" ".join([text[x:y] for x, y in zip(start[kept].tolist(), end[kept].tolist(), strict=True)]))
            else:
                out["collapsed"].append(b" ".join(text[offsets[r] : offsets[r + 1]].split()))
            out["runs"].append([{"start": s, "length": size, "period": q} for s, size, q in runs])
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for chunk in text_chunks(batches):
            ids = chunk.rows.column(0).slice(chunk.first, len(chunk.ids))
            out = rows(chunk, ids.to_pylist())
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(out["n_words"], pa.int64()), pa.array(out["runs"], kind), pa.array(out["collapsed"], pa.binary()).cast(pa.string())],
                ["doc_id", "n_words", "runs", "collapsed"])
    return run


def periodic_runs(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 12,
                  view: Callable[[int | None, int], np.ndarray | None] | None = None) -> DataFrame:
    """One row per document row: ``doc_id, n_words, runs, collapsed``.

    ``runs`` lists (start, length, period) in words by start, then period. ``collapsed`` joins by one space
    the words that no run holds after its first period. ``view(id, n)`` may name, for a text of n words,
    the words to read instead (as numbers of its words, in order); None reads them as they are.
    """
    texts = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return texts.mapInArrow(_scan(least, view), f"doc_id long, n_words long, runs {RUNS}, collapsed string")
