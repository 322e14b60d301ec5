"""Benchmark decontamination by q-gram counts in diagonal bands and banded alignment (operator 2).

Texts and benchmark items are compared on their letters and digits alone (bytes A-Z lower-cased, every
other ASCII byte dropped), so case, spacing and punctuation don't hide a copy. An item of m such bytes
*leaks* into a document that holds a passage within ``edits = budget * m`` edits of the whole item. A long
item (``2 * PIECE`` bytes or more) is also looked for in overlapping pieces of ``PIECE`` bytes, each with its own
budget: whatever quotes ``3 * PIECE // 2`` bytes of it in a row holds a piece whole. An item too short for the
lemma (fewer than ``LEAST`` bytes) leaks where it stands letter for letter between word borders.

By the q-gram lemma such a passage shares at least ``m - q + 1 - edits * q`` of the item's q-grams, and
their diagonals (place in the text minus place in the item) span at most ``edits`` steps. So each
shared q-gram is counted in its item's bands of diagonals, which overlap by ``edits``; only bands that
reach the bound are regions, and each region is verified by an alignment within its band.

The items are a given query set: they are taken in blocks of at most ``BLOCK_BYTES`` of text, each of
which is compared with every document in one pass without a shuffle.

Cases: null or blank texts and items match nothing; items of one or two words with fewer than ``LEAST`` letters
and digits stand in any text and are left out; items that repeat are reported under each id; a passage of the whole
item is reported before one of a piece; rows without an id are
left out of the report and kept by ``drop_leaks`` only if clean; extra columns are kept or ignored; an
empty table on either side gives an empty report and all documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.blocks import LOWER, mix, text_bytes

Q = 12
BUDGET = 0.06
LEAST = 24
SHORT_WORDS = 3  # words that an item of fewer than LEAST letters needs
PIECE = 160
BLOCK_BYTES = 4 << 20
CHUNK = 1 << 20
MAP_BITS = 22

KEPT = np.zeros(256, dtype=bool)
KEPT[48:58] = KEPT[65:91] = KEPT[97:123] = KEPT[128:] = True


def words_of(text: str) -> list[bytes]:
    """Runs of letters and digits."""
    data = np.frombuffer(text.encode(), np.uint8)
    return np.where(KEPT[data], data, 32).astype(np.uint8).tobytes().split()


def letters(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased letters and digits, and their places in ``data``."""
    at = np.flatnonzero(KEPT[data])
    return LOWER[data[at]], at


def gram_hashes(data: np.ndarray, q: int) -> np.ndarray:
    """A hash of each q bytes (8 <= q <= 16): two overlapping 8-byte words, read as they stand."""
    n = len(data) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    data = np.ascontiguousarray(data)
    read = lambda a: np.ndarray((n,), np.uint64, data, offset=a, strides=(1,))
    return mix(read(0) * np.uint64(0x9E3779B97F4A7C15) + mix(read(q - 8), 3), 4)


class Items:
    """One block of benchmark items, indexed by q-gram."""

    def __init__(self, rows: list[tuple[int, str]], q: int, budget: float):
        self.q = q
        cleaned = [(i, t or "", letters(np.frombuffer((t or "").encode(), np.uint8))[0]) for i, t in rows]
        self.short: dict[str, list[int]] = {}
        for i, t, own in cleaned:
            if len(own) < max(LEAST, q) and len(words_of(t)) >= SHORT_WORDS:
                self.short.setdefault(own.tobytes().decode("latin-1"), []).append(i)
        self.exact = None
        if self.short:
            self.exact = ahocorasick.Automaton()
            for own in self.short:
                self.exact.add_word(own, own)
            self.exact.make_automaton()
        entries = []
        for i, _, own in cleaned:
            if len(own) >= max(LEAST, q):
                entries.append((i, own, True))
                if len(own) >= 2 * PIECE:
                    entries += [(i, own[a : a + PIECE], False) for a in (*range(0, len(own) - PIECE, PIECE // 2), len(own) - PIECE)]
        self.ids = np.array([i for i, _, _ in entries], np.int64)
        self.texts, self.whole = [t for _, t, _ in entries], [w for _, _, w in entries]
        self.size = np.array([len(t) for t in self.texts], np.int64)
        self.edits = np.minimum((self.size * budget).astype(np.int64), (self.size - q) // q)
        self.least = self.size - q + 1 - self.edits * q
        self.band = 2 * self.edits + 2
        grams = [gram_hashes(t, q) for t in self.texts]
        hashes = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        item = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        at = np.concatenate([np.arange(len(g)) for g in grams]) if grams else item
        order = np.argsort(hashes, kind="stable")
        self.item, self.at = item[order], at[order]
        self.grams, self.first, self.count = np.unique(hashes, return_index=True, return_counts=True)
        self.first = np.searchsorted(hashes[order], self.grams)
        self.map = np.zeros(1 << MAP_BITS, dtype=bool)
        self.map[self.grams >> np.uint64(64 - MAP_BITS)] = True

    def regions(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, item, first diagonal) of bands that reach the bound in letters of rows at ``offsets``."""
        hashes = gram_hashes(data, self.q)
        place = np.flatnonzero(self.map[hashes >> np.uint64(64 - MAP_BITS)])
        found = np.minimum(np.searchsorted(self.grams, hashes[place]), len(self.grams) - 1)
        same = self.grams[found] == hashes[place]
        place, found = place[same], found[same]
        row = np.searchsorted(offsets, place, side="right") - 1
        inside = place + self.q <= offsets[row + 1]
        place, found, row = place[inside], found[inside], row[inside]
        times = self.count[found]
        entry = np.repeat(self.first[found] - (np.cumsum(times) - times), times) + np.arange(times.sum())
        item = self.item[entry]
        diagonal = np.repeat(place, times) - self.at[entry] + self.size.max(initial=0)  # never negative
        row = np.repeat(row, times)
        band = diagonal // self.band[item]
        also = (diagonal % self.band[item] < self.edits[item]) & (band > 0)
        bands = int(band.max(initial=0)) + 1
        key = (row * len(self.ids) + item) * bands + band
        keys, counts = np.unique(np.concatenate([key, key[also] - 1]), return_counts=True)
        pair, band = np.divmod(keys, bands)
        row, item = np.divmod(pair, len(self.ids))
        enough = counts >= self.least[item]
        row, item, band = row[enough], item[enough], band[enough]
        return row, item, band * self.band[item] - self.size.max(initial=0)


def align(item: np.ndarray, text: np.ndarray, low: int, width: int, start: int | None = None) -> np.ndarray:
    """Edits of ``item`` against passages of ``text`` that end at ``len(item) + low + x``, x < width, within
    the diagonals ``low ... low + width - 1``; the passage begins anywhere, or at ``start``."""
    x = np.arange(width)
    far = len(item) + len(text) + 1
    here = low + x
    now = np.where((here >= 0) & (here <= len(text)) & ((here == start) if start is not None else True), 0, far)
    padded = np.concatenate([text.astype(np.int16), np.full(1, -1, np.int16)])
    for i in range(1, len(item) + 1):
        here = i + low + x
        valid = (here >= 0) & (here <= len(text))
        char = padded[np.where((here >= 1) & (here <= len(text)), here - 1, len(text))]
        step = now + (char != item[i - 1])
        step[here < 1] = far
        step[:-1] = np.minimum(step[:-1], now[1:] + 1)
        step = np.where(valid, step, far)
        now = np.minimum.accumulate(step - x) + x
        now = np.where(valid, now, far)
    return now


def exact_places(items: Items, text: np.ndarray, at: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
    """(row, id, 0, start, end) of the short items between word borders, by places in the data."""
    if items.exact is None or not len(text):
        return
    border = np.ones(len(text) + 1, dtype=bool)  # no letter stands right before this one in the row
    border[1:-1] = at[1:] != at[:-1] + 1
    border[bounds] = True
    for stop, own in items.exact.iter(text.tobytes().decode("latin-1")):
        begin, end = stop + 1 - len(own), stop + 1
        row = int(np.searchsorted(bounds, begin, side="right")) - 1
        if border[begin] and border[end] and end <= bounds[row + 1]:
            for i in items.short[own]:
                yield row, i, 0, int(at[begin]), int(at[end - 1]) + 1


def leaks(items: Items, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
    """(row, item's id, edits, start, end) of the best passage per row and item; byte places within the row."""
    text, at = letters(data)
    bounds = np.searchsorted(at, offsets)
    chosen: dict[tuple[int, int], tuple[bool, int, int, int]] = {}
    for row, i, edits, start, end in exact_places(items, text, at, bounds):
        match = (False, edits, start - int(offsets[row]), end - int(offsets[row]))
        chosen[row, i] = min(chosen.get((row, i), match), match)
    for (row, entry), match in passages(items, text, at, bounds, offsets).items():
        match, key = (not items.whole[entry], *match), (row, int(items.ids[entry]))
        chosen[key] = min(chosen.get(key, match), match)
    for (row, i), (_, *match) in sorted(chosen.items()):
        yield row, i, *match


def passages(items: Items, text: np.ndarray, at: np.ndarray, bounds: np.ndarray, offsets: np.ndarray) -> dict[tuple[int, int], tuple[int, int, int]]:
    """(edits, start, end) of the best passage per row and entry of ``items``."""
    if not len(items.ids):
        return {}
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    for row, item, diagonal in zip(*items.regions(text, bounds), strict=True):
        edits, size = int(items.edits[item]), int(items.size[item])
        if best.get((int(row), int(item)), (1,))[0] == 0:
            continue
        low = int(diagonal - bounds[row]) - edits
        width = int(items.band[item]) + 3 * edits + 1
        first, last = int(bounds[row]) + max(0, low), min(int(bounds[row]) + size + low + width, int(bounds[row + 1]))
        own, places = text[first:last], at[first:last]  # all that the band can reach
        if (exact := own.tobytes().find(items.texts[item].tobytes())) >= 0:
            best[int(row), int(item)] = (0, int(places[exact] - offsets[row]), int(places[exact + size - 1] + 1 - offsets[row]))
            continue
        low = min(low, 0)
        found = align(items.texts[item], own, low, width)
        if found.min() > edits:
            continue
        end = size + low + int(found.argmin())
        # The same alignment backwards from the end gives the beginning.
        back_low = len(own) - end - 2 * edits
        back = align(items.texts[item][::-1], own[::-1], back_low, 4 * edits + 1, start=len(own) - end)
        begin = len(own) - (size + back_low + int(back.argmin()))
        match = (int(found.min()), int(places[begin] - offsets[row]), int(places[end - 1] + 1 - offsets[row]))
        key = (int(row), int(item))
        best[key] = min(best.get(key, match), match)
    return best


def _chunks(batch: pa.RecordBatch, text_at: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    data, offsets = text_bytes(batch.column(text_at))
    row = 0
    while row < batch.num_rows:
        last = min(batch.num_rows, max(row + 1, int(np.searchsorted(offsets, offsets[row] + CHUNK, side="right")) - 1))
        yield row, data[offsets[row] : offsets[last]], offsets[row : last + 1] - offsets[row]
        row = last


def _report(items: Items):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            out = [(ids[row + i].as_py(), item, *rest) for row, data, offsets in _chunks(batch, 1) for i, item, *rest in leaks(items, data, offsets)]
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], pa.int64()) for k in range(5)], ["doc_id", "item_id", "edits", "start", "end"])
    return run


def _clean(items: Items, text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.ones(batch.num_rows, dtype=bool)
            for row, data, offsets in _chunks(batch, text_at):
                for i, *_ in leaks(items, data, offsets):
                    keep[row + i] = False
            yield batch.filter(pa.array(keep))
    return run


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str, q: int, budget: float) -> Iterator[Items]:
    """The items in blocks of bounded size."""
    rows = benchmark.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("id is not null and text is not null")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = total // BLOCK_BYTES + 1
    for b in range(blocks):
        part = rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == b)
        yield Items(sorted({(r.id, r.text) for r in part.toLocalIterator()}), q, budget)


def benchmark_leaks(documents: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", q: int = Q, budget: float = BUDGET) -> DataFrame:
    """``doc_id, item_id, edits, start, end``: the best passage of each leaked item per document
    (``start`` and ``end`` are byte places in the text)."""
    schema = "doc_id long, item_id long, edits long, start long, end long"
    texts = documents.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long"), F.col(text_col))
    out = None
    for items in item_blocks(benchmark, item_col, item_text, q, budget):
        found = texts.mapInArrow(_report(items), schema)
        out = found if out is None else out.unionByName(found)
    return out


def drop_leaks(documents: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", q: int = Q, budget: float = BUDGET) -> DataFrame:
    """The rows of ``documents`` into which no item leaks, with their own columns."""
    out = documents
    for items in item_blocks(benchmark, item_col, item_text, q, budget):
        out = out.mapInArrow(_clean(items, documents.columns.index(text_col)), documents.schema)
    return out
