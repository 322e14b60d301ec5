"""Removal of repeated byte strings with a hash-compared suffix sort (operator 5).

Every byte that lies in a ``length``-byte string which also starts earlier (smaller id, or same text
and smaller offset) goes; texts are UTF-8 bytes and no string crosses a text's end. All strings are
judged on the input.

Sorting every suffix of a corpus would move its text many times over, so the sort gets only suffixes
that can matter:

1. *Anchors.* Of the ``gram``-byte strings inside each ``length``-byte string, those with the least
   hash are anchors (winnowing). Equal strings choose equal anchors, so two equal ``length``-byte
   strings always meet at an anchor. An anchor's *context* is all text that any string through it
   can cover. Tasks send (anchor hash, context hash, id, offset), first copies only.
2. Anchors with equal contexts are equal in every string through them: all but the earliest are
   covered whole. Contexts are compared by a 64-bit hash without structure (``lane_hashes``) beside the
   anchor's own, 128 bits of two kinds. Anchors whose hash has several contexts need the exact comparison.
3. For those, the context's bytes are fetched, and the suffixes that start at the anchors are sorted
   by a mergesort whose comparisons find the longest common extension by binary search over prefix
   polynomial hashes; the reversed texts before the anchors likewise. Neighbours' extensions are then
   verified byte by byte (a collision leads to a plain sort of the bytes). For each offset d of the
   anchor within a string, blocks of suffixes that share ``length - d`` bytes and of prefixes that
   share d bytes give the classes of equal strings; all but the earliest of a class are covered.
   Hashes with very many contexts (a short phrase in a large part of the corpus) are dealt by the
   string itself instead. Of equal strings (bytes compared) a task sends only the earliest of each
   ``FLUSH // 10``, the others are covered; what is left meets by salted hash first, where again the
   earliest stays, then by hash: a string gives a task at most one row per bucket.
4. The covered ranges meet their text, per document.

Cases: null text counts as empty; rows with a null id are left out; rows that share an id count as
the same document; extra columns are kept (``strip_repeats``) or ignored; an empty table gives an
empty result; texts shorter than ``length`` bytes keep every byte.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.blocks import (
    bounded_batches,
    bucket_of,
    deltas,
    hand_off,
    lane_hashes,
    mix,
    pack,
    prefix_hashes,
    row_prefix_hashes,
    shuffle_partitions,
    slices,
    span_hashes,
    text_bytes,
    text_chunks,
    unpack,
    unused,
)

LENGTH = 100
GRAM = 40
CHUNK = 1 << 18
FLUSH = 300_000  # anchors a task gathers before it sends blocks
BYTES_PER_BUCKET = 16 << 20
RUN = 16_000  # suffixes sorted at a time
MANY = 20_000  # contexts of one anchor hash in a bucket beyond which strings are dealt singly


def _sliding(op, values: np.ndarray, width: int) -> np.ndarray:
    """op over each run of ``width`` values, by doubling."""
    out, size = values, 1
    while 2 * size <= width:
        out = op(out[:-size], out[size:])
        size *= 2
    rest = width - size
    return op(out[: len(out) - rest], out[rest:]) if rest else out


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """Offsets in ``data`` of the anchors, with their hashes and row numbers."""
    prefix = prefix_hashes(data)
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none.astype(np.uint64), none
    width = length - gram + 1
    at = np.arange(len(data) - gram + 1)
    grams = mix(span_hashes(prefix, at, at + gram), 5) | np.uint64(1)
    least = _sliding(np.minimum, grams, width)
    ends = offsets[1:][np.searchsorted(offsets, at[: len(least)], side="right") - 1] if len(offsets) > 2 else np.full(len(least), len(data))
    least[at[: len(least)] + length > ends] = 0
    pad = np.zeros(width - 1, np.uint64)
    chosen = np.flatnonzero(_sliding(np.maximum, np.concatenate([pad, least, pad]), width) == grams)
    # Anchors are minima, so their hashes lie low: mixed again they fill the buckets evenly.
    return chosen, mix(grams[chosen], 6), np.searchsorted(offsets, chosen, side="right") - 1


def _same_as_before(*keys: np.ndarray) -> np.ndarray:
    same = np.ones(len(keys[0]), dtype=bool)
    same[:1] = False
    for k in keys:
        same[1:] &= k[1:] == k[:-1]
    return same


def _firsts(hashes, contexts, docs, at):
    """Order by (hash, context, id, offset), which of them are first of their context, which are covered."""
    order = np.lexsort((at, docs, contexts, hashes))
    hashes, contexts, docs, at = hashes[order], contexts[order], docs[order], at[order]
    again = _same_as_before(hashes, contexts)
    head = np.maximum.accumulate(np.where(again, 0, np.arange(len(order))))
    covered = again & ~((docs == docs[head]) & (at == at[head]))
    return hashes, contexts, docs, at, ~again, covered


def _send(length: int, gram: int, buckets: int):
    before, after = length - gram, length

    def blocks(parts: list) -> pa.RecordBatch:
        hashes, contexts, docs, at, first, covered = _firsts(*(np.concatenate(x) for x in zip(*parts, strict=True)))
        keys, data = [], []
        for bucket, a, b in slices(bucket_of(hashes, buckets)):
            f, c = np.flatnonzero(first[a:b]) + a, np.flatnonzero(covered[a:b]) + a
            own, index = np.unique(docs[f], return_inverse=True)
            keys.append(bucket)
            data.append(pack(deltas(hashes[f]), contexts[f], index.astype(np.uint32), own, at[f].astype(np.uint32), docs[c], at[c].astype(np.uint32)))
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array(data, pa.binary())], ["bucket", "data"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for chunk in text_chunks(batches, CHUNK):
            at, hashes, row = anchors(chunk.data, chunk.offsets, length, gram)
            if not len(at):
                continue
            begin, end = chunk.offsets[row], chunk.offsets[row + 1]
            left, right = np.maximum(begin, at - before), np.minimum(end, at + after)
            contexts = mix(lane_hashes(chunk.data, left, right, 70) + mix((at - left).astype(np.uint64) * np.uint64(1000) + (right - at).astype(np.uint64), 8), 9)
            parts.append((hashes, contexts, chunk.ids[row].astype(np.int64), at - begin))
            held += len(at)
            if held >= FLUSH:
                yield blocks(parts)
                parts, held = [], 0
        if parts:
            yield blocks(parts)
    return run


def _classes(parts: int):
    """Blocks of one anchor bucket to blocks, by document, of covered and of undecided anchors."""
    def run(group: pa.Table) -> pa.Table:
        got = [unpack(b.as_buffer()) for b in group.column("data")]
        hashes = np.concatenate([np.cumsum(g[0], dtype=np.uint64) for g in got])
        contexts = np.concatenate([g[1] for g in got])
        docs = np.concatenate([g[3][g[2]] for g in got])
        at = np.concatenate([g[4] for g in got]).astype(np.int64)
        hashes, contexts, docs, at, first, covered = _firsts(hashes, contexts, docs, at)
        hashes_f = hashes[first]
        new = ~_same_as_before(hashes_f)
        counts = np.diff(np.r_[np.flatnonzero(new), len(hashes_f)])
        several = np.repeat(counts, counts)
        u = np.flatnonzero(first)[several > 1]
        many = (several[several > 1] > MANY).astype(np.uint8)
        docs_c, at_c = np.concatenate([docs[covered], *[g[5] for g in got]]), np.concatenate([at[covered], *[g[6] for g in got]]).astype(np.int64)
        docs_all, at_all = np.concatenate([docs_c, docs[u]]), np.concatenate([at_c, at[u]])
        what = np.concatenate([np.zeros(len(docs_c), np.uint8), 1 + many])
        anchor = np.concatenate([np.zeros(len(docs_c), np.uint64), hashes[u]])
        part = bucket_of(mix(docs_all.view(np.uint64), 7), parts)
        order = np.argsort(part, kind="stable")
        keys, data = [], []
        for key, a, b in slices(part[order]):
            s = order[a:b]
            keys.append(key)
            data.append(pack(docs_all[s], at_all[s].astype(np.uint32), what[s], anchor[s]))
        return pa.table({"part": pa.array(keys, pa.int32()), "data": pa.array(data, pa.binary())})
    return run


def _per_document(group: pa.Table) -> pa.Table:
    docs, at, what, anchor = (np.concatenate(x) for x in zip(*[unpack(b.as_buffer()) for b in group.column("data")], strict=True))
    order = np.lexsort((at, docs))
    docs, at, what, anchor = docs[order], at[order], what[order], anchor[order]
    edges = np.r_[0, np.flatnonzero(np.diff(docs)) + 1, len(docs)]
    out = {"doc_id": [], "covered": [], "open": []}
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        c = what[a:b] == 0
        out["doc_id"].append(int(docs[a]))
        out["covered"].append(pack(np.unique(at[a:b][c])) if c.any() else None)
        out["open"].append(None if c.all() else pack(at[a:b][~c], what[a:b][~c], anchor[a:b][~c]))
    return pa.table({"doc_id": pa.array(out["doc_id"], pa.int64()), "covered": pa.array(out["covered"], pa.binary()), "open": pa.array(out["open"], pa.binary())})


FEW, STRINGS, RANGES = 0, 1, 2  # kinds of blocks: contexts of an anchor, single strings, covered ranges


def _earliest(keys, docs, start, body):
    """Of strings with equal bytes (equal keys, verified) the earliest: indices of those, and of the covered others."""
    def firsts(*more):
        order = np.lexsort((start, docs, *more, keys))
        again = _same_as_before(keys[order], *(m[order] for m in more))
        return order, again, order[np.maximum.accumulate(np.where(again, 0, np.arange(len(order))))]

    order, again, head = firsts()
    if any((body[order[a : a + RUN]] != body[head[a : a + RUN]]).any() for a in range(0, len(order), RUN)):  # a collision of hashes
        order, again, head = firsts(np.unique(np.ascontiguousarray(body).view(f"V{body.shape[1]}").reshape(-1), return_inverse=True)[1])
    return order[~again], order[again & ~((docs[order] == docs[head]) & (start[order] == start[head]))]


def _runs(docs, start, length: int):
    """(id, start, end) of the ranges that strings at ``start`` cover, touching ones joined."""
    order = np.lexsort((start, docs))
    docs, start = docs[order], start[order]
    new = ~_same_as_before(docs)
    new[1:] |= start[1:] > start[:-1] + length
    return docs[new], start[new], start[np.r_[new[1:], np.ones(min(1, len(new)), bool)]] + length


def _by_bucket(kind: int, bucket: np.ndarray, *columns: np.ndarray) -> Iterator[tuple[int, bytes]]:
    order = np.argsort(bucket, kind="stable")
    for key, a, b in slices(bucket[order]):
        yield key, pack(np.array([kind], np.uint8), *[x[order[a:b]].reshape(-1) for x in columns])


def _strings(keys, docs, start, body, length: int, buckets: int) -> Iterator[tuple[int, bytes]]:
    """Blocks of the earliest of equal strings, by salted key, and of the ranges the others cover."""
    kept, gone = _earliest(keys, docs, start, body)
    salt = mix((docs[:1] ^ start[:1]).view(np.uint64), 61)
    bucket = bucket_of(mix(keys[kept] ^ salt, 62), buckets)
    yield from _by_bucket(STRINGS, bucket, keys[kept], docs[kept], start[kept], body[kept])
    docs, start, end = _runs(docs[gone], start[gone], length)
    yield from _by_bucket(RANGES, bucket_of(mix(docs.view(np.uint64), 7), buckets), docs, start, end)


def _blocks(out: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], pa.int32()), pa.array([d for _, d in out], pa.binary())], ["bucket", "data"])


def _contexts(length: int, gram: int, buckets: int):
    """Texts with undecided anchors to blocks: (anchor, id, offset, bytes around it) by anchor, or (string's hash,
    id, offset, string) by salted hash, the earliest of a block's equal strings only, and the ranges of the others."""
    before = length - gram

    def around(parts: list) -> pa.RecordBatch:
        keys, *rest = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(keys, kind="stable")
        keys, docs, at, left, right, body = (x[order] for x in (keys, *rest))
        return _blocks(list(_by_bucket(FEW, bucket_of(keys, buckets), keys, docs, at.astype(np.uint32), left, right, body)))

    def strings(parts: list) -> pa.RecordBatch:
        keys, docs, start, body = (np.concatenate(x) for x in zip(*parts, strict=True))
        return _blocks(list(_strings(keys, docs, start, body, length, buckets)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        few_parts, few_held, parts, held = [], 0, [], 0
        for batch in batches:
            texts, offsets = text_bytes(batch.column(1))
            for i, (doc, packed) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2), strict=True)):
                text = texts[offsets[i] : offsets[i + 1]]
                at, what, anchor = unpack(packed.as_buffer())
                at = at.astype(np.int64)
                few = what == 1
                if few.any():
                    padded = np.concatenate([np.zeros(before, np.uint8), text, np.zeros(length, np.uint8)])
                    s = at[few]
                    row = np.lib.stride_tricks.sliding_window_view(padded, before + length)[s]
                    few_parts.append((anchor[few], np.full(len(s), doc, np.int64), s, np.minimum(s, before).astype(np.uint8), np.minimum(len(text) - s, length).astype(np.uint8), row))
                    few_held += len(s)
                    if few_held >= FLUSH // 10:
                        yield around(few_parts)
                        few_parts, few_held = [], 0
                if few.all() or len(text) < length:
                    continue
                through = np.zeros(len(text) + 1, np.int64)  # strings through an anchor: each once, whatever its anchors
                np.add.at(through, np.maximum(at[~few] - before, 0), 1)
                np.add.at(through, at[~few] + 1, -1)
                starts = np.flatnonzero(np.cumsum(through)[: len(text) - length + 1])
                prefix, window = prefix_hashes(text), np.lib.stride_tricks.sliding_window_view(text, length)
                while len(starts):
                    s, starts = starts[: FLUSH // 10 - held], starts[FLUSH // 10 - held :]
                    parts.append((mix(span_hashes(prefix, s, s + length), 60), np.full(len(s), doc, np.int64), s, window[s]))
                    held += len(s)
                    if held >= FLUSH // 10:
                        yield strings(parts)
                        parts, held = [], 0
        if few_parts:
            yield around(few_parts)
        if parts:
            yield strings(parts)
    return run


class Suffixes:
    """Suffixes (rows of ``body``, each with its length) in groups, in lexicographic order."""

    def __init__(self, body: np.ndarray, lengths: np.ndarray, groups: np.ndarray):
        """groups: start of each row's group; rows of a group stand together."""
        self.body, self.lengths, self.groups = body, lengths.astype(np.int64), groups
        self.width = body.shape[1]
        self.prefix = row_prefix_hashes(body)

    def extension(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Longest common extension of rows i and j: binary search over prefix hashes."""
        low, high = np.zeros(len(i), np.int64), np.minimum(self.lengths[i], self.lengths[j])
        for _ in range(int(self.width).bit_length()):
            middle = (low + high + 1) >> 1
            same = self.prefix[i, middle] == self.prefix[j, middle]
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low

    def compare(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """-1, 0 or 1; a suffix that ends sorts first."""
        common = self.extension(i, j)
        flat, last = self.body.reshape(-1), self.width - 1
        step = np.minimum(common, last)
        x = np.where(common < self.lengths[i], flat[i * self.width + step].astype(np.int16), -1)
        y = np.where(common < self.lengths[j], flat[j * self.width + step].astype(np.int16), -1)
        return np.sign(x - y)

    def sort(self) -> np.ndarray:
        """Mergesort of every group at once: each element finds its rank in its sibling run by binary search."""
        n = len(self.body)
        order, at = np.arange(n), np.arange(n)
        relative = at - self.groups
        size = np.bincount(self.groups, minlength=n)[self.groups]
        ends = self.groups + size
        width = 1
        while width < size.max(initial=0):
            base = self.groups + relative // (2 * width) * (2 * width)
            middle, end = np.minimum(base + width, ends), np.minimum(base + 2 * width, ends)
            in_left = at < middle
            low, high = np.where(in_left, middle, base), np.where(in_left, end, middle)
            start = low.copy()
            active = np.flatnonzero(low < high)
            while len(active):
                probe = (low[active] + high[active]) >> 1
                sign = self.compare(order[probe], order[active])
                further = np.where(in_left[active], sign < 0, sign <= 0)
                low[active] = np.where(further, probe + 1, low[active])
                high[active] = np.where(further, high[active], probe)
                active = active[low[active] < high[active]]
            target = base + (at - np.where(in_left, base, middle)) + (low - start)
            merged = np.empty_like(order)
            merged[target] = order
            order = merged
            width *= 2
        return order

    def neighbours(self, order: np.ndarray) -> np.ndarray:
        """Verified common extension of each sorted suffix with the one before it (0 at a group's start)."""
        out = np.zeros(len(order), np.int64)
        for a in range(1, len(order), 1 << 16):
            b = min(len(order), a + (1 << 16))
            i, j = order[a - 1 : b - 1], order[a:b]
            differ = self.body[i] != self.body[j]
            equal = np.where(differ.any(axis=1), differ.argmax(axis=1), self.width)
            equal = np.minimum(equal, np.minimum(self.lengths[i], self.lengths[j]))
            out[a:b] = np.where(self.groups[i] == self.groups[j], equal, 0)
        return out

    def sorted_extensions(self) -> tuple[np.ndarray, np.ndarray]:
        order = self.sort()
        found = self.neighbours(order)
        if len(order) > 1:
            hashed = np.where(self.groups[order[1:]] == self.groups[order[:-1]], self.extension(order[:-1], order[1:]), 0)
            if (hashed != found[1:]).any():  # a collision of hashes: sort the bytes themselves
                order = np.array(sorted(range(len(order)), key=lambda r: (self.groups[r], self.body[r, : self.lengths[r]].tobytes())))
                found = self.neighbours(order)
        return order, found


def repeated(keys, docs, at, left, right, body, length: int, before: int):
    """(id, start, end) covered by strings through the anchors; rows sorted by (key, id, offset).

    Whole groups of equal keys are taken in runs of about ``RUN`` rows, which bounds memory.
    """
    edges = np.r_[np.flatnonzero(~_same_as_before(keys)), len(keys)]
    out, begin = [], 0
    while begin < len(keys):
        end = edges[max(np.searchsorted(edges, begin + RUN, side="right") - 1, np.searchsorted(edges, begin, side="right"))]
        out.append(_repeated(*(x[begin:end] for x in (keys, docs, at, left, right, body)), length, before))
        begin = end
    return [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 3


def _repeated(keys, docs, at, left, right, body, length: int, before: int):
    again = _same_as_before(keys)
    groups = np.maximum.accumulate(np.where(again, 0, np.arange(len(keys))))
    ahead = Suffixes(np.ascontiguousarray(body[:, before:]), right, groups)
    behind = Suffixes(np.ascontiguousarray(body[:, :before][:, ::-1]), left, groups)
    orders = [s.sorted_extensions() for s in (ahead, behind)]
    covered = np.zeros((before + 2, len(keys)), dtype=bool)  # the last row stays empty
    for d in range(before + 1):
        fits = np.flatnonzero((left >= d) & (right >= length - d))
        if len(fits) < 2:
            continue
        labels = []
        for (order, found), need in zip(orders, (length - d, d), strict=True):
            label = np.empty(len(keys), np.int64)
            starts = (found < need) if need else np.r_[True, groups[order[1:]] != groups[order[:-1]]]
            starts[:1] = True
            label[order] = np.cumsum(starts)
            labels.append(label[fits])
        _, first, inverse = np.unique(labels[0] * (len(keys) + 1) + labels[1], return_index=True, return_inverse=True)
        head = fits[first[inverse]]
        covered[d, fits] = (docs[head] != docs[fits]) | (at[head] != at[fits])
    rows, d = np.nonzero((covered & ~np.roll(covered, 1, axis=0)).T)
    rows_end, d_end = np.nonzero((covered & ~np.roll(covered, -1, axis=0)).T)
    return docs[rows_end], at[rows_end] - d_end, at[rows] - d + length


def _by_document(docs, start, end) -> tuple[list, list]:
    order = np.argsort(docs, kind="stable")
    docs, start, end = docs[order], start[order], end[order]
    edges = np.r_[0, np.flatnonzero(np.diff(docs)) + 1, len(docs)] if len(docs) else np.zeros(1, int)
    pairs = list(zip(edges[:-1], edges[1:], strict=True))
    return [int(docs[a]) for a, _ in pairs], [pack(start[a:b], end[a:b]) for a, b in pairs]


def _exact(length: int, gram: int, buckets: int, last: bool):
    """Blocks of one bucket to ranges (bucket -1) by document and, unless ``last``, to blocks of the strings left, by key."""
    before = length - gram

    def run(group: pa.Table) -> pa.Table:
        got = {kind: [] for kind in (FEW, STRINGS, RANGES)}
        for block in group.column("data"):
            kind, *columns = unpack(block.as_buffer())
            got[int(kind[0])].append(columns)
        joined = {kind: [np.concatenate(x) for x in zip(*parts, strict=True)] for kind, parts in got.items() if parts}
        got.clear()
        ranges, left_over = [], []
        if FEW in joined:
            keys, docs, at, left, right, body = joined.pop(FEW)
            body, at = body.reshape(-1, before + length), at.astype(np.int64)
            order = np.lexsort((at, docs, keys))
            ranges.append(repeated(keys[order], docs[order], at[order], left[order].astype(np.int64), right[order].astype(np.int64), body[order], length, before))
        if STRINGS in joined:
            keys, docs, start, body = joined.pop(STRINGS)
            body = body.reshape(-1, length)
            kept, gone = _earliest(keys, docs, start, body)
            ranges.append(_runs(docs[gone], start[gone], length))
            if not last:
                left_over = list(_by_bucket(STRINGS, bucket_of(keys[kept], buckets), keys[kept], docs[kept], start[kept], body[kept]))
        if RANGES in joined:
            ranges.append(joined.pop(RANGES))
        docs, data = _by_document(*(np.concatenate(x) for x in zip(*ranges, strict=True))) if ranges else ([], [])
        keys = [-1] * len(docs) + [k for k, _ in left_over]
        return pa.table({"bucket": pa.array(keys, pa.int32()), "doc_id": pa.array(docs + [None] * len(left_over), pa.int64()), "data": pa.array(data + [d for _, d in left_over], pa.binary())})
    return run


def marked(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``documents`` (all columns) with covered anchors and ranges of each text as the last two columns."""
    spark = bounded_batches(documents.sparkSession)
    texts = documents.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(shuffle_partitions(spark), total // BYTES_PER_BUCKET + 1)
    sent = texts.mapInArrow(_send(length, gram, buckets), "bucket int, data binary")
    classes = sent.groupBy("bucket").applyInArrow(_classes(buckets), "part int, data binary")
    state = hand_off(classes.groupBy("part").applyInArrow(_per_document, "doc_id long, covered binary, open binary"), "anchors")
    undecided = state.where("open is not null").select("doc_id", "open")
    around = texts.join(undecided, "doc_id").select("doc_id", "text", "open").mapInArrow(_contexts(length, gram, buckets), "bucket int, data binary")
    schema = "bucket int, doc_id long, data binary"
    salted = hand_off(around.groupBy("bucket").applyInArrow(_exact(length, gram, buckets, False), schema), "strings")
    merged = salted.where("bucket >= 0").select("bucket", "data").groupBy("bucket").applyInArrow(_exact(length, gram, buckets, True), schema)
    ranges = salted.where("bucket < 0").unionByName(merged).groupBy("doc_id").agg(F.collect_list("data").alias("_ranges"))
    ranges = hand_off(ranges, "ranges")
    doc, covered, by = unused(documents.columns, "_doc", "_covered", "_ranges")
    found = state.where("covered is not null").select("doc_id", "covered").join(ranges, "doc_id", "full").select(
        F.col("doc_id").alias(doc), F.col("covered").alias(covered), F.col("_ranges").alias(by))
    return documents.where(F.col(id_col).isNotNull()).join(found, F.col(id_col).cast("long") == F.col(doc), "left").drop(doc)


def _mask(text: np.ndarray, covered, ranges, length: int, gram: int) -> np.ndarray:
    """True for each byte that goes."""
    step = np.zeros(len(text) + 1, np.int64)
    starts, ends = [], []
    if covered is not None:
        at = unpack(covered)[0].astype(np.int64)
        starts.append(np.maximum(at - (length - gram), 0))
        ends.append(np.minimum(at + length, len(text)))
    for block in ranges or ():
        s, e = unpack(block)
        starts.append(s)
        ends.append(e)
    for s, e in zip(starts, ends, strict=True):
        np.add.at(step, s, 1)
        np.add.at(step, e, -1)
    return np.cumsum(step)[:-1] > 0


def _digests(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, offsets = text_bytes(batch.column(1))
            out = []
            for i, (doc, covered, ranges) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                text = texts[offsets[i] : offsets[i + 1]]
                if covered is None and not ranges:
                    out.append((doc, len(text), 0, 0, hashlib.sha256(text.tobytes()).hexdigest()))
                    continue
                gone = _mask(text, covered, ranges, length, gram)
                spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                out.append((doc, len(text), int(gone.sum()), spans, hashlib.sha256(text[~gone].tobytes()).hexdigest()))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate(types)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
    return run


def suffix_dedup(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Per document ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``."""
    rows = marked(documents, id_col, text_col, length, gram)
    rows = rows.select(F.col(id_col).cast("long"), F.col(text_col), *rows.columns[-2:])
    return rows.mapInArrow(_digests(length, gram), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def _cut(length: int, gram: int, text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, offsets = text_bytes(batch.column(text_at))
            out = batch.column(text_at).to_pylist()
            for i, (covered, ranges) in enumerate(zip(batch.column(batch.num_columns - 2).to_pylist(), batch.column(batch.num_columns - 1).to_pylist(), strict=True)):
                if covered is None and not ranges:
                    continue
                text = texts[offsets[i] : offsets[i + 1]]
                gone = _mask(text, covered, ranges, length, gram)
                lead = np.flatnonzero((text & 0xC0) != 0x80)  # a character goes if all its bytes go
                whole = np.logical_and.reduceat(gone, lead)
                out[i] = text[~np.repeat(whole, np.diff(np.r_[lead, len(text)]))].tobytes().decode()
            columns = [pa.array(out, pa.string()) if k == text_at else batch.column(k) for k in range(batch.num_columns - 2)]
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names[:-2])
    return run


def strip_repeats(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``documents`` with the repeated strings cut out of the text (whole characters only)."""
    rows = marked(documents, id_col, text_col, length, gram)
    text_at = documents.columns.index(text_col)
    return rows.mapInArrow(_cut(length, gram, text_at), documents.schema)
