"""N-gram Jaccard join by multiple-global-order prefix filtering (operator 1).

Texts are A-Z lower-cased and split at ``[\\x20\\x09-\\x0D]``. A document's set holds its distinct
``width``-word shingles as 64-bit hashes; a text with fewer words is one shingle, a text without
words has the empty set. Two documents link when ``100 * |A & B| >= percent * |A | B|``.

The method. In any one global order of all shingles, two linked sets share a shingle among the first
``n - ceil(percent * n / 100) + 1`` of each. This holds in *every* order, so a candidate pair must
share a prefix shingle under all of ``ORDERS`` orders: the pairs of the first order are intersected
with the filters of the others before their sets are compared. All orders put rare shingles first
(document frequency, counted over all texts), and differ in how they break ties:

1. one pass hashes the texts and sends each shingle with its document to the shingle's bucket, as
   sorted, packed blocks (copies within a task go once);
2. each bucket counts frequencies and returns the shingles that two or more documents have;
3. per document, shingles of frequency one come first in every order. A document whose prefix holds
   nothing else has no partner. For the others the prefixes of all orders are cut;
4. documents that share a prefix shingle of the first order (at places that a linked pair of their
   sizes allows) are compared with one centre of that shingle first, in two turns; whatever is linked
   then needs no further comparison, since only the components are asked for. Then the documents that still meet another component are compared within their
   centre's group, block by block, so no link between different components is lost, and copies that
   link to a centre cost one comparison each.

Cases: null or blank texts have ``n_shingles`` 0 and are linked with nothing; rows with a null id are
left out; rows that share an id count as one node, and each is returned; extra columns are ignored.
An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.blocks import (
    bucket_of,
    deltas,
    hand_off,
    mix,
    pack,
    shuffle_partitions,
    slices,
    text_chunks,
    unpack,
    word_hashes,
)
from shelfwise.llm.components import components

ORDERS = 3
FLUSH = 2_000_000  # shingles a task gathers before it sends blocks
PER_BUCKET = 1_500_000  # shingles of a bucket, on average
STAR_TURNS = 2
BLOCK = 512  # documents of one centre that a task compares with as many others


def shingle_sets(chunk, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of each row of a chunk."""
    words, row = word_hashes(chunk.data, chunk.offsets)
    bounds = np.searchsorted(row, np.arange(len(chunk.ids) + 1))
    rolled = np.zeros(len(words), dtype=np.uint64)
    for k in range(width):
        step = words[k:] * np.uint64(2 * k + 3) + (words[k:] >> np.uint64(17 + k))
        rolled[: len(step)] = mix(rolled[: len(step)] + step, 2 + k)
    for i in range(len(chunk.ids)):
        begin, end = bounds[i], bounds[i + 1]
        if end - begin >= width:
            yield i, np.unique(rolled[begin : end - width + 1])
        elif end > begin:
            whole = np.uint64(end - begin)
            for w in words[begin:end]:
                whole = mix(np.array([whole ^ w], dtype=np.uint64), 50)[0]
            yield i, np.array([whole], dtype=np.uint64)
        else:
            yield i, np.zeros(0, dtype=np.uint64)


def digest(hashes: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set."""
    signed = np.array([mix(hashes, 90).sum(dtype=np.uint64), mix(hashes, 91).sum(dtype=np.uint64)]).view(np.int64)
    return int(signed[0]), int(signed[1])


def _sizes(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in text_chunks(batches):
            rows = [(int(chunk.ids[i]), len(s), *digest(s)) for i, s in shingle_sets(chunk, width)]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows, strict=True)], ["doc_id", "n", "h1", "h2"])
    return run


def _send(width: int, buckets: int):
    """Texts to blocks (bucket, shingles, documents)."""
    def blocks(ids: list, sets: list) -> pa.RecordBatch:
        hashes = np.concatenate(sets)
        docs = np.repeat(np.arange(len(sets), dtype=np.uint32), [len(s) for s in sets])
        order = np.argsort(hashes, kind="stable")
        hashes, docs = hashes[order], docs[order]
        names, sizes = np.array(ids, np.int64), np.array([len(s) for s in sets], np.int64)
        keys, data = [], []
        for bucket, a, b in slices(bucket_of(hashes, buckets)):
            here, index = np.unique(docs[a:b], return_inverse=True)
            keys.append(bucket)
            data.append(pack(deltas(hashes[a:b]), index.astype(np.uint32), names[here], sizes[here]))
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array(data, pa.binary())], ["bucket", "data"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, sets, held, seen = [], [], 0, set()
        for chunk in text_chunks(batches):
            for i, s in shingle_sets(chunk, width):
                if len(s) and (key := (len(s), *digest(s))) not in seen:
                    seen.add(key)
                    ids.append(int(chunk.ids[i]))
                    sets.append(s)
                    held += len(s)
                    if held >= FLUSH:
                        yield blocks(ids, sets)
                        ids, sets, held, seen = [], [], 0, set()
        if sets:
            yield blocks(ids, sets)
    return run


def _shared(parts: int):
    """Blocks of one shingle bucket to blocks of the shingles that two or more documents have."""
    def run(group: pa.Table) -> pa.Table:
        hashes, docs, sizes = [], [], []
        for block in group.column("data"):
            h, index, names, n = unpack(block.as_buffer())
            hashes.append(np.cumsum(h, dtype=np.uint64))
            docs.append(names[index])
            sizes.append(n[index])
        hashes, docs, sizes = np.concatenate(hashes), np.concatenate(docs), np.concatenate(sizes)
        order = np.argsort(hashes, kind="stable")
        hashes = hashes[order]
        new = np.r_[True, hashes[1:] != hashes[:-1]]
        counts = np.diff(np.r_[np.flatnonzero(new), len(hashes)])
        frequency = np.repeat(counts, counts)
        keep = frequency > 1
        order, hashes, frequency = order[keep], hashes[keep], frequency[keep]
        docs, sizes = docs[order], sizes[order]
        part = bucket_of(mix(docs.view(np.uint64), 7), parts)
        order = np.lexsort((docs, part))
        keys, data = [], []
        for key, a, b in slices(part[order]):
            at = order[a:b]
            keys.append(key)
            data.append(pack(docs[at], sizes[at].astype(np.uint32), hashes[at], np.minimum(frequency[at], 2**32 - 1).astype(np.uint32)))
        return pa.table({"part": pa.array(keys, pa.int32()), "data": pa.array(data, pa.binary())})
    return run


def prefix_size(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def _prefixes(percent: int):
    """Blocks of some documents to each document's shared shingles and its prefix in every order."""
    def run(group: pa.Table) -> pa.Table:
        parts = [unpack(block.as_buffer()) for block in group.column("data")]
        docs, sizes, hashes, frequency = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((hashes, docs))
        docs, sizes, hashes, frequency = docs[order], sizes[order], hashes[order], frequency[order]
        edges = np.r_[0, np.flatnonzero(np.diff(docs)) + 1, len(docs)]
        out = {k: [] for k in ("doc_id", "n", "first", "shared", "prefix", "filters")}
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            own, first = np.unique(hashes[a:b], return_index=True)
            n, often = int(sizes[a]), frequency[a:b][first]
            room = prefix_size(n, percent) - (n - len(own))
            if room <= 0:
                continue
            cut = [own[np.lexsort((mix(own, 20 + k), often if k == 0 else np.frexp(often)[1] if k == 1 else often > 2))[:room]] for k in range(ORDERS)]
            out["doc_id"].append(int(docs[a]))
            out["n"].append(n)
            out["first"].append(n - len(own))
            out["shared"].append(own.tobytes())
            out["prefix"].append(cut[0].view(np.int64))
            out["filters"].append([np.sort(c).tobytes() for c in cut[1:]])
        types = {"doc_id": pa.int64(), "n": pa.int64(), "first": pa.int64(), "shared": pa.binary(), "prefix": pa.list_(pa.int64()), "filters": pa.list_(pa.binary())}
        return pa.table({k: pa.array(out[k], t) for k, t in types.items()})
    return run


def _meet(a: bytes, b: bytes) -> int:
    return len(np.intersect1d(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), assume_unique=True))


def _verify(percent: int):
    """Candidate pairs with both sides' sets to links."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if all(_meet(p, q) for p, q in zip(r["filters_x"], r["filters_y"], strict=True)):
                    both = _meet(r["shared_x"], r["shared_y"])
                    if 100 * both >= percent * (r["n_x"] + r["n_y"] - both):
                        out.append((r["x"], r["y"]))
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], pa.int64()) for k in (0, 1)], ["u", "v"])
    return run


def candidate_sets(documents: DataFrame, id_col: str, text_col: str, width: int, percent: int, total: int) -> DataFrame:
    """(doc_id, n, first, shared, prefix, filters) of every document that can have a partner."""
    spark = documents.sparkSession
    buckets = max(shuffle_partitions(spark), total // PER_BUCKET + 1)
    texts = documents.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sent = texts.mapInArrow(_send(width, buckets), "bucket int, data binary")
    shared = sent.groupBy("bucket").applyInArrow(_shared(buckets), "part int, data binary")
    return shared.groupBy("part").applyInArrow(_prefixes(percent), "doc_id long, n long, first long, shared binary, prefix array<long>, filters array<binary>")


def links(sets: DataFrame, percent: int) -> DataFrame:
    """(node, component) of the documents in ``sets`` that have a link.

    ``n - least_common + 1`` bounds where the first common shingle of a pair can stand, so a rare
    shingle at the front of one set keeps it from all sets of its size. The smaller set of a pair is
    looked up by its *index prefix* (that bound for two sets of equal size), the larger one probes.
    """
    index = hand_off(sets.select("doc_id", "n", "first", F.posexplode("prefix").alias("at", "shingle")).withColumn("at", F.expr("first + at + 1")).drop("first"), "index")
    arrays = sets.select("doc_id", "n", "shared", "filters")
    common = lambda n, m: f"(({percent} * ({n} + {m}) + {99 + percent}) div {100 + percent})"
    fits = (f"100 * least(n, n_y) >= {percent} * greatest(n, n_y) and at <= n - {common('n', 'n_y')} + 1 and at_y <= n_y - {common('n', 'n_y')} + 1 and component <> component_y")
    largest = f"((n - at + 1) * {100 + percent}) div {percent} - n"  # size of the largest set that this entry can pair with

    def check(pairs: DataFrame) -> DataFrame:
        side = lambda s: pairs.join(arrays, F.col(s) == F.col("doc_id")).select("x", "y", *[F.col(c).alias(f"{c}_{s}") for c in ("n", "shared", "filters")])
        return side("x").join(side("y"), ["x", "y"]).mapInArrow(_verify(percent), "u long, v long")

    ids = sets.select(F.col("doc_id").alias("node"))
    labels, found = ids.withColumn("component", F.col("node")), None
    for turn in range(STAR_TURNS + 1):
        probes = index.join(labels, index.doc_id == labels.node).drop("node")
        indexed = probes.where(f"at <= n - {common('n', 'n')} + 1")
        centre = F.min(F.struct("n" if turn != 1 else F.xxhash64("doc_id"), "doc_id", F.col("n").alias("n_y"), F.col("at").alias("at_y"), F.col("component").alias("component_y"))).alias("c")
        met = indexed.groupBy("shingle").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.min("n").alias("least_n"), centre)
        live = probes.join(met, "shingle").where(f"{largest} >= least_n and (component <> lo or component <> hi)")
        if turn < STAR_TURNS:
            pairs = live.select("doc_id", "n", "at", "component", F.col("c.doc_id").alias("centre"), "c.n_y", "c.at_y", "c.component_y").where(fits)
            if turn == 0:  # each document with the centre that it meets most often
                pairs = pairs.groupBy("doc_id", "centre").agg(F.count("*").alias("c")).groupBy("doc_id").agg(F.max(F.struct("c", "centre")).alias("m")).select("doc_id", "m.centre")
            pairs = hand_off(pairs.select(F.least("doc_id", "centre").alias("x"), F.greatest("doc_id", "centre").alias("y")).distinct(), "pairs")
            if turn and pairs.isEmpty():
                continue
            new = hand_off(check(pairs), "links")
        else:
            live = hand_off(live.select("shingle", F.col("c.doc_id").alias("centre"), "doc_id", "component", "n"), "live")
            if live.isEmpty():
                break
            asked = live.select("shingle", "centre").distinct()
            members = live.drop("shingle").unionByName(indexed.join(asked, "shingle").select("centre", "doc_id", "component", "n")).distinct()
            new = hand_off(in_blocks(hand_off(members, "members"), sets, percent), "links")
        found = new if found is None else found.unionByName(new)
        reached = components(found)
        labels = ids.join(reached, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
    return reached


def _common(a: list, b: list, asked: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the sets of a with those of b, for the pairs ``asked`` only (else 0)."""
    own = np.split(np.unique(np.concatenate([*a, *b]), return_inverse=True)[1], np.cumsum([len(s) for s in (*a, *b)])[:-1])
    left, right = own[: len(a)], own[len(a) :]
    sizes = np.array([len(s) for s in right])
    mark = np.zeros(max(int(s.max(initial=-1)) for s in own) + 1, bool)
    out = np.zeros(asked.shape, np.int64)
    for i in np.flatnonzero(asked.any(1)):
        j = np.flatnonzero(asked[i])
        mark[left[i]] = True
        out[i, j] = np.add.reduceat(mark[np.concatenate([right[k] for k in j])], np.cumsum(sizes[j]) - sizes[j], dtype=np.int64)
        mark[left[i]] = False
    return out


def _block(percent: int):
    """Two blocks of a group's documents: one link for each two components that have any.

    A pair stays a candidate while its sizes and components allow a new link and its prefixes meet, one order
    after the other; the whole sets of the pairs that are left are compared.
    """
    def run(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        low, high = ([r for r in rows if r["block"] == group.column(k)[0].as_py()] for k in ("lo", "hi"))
        n, m = (np.array([r["n"] for r in side], np.int64) for side in (low, high))
        c, d = (np.array([r["component"] for r in side], np.int64) for side in (low, high))
        pairs = (c[:, None] != d[None, :]) & (100 * np.minimum(n[:, None], m[None, :]) >= percent * np.maximum(n[:, None], m[None, :]))
        cuts = [lambda r: np.array(r["prefix"], np.int64).view(np.uint64), *[lambda r, k=k: np.frombuffer(r["filters"][k], np.uint64) for k in range(ORDERS - 1)]]
        for cut in cuts:
            if pairs.any():
                pairs = _common([cut(r) for r in low], [cut(r) for r in high], pairs) > 0
        if not pairs.any():
            return pa.table({"u": pa.array([], pa.int64()), "v": pa.array([], pa.int64())})
        both = _common(*([np.frombuffer(r["shared"], np.uint64) for r in side] for side in (low, high)), pairs)
        i, j = np.nonzero(pairs & (100 * both >= percent * (n[:, None] + m[None, :] - both)))
        kept = np.unique(np.stack([np.minimum(c[i], d[j]), np.maximum(c[i], d[j])]), axis=1, return_index=True)[1] if len(i) else []
        return pa.table({"u": pa.array([low[i[k]]["doc_id"] for k in kept], pa.int64()), "v": pa.array([high[j[k]]["doc_id"] for k in kept], pa.int64())})
    return run


def in_blocks(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between different components among the ``members`` (centre, doc_id, component, n) of each centre.

    A centre's documents are dealt into blocks of about ``BLOCK``: a component with more of them has blocks
    of its own, the others share theirs, each by bands of set sizes that are as wide as a link allows. Two
    blocks meet in a task of their own, unless both belong to one component or their bands do not touch. So a
    large linked group costs its size times the number of strangers in it, no task holds a group, and only
    links leave it.
    """
    width = max(math.log(100 / percent) * 1.0001, 1e-9)  # a little wider, so that rounding parts no linked sizes
    kind = ["centre", "mixed", "owner", "band"]
    block = F.struct(*kind[1:], "piece").alias("block")
    parts = members.groupBy("centre", "component").agg(F.count("*").alias("size"))
    several = parts.groupBy("centre").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a < b").select("centre")
    owners = parts.join(several, "centre").select("centre", "component", F.expr(f"size < {BLOCK}").alias("mixed"))
    dealt = members.join(owners, ["centre", "component"]).withColumn("owner", F.expr("if(mixed, 0L, component)")).withColumn("band", F.expr(f"cast(floor(ln(n) / {width!r}D) as long)"))
    counts = hand_off(dealt.groupBy(*kind).agg(F.expr(f"(count(*) - 1) div {BLOCK} + 1").alias("blocks")), "counts")
    named = counts.withColumn("piece", F.explode(F.expr("sequence(0L, blocks - 1)"))).select("centre", block)
    x, y = named.alias("x"), named.alias("y")
    meet = F.expr("x.centre = y.centre and x.block <= y.block and abs(x.block.band - y.block.band) <= 1 and (x.block.mixed or y.block.mixed or x.block.owner <> y.block.owner)")
    turns = hand_off(x.join(y, meet).select("x.centre", F.col("x.block").alias("lo"), F.col("y.block").alias("hi")), "turns")
    sides = turns.withColumn("block", F.col("lo")).unionByName(turns.where("lo <> hi").withColumn("block", F.col("hi")))
    own = dealt.join(counts, kind).withColumn("piece", F.expr("pmod(xxhash64(doc_id), blocks)")).select("centre", "doc_id", "component", block)
    rows = own.join(sides, ["centre", "block"]).join(sets.select("doc_id", "n", "shared", "prefix", "filters"), "doc_id")
    return rows.groupBy("centre", "lo", "hi").applyInArrow(_block(percent), "u long, v long")


def ngram_jaccard_join(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, percent: int = 85) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, class_id, component_id``.

    ``class_id`` is the least id with the same set; ``component_id`` the least id that links reach.
    """
    texts = documents.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sizes = hand_off(texts.mapInArrow(_sizes(width), "doc_id long, n long, h1 long, h2 long"), "sizes")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    classes = hand_off(sizes.where("n > 0").groupBy("n", "h1", "h2").agg(F.min("doc_id").alias("class_id")), "class_ids")  # a plain table: Spark splits a hot class
    named = hand_off(sizes.join(classes, ["n", "h1", "h2"], "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("class_id", "doc_id").alias("class_id")), "classes")
    sets = candidate_sets(documents, id_col, text_col, width, percent, total)
    sets = hand_off(sets, "sets")
    # One row per class: documents that stood for their copies within a task have equal sets.
    one = sets.select("doc_id").distinct().join(named.select("doc_id", "class_id").distinct(), "doc_id").groupBy("class_id").agg(F.min("doc_id").alias("doc_id"))
    sets = hand_off(sets.join(one, "doc_id").drop("doc_id").withColumnRenamed("class_id", "doc_id"), "classes")
    reached = links(sets, percent)
    return named.join(reached, named.class_id == reached.node, "left").select("doc_id", "n_shingles", "class_id", F.coalesce("component", "class_id").alias("component_id"))
