"""Spelling variant grouping by blocked Gram matrices of letter counts (operator 13).

Words are maximal runs of ``[A-Za-z\\u00C0-\\u00FF]``, A-Z lower-cased, of at least ``least_length`` code points and
``least_count`` occurrences. Two words are *near* if they differ by exactly one inserted, deleted or replaced
code point. A word's form is its most frequent near word, if that is ``factor`` times as frequent. The method:

1. tasks count their words and send one row per word; Spark adds them up;
2. words are laid out in blocks of adjacent lengths L and L + 1. Per block, NumPy multiplies the matrices of
   letter counts: ``|a|^2 + |b|^2 - 2ab`` is the squared distance, which one replacement makes 2 and one insertion
   makes 1. Pairs at most that far apart are verified on their code points;
3. a block that holds all words of two lengths would grow with the square of the vocabulary. So a block also
   fixes where the edit falls: in places [lo, hi) of the shorter word, everything outside being equal. A word is
   in the blocks of both halves of [0, L); a block of more than ``BLOCK`` words is halved again, down to one
   place, where at most one word per letter (or pair of letters) is left. An edit belongs to the one block
   that holds its first differing place, so each pair is found once, and none is lost;
4. per word Spark takes the count of near words and the most frequent one, and doubles the paths along the
   forms until each word points at its root (counts grow by ``factor`` along a path, so it has no cycle).

A bucket of blocks is worked on by one task; a block holds at most ``BLOCK`` words, or one row per pair of
letters. Nothing is collected but the number of blocks to halve.

Cases: null and empty texts have no words. Rows without an id count like others (``respell`` sees None).
Rows that share an id count each. Extra columns are ignored. Words of any length are compared whole. An
empty table gives an empty result.
"""

from __future__ import annotations

import re
import string
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.blocks import bounded_batches, hand_off, shuffle_partitions

BLOCK = 1024  # words of a block before it is halved
HELD = 400_000  # different words a task counts before it sends them
PER_BUCKET = 100_000  # rows of a task's blocks, on average
TILE = 512
LETTERS = 26 + 64  # a-z and U+00C0 to U+00FF
_LOWER = {ord(c): c.lower() for c in string.ascii_uppercase}


def _count(least_length: int, respell: Callable | None):
    long_runs = re.compile(rf"[A-Za-zÀ-ÿ]{{{least_length},}}")

    def sent(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts.keys()), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for raw, n in Counter(long_runs.findall(text.as_py() or "")).items():
                    word = raw.lower() if raw.isascii() else raw.translate(_LOWER)
                    if respell is not None:
                        word = respell(doc, word)
                    if len(word) >= least_length:
                        counts[word] += n
                if len(counts) >= HELD:
                    yield sent(counts)
                    counts.clear()
        if counts:
            yield sent(counts)
    return run


def word_counts(documents: DataFrame, id_col: str, text_col: str, least_length: int, least_count: int, respell: Callable | None = None) -> DataFrame:
    """(word, n) of every word that is long and frequent enough."""
    bounded_batches(documents.sparkSession)
    texts = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    counted = texts.mapInArrow(_count(least_length, respell), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _halved(rows: DataFrame) -> DataFrame:
    """Each (word, n, short, lo, hi) in the blocks of both halves of [lo, hi)."""
    middle = F.expr("(lo + hi) div 2").cast("int")
    halves = F.explode(F.array(F.struct(F.col("lo").alias("lo"), middle.alias("hi")), F.struct(middle.alias("lo"), F.col("hi").alias("hi"))))
    return rows.select("word", "n", "short", halves.alias("half")).select("word", "n", "short", "half.lo", "half.hi").withColumn(
        "block", F.concat_ws("\t", "short", "lo", "hi", F.expr("substring(word, 1, lo)"), F.expr("right(word, short - hi)")))


def blocks_of(words: DataFrame) -> DataFrame:
    """(word, n, short, lo, hi, block) of all blocks, none of more than ``BLOCK`` words that can be halved."""
    length = F.length("word").cast("int")
    lengths = words.select("word", "n", F.explode(F.array(length, length - 1)).alias("short"))
    rows = _halved(lengths.withColumns({"lo": F.lit(0), "hi": F.col("short")}))
    ready = None
    while True:
        rows = hand_off(rows, "blocks")
        large = hand_off(rows.where("hi - lo > 1").groupBy("block").count().where(F.col("count") > BLOCK).select("block"), "large")
        fine = rows.join(large, "block", "left_anti")
        ready = fine if ready is None else ready.unionByName(fine)
        if large.isEmpty():
            return ready
        rows = _halved(rows.join(large, "block", "left_semi").drop("block"))


def _letters(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words behind one another, and where each begins."""
    sizes = pc.utf8_length(words).to_numpy()
    codes = np.frombuffer("".join(words.to_pylist()).encode("utf-32-le"), np.uint32)
    return codes, np.r_[0, np.cumsum(sizes)]


def _pairs(codes: np.ndarray, begin: np.ndarray, sizes: np.ndarray, short: int, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """Near pairs of one block's words whose first differing place is in [lo, hi) (or behind the end, for hi = short)."""
    m = len(begin)
    width = short + 1
    place = begin[:, None] + np.minimum(np.arange(width), sizes[:, None] - 1)
    letters = codes[place]
    letters[sizes == short, short] = 0
    column = np.where(letters < 128, letters - 97, letters - 0xC0 + 26).astype(np.int64)
    inside = letters > 0
    exact = np.float32 if short < 2048 else np.float64  # squares of counts stay whole numbers
    counts = np.bincount((np.arange(m)[:, None] * LETTERS + column)[inside], minlength=m * LETTERS).reshape(m, LETTERS).astype(exact)
    square = (counts * counts).sum(axis=1)
    small = np.flatnonzero(sizes == short)
    found = []
    for at in range(0, len(small), TILE):
        a = small[at : at + TILE]
        distance = square[a][:, None] + square[None, :] - 2 * (counts[a] @ counts.T)
        other = np.where(sizes[None, :] == short, (distance == 2) & (np.arange(m)[None, :] > a[:, None]), distance == 1)
        i, j = np.nonzero(other)
        if not len(i):
            continue
        i = a[i]
        x, y = letters[i], letters[j]
        differs = x[:, :short] != y[:, :short]
        first = np.where(differs.any(axis=1), differs.argmax(axis=1), short)
        longer = sizes[j] > short
        replaced = differs.sum(axis=1) == 1
        shifted = ((x[:, :short] == y[:, 1:]) | (np.arange(short)[None, :] < first[:, None])).all(axis=1)
        fits = np.where(longer, shifted, replaced) & (first >= lo) & ((first < hi) | (hi == short))
        found.append((i[fits], j[fits]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _near(group: pa.Table) -> pa.Table:
    """A bucket's blocks to (word, near, near_n), both ways."""
    group = group.combine_chunks()
    block = group.column("block").combine_chunks().dictionary_encode().indices.to_numpy()
    order = np.argsort(block, kind="stable")
    words, n = group.column("word").combine_chunks(), group.column("n").to_numpy()
    short, lo, hi = (group.column(c).to_numpy() for c in ("short", "lo", "hi"))
    codes, begin = _letters(words)
    sizes = np.diff(begin)
    edges = np.flatnonzero(np.diff(block[order])) + 1
    left, right = [], []
    for a, b in zip(np.r_[0, edges], np.r_[edges, len(order)], strict=True):
        if b - a > 1:
            own = order[a:b]
            one = own[0]
            if (sizes[own] == short[one]).any():
                i, j = _pairs(codes, begin[own], sizes[own], int(short[one]), int(lo[one]), int(hi[one]))
                left.append(own[i])
                right.append(own[j])
    none = np.zeros(0, np.int64)
    i, j = np.concatenate([none, *left, *right]), np.concatenate([none, *right, *left])
    return pa.table({"word": words.take(pa.array(i)), "near": words.take(pa.array(j)), "near_n": pa.array(n[j], pa.int64())})


def near_words(words: DataFrame) -> DataFrame:
    """(word, near, near_n) of all near pairs of the (word, n), both ways."""
    blocks = blocks_of(words)
    rows = words.count()
    buckets = max(shuffle_partitions(words.sparkSession), 4 * rows // PER_BUCKET + 1)
    dealt = blocks.withColumn("bucket", F.expr(f"cast(pmod(xxhash64(block), {buckets}) as int)"))
    return dealt.groupBy("bucket").applyInArrow(_near, "word string, near string, near_n long")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the (word, form): the end of each path along the forms."""
    paths = hand_off(forms.select("word", F.col("form").alias("root")), "paths")
    while True:
        further = paths.select(F.col("word").alias("root"), F.col("root").alias("next"))
        doubled = hand_off(paths.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "paths")
        paths = doubled.drop("moved")
        if doubled.where("moved").isEmpty():
            return paths


def spelling_variants(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = 7, least_count: int = 2,
                      factor: int = 10, respell: Callable[[int | None, str], str] | None = None) -> DataFrame:
    """One row per word: ``word, form, root, n, n_near, form_n``.

    ``respell(id, run)`` may change each lower-cased run of a document before it is counted; it may not
    make it longer.
    """
    words = hand_off(word_counts(documents, id_col, text_col, least_length, least_count, respell), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near"))).alias("best")
    near = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), best)
    follows = F.expr(f"-best.minus >= {factor} * n")
    formed = hand_off(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(follows, F.col("best.near")).alias("form"), F.when(follows, -F.col("best.minus")).alias("form_n")), "forms")
    ends = roots(formed.where("form is not null"))
    return formed.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
