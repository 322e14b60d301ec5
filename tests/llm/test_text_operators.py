"""Operators on document texts against brute force, with the corner cases their docstrings define."""

import collections
import itertools
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark import TaskContext
from pyspark.sql import functions as F

from shelfwise.llm import blocks, decontam, license_scan, lm, ngram_join, quality, suffix_dedup
from shelfwise.llm.byte_bpe import Encoder, bpe_round_trip, encoder, id_digests, read_ranks
from tests.llm import brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
RNG = random.Random(5)
VOCABULARY = ["".join(RNG.choice("aeioustrnlé") for _ in range(RNG.randint(1, 7))) for _ in range(300)]


def prose(n, rng=RNG):
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


def edited(text, n, rng=RNG):
    words = text.split(" ")
    for _ in range(n):
        words[rng.randrange(len(words))] = rng.choice(VOCABULARY) + "x"
    return " ".join(words)


@pytest.fixture(scope="module")
def rows():
    base, passage = prose(200), prose(40)
    out = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "ONE two"), (6, "one two three"), (7, base), (8, base), (9, base.upper())]
    out += [(10 + k, edited(base, k % 9)) for k in range(40)]
    out += [(60 + k, prose(30 + 7 * k) + " " + passage + " " + prose(20)) for k in range(12)]
    out += [(80, "a" * 700), (81, "ab" * 400), (82, prose(6000)), (83, "é" * 130), (84, "\n".join([prose(8)] * 9)), (85, "日本語 한국어 text x")]
    return out


@pytest.fixture(scope="module")
def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en" if i % 3 else None, f"s{i % 2}", 0) for i, t in rows], SCHEMA).repartition(5)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def clashing(df):
    """Columns named like those the operators make."""
    return df.withColumns({c: F.lit("mine") for c in ("n", "component", "shingle", "ids", "decoded", "n_words", "kept", "covered", "_x", "class_id", "_covered", "_ranges", "_doc", "_gone", "_text", "order", "part", "over", "_row", "_lang", "limits")})


# 1 ----------------------------------------------------------------------------------------------


@pytest.mark.parametrize("width, percent", [(4, 85), (5, 80), (2, 60)])
def test_join_equals_brute_force(documents, rows, width, percent):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.ngram_jaccard_join(clashing(documents), width=width, percent=percent).collect()}
    assert got == brute.components(rows, width, percent)


def test_join_in_blocks_keeps_every_link(spark, monkeypatch):
    """Many documents near the threshold, no star turn, tiny blocks."""
    monkeypatch.setattr(ngram_join, "BLOCK", 7)
    monkeypatch.setattr(ngram_join, "STAR_TURNS", 1)
    rng = random.Random(9)
    base = prose(120, rng)
    rows = [(k, edited(base, rng.randint(1, 6), rng)) for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.ngram_jaccard_join(docs).collect()}
    want = brute.components(rows, 4, 85)
    assert got == want
    assert len({c for _, c in want.values()}) > 3


@pytest.mark.parametrize("percent", [60, 85, 100])
def test_join_in_blocks_of_large_components_and_bands(spark, monkeypatch, percent):
    """A linked group of many blocks, strangers in it, sizes over many bands, every link found by blocks."""
    monkeypatch.setattr(ngram_join, "BLOCK", 4)
    monkeypatch.setattr(ngram_join, "STAR_TURNS", 1)
    rng = random.Random(10)
    base = prose(90, rng)
    rows = [(k, base + " " + prose(k % 40, rng)) for k in range(70)]
    rows += [(100 + k, edited(base, rng.randint(1, 5), rng)) for k in range(40)]
    rows += [(200 + k, " ".join(base.split()[: 20 + 2 * k])) for k in range(35)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.ngram_jaccard_join(docs, percent=percent).collect()}
    assert got == brute.components(rows, 4, percent)


def test_common_counts_the_asked_pairs_only():
    rng = np.random.default_rng(4)
    draw = lambda: np.unique(rng.integers(0, 40, rng.integers(1, 25)).astype(np.uint64))
    a, b = [draw() for _ in range(9)], [draw() for _ in range(13)]
    asked = rng.random((9, 13)) < 0.5
    asked[3] = False
    want = np.array([[len(np.intersect1d(x, y)) for y in b] for x in a]) * asked
    assert (ngram_join._common(a, b, asked) == want).all()


def test_join_on_empty_repeated_and_unnamed_rows(spark):
    assert ngram_join.ngram_jaccard_join(empty(spark)).count() == 0
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, "a b c d e f")]
    got = ngram_join.ngram_jaccard_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(1, 1), (1, 1), (2, 1)]


@pytest.mark.parametrize("width, percent", [(4, 85), (5, 80)])
def test_join_of_texts_shorter_than_a_shingle(spark, width, percent):
    words = ["one", "two", "three", "four", "five"]
    for n in range(width + 1):  # each alone in a chunk
        batch = pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([" ".join(words[:n])])], ["doc_id", "text"])
        (chunk,) = ngram_join.text_chunks([batch])
        assert [len(s) for _, s in ngram_join.shingle_sets(chunk, width)] == [min(n, 1)]
    rows = [(10 * k + n, " ".join(words[:n])) for n in range(width + 1) for k in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(16)  # each row alone in its partition
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.ngram_jaccard_join(docs, width=width, percent=percent).collect()}
    assert got == brute.components(rows, width, percent)


# 5 ----------------------------------------------------------------------------------------------


def test_suffix_dedup_equals_brute_force(documents, rows):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.suffix_dedup(clashing(documents)).collect()}
    assert got == brute.suffix_rows(rows, 100)


def test_suffix_dedup_with_strings_dealt_singly(documents, rows, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "MANY", 1)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.suffix_dedup(documents).collect()}
    assert got == brute.suffix_rows(rows, 100)


def _with_footer(n, rng):
    footer = "".join(rng.choice("abcdefgh ") for _ in range(130))
    return footer, [(k, prose(rng.randint(5, 40), rng) + footer + prose(rng.randint(5, 40), rng)) for k in range(n)]


def test_suffix_dedup_of_a_footer_in_many_contexts(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "MANY", 1)
    monkeypatch.setattr(suffix_dedup, "FLUSH", 700)
    _, rows = _with_footer(150, random.Random(21))
    rows += [(200, "a" * 900), (201, rows[3][1]), (202, rows[3][1][40:] + "é"), (-7, rows[9][1][20:])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.suffix_dedup(docs).collect()}
    assert got == brute.suffix_rows(rows, 100)


def test_a_task_sends_a_string_of_many_documents_once(monkeypatch):
    footer, rows = _with_footer(90, random.Random(22))
    opened = []
    for _, text in rows:
        data = np.frombuffer(text.encode(), np.uint8)
        at, hashes, _ = suffix_dedup.anchors(data, np.array([0, len(data)]), 100, 40)
        opened.append(suffix_dedup.pack(at.astype(np.uint32), np.full(len(at), 2, np.uint8), hashes))
    batch = pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows]), pa.array([t for _, t in rows]), pa.array(opened, pa.binary())], ["doc_id", "text", "open"])
    sent = 0
    for out in suffix_dedup._contexts(100, 40, 1)(iter([batch])):
        for block in out.column(1).to_pylist():
            arrays = suffix_dedup.unpack(block)
            n = next(len(a) for a in arrays if a.dtype == np.uint64 or a.dtype == np.int64)
            sent += sum(footer[15:115].encode() in row.tobytes() for a in arrays if a.dtype == np.uint8 and len(a) >= 100 * n for row in a.reshape(n, -1))
    assert 1 <= sent <= 3


def test_strings_with_colliding_hashes_are_told_apart():
    rng = np.random.default_rng(8)
    body = rng.integers(0, 2, size=(200, 4), dtype=np.uint8)
    docs, start = rng.integers(-5, 5, size=200), rng.integers(0, 30, size=200)
    kept, gone = suffix_dedup._earliest(np.zeros(200, np.uint64), docs, start, body)
    least = {}
    for d, s, b in zip(docs, start, body):
        least[b.tobytes()] = min(least.get(b.tobytes(), (d, s)), (d, s))
    assert sorted((body[k].tobytes(), (docs[k], start[k])) for k in kept) == sorted(least.items())
    assert sorted(gone) == [k for k in range(200) if (docs[k], start[k]) != least[body[k].tobytes()]]


def test_repeated_rows_are_one_document_and_empty_tables_pass(spark):
    text = prose(60)
    docs = spark.createDataFrame([(1, text), (1, text), (None, text)], "doc_id long, text string").repartition(3)
    assert [(r.doc_id, r.n_removed) for r in suffix_dedup.suffix_dedup(docs).collect()] == [(1, 0), (1, 0)]
    assert suffix_dedup.suffix_dedup(empty(spark)).count() == 0


def test_stripped_texts_stay_characters(documents, rows):
    want = brute.kept_bytes(rows, 100)
    stripped = suffix_dedup.strip_repeats(documents)
    assert stripped.columns == documents.columns
    for r in stripped.collect():
        data, gone = want[r.doc_id]
        whole = "".join(c for c, flags in _characters(data, gone) if not all(flags))
        assert (r.text or "") == whole


def _characters(data, gone):
    at = 0
    for c in data.decode():
        size = len(c.encode())
        yield c, gone[at:at + size]
        at += size


def test_suffix_sort_survives_hash_collisions(monkeypatch):
    rng = np.random.default_rng(3)
    body = rng.integers(97, 99, size=(300, 12), dtype=np.uint8)
    groups = np.repeat(np.arange(0, 300, 100), 100)
    lengths = rng.integers(1, 13, size=300)
    want = sorted(range(300), key=lambda r: (groups[r], body[r, :lengths[r]].tobytes()))
    order, found = suffix_dedup.Suffixes(body, lengths, groups).sorted_extensions()
    key = lambda r: (groups[r], body[r, :lengths[r]].tobytes())
    assert [key(r) for r in order] == [key(r) for r in want]
    monkeypatch.setattr(suffix_dedup, "row_prefix_hashes", lambda rows: np.zeros((len(rows), rows.shape[1] + 1), np.uint64))
    order, again = suffix_dedup.Suffixes(body, lengths, groups).sorted_extensions()
    assert [key(r) for r in order] == [key(r) for r in want] and list(again) == list(found)


# 2 ----------------------------------------------------------------------------------------------


def test_leaks_within_the_budget_are_found(spark):
    rng = random.Random(2)
    items = [(k, prose(30, rng)) for k in range(20)] + [(30, None), (31, "short"), (32, "")]
    rows = [(900, None), (901, ""), (902, prose(4000, rng))]
    for k in range(20):
        text = list(items[k][1])
        for at in rng.sample([at for at, c in enumerate(text) if c in "aeioustrnl"], k % 6):
            text[at] = rng.choice("xyzq")
        rows.append((k, prose(rng.randint(0, 50), rng) + " " + "".join(text).replace(" ", ",\n ").replace("t", "T") + "! " + prose(5, rng)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.benchmark_leaks(clashing(docs), benchmark).collect()
    texts = dict(rows)
    for r in got:
        passage = texts[r.doc_id].encode()[r.start:r.end]
        letters = [decontam.letters(np.frombuffer(x, np.uint8))[0].tobytes() for x in (passage, items[r.item_id][1].encode())]
        assert brute.edits(*letters) == r.edits <= decontam.BUDGET * len(letters[1])
    assert {(r.doc_id, r.item_id) for r in got} >= {(k, k) for k in range(20) if k % 6 <= 3}
    assert {r.doc_id for r in got} <= set(range(20))
    clean = decontam.drop_leaks(docs, benchmark)
    assert clean.columns == docs.columns and clean.count() == len(rows) - len({r.doc_id for r in got})
    assert decontam.benchmark_leaks(empty(spark), benchmark).count() == 0
    assert decontam.benchmark_leaks(docs, benchmark.limit(0)).count() == 0
    assert decontam.drop_leaks(docs, benchmark.limit(0)).count() == len(rows)


# 3 ----------------------------------------------------------------------------------------------


def test_counts_equal_brute_force(documents, rows):
    texts = dict(rows)
    got = quality.quality_rules(clashing(documents)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute.counts(texts[r.doc_id]), r.doc_id
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.kept and r.base_failed)


def test_thresholds_follow_the_group(spark):
    rng = random.Random(4)
    plain = [(k, prose(50, rng), "en", "a", 0) for k in range(300)]
    marked = [(1000 + k, " ".join(w + "#" for w in prose(50, rng).split()), "en", "code", 0) for k in range(300)]
    odd = [(5000, " ".join(w + "#" for w in prose(50, rng).split()), "en", "a", 0), (5001, None, None, None, None)]
    docs = spark.createDataFrame(plain + marked + odd, SCHEMA)
    kept = {r.doc_id for r in quality.keep_good(docs).collect()}
    assert kept == {r[0] for r in plain + marked}  # usual in one source, an outlier in the other
    assert quality.keep_good(docs).columns == docs.columns
    assert quality.quality_rules(empty(spark)).count() == 0 and quality.keep_good(empty(spark)).count() == 0


def test_sketches_merge_by_adding(spark):
    rng = random.Random(8)
    values = [int(rng.lognormvariate(6, 2)) for _ in range(4000)]
    rows = spark.createDataFrame([("x", v) for v in values], "_lang string, word_length long").withColumns({n: F.lit(None).cast("long") for n in quality.RATES if n != "word_length"})
    whole = quality.quantiles(quality.sketches(rows, ["_lang"]), ["_lang"]).where("rate = 'word_length'").first()
    values.sort()
    for q, got in ((25, whole.q25), (75, whole.q75)):
        exact = values[math.ceil(q * len(values) / 100) - 1]
        assert exact <= got <= exact * (1 + 1 / 64) + 1


# 7 ----------------------------------------------------------------------------------------------


def test_licenses_are_found(spark):
    mit = license_scan.TEMPLATES["MIT-text"]
    dropped = " ".join(w for k, w in enumerate(mit.split()) if k % 9)
    rows = [(1, prose(50) + " Released under the MIT License. " + prose(9)), (2, prose(80) + "\n" + dropped.upper()), (3, prose(300)), (4, None), (5, ""),
            (6, "Released under the MIT License. " * 3), (7, "Licensed under the Apache License, Version 2.0."), (7, "Licensed under the Apache License, Version 2.0."), (None, mit)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = collections.defaultdict(set)
    for r in license_scan.license_scan(clashing(docs)).collect():
        assert 100 * r.matched >= 80 * r.template_words and r.first_word < r.end_word
        got[r.doc_id].add(r.license)
    assert got == {1: {"MIT"}, 2: {"MIT-text"}, 6: {"MIT"}, 7: {"Apache-2.0"}}
    assert license_scan.license_scan(empty(spark)).count() == 0
    assert license_scan.license_scan(docs, {"none": ""}).count() == 0


def test_scan_equals_looking_at_every_window():
    rng = random.Random(6)
    words = [f"w{k}" for k in range(40)]
    template = {"t": " ".join(rng.choice(words) for _ in range(25))}
    counted = collections.Counter(rng.choice(words) for _ in range(500))
    scan = license_scan.Templates(template, 80, counted)
    every = license_scan.Templates(template, 1, counted)  # nearly every word is a seed
    every.percent = 80
    for _ in range(60):
        body = template["t"].split()
        for _ in range(rng.randint(0, 6)):
            body[rng.randrange(25)] = rng.choice(words)
        text = " ".join([*(rng.choice(words) for _ in range(30)), *body, *(rng.choice(words) for _ in range(30))])
        found, want = scan.scan(text), every.scan(text)
        assert bool(found) == bool(want)


@pytest.mark.parametrize("name", sorted(license_scan.TEMPLATES))
def test_copies_near_the_start_are_found_after_stray_seeds(name):
    """Against a longest common subsequence over the whole text."""
    template = license_scan.words_of(license_scan.TEMPLATES[name])
    scan = license_scan.Templates({name: license_scan.TEMPLATES[name]}, 80, {})
    for stray in sorted(scan.seeds):
        for offset in range(len(template) // 4 + 4):
            text = [stray, *(f"x{k}" for k in range(offset - 1))][:offset] + template + [f"y{k}" for k in range(30)]
            assert brute.common(text, template) == len(template)
            found = scan.scan(" ".join(text))
            assert [(f[0], f[1]) for f in found] == [(name, len(template))], (stray, offset)


def test_a_licence_header_after_its_copyright_line_is_found():
    header = "Copyright (c) 2020 Name " + license_scan.TEMPLATES["MIT-text"]
    counted = collections.Counter(license_scan.words_of(license_scan.TEMPLATES["MIT-text"]))  # seeds occur once
    assert [f[0] for f in license_scan.Templates(license_scan.TEMPLATES, 80, counted).scan(header)] == ["MIT-text"]


def test_longest_increasing_subsequence():
    rng = random.Random(1)
    for _ in range(200):
        values = [rng.randrange(12) for _ in range(rng.randrange(9))]
        rising = lambda s: all(a < b for a, b in zip(s, s[1:]))
        best = max(n for n in range(len(values) + 1) if any(map(rising, itertools.combinations(values, n))))
        kept = license_scan.increasing(values)
        assert len(kept) == best and all(values[a] < values[b] for a, b in zip(kept, kept[1:]))


# 9 ----------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(PATH), special_tokens={})


def test_bpe_equals_tiktoken(documents, rows, reference):
    texts = dict(rows)
    out = bpe_round_trip(clashing(documents), PATH, public_tokenizers.PATTERN)
    assert "kept" in out.columns and out.columns.count("ids") == 1
    for r in out.collect():
        assert r.ids == reference.encode_ordinary(texts[r.doc_id] or "")
        assert bytes(r.decoded).decode() == (texts[r.doc_id] or "")
    digests = id_digests(out)
    assert digests.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_bpe_on_random_pieces(reference):
    bpe = encoder(PATH, public_tokenizers.PATTERN)
    rng = random.Random(3)
    for _ in range(3000):
        text = "".join(rng.choice(rng.choice(["ab", "abc ", "éàü", " \t\n", "01", "日本語", "'s t"])) for _ in range(rng.randint(0, 60)))
        ids = bpe.encode(text)
        assert ids == reference.encode_ordinary(text) and bpe.decode(ids).decode() == text
    assert list(bpe.encode_piece(b"a" * 50_000)) == reference.encode_ordinary("a" * 50_000)


def test_bpe_merges_of_a_small_vocabulary():
    """Against repeated merging of the lowest pair, on vocabularies whose merges overlap."""
    rng = random.Random(7)
    for _ in range(20):
        ranks = {bytes([b]): b for b in range(256)}
        words = [bytes(rng.choice(b"abc") for _ in range(12)) for _ in range(30)]
        for rank in range(256, 290):
            pairs = collections.Counter(p for w in words for p in itertools.pairwise(_merge(w, ranks)))
            pairs = [(n, p) for p, n in pairs.items() if p[0] + p[1] not in ranks]
            if pairs:
                ranks[b"".join(max(pairs)[1])] = rank
        bpe = Encoder(ranks, r"\S+|\s+")
        for _ in range(200):
            piece = bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 25)))
            want = (ranks[piece],) if piece in ranks else tuple(ranks[t] for t in _merge(piece, ranks))
            assert bpe.encode_piece(piece) == want


def _merge(piece, ranks):
    parts = [piece[k:k + 1] for k in range(len(piece))]
    while True:
        best = min(((ranks[a + b], k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks), default=None)
        if best is None:
            return parts
        k = best[1]
        parts[k:k + 2] = [parts[k] + parts[k + 1]]


# 2, parts and short items ---------------------------------------------------------------------


def test_short_items_and_parts_of_long_ones(spark):
    rng = random.Random(31)
    long = prose(120, rng)
    items = [(1, "Who wrote Don Quixote?"), (2, "Paris"), (3, long), (4, "to be, or not"), (5, None), (6, "who wrote don quixote")]
    half, most = long[: len(long) // 2], edited(long[20 : 20 + int(len(long) * 0.8)], 2, rng)
    docs = [(10, prose(30, rng) + " who WROTE Don  Quixote and when"), (11, "Whowho wrote don quixotes"), (12, "Paris in spring " + prose(5, rng)), (13, prose(9, rng) + " " + half + " " + prose(9, rng)),
            (14, prose(9, rng) + " " + most + " " + prose(9, rng)), (15, long), (16, "To be or not to be"), (17, "unto be or nothing"), (18, ""), (19, None), (20, long[:100] + " " + prose(60, rng))]
    found = decontam.benchmark_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    got = {(r.doc_id, r.item_id): r for r in found}
    assert set(got) == {(10, 1), (10, 6), (13, 3), (14, 3), (15, 3), (16, 4)} and len(found) == len(got)
    text = dict(docs)
    assert text[10].encode()[got[10, 1].start:got[10, 1].end] == b"who WROTE Don  Quixote"
    assert (got[15, 3].edits, got[15, 3].start, got[15, 3].end) == (0, 0, len(long.rstrip().encode()))


def test_any_long_quotation_of_an_item_is_found():
    """Brute force over every passage of one and a half pieces."""
    rng = random.Random(33)
    item = "".join(rng.choice("abcdefgh") for _ in range(700))
    items = decontam.Items([(1, item)], decontam.Q, decontam.BUDGET)
    size = 3 * decontam.PIECE // 2
    for begin in range(0, len(item) - size + 1, 7):
        data = np.frombuffer(("xyz" * 20 + item[begin : begin + size] + "zyx" * 20).encode(), np.uint8)
        assert [x[:3] for x in decontam.leaks(items, data, np.array([0, len(data)]))] == [(0, 1, 0)]
    data = np.frombuffer(("xyz" * 20 + item[: decontam.PIECE // 2] + "zyx" * 20).encode(), np.uint8)
    assert list(decontam.leaks(items, data, np.array([0, len(data)]))) == []


def test_license_with_words_between(spark):
    """As the docstring bounds them: up to a quarter of the template's words, and two."""
    words = license_scan.words_of(license_scan.TEMPLATES["ISC-text"])
    for n in (0, 4, len(words) // 4 + 2):
        text = " ".join([*words[:17], *[f"other{k}" for k in range(n)], *words[17:]])
        found = {x[0]: x[1] for x in license_scan.Templates(license_scan.TEMPLATES, 80, {}).scan(text)}
        assert found["ISC-text"] == len(words)


# 10 ---------------------------------------------------------------------------------------------


def test_base_score_equals_brute_force(documents, rows, monkeypatch):
    monkeypatch.setattr(lm, "HOT", 5)  # nearly every word goes by its bucket
    words = {i: [*(t or "").encode().lower().split(), None] for i, t in rows}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in words}
    c = collections.Counter(w for i, ws in words.items() if not held[i] for w in ws)
    size = sum(c.values())
    got = lm.lm_scores(clashing(documents), PATH).collect()
    assert len(got) == len(rows)
    for r in got:
        ws = words[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(ws), sum(c[w] > 0 for w in ws), size)
        assert r.base_score == pytest.approx(sum(math.log10((c[w] + 1) / (size + len(c) + 1)) for w in ws), abs=1e-6)
        assert -1e9 < r.score < 0


def test_scores_on_an_empty_table(spark):
    assert lm.lm_scores(empty(spark), PATH).count() == 0
    docs = spark.createDataFrame([(None, "a b"), (None, None)], "doc_id long, text string")
    assert sorted((r.doc_id, r.held_out, r.n_tokens) for r in lm.lm_scores(docs, PATH).collect()) == [(None, False, 1), (None, False, 3)]


def _model():
    counts = np.zeros(300, np.int64)
    counts[:60] = 1000 // np.arange(1, 61)
    layout = lm.Layout(counts, 299)
    model = layout.start()
    rng = np.random.default_rng(1)
    return layout, {k: v + rng.normal(size=v.shape).astype(np.float32) * 0.3 for k, v in model.items()}


def test_gradients_equal_differences():
    layout, model = _model()
    model = {k: v.astype(np.float64) for k, v in model.items()}
    rng = np.random.default_rng(2)
    x, y, _ = lm._encode([rng.integers(0, 300, size=n) for n in (3, 40, 1)], layout)
    y = np.where(y >= 0, layout.classes[y], -1)
    _, g = lm.gradients(model, x, y, layout.pad)
    for name in model:
        flat = model[name].reshape(-1)
        for k in rng.choice(len(flat), 6):
            was, step = flat[k], 1e-5
            flat[k] = was + step
            up = lm.gradients(model, x, y, layout.pad)[0]
            flat[k] = was - step
            down = lm.gradients(model, x, y, layout.pad)[0]
            flat[k] = was
            assert (up - down) / (2 * step) == pytest.approx(g[name].reshape(-1)[k], abs=2e-4)


def test_windows_score_each_token_once_and_causally():
    layout, model = _model()
    score = lm.Scorer(model, layout)
    rng = np.random.default_rng(4)
    texts = [rng.integers(0, 300, size=n) for n in (1, 15, 16, 17, 20, 25, 100)]
    whole = score(texts)
    assert whole == pytest.approx([score([t])[0] for t in texts], rel=1e-5)
    index, scored = lm.windows(np.array([len(t) for t in texts]))
    assert sorted(scored[scored >= 0]) == list(range(sum(map(len, texts))))
    # Probabilities of the next id sum to one, whatever the context.
    for begin in ([], [5, 9, 2]):
        before = score([np.array(begin)])[0] if begin else 0.0
        after = score([np.array([*begin, k]) for k in range(300)])
        assert sum(10 ** (after - before)) == pytest.approx(1, abs=1e-3)


def test_the_context_tells_frequent_ids_apart():
    """Also far behind the most frequent ids: which of two is likelier must not be the same after every context."""
    layout = lm.Layout(20_000_000 // np.arange(1, 3001), 2999)
    rng = np.random.default_rng(6)
    score = lm.Scorer({k: v + rng.normal(size=v.shape).astype(np.float32) * 0.3 for k, v in layout.start().items()}, layout)
    for one, other in ((40, 41), (300, 301), (900, 901)):
        margins = [np.subtract(*score([np.array([*context, one]), np.array([*context, other])])) for context in ([3, 8], [700, 5])]
        assert abs(margins[0] - margins[1]) > 1e-3
    assert lm.CONTEXT - lm.STRIDE >= 8 and sorted(set(layout.classes.tolist())) == list(range(layout.size))


def test_training_reads_every_token_once(spark, monkeypatch):
    rows = [(1, prose(4000)), (2, None), (3, ""), (None, prose(900)), (4, prose(30)), (4, prose(30))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    cut = lm.cutter(PATH)
    sequences = [np.array([*cut((t or "").encode()), cut.end]) for _, t in rows]
    layout = lm.Layout(np.bincount(np.concatenate(sequences), minlength=cut.size), cut.end)
    cut_rows = docs.mapInArrow(lm._cut(PATH), "doc_id long, text string, ids binary")
    for part_bytes, fan in ((16 << 20, 64), (3000, 2)):
        monkeypatch.setattr(lm, "PART_BYTES", part_bytes)
        monkeypatch.setattr(lm, "FAN", fan)
        seen, first = [], type(docs).first
        with monkeypatch.context() as inside:
            inside.setattr(type(docs), "first", lambda df: seen.append(first(df)) or seen[-1])
            lm.train(cut_rows, layout)
        assert sum(r["tokens"] for r in seen if r is not None and "tokens" in r) == sum(map(len, sequences))


def test_parts_are_learned_from_in_tasks_of_their_own(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(lm, "PART_BYTES", 1000)
    rng = random.Random(15)
    docs = spark.createDataFrame([(k, prose(60, rng)) for k in range(60)], "doc_id long, text string")
    cut, plain, folder = lm.cutter(PATH), lm._train, str(tmp_path)

    def noted(layout, model, turn):
        run = plain(layout, model, turn)

        def note(group):
            with open(f"{folder}/{turn} {group.column('part')[0]} {TaskContext.get().partitionId()}", "w"):
                return run(group)
        return note

    monkeypatch.setattr(lm, "_train", noted)
    lm.train(docs.mapInArrow(lm._cut(PATH), "doc_id long, text string, ids binary"), lm.Layout(np.ones(cut.size, np.int64), cut.end))
    found = [x.name.split() for x in tmp_path.iterdir()]
    for turn in {x[0] for x in found}:
        parts, tasks = zip(*(x[1:] for x in found if x[0] == turn), strict=True)
        assert len(parts) == len(set(parts)) == len(set(tasks)) > 4


def test_scores_do_not_depend_on_partitions(spark, monkeypatch):
    monkeypatch.setattr(lm, "PART_BYTES", 4000)
    rows = [(k, prose(60 + k % 50)) for k in range(60)] + [(7, prose(5)), (None, prose(9))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    one, many = (sorted((str(r.doc_id), r.n_tokens, r.base_score, r.score) for r in lm.lm_scores(docs.repartition(n), PATH).collect()) for n in (1, 8))
    assert [x[:2] for x in one] == [x[:2] for x in many]
    assert [x[3] for x in one] == pytest.approx([x[3] for x in many], rel=1e-6)  # batches of single-precision products differ


def test_ids_stay_exact_beside_nulls(spark):
    rows = [(9007199254740993, "a b"), (None, "c")]
    assert {r.doc_id for r in lm.lm_scores(spark.createDataFrame(rows, "doc_id long, text string").repartition(1), PATH).collect()} == {9007199254740993, None}


def test_pieces_are_cut_like_one_by_one():
    cut, texts = lm.cutter(PATH), [b"", b" ", b"The  cat\nsat ", b"x", "Été à la mer\t\t".encode(), b"\n\nthe cat", b"a" * 300, b"  "]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.r_[0, np.cumsum([len(t) for t in texts])]
    tokens = {v: k for k, v in read_ranks(PATH).items()}
    for own, text in zip(cut.cut(data, offsets), texts, strict=True):
        assert own[-1] == cut.end and own[:-1].tolist() == cut(text)
        assert b"".join(tokens[i] for i in own[:-1].tolist()) == text.lower()
        pieces = re.findall(rb"[\x20\x09-\x0d]*[^\x20\x09-\x0d]+|[\x20\x09-\x0d]+$", text.lower())
        assert [i for x in pieces for _, i in cut.automaton.iter_long(x.decode("latin-1"))] == cut(text)


@pytest.mark.parametrize("larger", [1, 40])
def test_scorer_equals_a_plain_forward_pass(larger):
    """One token after the other, one window after the other, without batches or tables; also where exponents need an offset."""
    layout, model = _model()
    model["C"] *= larger
    model["Q"] *= larger
    m = {k: v.astype(np.float64) for k, v in model.items()}
    rng = np.random.default_rng(8)
    for n in (1, 5, 16, 17, 40, 70):
        ids = rng.integers(0, 300, size=n)
        rows, total = [layout.begin, *layout.rows[ids[:-1]]], 0.0
        for t, token in enumerate(ids):
            begin = max(0, t // lm.STRIDE * lm.STRIDE + lm.STRIDE - lm.CONTEXT)
            place = lm.CONTEXT - lm.STRIDE - t // lm.STRIDE * lm.STRIDE  # slot of the text's place 0
            x = np.array([m["E"][rows[j]] + m["P"][j + place] for j in range(begin, t + 1)])
            scores = (x @ m["K"]) @ (x[-1] @ m["Q"]) / math.sqrt(lm.WIDTH)
            a = np.exp(scores - scores.max())
            h = x[-1] + (a / a.sum()) @ (x @ m["V"])
            z = h @ m["C"] + m["b"]
            total += (z[layout.classes[token]] - z.max() - math.log(np.exp(z - z.max()).sum())) / math.log(10) + layout.share[token]
        assert lm.Scorer(model, layout)([ids])[0] == pytest.approx(total, rel=1e-4 * larger)


def test_slots_without_a_target_get_no_class_scores(monkeypatch):
    layout, model = _model()
    counted = []
    for name in ("exp", "exp2"):
        monkeypatch.setattr(np, name, lambda z, *args, _plain=getattr(np, name), **more: counted.append(np.size(z)) or _plain(z, *args, **more))
    texts = [np.array([k % 300]) for k in range(200)]
    lm.Scorer(model, layout)(texts)
    assert sum(counted) < 2 * len(texts) * (layout.size + lm.STRIDE * lm.CONTEXT)
    counted.clear()
    x, y, _ = lm._encode(texts, layout)
    lm.gradients(model, x, np.where(y >= 0, layout.classes[y], -1), layout.pad)
    assert sum(counted) < 2 * len(texts) * (layout.size + lm.STRIDE * lm.CONTEXT)


@pytest.mark.parametrize("larger", [1, 30, 1000])
def test_class_scores_in_blocks_equal_a_plain_softmax(larger):
    """Also in a block that is not full, and where powers need an offset."""
    rng = np.random.default_rng(9)
    C, b = rng.normal(size=(lm.WIDTH, 70)) * larger, rng.normal(size=70)
    classes = lm.Classes(C, b)
    for n in (1, lm.BLOCK, lm.BLOCK * lm.STACK, 2 * lm.BLOCK * lm.STACK + 5):
        h, own = rng.normal(size=(n, lm.WIDTH)), rng.integers(0, 70, n)
        z = h @ C + b
        z -= z.max(1, keepdims=True)
        shares = np.exp(z) / np.exp(z).sum(1, keepdims=True)
        contexts = classes.blocks(h)
        logs = np.empty(contexts.shape[:2])
        got = np.concatenate([(p / total[..., None]).reshape(-1, 70) for _, p, total in classes(contexts, logs)])[:n]
        assert got == pytest.approx(shares, abs=1e-9)
        assert (classes.chosen(contexts, own) - logs.reshape(-1)[:n]) * np.log(2) == pytest.approx((z - np.log(np.exp(z).sum(1, keepdims=True)))[np.arange(n), own], abs=1e-7 * larger)


# Hashes -----------------------------------------------------------------------------------------


def thue_morse(n, a="a", b="b"):
    return "".join(a if bin(k).count("1") % 2 == 0 else b for k in range(n))


def test_hashes_tell_thue_morse_strings_apart():
    for n in (8, 64, 128, 1024, 4096):
        x, y = thue_morse(n).encode(), thue_morse(n, "b", "a").encode()
        data = np.frombuffer(x + y, np.uint8)
        h = blocks.lane_hashes(data, np.array([0, n]), np.array([n, 2 * n]))
        assert h[0] != h[1]
    rng = np.random.default_rng(3)
    data = rng.integers(97, 99, 5000).astype(np.uint8)
    start = np.sort(rng.integers(0, 5000, 4000))
    end = np.minimum(5000, start + rng.integers(0, 60, 4000))
    names = {}
    for s, e, h in zip(start, end, blocks.lane_hashes(data, start, end).tolist(), strict=True):
        assert names.setdefault(h, data[s:e].tobytes()) == data[s:e].tobytes()
    assert len(names) == len({data[s:e].tobytes() for s, e in zip(start, end, strict=True)})


def test_operators_tell_thue_morse_texts_apart(spark):
    x, y = thue_morse(1024), thue_morse(1024, "b", "a")
    docs = spark.createDataFrame([(1, x), (2, y), (3, x + "\n" + y + " z" * 30)], "doc_id long, text string").withColumns({"lang": F.lit("en"), "source": F.lit("s")})
    assert {r.doc_id: r.component_id for r in ngram_join.ngram_jaccard_join(docs).collect()} == {1: 1, 2: 2, 3: 3}
    assert {r.doc_id: r.n_dup_lines for r in quality.quality_rules(docs).collect()} == {1: 0, 2: 0, 3: 0}
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.suffix_dedup(docs).collect()} == brute.suffix_rows([(r.doc_id, r.text) for r in docs.collect()], 100)
    words = {r.doc_id: r.n_known for r in lm.lm_scores(docs, PATH).collect()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in (1, 2, 3)}
    assert words[1] == 1 + (not held[1] or not held[3]) and words[2] == 1 + (not held[2] or not held[3])


def test_training_helps_on_held_out_texts(spark):
    rng = random.Random(12)
    cycle = [" the cat", " sat on", " a mat", " and then"]
    rows = [(k, "".join(cycle[(k + j) % 4] for j in range(rng.randint(30, 120)))) for k in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = [r for r in lm.lm_scores(docs, PATH).collect() if r.held_out]
    assert got and sum(r.score for r in got) < 0
    cut = lm.cutter(PATH)
    ids = collections.Counter(i for k, t in rows if zlib.crc32(str(k).encode()) % 7 != 2 for i in [*cut(t.encode()), cut.end])
    total = sum(ids.values()) + cut.size
    unigram = sum(math.log10((ids[i] + 1) / total) for k, t in rows if zlib.crc32(str(k).encode()) % 7 == 2 for i in [*cut(t.encode()), cut.end])
    assert sum(r.score for r in got) > 0.8 * unigram
