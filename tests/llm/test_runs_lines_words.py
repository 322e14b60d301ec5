"""Periodic runs, line dedup and spelling variants against brute force, with the cases their docstrings define."""

import collections
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import periodic_runs as pr
from shelfwise.llm import spelling
from shelfwise.llm.line_dedup import line_dedup
from tests.llm import brute

SCHEMA = "doc_id long, text string, lang string"


def frame(spark, rows, parts=5):
    return spark.createDataFrame([(i, t, None) for i, t in rows], SCHEMA).repartition(parts)


def clashing(df, *names):
    return df.withColumns({c: F.lit("mine") for c in names})


# 11 ---------------------------------------------------------------------------------------------


def words_with_repeats(rng):
    n, letters = rng.randint(0, 60), rng.randint(1, 4)
    words = [rng.randrange(letters) for _ in range(n)]
    if n and rng.random() < 0.5:
        p, a = rng.randint(1, 10), rng.randrange(n)
        words = [words[i] if i < a else words[a + (i - a) % min(p, n - a)] for i in range(n)]
    return words


@pytest.mark.parametrize("least", [2, 5, 12, 13])
def test_automaton_finds_the_runs_and_regions_hold_them(least):
    rng = random.Random(least)
    for _ in range(400):
        texts = [words_with_repeats(rng) for _ in range(rng.randint(1, 3))]
        bounds = np.r_[0, np.cumsum([len(t) for t in texts])].astype(int)
        flat = [w for t in texts for w in t]
        want = [(s + a, n, q) for t, a in zip(texts, bounds[:-1].tolist(), strict=True) for s, n, q in brute.runs(t, least)]
        for t in texts:
            assert pr.runs_of(t, least) == brute.runs(t, least)
        regions = pr.repeated_regions(pr.mix(np.array(flat, dtype=np.uint64)), bounds, least)
        assert sorted((s + a, n, q) for a, b in regions for s, n, q in pr.runs_of(flat[a:b], least)) == sorted(want)
        # Equal hashes may only send more words to the automaton.
        regions = pr.repeated_regions(np.zeros(len(flat), np.uint64), bounds, least)
        assert sorted((s + a, n, q) for a, b in regions for s, n, q in pr.runs_of(flat[a:b], least)) == sorted(want)


def test_runs_of_fibonacci_and_unary_words():
    a, b = [0], [0, 1]
    while len(b) < 400:
        a, b = b, b + a
    assert pr.runs_of(b, 12) == brute.runs(b, 12)
    assert pr.runs_of([7] * 3000, 12) == [(0, 3000, 1)]


@pytest.fixture(scope="module")
def run_rows():
    rng = random.Random(3)
    vocabulary = [f"w{k}" for k in range(40)] + ["é", "日本", "A", "a"]
    rows = [(None, None), (1, None), (2, ""), (3, " \t\n\x0b"), (4, "one two"), (5, "x " * 11), (6, "x\n" * 12), (6, "x\n" * 12), (None, "y z " * 9), (7, "A a " * 8)]
    for k in range(120):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(0, 80))]
        if k % 3 == 0 and words:
            a, p = rng.randrange(len(words)), rng.randint(1, 12)
            words = words[:a] + words[a:a + p] * rng.randint(1, 9) + words[a:]
        rows.append((100 + k, rng.choice([" ", "  ", "\n", "\t \r\n"]).join(words)))
    rows.append((999, "lorem ipsum dolor " * 30000))
    return rows


def test_periodic_runs_equal_brute_force(spark, run_rows):
    got = pr.periodic_runs(clashing(frame(spark, run_rows), "runs", "n_words", "collapsed", "start")).collect()
    want = []
    for i, text in run_rows:
        words = brute.WORD.findall(text or "")
        runs = brute.runs(words, 12) if i != 999 else [(0, 90000, 3)]
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        want.append((i, len(words), runs, " ".join(w for k, w in enumerate(words) if k not in gone)))
    assert sorted(map(repr, want)) == sorted(repr((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed)) for r in got)


def test_view_reads_words_in_another_order(spark):
    rows = [(1, "a b c"), (2, "a b c"), (None, "d e")]
    got = pr.periodic_runs(frame(spark, rows, 1), view=lambda i, n: np.arange(24) % n if i == 2 else None).collect()
    assert sorted((str(r.doc_id), r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got) == [
        ("1", 3, [], "a b c"), ("2", 24, [(0, 24, 3)], "a b c"), ("None", 2, [], "d e")]


def test_large_ids_stay_exact_beside_nulls(spark):
    rows = [(9007199254740993, "a"), (None, "b")]
    assert {r.doc_id for r in pr.periodic_runs(frame(spark, rows, 1)).collect()} == {9007199254740993, None}


def test_periodic_runs_of_an_empty_table(spark):
    assert pr.periodic_runs(frame(spark, [], 1)).collect() == []


# 12 ---------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def line_texts():
    rng = random.Random(8)
    shared = ["A Footer That Many documents hold", "Été à la ÉCOLE des beaux", "short line", "x" * 19, "x" * 20, " \t" + "Y" * 20 + "\r", "é" * 20]
    rows = [(None, None), (1, None), (2, ""), (3, "\n\n"), (None, "\n".join(shared)), (4, "\n".join(shared * 2)), (4, "\n".join(shared[:3])), (4, "\n".join(shared[:3]))]
    for k in range(60):
        lines = [rng.choice(shared) if rng.random() < 0.6 else f"only the line number {k} {j} of this text" for j in range(rng.randint(0, 9))]
        rows.append((10 + k, "\n".join(x.upper() if rng.random() < 0.2 and x.isascii() else x for x in lines)))
    rows += [(200, shared[0]), (201, "held by two documents only"), (202, "held by two documents only"), (300, "\n".join([shared[0], "a line of a long text, again"] * 40000))]
    return rows


@pytest.mark.parametrize("least_chars, least_docs", [(20, 3), (1, 2), (20, 1)])
def test_line_dedup_equals_brute_force(spark, line_texts, least_chars, least_docs):
    got = line_dedup(clashing(frame(spark, line_texts), "row", "line", "lines", "at", "hash", "key", "gone"), least_chars=least_chars, least_docs=least_docs).collect()
    assert sorted(map(repr, brute.line_rows(line_texts, least_chars, least_docs))) == sorted(repr(tuple(r)) for r in got)


def test_line_dedup_of_an_empty_table(spark):
    assert line_dedup(frame(spark, [], 1)).collect() == []


# 13 ---------------------------------------------------------------------------------------------


def misspelt(rng, letters, bases, n, longest):
    out = []
    for _ in range(n):
        w = list(rng.choice(bases))
        for _ in range(rng.choice([0, 1, 1, 2])):
            at = rng.randrange(len(w))
            w[at:at + rng.choice([0, 1])] = rng.choice([[], [rng.choice(letters)]])
        out.append("".join(w)[:longest])
    return out


@pytest.fixture(scope="module")
def spelling_texts():
    rng = random.Random(13)
    letters = "abcdeéÀß×÷"
    bases = ["".join(rng.choice(letters) for _ in range(rng.randint(7, 14))) for _ in range(25)] + ["a" * 9, "ab" * 5, "a" * 40]
    rows = [(None, None), (1, None), (2, ""), (3, "short words"), (None, bases[0] + " " + bases[0]), (4, (bases[1] + ", ") * 60), (4, (bases[1] + ", ") * 60), (5, "Xyzzyxa xyzzyxa XYZZYXA日xyzzyxb")]
    rows += [(10 + k, rng.choice([" ", "-", "1", "日"]).join(misspelt(rng, letters, bases, 60, 60))) for k in range(60)]
    rows.append((999, " ".join(bases * 2000)))
    return rows


def counted(rows):
    low = lambda s: "".join(c.lower() if "A" <= c <= "Z" else c for c in s)
    counts = collections.Counter(low(w) for _, t in rows for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""))
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


@pytest.mark.parametrize("block, held", [(1024, 400_000), (2, 50)])
def test_spelling_variants_equal_brute_force(spark, spelling_texts, monkeypatch, block, held):
    monkeypatch.setattr(spelling, "BLOCK", block)
    monkeypatch.setattr(spelling, "HELD", held)
    got = spelling.spelling_variants(clashing(frame(spark, spelling_texts), "word", "n", "near", "block")).collect()
    want = brute.spelling_rows(counted(spelling_texts), 10)
    assert len(want) > 200 and any(v[0] for v in want.values()) and any(v[3] > 2 for v in want.values())
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got} == want
    assert len(got) == len(want)


def test_forms_chain_to_their_root(spark):
    """Counts 1000, 100, 10 and 2 in a row of single edits, and a tie between two forms."""
    text = " ".join(["abcdefgh"] * 3000 + ["abcdefgx"] * 300 + ["abcdefyx"] * 30 + ["abcdezyx"] * 3 + ["tiewordb"] * 40 + ["tieworda"] * 40 + ["tiewordc"] * 2)
    got = {r.word: (r.form, r.root, r.n_near) for r in spelling.spelling_variants(frame(spark, [(1, text)], 1)).collect()}
    assert got["abcdezyx"] == ("abcdefyx", "abcdefgh", 1)
    assert got["abcdefgh"] == (None, "abcdefgh", 1)
    assert got["tiewordc"] == ("tieworda", "tieworda", 2)


def test_a_block_of_one_prefix_is_halved(spark, monkeypatch):
    """All words share all but their last letters: the block is halved until few are left, and no pair is lost."""
    monkeypatch.setattr(spelling, "BLOCK", 20)
    rng = random.Random(2)
    words = sorted({"prefixprefix" + "".join(rng.choice("abc") for _ in range(rng.choice([4, 5]))) for _ in range(300)})
    table = spark.createDataFrame([(w, 2) for w in words], "word string, n long")
    largest = spelling.blocks_of(table).where("hi - lo > 1").groupBy("block").count().agg(F.max("count")).first()[0]
    assert largest <= 20
    got = sorted((r.word, r.near) for r in spelling.near_words(table).collect())
    assert got == sorted((a, b) for a in words for b in words if abs(len(a) - len(b)) <= 1 and brute.edits(a, b) == 1)


def test_spelling_variants_of_an_empty_table(spark):
    assert spelling.spelling_variants(frame(spark, [], 1)).collect() == []
