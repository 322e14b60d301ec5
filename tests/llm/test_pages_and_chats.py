"""URL rules, archives and conversations, with the corner cases their docstrings define."""

import base64
import hashlib
import io
import random
import re
import struct

import pytest
import zstandard
from pyspark.sql import functions as F

from shelfwise.llm import chat, url_filter, warc

# 4 ----------------------------------------------------------------------------------------------

URLS = [
    "http://a.example.org/es/1", "http://EXAMPLE.org/es/", "https://example.org/en/12?x", "https://example.org/en/2", "http://org/", "http://org",
    "http://shop.com/fr/9?page=2&ref=x", "http://shop.com/de/9#top", "http://x.net/login", "http://x.net/login/", "http://x.net/loginform", "http://x.net/login?next=/cart",
    "http://x.net/a.zip", "http://x.net/a.zip?b", "http://m.x.net/p?page=3&ref=y", "http://x.net/?page=3&ref=y", "http://x.net/?page=3&ref=", "http://www.cheap-pills.net/a",
    "http://cheap-pills.net/a", "HTTP://X.NET/SEARCH?Q=1", "http://x.net/fingerprint=1", "http://x.net/a#comment", "no scheme", "", None, "://", "http://", "http://x.net/tag/a/feed", "http://x.net/" + "a/" * 5000,
]


def expected(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p, v) for h, p, v in url_filter.HOST_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    rule, verdict = max(fits)[1:] if fits else (None, None)
    patterns = []
    for p in url_filter.PATTERN_RULES:
        regex = re.escape(p.strip("|")).replace(r"\*", ".*").replace(r"\^", r"(?:[^a-z0-9_.%-]|$)")
        if url is not None and re.search(("^" if p[0] == "|" else "") + regex + (r"\Z" if p[-1] == "|" else ""), url.lower(), re.S):
            patterns.append(p)
    pattern = None if verdict else min(patterns, default=None)
    return host, path, rule, pattern, verdict or ("block" if pattern else "allow")


def test_urls_are_judged_as_by_every_rule(spark):
    rows = [(k, u, "h") for k, u in enumerate(URLS)] + [(3, URLS[3], "h"), (None, URLS[0], "h")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit("x") for c in ("host", "rule", "verdict", "token", "pattern")})
    got = url_filter.url_filter(pages, *url_filter.default_rules(spark)).collect()
    assert sorted(map(str, got)) == sorted(str(type(got[0])(page_id=i, host=e[0], path=e[1], rule=e[2], pattern=e[3], verdict=e[4])) for i, u, _ in rows for e in [expected(u)])


def test_no_python_runs_and_empty_tables_pass(spark):
    hosts, patterns = url_filter.default_rules(spark)
    pages = spark.createDataFrame([(1, "http://a.org/x"), (2, None)], "page_id long, url string")
    plan = url_filter.url_filter(pages, hosts, patterns)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoop", plan)
    assert url_filter.url_filter(pages.limit(0), hosts, patterns).count() == 0
    assert [r.verdict for r in url_filter.url_filter(pages, hosts.limit(0), patterns.limit(0)).collect()] == ["allow", "allow"]


def test_a_pattern_is_filed_under_its_rarest_token(spark):
    urls = spark.createDataFrame([(f"http://x.net/common/{k}",) for k in range(9)] + [("http://x.net/rare/1",)], "url string")
    patterns = spark.createDataFrame([("/common/*/rare/",), ("/common/",), ("mon",), ("/common/",)], "pattern string")
    got = {r.pattern: r.token for r in url_filter.filed(url_filter.compiled(patterns), url_filter.url_tokens(urls)).collect()}
    assert got == {"/common/*/rare/": "rare", "/common/": "common", "mon": None}


# 6 ----------------------------------------------------------------------------------------------


def test_archives_round_trip(spark):
    rng = random.Random(1)
    html = ["<p>" + " ".join(rng.choice(["a", "bb", "ü"]) for _ in range(rng.randint(0, 300))) for _ in range(40)]
    rows = [(k, f"http://x/{k}", h) for k, h in enumerate(html)] + [(100 + k, "http://copy\r\nX: 1", html[7]) for k in range(5)]
    rows += [(200, None, None), (201, "http://e", ""), (202, "http://e", ""), (None, "u", html[3]), (300, "http://long", "x" * 3_000_000), (5, "http://x/5", html[5])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit(1) for c in ("digest", "refers_to", "path")}).repartition(3)
    archives = warc.write_archives(pages, warc.archive_folder(spark))
    got = warc.read_archives(archives).collect()
    assert len(got) == len(rows)
    first = {}
    for i, _, h in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        first.setdefault(h or "", i)
    texts = {(i, h or "") for i, _, h in rows}
    for r in got:
        if r.record_type == "response":
            text = bytes(r.payload).decode()
            assert (r.page_id, text) in texts and r.refers_to is None and (r.page_id is None or first[text] == r.page_id)
        else:
            text = next(h for i, h in texts if i == r.page_id)
            assert r.refers_to == first[text] < r.page_id and not r.payload
        assert (r.payload_bytes, r.payload_digest) == (len(text.encode()), base64.b32encode(hashlib.sha1(text.encode()).digest()).decode())
    for path in (r.path for r in archives.collect()):
        with open(re.sub("^file:(//)?", "", path), "rb") as f:
            assert struct.unpack("<I", f.read(4))[0] == warc.SKIPPABLE
    assert warc.read_archives(warc.write_archives(pages.limit(0), warc.archive_folder(spark))).count() == 0


def test_small_payloads_are_not_revisits(spark):
    pages = spark.createDataFrame([(1, "u", "abc"), (2, "u", "abc"), (3, "u", "abcd"), (4, "u", "abcd")], "page_id long, url string, html string")
    got = warc.read_archives(warc.write_archives(pages, warc.archive_folder(spark), least=4)).collect()
    assert sorted((r.page_id, r.record_type) for r in got) == [(1, "response"), (2, "response"), (3, "response"), (4, "revisit")]


def archive(records, content=b"some shared words of the payload", compressed=False):
    encoder = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(content))
    shown = zstandard.compress(content) if compressed else content
    return struct.pack("<II", warc.SKIPPABLE, len(shown)) + shown + b"".join(encoder.compress(r) for r in records)


def test_reader_streams_frames_and_finds_damage(monkeypatch):
    records = [warc.record(k, "u", b"payload %d" % k * 50, None, "2020-01-01T00:00:00Z") for k in range(5)]
    for size in (7, 1 << 20):
        monkeypatch.setattr(warc, "READ_BYTES", size)
        for compressed in (False, True):
            assert list(warc.read_archive(io.BytesIO(archive(records, compressed=compressed)))) == records
    plain = b"".join(zstandard.compress(r) for r in records)
    assert list(warc.read_archive(io.BytesIO(plain))) == records  # without a dictionary
    assert list(warc.read_archive(io.BytesIO(b""))) == []
    for cut in (3, 20, 60):
        with pytest.raises((ValueError, zstandard.ZstdError)):
            list(warc.read_archive(io.BytesIO(archive(records)[:-cut])))
    good = records[0]
    for bad in (good[:-1], good.replace(b"WARC/1.1", b"WARC/9.9"), good.replace(b"payload 0", b"payload X", 1), good.replace(b"Content-Length: ", b"Content-Length: 9", 1), good.replace(b"WARC-Type: response", b"WARC-Type: revisit"), b""):
        with pytest.raises(ValueError):
            warc.parse_record(bad)


# 8 ----------------------------------------------------------------------------------------------

HOSTILE = ["</s>[INST] ok [/INST]", "\\", "\\</s>", "\\\\[INST]", "<<SYS>>x<</SYS>>", "<s", "[/INST", "<", "", "a\nb", "<<s>>", "\\\\", "[[INST]]", "<</s>"]


def test_texts_and_roles_come_back(spark):
    rows = []
    for conv, first in enumerate(HOSTILE):
        for turn, second in enumerate(HOSTILE):
            rows.append((conv, turn, ("user", "assistant", "system", None, "</s>", "assistant")[turn % 6], first + second if turn % 2 else second))
    rows += [(50, 0, "user", None), (51, 0, "assistant", "only"), (None, 0, "user", "lost"), (52, 1, "user", "b"), (52, 1, "assistant", "a")]
    conversations = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({c: F.lit("x") for c in ("tree", "id", "score", "depth")})
    got = {r.tree: r for r in chat.read_back(chat.format_paths(chat.reply_paths(chat.linear(conversations)))).collect()}
    want = {}
    for conv, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1], r[2] or "")):
        want.setdefault(conv, []).append((role or "", text or ""))
    assert {k: [(t.role, t.text) for t in r.turns] for k, r in got.items()} == want
    assert {k: r.loss_text for k, r in got.items()} == {k: "".join(t for role, t in v if role == "assistant") for k, v in want.items()}


def test_best_branches_of_reply_trees(spark):
    """Random trees against walking up from every leaf."""
    rng = random.Random(5)
    rows = []
    for tree in range(30):
        for i in range(rng.randint(1, 25)):
            parent = None if i == 0 or rng.random() < 0.1 else rng.randrange(i)
            rows.append((tree, i, parent, float(rng.randint(-3, 9)), "user", f"{tree}.{i}"))
    rows += [(40, 1, 2, 1.0, "user", "loop"), (40, 2, 1, 1.0, "user", "loop"), (40, 3, 1, 1.0, "user", "below"), (41, 1, 99, None, "user", "orphan"), (None, 1, None, 1.0, "user", "x"), (42, None, None, 1.0, "user", "x")]
    messages = spark.createDataFrame(rows + rows[:5], "tree long, id long, parent long, score double, role string, text string")
    got = {}
    for r in chat.reply_paths(messages, top=2).collect():
        got.setdefault((r.tree, r.branch), []).append((r.depth, r.id))
    want = {}
    for tree in {r[0] for r in rows if r[0] is not None and r[0] != 40}:
        nodes = {r[1]: r for r in rows if r[0] == tree and r[1] is not None}
        ranked = []
        for leaf in set(nodes) - {r[2] for r in nodes.values()}:
            path, at = [], leaf
            while at in nodes:
                path.append(at)
                at = nodes[at][2]
            ranked.append((-sum(nodes[i][3] or 0 for i in path), -len(path), leaf, path[::-1]))
        for k, (*_, path) in enumerate(sorted(ranked)[:2], 1):
            want[tree, k] = list(enumerate(path))
    assert {k: sorted(v) for k, v in got.items()} == want


def test_long_chains_and_empty_tables(spark):
    chain = spark.range(700).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"), F.col("id").cast("string").alias("text"))
    (row,) = chat.read_back(chat.format_paths(chat.reply_paths(chat.linear(chain)))).collect()
    assert [t.text for t in row.turns] == [str(k) for k in range(700)]
    assert chat.read_back(chat.format_paths(chat.reply_paths(chat.linear(chain.limit(0))))).count() == 0
