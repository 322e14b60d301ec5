"""Brute-force versions of the operators, on plain Python values."""

import collections
import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def components(rows, width, percent):
    """{id: (set size, least id that links reach)}."""
    sets = {}
    for i, text in rows:
        w = (text or "").encode().lower().split()
        sets[i] = {tuple(w[k:k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] & sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


def kept_bytes(rows, length):
    """{id: (bytes, flags of those that go)}, over distinct (id, text) rows in order of id."""
    seen, out = set(), {}
    for i, text in sorted(rows):
        data = (text or "").encode()
        gone = [False] * len(data)
        for s in range(len(data) - length + 1):
            h = hashlib.md5(data[s:s + length]).digest()
            if h in seen:
                gone[s:s + length] = [True] * length
            seen.add(h)
        out[i] = (data, gone)
    return out


def suffix_rows(rows, length):
    out = {}
    for i, (data, gone) in kept_bytes(rows, length).items():
        spans = sum(g and not p for g, p in zip(gone, [False, *gone]))
        out[i] = (len(data), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(data, gone) if not g)).hexdigest())
    return out


def counts(text):
    text = text or ""
    w = WORD.findall(text)
    seen, dup, lines = set(), 0, 0
    for line in text.split("\n"):
        if WORD.search(line):
            lines += 1
            dup += line in seen
        seen.add(line)
    windows = collections.Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    repeated = {j for i in range(len(w) - 7) if windows[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(repeated)


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def common(a, b):
    """Length of a longest common subsequence."""
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b, 1):
            new.append(row[j - 1] + 1 if x == y else max(row[j], new[-1]))
        row = new
    return row[-1]


def runs(words, least):
    """(start, length, period) of the maximal stretches of every period that is their smallest one."""
    n, out = len(words), []
    for q in range(1, n // 2 + 1):
        j = 0
        while j < n - q:
            begin = j
            while j < n - q and words[j] == words[j + q]:
                j += 1
            size = j - begin + q
            if j > begin and size >= max(least, 2 * q):
                piece = words[begin:begin + size]
                if not any(piece[p:] == piece[:-p] for p in range(1, q)):
                    out.append((begin, size, q))
            j += 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def line_rows(rows, least_chars, least_docs):
    """[(id, lines, dropped, kept text)] of every row."""
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))
    holders = collections.defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if i is not None and len(key(line)) >= least_chars:
                holders[key(line)].add(i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if i is None or len(holders[key(x)]) < least_docs or max(holders[key(x)]) == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def spelling_rows(counts, factor):
    """{word: (form, root, n, near words, form's n)} by comparing all words."""
    near = {w: [v for v in counts if abs(len(v) - len(w)) <= 1 and edits(w, v) == 1] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= factor * counts[w] else None
    out = {}
    for w in counts:
        end = w
        while form[end] is not None:
            end = form[end]
        out[w] = (form[w], end, counts[w], len(near[w]), counts.get(form[w]))
    return out
