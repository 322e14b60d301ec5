"""Byte-level BPE encoding and decoding by backtracking from longest matches (operator 9).

The vocabulary is a file of base64 tokens and ranks (its path is a parameter and must be readable on
every executor). Texts are split by the pre-token pattern and every piece is encoded on its own, to
the ids that repeated merging of the lowest-ranked adjacent pair would give.

Bytes are mapped to Latin-1 characters for an Aho-Corasick automaton, whose one pass over a piece
gives the longest token at each offset. From there the encoder goes left to right: it takes the
longest token that is *compatible* with the one before it (merging would not have crossed their
border), falls back to the token's next shorter prefix token, and steps back where none fits; an
offset that was left is never entered again, so the work is linear in the piece. Compatibility of two
adjacent tokens follows from the merges that made them, and is memoised.

Cases: null text counts as empty and has no ids; special tokens are ordinary text; extra columns are
kept; rows are independent, so ties and repeated rows need no rule; an empty table gives an empty
result.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.blocks import unused

MEMO = 1 << 20  # compatible pairs kept
PIECES = 400_000  # pieces kept by a worker
BATCH_BYTES = 4 << 20

_ENCODERS: dict[tuple[str, str], Encoder] = {}


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Encoder(dict):
    """Maps a piece (str) to its ids; looking up a new piece encodes it."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        super().__init__()
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.find = regex.compile(pattern).findall
        self.automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.automaton.add_word(token.decode("latin-1"), rank)
        self.automaton.make_automaton()
        self.sizes = {rank: len(token) for token, rank in ranks.items()}
        self.memo: dict[int, bool] = {}
        self.pairs: dict[tuple[int, int], int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        self.shorter = {rank: self._prefix_token(token) for token, rank in ranks.items()}
        for rank, token in sorted(self.tokens.items()):
            self.halves[rank] = self._split(rank, token)

    def _prefix_token(self, token: bytes) -> int | None:
        for end in range(len(token) - 1, 0, -1):
            if (rank := self.ranks.get(token[:end])) is not None:
                return rank
        return None

    def _split(self, rank: int, token: bytes) -> tuple[int, int]:
        """The two tokens whose merge made this one; a token without such a pair is its own halves."""
        left = self.shorter[rank]
        while left is not None:
            right = self.ranks.get(token[len(self.tokens[left]) :])
            if right is not None and left < rank and right < rank and self._compatible(left, right):
                self.pairs[left, right] = rank
                return left, right
            left = self.shorter[left]
        return rank, rank

    def _compatible(self, left: int, right: int) -> bool:
        """Whether merging keeps the border between two adjacent tokens.

        Undoes the latest merge of either side, step by step, and looks for a pair across the border
        that would have been merged earlier than what was undone.
        """
        limit = float("inf")
        while True:
            if self.pairs.get((left, right), limit) < limit:
                return False
            if left > right:
                undo_left, whole = True, self.halves[left][0] == left
            else:
                undo_left, whole = False, self.halves[right][0] == right
            if whole:  # a single byte: the other side is undone
                undo_left = not undo_left
                side = left if undo_left else right
                if self.halves[side][0] == side:
                    return True
            if undo_left:
                limit, left = left, self.halves[left][1]
            else:
                limit, right = right + 1, self.halves[right][0]

    def encode_piece(self, piece: bytes) -> tuple[int, ...]:
        if (rank := self.ranks.get(piece)) is not None:
            return (rank,)
        sizes, shorter, memo = self.sizes, self.shorter, self.memo
        if len(memo) >= MEMO:
            memo.clear()
        longest = [0] * len(piece)
        for end, rank in self.automaton.iter(piece.decode("latin-1")):
            longest[end + 1 - sizes[rank]] = rank  # a later end at the same start is a longer token
        closed = set()
        ids: list[int] = []
        at, goal, token, last = 0, len(piece), longest[0], -1
        while True:
            end = at + sizes[token]
            if end not in closed:
                if last < 0:
                    fits = True
                else:
                    pair = last << 32 | token
                    fits = memo.get(pair)
                    if fits is None:
                        fits = memo[pair] = self._compatible(last, token)
                if fits:
                    ids.append(token)
                    if end == goal:
                        return tuple(ids)
                    at, last, token = end, token, longest[end]
                    continue
            token = shorter[token]
            while token is None:  # nothing fits here: the offset is closed, and the token before it shortened
                closed.add(at)
                token = ids.pop()
                at -= sizes[token]
                last = ids[-1] if ids else -1
                token = shorter[token]

    def __missing__(self, piece: str) -> tuple[int, ...]:
        if len(self) >= PIECES:
            self.clear()
        ids = self[piece] = self.encode_piece(piece.encode())
        return ids

    def encode(self, text: str) -> list[int]:
        get = self.__getitem__
        return list(chain.from_iterable(map(get, self.find(text))))

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def encoder(path: str, pattern: str) -> Encoder:
    """The worker's encoder for a vocabulary file, built once."""
    if (path, pattern) not in _ENCODERS:
        _ENCODERS[path, pattern] = Encoder(read_ranks(path), pattern)
    return _ENCODERS[path, pattern]


def _encode(path: str, pattern: str, text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path, pattern)
        for batch in batches:
            names = [*batch.schema.names, "ids", "decoded"]
            texts = batch.column(text_at)
            begin, held, ids, decoded = 0, 0, [], []
            for row, text in enumerate(texts):
                ids.append(bpe.encode(text.as_py() or ""))
                decoded.append(bpe.decode(ids[-1]))
                held += len(decoded[-1])
                if held >= BATCH_BYTES or row + 1 == len(texts):
                    new = [pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.binary())]
                    yield pa.RecordBatch.from_arrays([*batch.slice(begin, row + 1 - begin).columns, *new], names)
                    begin, held, ids, decoded = row + 1, 0, [], []
    return run


def bpe_round_trip(documents: DataFrame, path: str, pattern: str, text_col: str = "text", keep: tuple[str, ...] | None = None) -> DataFrame:
    """The columns ``keep`` (default: all), with ``ids array<int>`` and ``decoded binary`` (the ids decoded).

    Columns named ``ids`` or ``decoded`` in the input are replaced.
    """
    names = [c for c in (documents.columns if keep is None else keep) if c not in ("ids", "decoded")]
    (text,) = unused([*names, "ids", "decoded"], "_text")
    rows = documents.select(*names, F.col(text_col).alias(text))
    schema = T.StructType([*rows.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.BinaryType())])
    return rows.mapInArrow(_encode(path, pattern, len(names)), schema).drop(text)


def id_digests(encoded: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of encoded rows."""
    return encoded.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
