"""Byte-level BPE encoding and decoding by prefix dynamic programming.

For a piece of bytes, each prefix has exactly one token with which a valid
encoding of it can end: the token must be a suffix of the prefix, and it must
stand next to the last token of what lies before it without a merge across
their border. Storing that token for each prefix gives the encoding by walking
back from the end, lets bytes be appended without touching what is stored, and
lets an edit redo only the prefixes near it.

Results, row by row: null text counts as empty (no tokens). Nothing depends on
doc_id, so null or repeated ids and repeated rows are encoded like any other.
An empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from textsieve.llm.common import by_slice, id_text, id_type

#: Bounds of what a Python worker remembers; beyond them it starts anew.
CHARACTERS_REMEMBERED = 12_000_000
PAIRS_REMEMBERED = 1_000_000


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes to rank, from lines of base64 and rank."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines()) if token}


def merge_greedily(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The defining rule: merge the leftmost pair of lowest rank until none is left."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        rank, at = min((ranks.get(parts[i] + parts[i + 1], 1 << 62), i) for i in range(len(parts) - 1))
        if rank == 1 << 62:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[part] for part in parts]


class Vocabulary:
    """Tokens with their ranks, and which of them may stand side by side.

    halves says which two tokens of lower rank a token is merged from; a token that
    the merges never lead to has none and is of no use inside a piece. A vocabulary
    in which merges lead to a token by way of higher ranks was not made by merging;
    it is handled by the defining rule alone, which is slower.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.sizes = {rank: len(token) for token, rank in ranks.items()}
        self.longest = max(map(len, ranks), default=1)
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.usable: dict[bytes, int] = {}
        for rank in sorted(self.tokens, key=lambda rank: (self.sizes[rank] > 1, rank)):
            token = self.tokens[rank]
            self.halves[rank] = found = self._halves(token, rank)
            if found or len(token) == 1:
                self.usable[token] = rank
        alone = (rank for rank, found in self.halves.items() if not found and self.sizes[rank] > 1)
        self.ordered = not any(merge_greedily(self.tokens[rank], ranks) == [rank] for rank in alone)
        if not self.ordered:
            self.usable = {token: rank for token, rank in ranks.items() if merge_greedily(token, ranks) == [rank]}
        #: For each three bytes, the length of the longest token that ends with them.
        self.reach: dict[bytes, int] = {}
        for token in self.usable:
            self.reach[token[-3:]] = max(len(token), self.reach.get(token[-3:], 2))
        self._beside: dict[int, bool] = {}

    def _halves(self, token: bytes, rank: int) -> tuple[int, int] | None:
        for cut in range(1, len(token)):
            left, right = self.usable.get(token[:cut]), self.usable.get(token[cut:])
            if left is not None and right is not None and self._apart(left, right, rank):
                return left, right
        return None

    def _apart(self, left: int, right: int, until: int) -> bool:
        """Whether nothing merges across the border of two tokens before the merge of rank until.

        Merges come in the order of their ranks, the leftmost first. Going back in
        time, the token made last falls into its halves; the two that then touch
        the border stood there until that merge, and must not merge before it. Of
        two merges of equal rank that on the left comes first.
        """
        find, tokens, halves = self.ranks.get, self.tokens, self.halves
        while True:
            merged = find(tokens[left] + tokens[right])
            if merged is not None and merged < until:
                return False
            in_left, in_right = halves[left], halves[right]
            if in_left and (not in_right or left > right):
                until, left = left, in_left[1]
            elif in_right:
                until, right = right + 1, in_right[0]
            else:
                return True

    def beside(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both gives these two tokens again."""
        key = left << 32 | right
        known = self._beside.get(key)
        if known is None:
            if len(self._beside) >= PAIRS_REMEMBERED:
                self._beside.clear()
            if self.ordered:
                known = self._apart(left, right, 1 << 62)
            else:
                known = merge_greedily(self.tokens[left] + self.tokens[right], self.ranks) == [left, right]
            self._beside[key] = known
        return known

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class PrefixTable:
    """The last token of each prefix of one piece; last[0] stands for the empty prefix."""

    def __init__(self, vocabulary: Vocabulary, piece: bytes = b""):
        self.vocabulary = vocabulary
        self.piece = b""
        self.last: list[int] = [-1]
        self.append(piece)

    def _extend(self, ends: range) -> None:
        piece, last, reach = self.piece, self.last, self.vocabulary.reach.get
        find, beside = self.vocabulary.usable.get, self.vocabulary.beside
        for end in ends:
            # The longest token that could end here; one or two bytes are tried in any case.
            far = end - reach(piece[end - 3 : end], 2) if end > 2 else 0
            for start in range(far if far > 0 else 0, end):
                token = find(piece[start:end])
                if token is not None and (not start or beside(last[start], token)):
                    last.append(token)
                    break
            else:
                raise ValueError("the vocabulary lacks single bytes")

    def append(self, more: bytes) -> None:
        """Exact: what is stored for shorter prefixes stays."""
        start = len(self.piece) + 1
        self.piece += more
        self._extend(range(start, len(self.piece) + 1))

    def change_to(self, piece: bytes) -> None:
        """Another piece; what is stored for the prefixes both share stays."""
        shared = 0
        for old, new in zip(self.piece, piece):
            if old != new:
                break
            shared += 1
        self.piece = piece[:shared]
        del self.last[shared + 1 :]
        self.append(piece[shared:])

    def edit(self, start: int, stop: int, new: bytes) -> int:
        """Replace bytes start to stop; returns how many prefixes were worked out anew.

        A prefix depends on the bytes and stored tokens of the longest token's
        length before it. Once that many prefixes in a row came out as they were
        before the edit, all that follow are as they were.
        """
        old, shift = self.last, len(new) - (stop - start)
        self.piece = self.piece[:start] + new + self.piece[stop:]
        self.last = old[: start + 1]
        same, end = 0, start + 1
        while end <= len(self.piece):
            self._extend(range(end, end + 1))
            token = self.last[end]
            after = end > start + len(new)
            same = same + 1 if after and token == old[end - shift] else 0
            end += 1
            if same > self.vocabulary.longest:
                self.last += old[end - shift :]
                break
        return end - start - 1

    def ids(self) -> list[int]:
        found, last, sizes, end = [], self.last, self.vocabulary.sizes, len(self.piece)
        while end:
            token = last[end]
            found.append(token)
            end -= sizes[token]
        return found[::-1]


#: A blank beside other white space; texts that hold one are cut more carefully.
UNEVEN = re.compile(r" \s|\s ")
SINGLE = re.compile(r"(?<=\S) (?=\S)")


class Encoder:
    """Splits texts by a pattern and encodes each match by its prefix table.

    The pattern must take a single blank between two characters that are no white
    space as the start of a match, so that a text may be cut before it.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.vocabulary = Vocabulary(ranks)
        self.split = regex.compile(pattern).findall
        self._pieces: dict[str, bytes] = {}
        self._chunks: dict[str, bytes] = {}
        self._characters = 0

    def _learn(self, chunks: set[str]) -> None:
        """Encode new chunks; pieces in byte order, so that each prefix which
        neighbours share is worked out once."""
        split, known = self.split, self._chunks
        alone: set[str] = set()  # chunks that are one piece
        several: dict[str, list[str]] = {}
        for chunk in chunks:
            pieces = split(chunk)
            if len(pieces) == 1 and len(pieces[0]) == len(chunk):
                alone.add(chunk)
            else:
                several[chunk] = pieces
        parts = set(chain.from_iterable(several.values())).difference(self._pieces)
        encoded = self._encode_pieces(alone | parts)
        known.update(zip(alone, map(encoded.__getitem__, alone)))
        self._pieces.update(zip(parts, map(encoded.__getitem__, parts)))
        for chunk, pieces in several.items():
            known[chunk] = b"".join(map(self._pieces.__getitem__, pieces))
        self._characters += sum(map(len, encoded)) + sum(map(len, several))

    def _encode_pieces(self, pieces: set[str]) -> dict[str, bytes]:
        """Packed ids of each piece."""
        whole, table, encoded = self.vocabulary.ranks.get, PrefixTable(self.vocabulary), {}
        for data, piece in sorted((piece.encode("utf-8", "surrogatepass"), piece) for piece in pieces):
            token = whole(data)
            if token is None:
                table.change_to(data)
                encoded[piece] = array("I", table.ids()).tobytes()
            else:
                encoded[piece] = token.to_bytes(4, "little")
        return encoded

    def _forget(self) -> None:
        if self._characters > CHARACTERS_REMEMBERED:
            self._pieces.clear()
            self._chunks.clear()
            self._characters = 0

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """For each text its ids as little-endian unsigned 32-bit integers."""
        self._forget()
        chunks, ends = [], [0]
        for text in texts:
            first, *rest = SINGLE.split(text) if UNEVEN.search(text) else text.split(" ")
            chunks.append(first)
            chunks.extend(map(" ".__add__, rest))
            ends.append(len(chunks))
        found = list(map(self._chunks.get, chunks))
        missing = [i for i, packed in enumerate(found) if packed is None]
        if missing:
            self._learn({chunks[i] for i in missing})
            for i in missing:
                found[i] = self._chunks[chunks[i]]
        return [b"".join(found[start:end]) for start, end in zip(ends, ends[1:])]

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]


_encoders: dict[tuple[int, str], Encoder] = {}


def encoder_in_task(data: bytes, pattern: str) -> Encoder:
    """One encoder per Python worker and vocabulary, kept from task to task."""
    key = hash(data), pattern
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(read_ranks(data), pattern)
    return _encoders[key]


def _over_texts(docs: DataFrame, path: str, pattern: str, schema: str, row: Callable[[bytes, list[int], bytes], tuple]) -> DataFrame:
    with open(path, "rb") as file:
        data = docs.sparkSession.sparkContext.broadcast(file.read())  # a vocabulary file: about a megabyte

    names = [part.split()[0] for part in schema.split(", ")]

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        encoder = encoder_in_task(data.value, pattern)
        tokens = encoder.vocabulary.tokens
        rows = []
        for packed in encoder.encode_all([text or "" for text in batch.column("text").to_pylist()]):
            ids = np.frombuffer(packed, "<u4").tolist()
            rows.append(row(packed, ids, b"".join(map(tokens.__getitem__, ids))))
        columns = [list(c) for c in zip(*rows)] or [[] for _ in names]
        kinds = {"n_tokens": pa.int64(), "ids": pa.list_(pa.int32())}
        arrays = [pa.array(c, kinds.get(n, pa.string())) for n, c in zip(names, columns)]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], ["doc_id", *names])

    return docs.mapInArrow(by_slice(make), f"doc_id {id_type(docs)}, {schema}")


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Tokens counted, and SHA-256 of the packed ids and of the bytes they decode to."""

    def row(packed: bytes, ids: list[int], decoded: bytes) -> tuple:
        return len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded).hexdigest()

    schema = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return _over_texts(id_text(docs), path, pattern, schema, row)


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, the ids, and the text decoded from them."""

    def row(packed: bytes, ids: list[int], decoded: bytes) -> tuple:
        return len(ids), ids, decoded.decode("utf-8", "replace")

    return _over_texts(id_text(docs), path, pattern, "n_tokens bigint, ids array<int>, text string", row)


def decode(tokens: DataFrame, path: str) -> DataFrame:
    """doc_id and text of rows of doc_id and ids; null ids give null text."""
    with open(path, "rb") as file:
        data = tokens.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = {rank: token for token, rank in read_ranks(data.value).items()}
        for batch in batches:
            texts = [
                None if ids is None else b"".join(map(table.__getitem__, ids)).decode("utf-8", "replace")
                for ids in batch.column("ids").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    narrow = tokens.select("doc_id", "ids")
    return narrow.mapInArrow(run, f"doc_id {id_type(narrow)}, text string")
