"""Byte-level BPE: encoding by backtracking from longest matches, and decoding.

A text falls into the matches of the vocabulary's pattern, each encoded alone. Merging the pair of lowest rank until none is
left gives every prefix of a match one encoding. It is found without merging: an automaton over the vocabulary, its bytes as
Latin-1 letters, names the longest token that begins at a position; a table names the next shorter one that it begins with.
The longest that fits the token before it is taken; fitting means that the two, side by side, encode as these two, which is
remembered by pair. Where none fits, the position is dead and the token before it gives way to the next shorter one. A position is left dead once, as only one token can lead to it, so the
time is linear in the bytes.

A match that is a token as a whole is that token, whatever merging would make of it.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import struct
from array import array
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from headway.llm.shared import Memo, once, over_texts, ship

BLOCK = 65_536
LONG_TEXT = 1 << 20
WORDS, PAIRS = 100_000, 200_000
LETTER_THEN_SPACE = regex.compile(r"\S\s")


def read_ranks(path: str) -> bytes:
    """The rank file's bytes on the driver (under a megabyte for the public ones); they travel to the tasks."""
    return Path(path).read_bytes()


def parse_ranks(lines: bytes) -> dict[bytes, int]:
    """{token: rank} of a file with a base64 token and its rank per line."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines.splitlines()))}


class Merger:
    """Merging by rank as such, for single tokens and for pairs of them."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("the vocabulary lacks single bytes")

    def merged(self, piece: bytes) -> list[int]:
        """Ids of a short piece, merging the pair of lowest rank, the leftmost of equals, until none is left."""
        return self.run(piece)[0]

    def run(self, piece: bytes) -> tuple[list[int], int]:
        """The ids by merging, and the place where the last two parts met."""
        last = 0
        ends = list(range(1, len(piece) + 1))  # end of the part that begins here, 0 for none
        before = list(range(-1, len(piece) - 1))
        heap = []

        def offer(at: int) -> None:
            if ends[at] < len(piece) and (rank := self.ranks.get(piece[at : ends[ends[at]]])) is not None:
                heapq.heappush(heap, (rank, at, ends[ends[at]]))

        for at in range(len(piece)):
            offer(at)
        while heap:
            _, at, end = heapq.heappop(heap)
            middle = ends[at]
            if not middle or middle >= len(piece) or ends[middle] != end:
                continue  # one of the two has merged since
            last = middle
            ends[middle], ends[at] = 0, end
            if end < len(piece):
                before[end] = at
            offer(at)
            if at:
                offer(before[at])
        out, at = [], 0
        while at < len(piece):
            out.append(self.ranks[piece[at : ends[at]]])
            at = ends[at]
        return out, last


class Encoder:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pattern = regex.compile(pattern)
        self.merger = Merger(ranks)
        self.token = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        self.automaton = ahocorasick.Automaton()
        # The two tokens that a token was last merged of, and whether they always came before it.
        self.halves: dict[int, tuple[int, int]] = {}
        self.in_order = True
        for token, rank in ranks.items():
            ids, middle = self.merger.run(token)
            if ids != [rank]:
                continue  # merging never makes it
            self.automaton.add_word(token.decode("latin-1"), rank)
            if middle:
                self.halves[rank] = ranks[token[:middle]], ranks[token[middle:]]
                self.in_order &= all(h < rank for h in self.halves[rank] if len(self.token[h]) > 1)
        self.automaton.make_automaton()
        self.length = {rank: len(token) for rank, token in self.token.items()}
        # For each token the next shorter one that it begins with, -1 for none.
        self.shorter = dict.fromkeys(self.token, -1)
        for rank in self.automaton.values():
            begun = [r for end, r in self.automaton.iter(self.token[rank][:-1].decode("latin-1")) if end + 1 == self.length[r]]
            if begun:
                self.shorter[rank] = begun[-1]
        self.fits = lru_cache(PAIRS)(self._fits)
        self.word = Memo(self._packed, WORDS)

    def _fits(self, a: int, b: int) -> bool:
        """Whether a and b side by side encode as just these two.

        Each does alone, so they do unless a merge across the seam comes first. The merges along the seam are taken back, the
        latest first: a merge of what then stands on both sides would have come before the one taken back, if its rank is
        lower, or the same one and it stands left of it.
        """
        token, rank, halves = self.token, self.merger.ranks, self.halves
        if not self.in_order:
            return self.merger.merged(token[a] + token[b]) == [a, b]
        limit = float("inf")
        while True:
            across = rank.get(token[a] + token[b])
            if across is not None and across < limit:
                return False
            left, right = (a if a in halves else -1), (b if b in halves else -1)
            if left > right:
                limit, a = left, halves[a][1]
            elif right >= 0:
                limit, b = right + 1, halves[b][0]
            else:
                return True

    def _longest(self, letters: str, block: int) -> list[int]:
        """For each position of a block the longest token that begins there."""
        low, length = block * BLOCK, self.length
        size = min(BLOCK, len(letters) - low)
        # Matches come by their ends, so of those that begin at one place the longest comes last. The places past the
        # block are of matches that begin after it.
        found = [-1] * (size + self.longest)
        for end, rank in self.automaton.iter(letters, low, min(len(letters), low + size + self.longest - 1)):
            found[end + 1 - length[rank] - low] = rank
        return found

    def encode_piece(self, piece: bytes) -> list[int] | array:
        """Ids of one match of the pattern, by backtracking."""
        whole = self.merger.ranks.get(piece)
        if whole is not None:
            return [whole]
        letters, fits, length, shorter = piece.decode("latin-1"), self.fits, self.length, self.shorter
        blocks = {0: self._longest(letters, 0)}
        dead = bytearray(len(letters) + 1)
        ids, at, size = [] if len(letters) < BLOCK else array("I"), 0, len(letters)
        token = blocks[0][0] if size else -1
        while at < size:
            while token >= 0 and (dead[at + length[token]] or ids and not fits(ids[-1], token)):
                token = shorter[token]
            if token < 0:  # nothing fits here: the token before gives way
                dead[at] = 1
                token = ids.pop()
                at -= length[token]
                token = shorter[token]
                continue
            ids.append(token)
            at += length[token]
            if at < size:
                block, place = divmod(at, BLOCK)
                if block not in blocks:
                    if len(blocks) > 1:
                        blocks.clear()
                    blocks[block] = self._longest(letters, block)
                token = blocks[block][place]
        return ids

    def _packed(self, word: str) -> bytes:
        ids = self.encode_piece(word.encode())
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> Iterator[bytes]:
        """Ids as little-endian unsigned 32-bit numbers, in runs for the stretches of a long text."""
        for stretch in stretches(text):
            yield b"".join(map(self.word.__getitem__, self.pattern.findall(stretch)))


def stretches(text: str, size: int = LONG_TEXT) -> Iterator[str]:
    """A text cut before white space that follows another character, once it is longer than `size`.

    No match of the public pattern holds white space after other characters, and none that ends in another character looks
    further, so matches are those of the whole text.
    """
    at = 0
    while len(text) - at > size and (cut := LETTER_THEN_SPACE.search(text, at + size)):
        yield text[at : cut.start() + 1]
        at = cut.start() + 1
    yield text[at:]


class Decoder:
    def __init__(self, ranks: dict[bytes, int]):
        self.tokens = {rank: token for token, rank in ranks.items()}

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(packed, "<u4").tolist()))


def coder(lines: bytes, pattern: str) -> tuple[Encoder, Decoder]:
    """Encoder and decoder of a rank file, made once in a worker process."""

    def make():
        ranks = parse_ranks(lines)
        return Encoder(ranks, pattern), Decoder(ranks)

    return once(f"ranks {hashlib.sha256(lines + pattern.encode()).hexdigest()}", make)


def encoded(lines: bytes, pattern: str, with_ids: bool = False):
    """Spark function of a text: n_tokens, ids_sha256, decoded_sha256 and, if asked for, the ids."""

    def start():
        encoder, decoder = coder(lines, pattern)

        def work(texts):
            columns = [[], [], [], *([[]] if with_ids else [])]
            for text in texts:
                n, ids_sha, text_sha, runs = 0, hashlib.sha256(), hashlib.sha256(), []
                for packed in encoder.encode((text or b"").decode()):
                    n += len(packed) // 4
                    ids_sha.update(packed)
                    text_sha.update(decoder.decode(packed))
                    if with_ids:
                        runs.append(packed)
                row = (n, ids_sha.hexdigest(), text_sha.hexdigest(), np.frombuffer(b"".join(runs), "<i4"))
                for column, value in zip(columns, row):
                    column.append(value)
            return columns

        return work

    fields = {"n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"}
    return over_texts(start, **fields | ({"ids": "array<int>"} if with_ids else {}))


def encode(docs: DataFrame, lines: bytes, pattern: str, id: str = "doc_id", text: str = "text", with_ids: bool = True) -> DataFrame:
    """`id`, number of ids, digests of the ids and of the bytes they decode to, and the ids themselves.

    `lines` is a rank file, `pattern` the one that belongs to it. No special tokens: their names are plain text. A null text
    is encoded like an empty one, as no ids. Repeated rows give repeated rows, an empty table an empty one; ids of documents
    may be null or of any type; other columns are not read. A very long text is worked on in stretches, a long match in blocks.
    """
    made = docs.select(F.col(id).alias("id"), encoded(lines, pattern, with_ids)(F.col(text)).alias("made"))
    names = ["n_tokens", "ids_sha256", "decoded_sha256", *(["ids"] if with_ids else [])]
    return made.select(F.col("id").alias(id), *(F.col("made")[n].alias(n) for n in names))


def decode(ids: Column, lines: bytes) -> Column:
    """The text of a column of id arrays; bytes that are no UTF-8 become U+FFFD. Null for null; unknown ids are an error."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        decoder = once(f"tokens {hashlib.sha256(lines).hexdigest()}", lambda: Decoder(parse_ranks(lines)))
        for batch in batches:
            packed = (None if x is None else np.array(x, "<u4").tobytes() for x in batch.to_pylist())
            yield pa.array([None if x is None else decoder.decode(x).decode(errors="replace") for x in packed], pa.string())

    ship(SparkSession.active())
    return arrow_udf(run, "string")(ids)
