"""Encoding and decoding with a SentencePiece BPE vocabulary by a table over prefixes.

Merging by best score gives every prefix of a text one encoding, so one last piece. Which one is found without merging:
among the pieces that end at a position (an automaton over the vocabulary names them), it is the one that encodes as itself
and is compatible with the last piece of the prefix before it, that is, both together encode as this pair. The ids are then
recovered backwards from the last entry of the table.

A piece holds the space mark only as its beginning, so a text is encoded in parts that begin with their space marks.
Frequent parts are remembered. Characters outside the vocabulary become byte pieces; nothing merges across them.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from headway.llm.shared import Memo, once, over_texts, ship

REMEMBERED = 200_000
MARK = "▁"
PART = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


@dataclass
class Vocabulary:
    """Pieces of a BPE model that can arise by merging, with scores; byte pieces and special ids apart."""

    ids: dict[str, int]
    score: dict[str, float]
    bytes_at: list[int]
    pieces: list[bytes | None]
    begin: int
    end: int
    unknown: int
    pairs: dict[int, bool] = field(default_factory=dict)

    def __post_init__(self):
        self.text = {i: piece for piece, i in self.ids.items()}

    @classmethod
    def load(cls, model: bytes) -> Vocabulary:
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        ids, score, bytes_at, pieces = {}, {}, [-1] * 256, []
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                bytes_at[int(piece[3:5], 16)] = i
                pieces.append(bytes([int(piece[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i):
                pieces.append(None)
            else:
                if sp.is_unused(i) or piece.find(MARK, len(piece) - len(piece.lstrip(MARK))) >= 0:
                    raise ValueError(f"piece {piece!r} is of a kind that this encoder does not know")
                ids[piece], score[piece] = i, sp.get_score(i)
                pieces.append(piece.encode())
        if min(bytes_at) < 0:
            raise ValueError("the vocabulary has no byte pieces")
        return cls(ids, score, bytes_at, pieces, sp.bos_id(), sp.eos_id(), sp.unk_id())

    def merged(self, text: str, wall: int = -1) -> list[str]:
        """The pieces of a short text by merging the best pair, the leftmost of equals, until none is left.

        Nothing, as soon as two parts merge that meet at `wall`.
        """
        parts: list[str | None] = list(text)
        after = list(range(1, len(text) + 1))
        before = list(range(-1, len(text) - 1))
        heap = []

        def offer(i: int) -> None:
            j = after[i]
            if j < len(parts) and (both := parts[i] + parts[j]) in self.ids:
                heapq.heappush(heap, (-self.score[both], i, both))

        for i in range(len(parts)):
            offer(i)
        while heap:
            _, i, both = heapq.heappop(heap)
            j = after[i] if parts[i] is not None else len(parts)
            if j >= len(parts) or parts[i] + parts[j] != both:
                continue
            if j == wall:
                return []
            parts[i], parts[j] = both, None
            after[i] = after[j]
            if after[i] < len(parts):
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [p for p in parts if p is not None]

    def compatible(self, a: int, b: int) -> bool:
        """Whether pieces a and b side by side encode as just these two."""
        known = self.pairs.get(a << 32 | b)
        if known is None:
            if len(self.pairs) >= 400_000:
                self.pairs.clear()
            # Both encode as themselves, so they do together unless a merge crosses from one to the other.
            left, right = self.text[a], self.text[b]
            known = self.pairs[a << 32 | b] = bool(self.merged(left + right, len(left)))
        return known


class Encoder:
    """Encodes texts; remembers up to twice `remembered` words and half as many parts of words."""

    def __init__(self, model: bytes, remembered: int = REMEMBERED):
        self.words = Vocabulary.load(model)
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.words.ids.items():
            if len(piece) == 1 or self.words.merged(piece) == [piece]:
                self.automaton.add_word(piece, (len(piece), i))
        self.automaton.make_automaton()
        self.part = Memo(self._packed, remembered // 2)
        # Letters that stand side by side in no piece: nothing merges across them.
        self.together = {pair for piece in self.words.ids for pair in zip(piece, piece[1:])}
        self.word = Memo(lambda word: b"".join(self.part[p] for p in self.cut(MARK + word)), remembered)

    def table(self, text: str) -> tuple[list[int], list[int]]:
        """For each prefix of a part the id and length of its last piece; -1 and 1 after a character outside the vocabulary."""
        last, size = [-1] * (len(text) + 1), [1] * (len(text) + 1)
        compatible, known = self.words.compatible, self.words.pairs.get
        for end, (n, i) in self.automaton.iter(text):
            here = end + 1
            if last[here] >= 0:
                continue
            start = here - n
            if start:
                before = last[start]
                if before < 0:
                    if text[start - 1] in self.words.ids:
                        continue
                else:
                    fits = known(before << 32 | i)
                    if not (compatible(before, i) if fits is None else fits):
                        continue
            last[here], size[here] = i, n
        return last, size

    def encode_part(self, text: str) -> list[int]:
        (last, size), ids, at = self.table(text), [], len(text)
        while at:
            if last[at] < 0:
                ids += [self.words.bytes_at[b] for b in reversed(text[at - 1].encode())]
            else:
                ids.append(last[at])
            at -= size[at]
        ids.reverse()
        return ids

    def cut(self, text: str) -> list[str]:
        """A text cut between neighbours that no piece holds side by side."""
        at = [i for i, pair in enumerate(zip(text, text[1:]), 1) if pair not in self.together]
        return [text[a:b] for a, b in zip([0, *at], [*at, len(text)])] if at else [text]

    def _packed(self, text: str) -> bytes:
        ids = self.encode_part(text)
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        """All ids with begin and end, as little-endian unsigned 32-bit numbers."""
        packed = b""
        if text:
            if "  " not in text and MARK not in text and text[-1] != " " and text[0] != " ":
                packed = b"".join(map(self.word.__getitem__, text.split(" ")))
            else:
                marked = MARK + text.replace(" ", MARK)
                packed = b"".join(self.part[p] for m in PART.finditer(marked) for p in self.cut(m[0]))
        return np.uint32(self.words.begin).tobytes() + packed + np.uint32(self.words.end).tobytes()


class Decoder:
    """Texts of ids: pieces side by side, space marks as spaces without the one put before the text, special ids left out.

    Bytes that are no UTF-8 become U+FFFD each.
    """

    UNKNOWN = " ⁇ ".encode()

    def __init__(self, words: Vocabulary):
        self.words = words
        mark = MARK.encode()
        self.plain = [(p or b"").replace(mark, b" ") for p in words.pieces]
        self.plain[words.unknown] = self.UNKNOWN
        self.byte = np.zeros(len(self.plain), bool)
        self.byte[words.bytes_at] = True
        # The mark before a text is the first piece's; the space of an unknown piece or of a byte stays.
        self.mark_first = ~self.byte
        self.mark_first[words.unknown] = False

    def decode(self, packed: bytes) -> bytes:
        ids = np.frombuffer(packed, "<u4")
        if len(ids) and ids[0] == self.words.begin:
            ids = ids[1:]
        if len(ids) and ids[-1] == self.words.end:
            ids = ids[:-1]
        special = (ids == self.words.begin) | (ids == self.words.end)
        if special.any():  # bytes on either side of a special id do not meet
            return self._repaired(ids[int(np.argmin(special)) if not special.all() else len(ids) :])
        text = b"".join(map(self.plain.__getitem__, ids.tolist()))
        if text[:1] == b" " and self.mark_first[ids[0]]:
            text = text[1:]
        try:
            text.decode()
            return text
        except UnicodeDecodeError:
            return self._repaired(ids)

    def _repaired(self, ids: np.ndarray) -> bytes:
        out: list[bytes] = []
        for run in () if not len(ids) else np.split(ids, np.flatnonzero(np.diff(self.byte[ids].astype(np.int8))) + 1):
            text = b"".join(map(self.plain.__getitem__, run.tolist()))
            if self.byte[run[0]]:
                text = "".join(_bytes_as_text(text)).encode()
            elif not out and text[:1] == b" " and self.mark_first[run[0]]:
                text = text[1:]
            out.append(text)
        return b"".join(out)


def _bytes_as_text(raw: bytes):
    at = 0
    while at < len(raw):
        for n in (1, 2, 3, 4):
            try:
                yield raw[at : at + n].decode()
                at += n
                break
            except UnicodeDecodeError:
                continue
        else:
            yield "�"
            at += 1


def coder(model: bytes, remembered: int = REMEMBERED) -> tuple[Encoder, Decoder]:
    """Encoder and decoder of a model, made once in a worker process."""

    def make():
        encoder = Encoder(model, remembered)
        return encoder, Decoder(encoder.words)

    return once(f"pieces {hashlib.sha256(model).hexdigest()} {remembered}", make)


def read_model(path: str) -> bytes:
    """The bytes of a model file on the driver; they travel to the tasks with the function (about half a megabyte)."""
    with open(path, "rb") as file:
        return file.read()


def encoded(model: bytes, with_ids: bool = False, remembered: int = REMEMBERED):
    """Spark function of a text: n_tokens, ids_sha256, decoded_sha256 and, if asked for, the ids.

    `remembered` bounds a worker's memory of words; it changes the time only.
    """

    def start():
        encoder, decoder = coder(model, remembered)

        def work(texts):
            n, ids_sha, text_sha, ids = [], [], [], []
            for text in texts:
                packed = encoder.encode((text or b"").decode())
                n.append(len(packed) // 4)
                ids_sha.append(hashlib.sha256(packed).hexdigest())
                text_sha.append(hashlib.sha256(decoder.decode(packed)).hexdigest())
                if with_ids:
                    ids.append(np.frombuffer(packed, "<i4"))
            return [n, ids_sha, text_sha, *([ids] if with_ids else [])]

        return work

    fields = {"n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"}
    return over_texts(start, **fields | ({"ids": "array<int>"} if with_ids else {}))


def encode(docs: DataFrame, model: bytes, id: str = "doc_id", text: str = "text", with_ids: bool = True) -> DataFrame:
    """`id`, number of ids (begin and end included), digests of the ids and of their decoded text, and the ids themselves.

    A null text is encoded like an empty one, as begin and end alone. Repeated rows give repeated rows, an empty table an
    empty one; other columns are not read.
    """
    made = docs.select(F.col(id).alias("id"), encoded(model, with_ids)(F.col(text)).alias("made"))
    names = ["n_tokens", "ids_sha256", "decoded_sha256", *(["ids"] if with_ids else [])]
    return made.select(F.col("id").alias(id), *(F.col("made")[n].alias(n) for n in names))


def decode(ids: Column, model: bytes) -> Column:
    """The text of a column of id arrays; null for null."""
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        _, decoder = coder(model)
        for batch in batches:
            yield pa.array(
                [None if x is None else decoder.decode(np.array(x, "<u4").tobytes()).decode() for x in batch.to_pylist()], pa.string()
            )

    ship(SparkSession.active())
    return arrow_udf(run, "string")(ids)
