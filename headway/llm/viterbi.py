"""Token counts of a unigram tokenizer, by a Viterbi pass that counts only.

An Aho-Corasick automaton over the vocabulary names the pieces that end at each character. Dynamic programming carries the
best score of each prefix and its number of pieces; no path is kept. Ties go as in the tokenizer: of equal scores the
longest last piece stays, since candidates come in order of their start and only a better one replaces. A character without
a piece of its own counts as its UTF-8 bytes, at the lowest score less 10.

Words begin with a space mark and are split there, so counts of words add up and frequent words are remembered.
"""

from __future__ import annotations

import hashlib
import math

import ahocorasick
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.shared import Memo, once, over_texts

MARK = "▁"
UNKNOWN_PENALTY = 10.0


def unigram_vocabulary(model: bytes) -> list[tuple[str, float]]:
    """(piece, score) by id, from the pieces of a SentencePiece file.

    The file's own scores are ranks; a unigram score is the log of a frequency, here by Zipf's law of the rank. Special
    and byte pieces have score 0 in the file and are never matched in text.
    """
    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) for i in range(sp.get_piece_size())]
    first = special.index(False)
    return [(sp.id_to_piece(i), 0.0 if special[i] else -math.log(i - first + 2)) for i in range(len(special))]


class Counter:
    """Counts pieces; `special` leading entries of the vocabulary are no text pieces."""

    def __init__(self, vocabulary: list[tuple[str, float]], special: int):
        self.single = set()
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary[special:]:
            self.automaton.add_word(piece, (len(piece), score))
            if len(piece) == 1:
                self.single.add(piece)
        self.automaton.make_automaton()
        self.unknown = min(score for _, score in vocabulary) - UNKNOWN_PENALTY
        self.seen = Memo(self.count_word)

    def count_word(self, word: str) -> int:
        n = len(word)
        score, pieces = [-math.inf] * (n + 1), [0] * (n + 1)
        score[0] = 0.0
        lacking = [i for i, letter in enumerate(word) if letter not in self.single]
        if not lacking:
            for end, (size, own) in self.automaton.iter(word):
                start = end + 1 - size
                total = score[start] + own
                if total > score[end + 1]:
                    score[end + 1], pieces[end + 1] = total, pieces[start] + 1
            return pieces[n]
        ending: list[list[tuple[int, float, int]]] = [[] for _ in range(n + 1)]
        for end, (size, own) in self.automaton.iter(word):
            ending[end + 1].append((end + 1 - size, own, 1))
        for i in lacking:
            ending[i + 1].append((i, self.unknown, len(word[i].encode())))
        for end in range(1, n + 1):
            for start, own, size in ending[end]:
                total = score[start] + own
                if total > score[end]:
                    score[end], pieces[end] = total, pieces[start] + size
        return pieces[n]

    def count(self, text: str) -> int:
        """Pieces of a text; a space mark is put before it unless it begins with a space or a mark."""
        if not text:
            return 0
        marked = text.replace(" ", MARK)
        words = marked.split(MARK)
        if marked.startswith(MARK):
            words = words[1:]
        return sum(map(self.seen.__getitem__, [MARK + w for w in words]))


def counted(model: bytes):
    """Spark function of a text: n_tokens."""

    def make() -> Counter:
        vocabulary = unigram_vocabulary(model)
        return Counter(vocabulary, sum(score == 0.0 for _, score in vocabulary))

    def start():
        counter = once(f"unigram {hashlib.sha256(model).hexdigest()}", make)
        return lambda texts: [[counter.count((t or b"").decode()) for t in texts]]

    return over_texts(start, n_tokens="long")


def token_counts(docs: DataFrame, model: bytes, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_tokens) of every document. Null and empty texts have none; repeated rows repeat; other columns are not read."""
    found = docs.select(F.col(id).alias("id"), counted(model)(F.col(text)).alias("found"))
    return found.select(F.col("id").alias(id), F.col("found")["n_tokens"].alias("n_tokens"))
