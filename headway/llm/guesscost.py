"""Secrets in texts: fixed patterns, and values in a credential context that are expensive to guess.

How many guesses a value needs is the least over all ways to cut it into words, dates, repeats, keyboard walks and spans
for brute force, by dynamic programming over its ends: log10 costs of the parts add up, and each part costs a factor of two more,
for whether another follows. A value after `pwd:`, `passphrase=` and the like becomes a
span of kind `guess` if no span of a fixed pattern covers all of it and it takes `least` powers of ten or more. Where such
a span covers a part of the value, the value is known to be a secret and its span is given whatever its cost.

A value in quotes goes on to the closing quote on its line, another one to white space, a quote, comma or semicolon. Signs
are `:`, `=`, `=>` and their doubles, with any spaces and tabs around. Contexts inside a quoted value count as well.

Values of more than 256 characters are cut into runs of 256 whose costs add up, so a long value stays linear.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.shared import over_texts

KINDS = ("assign", "access", "hex", "guess")
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII
)
ASSIGN_HINTS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
CONTEXT = re.compile(
    r"(?:password|passwd|passphrase|passcode|pwd|secret|token|credentials?|api_?key|access_?key|private_?key|auth)"
    r"[\"']?[\x20\t]*(?:[:=]{0,2}=>|[:=]{1,3})[\x20\t]*(?:\"([^\"\r\n]+)\"|'([^'\r\n]+)'|([^\s\"',;]+))",
    re.IGNORECASE | re.ASCII,
)
CONTEXT_HINTS = (*ASSIGN_HINTS, b"passphrase", b"passcode", b"pwd", b"credential", b"accesskey", b"access_key", b"privatekey", b"private_key", b"auth")
# Frequent passwords and words in them, most frequent first.
COMMON = (
    "password 123456 qwerty admin welcome letmein monkey dragon master login abc123 iloveyou sunshine princess football "
    "secret shadow superman batman trustno1 hello freedom whatever changeme default root user test guest example token "
    "pass key access summer winter spring autumn love baby angel flower computer internet server database security"
).split()
ROWS = ("1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
BESIDE = {
    (a, b)
    for row in (*ROWS, *("".join(c) for c in zip(*ROWS, strict=False)))
    for x, y in zip(row, row[1:], strict=False)
    for a, b in ((x, y), (y, x))
}
LEET = str.maketrans("4301!$5@7", "aeoiissat")
DATE = re.compile(r"(?:19|20)\d\d(?:([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01]))?|(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\2(?:19|20)?\d\d")
RUN = 256
PART = math.log10(2)
TO_HEX = bytes(0 if c in b"0123456789abcdef" else 1 for c in range(256))


def _alphabet(part: str) -> int:
    kinds = ((10, str.isdigit), (26, str.islower), (26, str.isupper), (33, lambda c: c.isascii() and not c.isalnum()), (100, lambda c: not c.isascii()))
    return sum(n for n, has in kinds if any(map(has, part))) or 1


class Guesses:
    """log10 of the guesses for a value; `words` are known ones, most frequent first."""

    def __init__(self, words: Iterable[str] = COMMON):
        self.rank = {}
        for n, word in enumerate(words, 1):
            self.rank.setdefault(word.lower(), n)
        self.longest = max(map(len, self.rank), default=0)

    def parts(self, value: str) -> list[tuple[int, int, float, str]]:
        """Known spans of a value: (start, end, log10 guesses, kind)."""
        found, low, n = [], value.lower(), len(value)
        plain = low.translate(LEET)
        for i in range(n):
            for j in range(i + 3, min(n, i + self.longest) + 1):
                rank = self.rank.get(low[i:j])
                if rank is None and (rank := self.rank.get(plain[i:j])) is not None:
                    rank *= 2
                if rank is not None:
                    case = 0.0 if value[i:j].islower() or not value[i:j].isalpha() else math.log10(2)
                    found.append((i, j, math.log10(rank) + case, "word"))
            if m := DATE.match(value, i):
                found.append((i, m.end(), math.log10(365 * 100 if len(m[0]) > 4 else 100), "date"))
        i = 0
        while i < n - 2:
            j = i + 1
            while j < n and (low[j - 1], low[j]) in BESIDE:
                j += 1
            for e in range(i + 3, j + 1):
                found.append((i, e, math.log10(47 * 4 * (e - i)), "walk"))
            i = max(i + 1, j - 1)
        for size in range(1, n // 2 + 1):
            i = 0
            while i + 2 * size <= n:
                unit, j = value[i : i + size], i + size
                while value.startswith(unit, j):
                    j += size
                times = (j - i) // size
                if times >= 2 and times * size >= 3:
                    cost = min(size * math.log10(_alphabet(unit)), math.log10(self.rank.get(unit.lower(), math.inf)) if unit.lower() in self.rank else math.inf)
                    found.append((i, j, cost + math.log10(times), "repeat"))
                    i = j - size + 1
                else:
                    i += 1
        return found

    def segments(self, value: str) -> tuple[float, list[tuple[int, int, str]]]:
        """Least cost of a value of at most 256 characters, and its parts; of equal costs the way found first stays."""
        n = len(value)
        if not n:
            return 0.0, []
        per = math.log10(_alphabet(value))
        ends: list[list] = [[] for _ in range(n + 1)]
        for i, j, cost, kind in self.parts(value):
            ends[j].append((i, cost, kind))
        # (end, last part by brute force or not): least cost, and the state and kind of part before.
        best: dict[tuple[int, bool], tuple] = {(0, False): (0.0, None, "")}

        def offer(state: tuple, before: tuple, cost: float, kind: str) -> None:
            if before in best and (state not in best or best[before][0] + cost + PART < best[state][0]):
                best[state] = (best[before][0] + cost + PART, before, kind)

        for j in range(1, n + 1):
            for i, cost, kind in ends[j]:
                offer((j, False), (i, False), cost, kind)
                offer((j, False), (i, True), cost, kind)
            for i in range(j):
                offer((j, True), (i, False), per * (j - i), "brute")
        at = min((s for s in ((n, False), (n, True)) if s in best), key=lambda s: best[s][0])
        total, parts = best[at][0], []
        while best[at][1] is not None:
            _, before, kind = best[at]
            parts.append((before[0], at[0], kind))
            at = before
        return total, parts[::-1]

    def cost(self, value: str) -> float:
        return sum(self.segments(value[i : i + RUN])[0] for i in range(0, len(value), RUN))


def base_spans(text: str, raw: bytes, low: bytes) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the fixed patterns, in code points."""
    found = []
    if any(h in low for h in ASSIGN_HINTS):
        found += [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if b"AKIA" in raw:
        found += [(m.start(), "access", m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    other = np.flatnonzero(np.frombuffer(raw.translate(TO_HEX), np.uint8))
    edges = np.concatenate(([-1], other, [len(raw)]))
    for k in np.flatnonzero(np.diff(edges) > 24).tolist():
        start, end = int(edges[k]) + 1, int(edges[k + 1])
        before = start if len(text) == len(raw) else len(raw[:start].decode())
        found.append((before, "hex", before + end - start))
    return found


def values(text: str) -> Iterator[tuple[int, int]]:
    """Places of the values in a credential context; in quoted ones, which may hold a stray quote's text, contexts are sought again."""
    m = CONTEXT.search(text)
    while m:
        start, end = m.span(m.lastindex)
        yield start, end
        m = CONTEXT.search(text, end if m.lastindex == 3 else start)


def guessed_spans(text: str, low: bytes, taken: list[tuple[int, str, int]], guesses: Guesses, least: float) -> list[tuple[int, str, int, float]]:
    """Values in a credential context that no pattern covers whole, and that one covers in part or that take 10^least guesses or more."""
    found = []
    if any(h in low for h in CONTEXT_HINTS):
        for start, end in values(text):
            if any(s <= start and end <= e for s, _, e in taken):
                continue
            cost = guesses.cost(text[start:end])
            if cost >= least or any(s < end and start < e for s, _, e in taken):
                found.append((start, "guess", end, cost))
    return found


def find(text: bytes | None, guesses: Guesses, least: float) -> tuple[list[tuple[int, str, int]], list[tuple[int, str, int, float]]]:
    """Spans of the fixed patterns, and those found by guess cost; both in order of start, then kind as listed."""
    if not text:
        return [], []
    raw, low, decoded = text, text.lower(), text.decode()
    base = sorted(base_spans(decoded, raw, low), key=lambda s: (s[0], KINDS.index(s[1])))
    return base, guessed_spans(decoded, low, base, guesses, least)


def written(spans: Iterable[tuple]) -> str:
    """kind:start:end, comma-joined, by start and then kind as listed."""
    return ",".join(f"{s[1]}:{s[0]}:{s[2]}" for s in sorted(spans, key=lambda s: (s[0], KINDS.index(s[1]))))


def redacted(text: bytes | None, spans: list[tuple], mark: str = "[SECRET]") -> str | None:
    """The text with each run of overlapping spans replaced by `mark`."""
    if text is None:
        return None
    decoded, out, at = text.decode(), [], 0
    for start, _, end, *_ in sorted(spans, key=lambda s: s[0]):
        if start >= at:
            out += [decoded[at:start], mark]
        at = max(at, end)
    return "".join([*out, decoded[at:]])


def scanned(least: float = 8.0, words: Iterable[str] = COMMON, redact: bool = False):
    """Spark function of a text: counts by kind, base spans, all spans, highest cost, and if asked for the redacted text."""
    words = tuple(words)

    def start():
        guesses = Guesses(words)

        def work(texts):
            columns = [[] for _ in range(8 if redact else 7)]
            for text in texts:
                base, more = find(text, guesses, least)
                counts = [sum(s[1] == k for s in base) for k in KINDS[:3]]
                row = [*counts, len(more), written(base), written([*base, *more]), max((s[3] for s in more), default=None)]
                for column, value in zip(columns, [*row, *([redacted(text, [*base, *more])] if redact else [])], strict=True):
                    column.append(value)
            return columns

        return work

    fields = {"n_assign": "long", "n_access": "long", "n_hex": "long", "n_guess": "long", "base": "string", "spans": "string", "most_guesses": "double"}
    return over_texts(start, **fields | ({"redacted": "string"} if redact else {}))


def scan(docs: DataFrame, text: str = "text", into: str = "secrets", **options) -> DataFrame:
    """`docs` with the struct `into`: n_assign, n_access, n_hex, n_guess, base and spans (kind:start:end), most_guesses.

    Places are code points, end exclusive. Null and empty texts have no spans; repeated rows give repeated rows, an empty
    table an empty one; a column called like `into` is replaced, others stay.
    """
    return docs.withColumn(into, scanned(**options)(F.col(text)))


def redact(docs: DataFrame, text: str = "text", n_chars: str = "n_chars", **options) -> DataFrame:
    """`docs` with every secret in `text` replaced, and `n_chars` set to the new length where a text changed."""
    into = "secrets"
    while into in docs.columns:
        into += "_"
    found = docs.withColumn(into, scanned(redact=True, **options)(F.col(text)))
    changed = F.col(into)["spans"] != ""
    new = {text: F.when(changed, F.col(into)["redacted"]).otherwise(F.col(text))}
    if n_chars in docs.columns:
        kind = docs.schema[n_chars].dataType
        new[n_chars] = F.when(changed, F.length(F.col(into)["redacted"]).cast(kind)).otherwise(F.col(n_chars))
    return found.withColumns(new).select(docs.columns)
