"""Secrets by rules, and by the entropy of windows that slide over strings no rule knows.

Candidates are runs of the characters that keys are written in. In each class of characters a window slides over a
candidate's run; its counts change by one character in and one out, and with them its Shannon entropy. Windows that reach
the class's bits and mix kinds of characters as keys do are hot, unless an allowed string lies in them.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm.common import text_of

#: Kinds of the rules, and what the entropy adds.
KINDS = ("assign", "access", "hex", "entropy")
ENTROPY = len(KINDS) - 1
# Texts are searched as UTF-8: all patterns are of ASCII, which no other character's bytes hold.
ASSIGN = re.compile(rb"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
NAMES = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"(?<![0-9a-f])[0-9a-f]{24,}")
CANDIDATE = re.compile(rb"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")

Span = tuple[int, int, int]  # start, kind, end


@dataclass(frozen=True)
class CharacterClass:
    """Characters, how many a window has, the bits from which it is hot, and the kinds of which it must hold some."""

    characters: bytes
    window: int
    bits: float
    mixes: tuple[str, ...]


_DIGITS, _LOWER, _UPPER = b"0123456789", b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_KINDS = {"digit": _DIGITS, "lower": _LOWER, "upper": _UPPER, "letter": _LOWER + _UPPER}
#: A window of 20 random characters has 3.4 bits of 16 characters, 3.9 of 36 and 4.0 of 64 on average; words stay lower,
#: or have no digits.
CLASSES = (
    CharacterClass(_DIGITS + b"abcdefABCDEF", 20, 3.0, ("digit", "letter")),
    CharacterClass(_DIGITS + _LOWER, 20, 3.6, ("digit", "lower")),
    CharacterClass(_DIGITS + _UPPER, 20, 3.6, ("digit", "upper")),
    CharacterClass(_DIGITS + _LOWER + _UPPER + b"+/_=-", 20, 3.8, ("digit", "lower", "upper")),
)
#: What is no secret: identifiers, times, alphabets in order, digests of nothing, and keys of manuals.
ALLOWED = (
    rb"[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}", rb"[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}", rb"sha(?:256|384|512)-[A-Za-z0-9+/=]+",
    rb"0123456789", rb"[Aa][Bb][Cc][Dd][Ee][Ff][Gg][Hh]", rb"d41d8cd98f00b204e9800998ecf8427e", rb"da39a3ee5e6b4b0d3255bfef95601890afd80709", rb"e3b0c44298fc1c149afbf4c8996fb924", rb"wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY",
)


def by_rule(raw: bytes) -> list[Span]:
    """Leftmost matches of each kind that are long enough, by start and kind, in bytes."""
    out, low = [], raw.lower()  # of bytes, lower() changes A to Z alone
    if any(n in low for n in NAMES):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(raw) if len(m[2]) >= 6]
    if b"AKIA" in raw:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(raw) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(raw)]
    return sorted(out)


class Scanner:
    """Spans of high entropy by character class, without what an allow-list knows."""

    def __init__(self, classes: tuple[CharacterClass, ...] = CLASSES, allowed: tuple[bytes, ...] = ALLOWED) -> None:
        self.classes = [(c, re.compile(b"[" + re.escape(c.characters) + b"]{%d,}" % c.window), [self._weights(k) for k in c.mixes]) for c in classes]
        self.allowed = re.compile(b"|".join(allowed)) if allowed else None
        most = max((c.window for c in classes), default=1)
        counts = np.arange(1, most + 1)
        # c log2 c, and what a further one adds
        self.terms = [0.0, *(counts * np.log2(counts)).tolist()]

    @staticmethod
    def _weights(kind: str) -> list[int]:
        return [int(i in _KINDS[kind]) for i in range(256)]

    def windows(self, run: bytes, own: CharacterClass, mixes: list[list[int]]) -> Iterator[int]:
        """Starts of the hot windows of a run. Entropy is log2(n) - sum(c log2 c) / n over a window's counts; one character
        comes and one goes at each step."""
        n, terms = own.window, self.terms
        counts, held, total = [0] * 256, [0] * len(mixes), 0.0
        limit = (np.log2(n) - own.bits) * n + 1e-9
        for at, c in enumerate(run):
            total += terms[counts[c] + 1] - terms[counts[c]]
            counts[c] += 1
            for k, m in enumerate(mixes):
                held[k] += m[c]
            if at >= n - 1:
                if total <= limit and all(held):
                    yield at - n + 1
                out = run[at - n + 1]
                total += terms[counts[out] - 1] - terms[counts[out]]
                counts[out] -= 1
                for k, m in enumerate(mixes):
                    held[k] -= m[out]

    def spans(self, raw: bytes) -> list[tuple[int, int]]:
        """(start, end) of what is hot, grown over letters and digits at both ends, in order and apart."""
        out: list[tuple[int, int]] = []
        for found in CANDIDATE.finditer(raw):
            text, base = found[0], found.start()
            plain = [m.span() for m in self.allowed.finditer(text)] if self.allowed else []
            hot = []
            for own, pattern, mixes in self.classes:
                for run in pattern.finditer(text):
                    for at in self.windows(run[0], own, mixes):
                        a, b = run.start() + at, run.start() + at + own.window
                        if not any(a < y and x < b for x, y in plain):
                            if hot and hot[-1][0] <= a <= hot[-1][1]:
                                hot[-1] = (hot[-1][0], max(b, hot[-1][1]))
                            else:
                                hot.append((a, b))
            last = -1
            for a, b in sorted(hot):
                while a > 0 and text[a - 1 : a].isalnum():
                    a -= 1
                while b < len(text) and text[b : b + 1].isalnum():
                    b += 1
                if a <= last:
                    out[-1] = (out[-1][0], max(out[-1][1], base + b))
                else:
                    out.append((base + a, base + b))
                last = max(last, b)
        return out


def apart(base: list[Span], added: list[tuple[int, int]]) -> list[Span]:
    """``added`` as spans, without those that meet one of ``base``."""
    out, k, reach = [], 0, -1
    for s, e in added:
        while k < len(base) and base[k][0] < e:
            reach = max(reach, base[k][2])
            k += 1
        if reach <= s:
            out.append((s, ENTROPY, e))
    return out


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def in_points(raw: bytes, spans: list[Span]) -> list[Span]:
    """Byte offsets as offsets of code points."""
    if not spans or raw.isascii():
        return spans
    before = np.append(0, np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80))
    return [(int(before[s]), k, int(before[e])) for s, k, e in spans]


def find_secrets(docs: DataFrame, classes: tuple[CharacterClass, ...] = CLASSES, allowed: tuple[bytes, ...] = ALLOWED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each input row: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_added.

    The counts and base_sha256 are of the spans by rule, which no allow-list takes away; ``spans`` has those of high entropy
    too, of the kind ``entropy``, where they meet none by rule, and n_added counts these. Offsets count code points of the
    whole text. Null and empty texts have no spans. Equal texts have equal values; rows that repeat an id or have none
    are rows of their own; an empty table gives an empty result; other columns, whatever their names, are not read."""
    plain = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_of(text_col).cast("binary").alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(classes, allowed)
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                part, base, both = b.slice(at, 1000), [], []
                for text in part.column("text"):
                    raw = text.as_py()
                    own = by_rule(raw)
                    added = apart(own, scanner.spans(raw))
                    base.append(in_points(raw, own))
                    both.append(sorted(base[-1] + in_points(raw, added)) if added else base[-1])
                counts = [pa.array([sum(k == kind for _, k, _ in x) for x in base], pa.int64()) for kind in range(ENTROPY)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *counts, pa.array([hashlib.sha256(written(x).encode()).hexdigest() for x in base], pa.string()), pa.array([written(x) for x in both], pa.string()), pa.array([len(y) - len(x) for x, y in zip(base, both)], pa.int64())],
                    ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_added"],
                )

    return plain.mapInArrow(run, "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, n_added bigint")
