"""Token counts of a document's sections by offset-mapped attribution.

A whole document is encoded once. Token spans, from the ids' byte lengths, are joined to the sections' intervals by
binary search over both sorted lists, and a token that crosses a boundary is allocated by an explicit rule.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm import tokens
from kindred.llm.common import text_of

#: Which section a token that crosses a boundary counts for: that of its first byte, of its last, or the one that
#: holds most of its bytes, the first of several.
RULES = ("first", "last", "most")
SCHEMA = "doc_id bigint, section bigint, start_char bigint, end_char bigint, n_tokens bigint, n_crossing bigint, doc_tokens bigint"


def line_starts(text: str) -> list[int]:
    """Character offsets at which lines begin; a line feed ends its line."""
    out, at = [0], text.find("\n")
    while at >= 0:
        if at + 1 < len(text):
            out.append(at + 1)
        at = text.find("\n", at + 1)
    return out


def attribute(lengths: np.ndarray, starts: np.ndarray, size: int, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of byte ``lengths`` over sections that begin at sorted byte offsets ``starts`` (the first 0) of ``size``
    bytes: tokens by section, and how many of them cross out of or into it."""
    ends = np.cumsum(lengths)
    begins = ends - lengths
    first = np.searchsorted(starts, begins, "right") - 1
    last = np.searchsorted(starts, ends - 1, "right") - 1
    own = last if rule == "last" else first.copy()
    crossing = np.flatnonzero(first != last)
    if rule == "most":
        edges = np.append(starts, size)
        for t in crossing:
            parts = np.minimum(edges[first[t] + 1 : last[t] + 2], ends[t]) - np.maximum(edges[first[t] : last[t] + 1], begins[t])
            own[t] = first[t] + int(np.argmax(parts))
    return np.bincount(own, minlength=len(starts)), np.bincount(own[crossing], minlength=len(starts))


def _attributor(rule: str, folder: str, vocabulary: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.load(folder, vocabulary)
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                out = []
                part = b.slice(at, 1000)
                for name, text, given in zip(part.column("doc_id").to_pylist(), part.column("text"), part.column("starts").to_pylist()):
                    text = text.as_py()
                    chars = line_starts(text) if given is None else sorted({0, *(x for x in given if x is not None and 0 < x < len(text))})
                    raw = np.frombuffer(text.encode("utf-8"), np.uint8)
                    places = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))
                    ids = encode(text)
                    counts, crossing = attribute(encode.bytes_of[ids], places[chars], len(raw), rule) if len(ids) else (np.zeros(1, int), np.zeros(1, int))
                    n = len(chars)
                    out.append((np.array([name] * n, object), np.arange(n), np.array(chars), np.array([*chars[1:], len(text)]), counts, crossing, np.full(n, len(ids))))
                columns = [np.concatenate(c) for c in zip(*out)]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], [c.split()[0] for c in SCHEMA.split(", ")])

    return run


def section_tokens(docs: DataFrame, rule: str = "first", starts_col: str | None = None, id_col: str = "doc_id", text_col: str = "text", folder: str | None = None, vocabulary: str = "byte_bpe_50k") -> DataFrame:
    """One row for each section of each input row: doc_id, section, start_char, end_char, n_tokens, n_crossing, doc_tokens.

    Sections are lines, or begin at the character offsets in the array column ``starts_col`` (null: lines; nulls,
    repeats and offsets outside the text in it are ignored). A document's sections cover it, and n_tokens sums to
    doc_tokens. Null and empty texts are one empty section. Rows that repeat an id or have none are rows of their own;
    an empty table gives an empty result; other columns, whatever their names, are not read."""
    if rule not in RULES:
        raise ValueError(f"rule: one of {', '.join(RULES)}")
    starts = F.lit(None).cast("array<bigint>") if starts_col is None else F.col(starts_col).cast("array<bigint>")
    plain = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_of(text_col).alias("text"), starts.alias("starts"))
    return plain.mapInArrow(_attributor(rule, folder or tokens.folder(), vocabulary), SCHEMA)
