"""What text filters remove together: each filter's share in every order of five.

A scan reads the texts' Arrow buffers: byte classes and their prefix sums count words, capitals, symbols and code points of
all documents of a piece at once. Words get hashes from prefix sums of their bytes' powers; sorted by document, equal
neighbours are verified on their bytes, which gives distinct words. Each document becomes a mask of the filters that it
fails, and the report of all orders is a product of the counts by mask.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm.common import text_of
from kindred.sources.tables import cut

FILTERS = "ABCDE"
SEPARATOR, CAPITAL, SYMBOL, BEGINS = 1, 2, 4, 8
_CLASS = np.zeros(256, np.uint8)
_CLASS[[0x20, *range(0x09, 0x0E)]] |= SEPARATOR
_CLASS[65:91] |= CAPITAL
_CLASS[[ord(c) for c in "#$%&*|"]] |= SYMBOL
_CLASS[:0x80] |= BEGINS
_CLASS[0xC0:] |= BEGINS  # the other bytes go on with a code point
#: Bytes that are scanned at once, unless a single word is longer.
PIECE = 1 << 20
#: The base of the words' hashes, odd so that powers can be undone modulo 2**64.
BASE = 0x9E3779B97F4A7C15
_SPREAD = np.uint64(0xD6E8FEB86659FD93)


class _Powers:
    """Powers of a base and of its inverse modulo 2**64, as many as the longest piece needed."""

    def __init__(self, base: int) -> None:
        self.base, self.inverse = np.uint64(base), np.uint64(pow(base, -1, 1 << 64))
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) <= n:
            size = max(n + 1, PIECE + 1)
            self.up, self.down = (np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, x)])) for x in (self.base, self.inverse))
        return self.up, self.down


def _before(mask: np.ndarray) -> np.ndarray:
    """How many are set before each place, and before the end."""
    out = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=out[1:])
    return out


def _equal(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether ``size`` bytes from a are those from b, pair by pair."""
    out, long = np.ones(len(a), bool), size > PIECE // 16
    for i in np.flatnonzero(long):
        out[i] = bool((data[a[i] : a[i] + size[i]] == data[b[i] : b[i] + size[i]]).all())
    short = np.flatnonzero(~long)
    piece = np.cumsum(size[short]) // PIECE
    for own in np.split(short, np.flatnonzero(np.diff(piece)) + 1) if len(short) else []:
        ends = np.cumsum(size[own])
        step = np.arange(ends[-1]) - np.repeat(ends - size[own], size[own])
        differ = np.flatnonzero(data[np.repeat(a[own], size[own]) + step] != data[np.repeat(b[own], size[own]) + step])
        out[own[np.searchsorted(ends, differ, "right")]] = False
    return out


def distinct_words(data: np.ndarray, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Distinct words of each of ``n`` documents. Words are sorted by document and hash; neighbours that agree are verified,
    and a document with words that only their hashes hold equal is counted word by word."""
    key = hashes * _SPREAD + doc.astype(np.uint64) * np.uint64(BASE)
    order = np.argsort(key)
    same = np.flatnonzero(key[order[1:]] == key[order[:-1]])
    i, j = order[same], order[same + 1]
    size = ends[i] - starts[i]
    good = (doc[i] == doc[j]) & (size == ends[j] - starts[j])
    good[good] = _equal(data, starts[i[good]], starts[j[good]], size[good])
    out = np.bincount(doc, minlength=n) - np.bincount(doc[j[good]], minlength=n)
    for d in np.unique(np.concatenate([doc[i[~good]], doc[j[~good]]])):
        own = np.flatnonzero(doc == d)
        out[d] = len({data[starts[k] : ends[k]].tobytes() for k in own})
    return out


def measures(data: np.ndarray, offsets: np.ndarray, powers: _Powers | None = None) -> np.ndarray:
    """Columns words, distinct words, capitals, symbols, code points of the texts data[offsets[i]:offsets[i + 1]]."""
    powers, n = powers or _Powers(BASE), len(offsets) - 1
    out = np.zeros((n, 5), np.int64)
    first = 0
    while first < n:
        # whole documents up to a piece; a longer one alone, cut at separators
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + PIECE, "right")) - 1)
        base, end = int(offsets[first]), int(offsets[last])
        found, at = [], base
        while True:
            stop = end
            if end - at > PIECE:
                stop = at + PIECE
                while stop < end and not _CLASS[data[stop]] & SEPARATOR:
                    stop += 1
            part = data[at:stop]
            own = _CLASS[part]
            edges = np.clip(offsets[first : last + 1], at, stop) - at
            inside = (own & SEPARATOR) == 0
            begin, over = inside.copy(), inside.copy()
            begin[1:] &= ~inside[:-1]
            over[:-1] &= ~inside[1:]
            heads = edges[:-1][edges[:-1] < edges[1:]]
            begin[heads] = inside[heads]
            tails = heads[heads > 0] - 1
            over[tails] = inside[tails]
            for k, mask in ((0, begin), (2, own & CAPITAL != 0), (3, own & SYMBOL != 0), (4, own & BEGINS != 0)):
                out[first:last, k] += np.diff(_before(mask)[edges])
            starts, ends = np.flatnonzero(begin), np.flatnonzero(over) + 1
            up, down = powers.upto(len(part))
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[: len(part)], out=sums[1:])
            found.append(((sums[ends] - sums[starts]) * down[starts], starts + at, ends + at, np.searchsorted(edges, starts, "right") - 1))
            at = stop
            if at >= end:
                break
        out[first:last, 1] = distinct_words(data, *(np.concatenate(x) for x in zip(*found)), last - first)
        first = last
    return out


def failures(measured: np.ndarray) -> np.ndarray:
    """The mask of the filters A to D (bits 0 to 3) that texts of these measures fail."""
    words, distinct, capitals, symbols, points = measured.T
    tests = (words < 200, 100 * distinct < 50 * words, 100 * capitals > 2 * points, symbols > 0)
    return sum(t.astype(np.int64) << k for k, t in enumerate(tests))


def _buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a column without nulls, as they lie in memory."""
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    held = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), held


def _scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    powers = _Powers(BASE)
    for b in batches:
        mask = failures(measures(*_buffers(b.column("text")), powers))
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("part"), b.column("digest"), pa.array(mask, pa.int64())], ["doc_id", "part", "digest", "mask"])


def failed_filters(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """(doc_id, part, digest, mask) of each input row: the filters A to D that it fails, and its text's digest."""
    text = text_of(text_col)
    plain = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"), text.alias("text"))
    return plain.mapInArrow(_scan, "doc_id bigint, part string, digest binary, mask bigint")


def counts_by_mask(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic) of ``failed_filters``' rows, a written table, with E as bit 4: how many documents of a
    part fail just these filters, and how many of those are labelled good or toxic."""
    known = rows.where("doc_id is not null")
    # one row a text; a copied text's rows meet it under their own ids, and so spread
    firsts = known.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("_first", F.lit(True))
    said = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), "quality", "toxic").groupBy("doc_id").agg(F.max(F.when(F.col("quality") == 1, 1)).alias("_good"), F.max(F.when(F.col("toxic") == 1, 1)).alias("_toxic"))
    told = known.join(firsts, ["digest", "doc_id"], "left").join(said, "doc_id", "left")
    told = told.select("part", (F.col("mask") + F.when(F.col("_first").isNull(), 16).otherwise(0)).alias("mask"), F.coalesce("_good", F.lit(0)).alias("g"), F.coalesce("_toxic", F.lit(0)).alias("t"))
    both = told.union(rows.where("doc_id is null").select("part", "mask", F.lit(0), F.lit(0)))
    return both.groupBy("part", "mask").agg(F.count("*").alias("n"), F.sum("g").cast("bigint").alias("good"), F.sum("t").cast("bigint").alias("toxic"))


def _orders() -> tuple[list[str], np.ndarray, dict[str, np.ndarray]]:
    """All orders with their steps: names, each step's filter, and by kind which masks (rows) a step (column) counts."""
    names = ["".join(p) for p in permutations(FILTERS)]
    place = np.array([[FILTERS.index(c) for c in name] for name in names])
    own = 1 << place
    before = np.cumsum(own, axis=1) - own
    mask, own, before = np.arange(1 << len(FILTERS))[:, None], own.ravel(), before.ravel()
    fails, was = (mask & own) > 0, (mask & before) > 0
    kinds = {"kept": ~fails & ~was, "removed": fails & ~was, "redundant": fails & was, "unique_fails": mask == own}
    return names, place.ravel(), {k: v.astype(np.int64) for k, v in kinds.items()}


REPORT = "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint"


def _report(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names, place, kinds = _orders()
    steps = len(FILTERS)
    for b in batches:
        for part, held in zip(b.part, b.held):
            count = np.zeros((3, 1 << steps), np.int64)
            for x in held:
                count[:, x["mask"]] = x["n"], x["good"], x["toxic"]
            n = {k: count[0] @ m for k, m in kinds.items()}
            lost = count[1:] @ kinds["removed"]
            shapley = np.bincount(place, n["removed"], steps).astype(np.int64)
            yield pd.DataFrame({"part": part, "filter_order": np.repeat(names, steps), "step": np.tile(np.arange(1, steps + 1), len(names)), **n, "good_lost": lost[0], "toxic_lost": lost[1], "shapley": shapley[place]})


def audit_filters(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """For each part (value of ``part_col``), order of the filters and step: kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley, as the words say; zeros are rows too.

    A document fails A below 200 words, B if under half of its words are distinct, C if over 2 % of its characters are
    capitals, D with any of ``#$%&*|``, E if a smaller id has the same text in any part. Null texts are empty, null parts
    the part ''. Each row counts. Rows that repeat an id have its labels each (1 if any of the label's rows says so), and
    do not make each other fail E; rows without an id have no labels, neither fail E nor make others fail it. An empty
    table has no parts, and so no rows. Other columns, whatever their names, are not read. A table's parts may be many."""
    rows = cut(failed_filters(docs, id_col, text_col, part_col), "masks")
    held = counts_by_mask(rows, labels).groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("held"))  # 32 masks at most
    return held.mapInPandas(_report, REPORT)
