"""Whitening of embeddings from singular values that are merged up a tree.

Each task keeps the singular values and right vectors of its centred rows, all of them, with their mean and exact sums.
Two such summaries merge by one more singular value decomposition: of both sides' scaled vectors and a row that corrects for
the distance of their means. Nothing is cut off, so that the root has the decomposition of all rows, whatever their order.
Products of rows are never summed, and rows are centred first: means that are large against the spread cost no digits.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.sources.tables import cut, drop

SCALE, COMPONENTS = 64, 32
#: Summaries that one task merges, and rows of a batch that are decomposed at once.
FAN_IN, ROWS = 16, 4096
SUMMARY = "part bigint, dims int, n bigint, sums array<decimal(38,0)>, mean array<double>, s array<double>, vt array<double>"
_FITS = float(2**62)


@dataclass
class Summary:
    """``n`` rows: exact sums of their whole parts, mean, singular values (as many as there can be) and right vectors of the centred rows."""

    n: int
    sums: list[int]
    mean: np.ndarray
    s: np.ndarray
    vt: np.ndarray

    @staticmethod
    def of(y: np.ndarray) -> Summary:
        """Of rows (n, dims), n at least 1."""
        mean = y.mean(axis=0)
        _, s, vt = np.linalg.svd(y - mean, full_matrices=False)
        whole = np.abs(y).max(initial=0) * len(y) < 2**53  # then sums of whole numbers are exact as they are
        return Summary(len(y), [int(x) for x in (y.sum(axis=0) if whole else [sum(map(int, c)) for c in y.T])], mean, s, vt)

    def merged(self, other: Summary) -> Summary:
        n = self.n + other.n
        apart = np.sqrt(self.n / n * other.n) * (self.mean - other.mean)
        _, s, vt = np.linalg.svd(np.concatenate([self.s[:, None] * self.vt, other.s[:, None] * other.vt, apart[None]]), full_matrices=False)
        return Summary(n, [a + b for a, b in zip(self.sums, other.sums)], self.mean + (other.mean - self.mean) * (other.n / n), s, vt)

    def row(self, part: int) -> tuple:
        return part, len(self.mean), self.n, [Decimal(x) for x in self.sums], self.mean.tolist(), self.s.tolist(), self.vt.ravel().tolist()

    @staticmethod
    def from_row(r: object) -> Summary:
        s = np.asarray(r.s, np.float64)
        return Summary(int(r.n), [int(x) for x in r.sums], np.asarray(r.mean, np.float64), s, np.asarray(r.vt, np.float64).reshape(len(s), int(r.dims)))


def matrices(vectors: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows' numbers, their entries as a matrix) of a list column, by length; null lists and null, infinite or undefined
    entries leave their row out."""
    sizes = pc.list_value_length(vectors).fill_null(-1).to_numpy(zero_copy_only=False)
    held = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # null lists hold nothing, null entries become nan
    starts = np.cumsum(np.maximum(sizes, 0)) - np.maximum(sizes, 0)
    for d in np.unique(sizes[sizes > 0]):
        own = np.flatnonzero(sizes == d)
        m = held[starts[own][:, None] + np.arange(d)]
        good = np.isfinite(m).all(axis=1)
        if good.any():
            yield own[good], m[good]


def whole(m: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """Which rows keep within 62 bits when scaled, and those rows' entries scaled and rounded down."""
    y = np.floor(m * scale)
    fits = (np.abs(y) < _FITS).all(axis=1)
    return fits, y[fits]


def _summaries(scale: float | None):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Summary] = {}
        for b in batches:
            for at in range(0, b.num_rows, ROWS):
                for _, m in matrices(b.column("v").slice(at, ROWS)):
                    y = m if scale is None else whole(m, scale)[1]
                    if len(y):
                        own = Summary.of(y)
                        held[y.shape[1]] = held[y.shape[1]].merged(own) if y.shape[1] in held else own
        rows = [s.row(TaskContext.get().partitionId()) for s in held.values()]
        if rows:
            yield _batch(rows)

    return run


_TYPES = [("part", pa.int64()), ("dims", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.decimal128(38, 0))), ("mean", pa.list_(pa.float64())), ("s", pa.list_(pa.float64())), ("vt", pa.list_(pa.float64()))]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), _TYPES)], [n for n, _ in _TYPES])


def _merger(fan_in: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        total = None
        for r in group.sort_values("part").itertuples():
            own = Summary.from_row(r)
            total = own if total is None else total.merged(own)
        return pd.DataFrame([total.row(int(group.part.min()) // fan_in)], columns=[n for n, _ in _TYPES])

    return run


def decomposed(vectors: DataFrame, scale: float | None = None, fan_in: int = FAN_IN) -> Summary | None:
    """The summary of all rows of the column ``v`` array<double>, or of floor(scale * v); None without any. Of vectors of
    several lengths those of the commonest count (of equal ones the greater).

    The tree has at most ``fan_in`` summaries a group and a written level for each; the driver sees the root, whose size
    is that of the vectors, not of the table."""
    level = cut(vectors.select("v").mapInArrow(_summaries(scale), SUMMARY), "summaries")
    last = level.agg(F.max("part")).first()[0]
    while last:
        above = cut(level.groupBy("dims", F.floor(F.col("part") / fan_in).alias("g")).applyInPandas(_merger(fan_in), SUMMARY), "summaries")
        drop(level)
        level, last = above, last // fan_in
    root = level.orderBy(F.desc("n"), F.desc("dims")).limit(1).collect()
    drop(level)
    return Summary.from_row(root[0]) if root else None


@dataclass
class Whitener:
    """Unit components as rows, by falling eigenvalue of the covariance (divisor n); ``sums`` are of floor(scale * c)."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    scale: float

    @staticmethod
    def fitted(root: Summary, most: int, scale: float) -> Whitener:
        e = root.s**2 / root.n
        d = len(root.mean)
        vt, e = root.vt, np.concatenate([e, np.zeros(max(0, d - len(e)))])
        if len(vt) < d:  # fewer rows than dimensions: any units that complete the basis
            vt = np.concatenate([vt, np.linalg.svd(vt)[2][len(vt) :]])
        k = min(most, d)
        signs = np.sign(vt[np.arange(k), np.abs(vt[:k]).argmax(axis=1)])
        return Whitener(root.n, root.sums, vt[:k] * signs[:, None], e[:k], float(e.sum()), scale)

    @property
    def spread(self) -> np.ndarray:
        """Which components have a variance that is more than rounding."""
        return self.eigenvalues > self.trace * len(self.components[0]) * 1e-24 + 1e-300

    def centred(self, y: np.ndarray) -> np.ndarray:
        """y - mean, the division last, so that whole numbers lose nothing before it."""
        exact = np.abs(y).max(initial=0) * self.n < 2**52 and max(map(abs, self.sums)) < 2**52
        if exact:
            return (self.n * y - np.array(self.sums, np.float64)) / self.n
        return np.array([[(self.n * int(x) - s) / self.n for x, s in zip(r, self.sums)] for r in y]).reshape(y.shape)

    def white(self, y: np.ndarray) -> np.ndarray:
        """Rows projected on the components, over their deviation; nan where there is none."""
        scale = np.where(self.spread, np.sqrt(np.where(self.spread, self.eigenvalues, 1)), np.nan)
        return self.centred(y) @ self.components.T / scale

    def deviations(self, y: np.ndarray) -> list[int | None]:
        """Sum over the dimensions of (n * y - sums) ** 2, exact; None if it has more than 63 bits."""
        most = np.abs(y).max(initial=0) * self.n + max(map(abs, self.sums))
        if most**2 * y.shape[1] < 2**62:
            return ((self.n * y.astype(np.int64) - np.array(self.sums, np.int64)) ** 2).sum(axis=1).tolist()
        out = [sum((self.n * int(x) - s) ** 2 for x, s in zip(r, self.sums)) for r in y]
        return [x if x < 2**63 else None for x in out]

    def rows(self, batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(rows' numbers, scaled whole entries) of the rows of the fitted length, in pieces."""
        for at in range(0, batch.num_rows, ROWS):
            for own, m in matrices(batch.column("v").slice(at, ROWS)):
                if m.shape[1] == len(self.sums):
                    fits, y = whole(m, self.scale)
                    if len(y):
                        yield own[fits] + at, y


def fit(vectors: DataFrame, most: int = COMPONENTS, scale: float = SCALE) -> Whitener | None:
    """Of the column ``v`` array<double>; None without rows that count."""
    root = decomposed(vectors, scale)
    return None if root is None else Whitener.fitted(root, most, scale)


def identity_error(vectors: DataFrame, w: Whitener) -> float:
    """The largest absolute entry of the whitened rows' covariance less the identity, by the same tree over the whitened
    rows themselves; components without spread have no part in it."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, y in w.rows(b):
                yield pa.RecordBatch.from_arrays([pa.array(list(w.white(y)[:, w.spread]), pa.list_(pa.float64()))], ["v"])

    root = decomposed(vectors.mapInArrow(run, "v array<double>"))
    if root is None:
        return 0.0
    covariance = (root.vt.T * (root.s**2 / root.n)) @ root.vt
    return float(np.abs(covariance - np.eye(len(covariance))).max())


WHITENED = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def whiten_embeddings(rows: DataFrame, most: int = COMPONENTS, scale: float = SCALE, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """For each row that counts and each of at most ``most`` components: vec_id, component, n, deviation, whitened,
    explained, identity_error.

    Entries become floor(scale * c), whose covariance gives the components; of each the entry of largest size is positive.
    All is centred first, so that a constant added to every entry, as the query's contract has it, changes nothing. Left out are null and empty vectors, those with a null, infinite or undefined entry or one beyond 62
    bits when scaled, and those of another length than the commonest. A component without variance (as when all
    rows are equal) has a null whitened value and no part in identity_error. A deviation beyond 63 bits is null. Rows
    that repeat an id or have none are rows of their own; an empty table gives an empty result; other columns, whatever
    their names, are not read."""
    plain = rows.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
    w = fit(plain.select("v"), most, scale)
    if w is None:
        return rows.sparkSession.createDataFrame([], WHITENED)
    error = identity_error(plain.select("v"), w)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        explained = w.eigenvalues / w.trace if w.trace > 0 else np.zeros(len(w.eigenvalues))
        k = len(explained)
        for b in batches:
            ids = b.column("vec_id")
            for own, y in w.rows(b):
                each = np.repeat(np.arange(len(y)), k)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(own[each])), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(y))), pa.array(np.full(len(each), w.n)), pa.array(w.deviations(y), pa.int64()).take(pa.array(each)),
                        pa.array(w.white(y).ravel(), from_pandas=True), pa.array(np.tile(explained, len(y))), pa.array(np.full(len(each), error)),
                    ],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return plain.mapInArrow(run, WHITENED)
