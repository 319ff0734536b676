"""A quality classifier: histogram gradient-boosted trees over document statistics.

Statistics are taken from every whole text. The trees are fitted on at most ``SAMPLE`` labelled documents, a bound that
is a parameter, and flattened into arrays that all rows of a batch walk through together, a level at a time.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.llm.common import text_of

SAMPLE = 20_000
STATISTICS = 30
_CLASS = np.zeros(256, np.int64)  # 0 other, then upper, lower, digit, space, line feed, high byte, stops, marks
for _i, _of in enumerate(("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789", " \t\r\v\f", "\n", "", ".,;:?'\"-()", "!#$%&*+/<=>@[\\]^_`{|}~"), 1):
    _CLASS[[ord(c) for c in _of]] = _i
_CLASS[128:] = 6


def statistics(text: str) -> np.ndarray:
    """``STATISTICS`` numbers about a text; all 0 for an empty one."""
    out = np.zeros(STATISTICS)
    raw = text.encode("utf-8", "surrogatepass")
    n = len(raw)
    if not n:
        return out
    data = np.frombuffer(raw, np.uint8)
    seen = np.bincount(data, minlength=256)
    share = seen[seen > 0] / n
    out[0] = np.log1p(n)
    out[1:9] = np.bincount(_CLASS, seen, 9)[1:] / n
    out[9] = -(share * np.log2(share)).sum()
    out[10:15] = seen[[33, 124, 46, 44, 42]] / n
    words = raw.split()
    if words:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        kinds = set(words)
        out[15] = np.log1p(len(words))
        out[16], out[17], out[18] = sizes.mean(), sizes.std(), sizes.max()
        out[19] = len(kinds) / len(words)
        out[20] = sum(map(bytes.isupper, words)) / len(words)
        out[21] = sum(map(bytes.istitle, words)) / len(words)
        out[22] = (sizes <= 3).mean()
        out[23] = len({w.lower() for w in kinds}) / len(kinds)
    lines = raw.split(b"\n")
    out[24] = len(lines)
    out[25] = 1 - len(set(lines)) / len(lines)
    out[26] = n / len(lines)
    out[27] = max(map(len, lines)) / n
    out[28] = (data[1:] == data[:-1]).mean() if n > 1 else 0
    out[29] = len(zlib.compress(raw, 1)) / n
    return out


@dataclass
class Forest:
    """Trees as flat arrays: a leaf points to itself."""

    feature: np.ndarray
    limit: np.ndarray
    child: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    base: float
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row."""
        if not len(self.roots):
            return np.full(len(x), 1 / (1 + np.exp(-self.base)))
        at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            at = self.child[at] + (x[rows, self.feature[at]] > self.limit[at])
        return 1 / (1 + np.exp(-(self.base + self.value[at].sum(axis=1))))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64, ridge: float = 1.0, least: int = 20) -> Forest:
    """Boosted trees on logistic loss; splits are found on histograms of ``bins`` quantile bins."""
    mean = min(max(float(y.mean()) if len(y) else 0.5, 1e-3), 1 - 1e-3)
    base = float(np.log(mean / (1 - mean)))
    feature, limit, child, value, roots = [], [], [], [], []

    def node() -> int:
        feature.append(0)
        limit.append(np.inf)
        child.append(len(child))  # a leaf: nothing is over its limit
        value.append(0.0)
        return len(child) - 1

    if len(y) >= 2 * least and 0 < y.sum() < len(y):
        edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
        binned = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], axis=1)
        flat = binned + np.arange(x.shape[1]) * bins
        f = np.full(len(y), base)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-f))
            g, h = y - p, p * (1 - p)
            roots.append(node())
            level = [(roots[-1], np.arange(len(y)))]
            for d in range(depth + 1):
                following = []
                for at, rows in level:
                    split = None
                    if d < depth and len(rows) >= 2 * least:
                        keys = flat[rows].ravel()
                        total = x.shape[1] * bins
                        gs, hs, ns = (np.bincount(keys, w, total).reshape(-1, bins).cumsum(axis=1) for w in (np.repeat(g[rows], x.shape[1]), np.repeat(h[rows], x.shape[1]), None))
                        gt, ht, nt = gs[:, -1:], hs[:, -1:], ns[:, -1:]
                        gain = gs**2 / (hs + ridge) + (gt - gs) ** 2 / (ht - hs + ridge) - gt**2 / (ht + ridge)
                        gain[(ns < least) | (nt - ns < least)] = 0
                        for i, e in enumerate(edges):
                            gain[i, len(e) :] = 0
                        best = int(gain.argmax())
                        if gain.flat[best] > 1e-6:
                            split = divmod(best, bins)
                    if split is None:
                        value[at] = rate * g[rows].sum() / (h[rows].sum() + ridge)
                        f[rows] += value[at]
                        continue
                    i, b = split
                    left, right = node(), node()
                    feature[at], limit[at], child[at] = i, edges[i][b], left
                    over = binned[rows, i] > b
                    following += [(left, rows[~over]), (right, rows[over])]
                level = following
    return Forest(*(np.array(v) for v in (feature, limit, child, value, roots)), base, depth)


def held_out(id_: Column) -> Column:
    return F.crc32(id_.cast("string").cast("binary")) % 3 == 1


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Forest:
    """Fit on at most ``sample`` labelled documents, drawn by a hash of the id, none of them held out. An id that is
    labelled several times counts as 1 if its mean is 0.5 or more; null labels and ids are ignored. Of rows that repeat
    an id the one with the least statistics counts. Without both
    labels the score is their rate, or 0.5 without any."""
    known = labels.select(F.col(id_col).cast("bigint").alias("its"), F.col(label_col).cast("double").alias("y")).where("its is not null and y is not null")
    known = known.where(~held_out(F.col("its"))).groupBy("its").agg((F.avg("y") >= 0.5).cast("double").alias("y"))
    known = known.orderBy(F.xxhash64("its"), "its").limit(sample)
    plain = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_of(text_col).alias("text"))
    # the limit bounds what is broadcast; of rows that repeat an id one comes back, folded where they are read
    rows = plain.join(F.broadcast(known), F.col("doc_id") == F.col("its")).select("doc_id", "y", "text").mapInArrow(_measure, "doc_id bigint, y double, x array<double>")
    rows = rows.groupBy("doc_id").agg(F.min(F.struct("y", "x")).alias("m")).select("doc_id", "m.y", "m.x").toArrow().combine_chunks()
    if not rows.num_rows:
        return fit(np.zeros((0, STATISTICS)), np.zeros(0))
    rows = rows.sort_by("doc_id")
    return fit(np.array(rows.column("x").to_pylist()), rows.column("y").to_numpy())


def _measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        x = [statistics(t.as_py()) for t in b.column("text")]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("y"), pa.array(x, pa.list_(pa.float64()))], ["doc_id", "y", "x"])


def _scores(forest: Forest, texts: pa.Array) -> np.ndarray:
    out = [np.zeros(0)]
    for at in range(0, len(texts), 1000):
        out.append(forest.score(np.stack([statistics(t.as_py() or "") for t in texts.slice(at, 1000)])))
    return np.concatenate(out)


def score_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """One row for each input row: doc_id, held_out, score, predicted.

    Null and empty texts have statistics of 0 and are scored as such. Rows that repeat an id or have none are rows of
    their own (a null id is not held out). An empty table gives an empty result; other columns, whatever their names,
    are not read: a score depends on the text alone."""
    forest = train(docs, labels, sample, id_col, text_col, label_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = _scores(forest, b.column("text"))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    plain = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(held_out(F.col(id_col).cast("bigint")), F.lit(False)).alias("held_out"), text_of(text_col).alias("text"))
    return plain.mapInArrow(run, "doc_id bigint, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, text_col: str = "text", **columns: str) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose score is 0.5 or more."""
    forest = train(docs, labels, sample, text_col=text_col, **columns)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(_scores(forest, b.column(text_col)) >= 0.5))

    return docs.mapInArrow(run, docs.schema)
