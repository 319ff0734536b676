"""Segment features: lists of segment IDs to grouped IDs, scores, vocabulary and lookup indices, pooled vectors."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred import functions as K
from kindred.operators.ranking import placed
from kindred.sources.tables import cut

GROUPS = ("gender", "age", "residence", "product", "content", "etc")
# fixed values: IDs kept of a bag, the last ones
MAX_LEN = {"residence": 72, "product": 24, "content": 48, "etc": 48}
# fixed values: what a gender segment says
GENDER_WEIGHTS = {"26455": 1.0, "26456": 0.5, "26457": -1.0, "26458": -0.5}


def segment_groups(latest: DataFrame, ids: dict[str, list[str]]) -> DataFrame:
    """(device_ifa, <group>_ids): a list's distinct IDs of each group, in the list's order; null stays null."""
    a = F.split("segments", ";")
    return latest.select("device_ifa", *[F.array_intersect(a, F.array(*map(F.lit, ids[g]))).alias(f"{g}_ids") for g in GROUPS])


def segment_features(latest: DataFrame, ids: dict[str, list[str]]) -> DataFrame:
    """The feature row: gender score and ``;``-joined IDs by group."""
    join = lambda g, name: F.array_join(f"{g}_ids", ";").alias(name)
    return segment_groups(latest, ids).select(
        "device_ifa", K.gender_score(F.col("gender_ids"), GENDER_WEIGHTS).alias("gender_score"),
        join("age", "age_bracket_ids"), join("residence", "residence_ids"), join("product", "product_interest_ids"), join("content", "content_interest_ids"), join("etc", "etc_segment_ids"),
    )


def vocabulary(tokens: DataFrame, column: str = "token", max_size: int | None = None, min_freq: int = 1) -> DataFrame:
    """(token, cnt, idx): by frequency, then token; indices from 2, after 0 for none and 1 for unknown.

    Tokens are counted before they are ranked."""
    counts = tokens.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("token")).agg(F.count("*").alias("cnt")).where(F.col("cnt") >= min_freq)
    ranked = placed(counts, [F.desc("cnt"), F.col("token")], "idx").withColumn("idx", (F.col("idx") + 1).cast("int"))
    return ranked if max_size is None else ranked.where(F.col("idx") < max_size + 2)


#: Rows of a lookup or vocabulary that go to the tasks whole, counted first; a larger one is joined.
LOOKUP_ROWS = 200_000


def encode_tokens(rows: DataFrame, column: str, vocab: DataFrame) -> DataFrame:
    """Adds idx: 0 for null or blank, 1 for unknown. The rows are not shuffled for a vocabulary that is counted to be small;
    a large one meets the rows by token, those without one apart."""
    known = vocab.select(F.col("token").alias("_t"), "idx")
    few = known.count() <= LOOKUP_ROWS
    joined = rows.join(F.broadcast(known) if few else known, F.col(column) == F.col("_t"), "left").drop("_t")
    return joined.withColumn("idx", F.when(K.not_blank(F.col(column)), F.coalesce("idx", F.lit(1))).otherwise(0))


def token_vectors(rows: DataFrame, column: str, vectors: list[list[float]]) -> DataFrame:
    """Adds v, the vector of the token index in ``column``; index 0, none, has zeros, as an index without a vector."""
    table = F.array(*[F.array(*[F.lit(float(x)) for x in v]) for v in [[0.0] * len(vectors[0]), *vectors[1:]]])
    return rows.withColumn("v", F.coalesce(F.get(table, F.col(column)), F.array_repeat(F.lit(0.0), len(vectors[0]))))


def bag_indices(rows: DataFrame, column: str, lookup: dict[str, int], most: int) -> DataFrame:
    """(device_ifa, idx): lookup rows of the last ``most`` IDs, unknown ones left out."""
    m = F.create_map(*[F.lit(x) for kv in lookup.items() for x in kv])
    own = K.last_items(F.split(column, ";"), most)
    return rows.select("device_ifa", F.filter(F.transform(own, lambda x: m[x]), lambda x: x.isNotNull()).alias("idx"))


def hashed_vectors(dims: int = 64) -> Callable[[list[str]], np.ndarray]:
    """A provider of text vectors that needs no model: signed counts of hashed character trigrams, of length 1."""

    def run(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), dims))
        for i, text in enumerate(texts):
            t = f"  {text.lower()} "
            for k in range(len(t) - 2):
                h = int.from_bytes(hashlib.blake2b(t[k : k + 3].encode(), digest_size=8).digest(), "little")
                out[i, h % dims] += 1 if h >> 63 else -1
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)

    return run


def path_parts(taxonomy: DataFrame) -> DataFrame:
    """(segment_id, token) once each: a path's words, and its beginnings up to each ``>``, so that near paths share more."""
    path = F.lower(F.coalesce("path", F.lit("")))
    steps = F.split(path, ">")
    begins = F.transform(F.sequence(F.lit(1), F.size(steps)), lambda i: F.concat(F.lit(">"), F.array_join(F.slice(steps, F.lit(1), i), ">")))
    parts = F.array_union(F.split(path, r"[>\s]+"), begins)
    return taxonomy.select("segment_id", F.explode(F.filter(F.array_distinct(parts), lambda x: F.length(F.replace(x, F.lit(">"), F.lit(""))) > 0)).alias("token"))


def _summed(rows: DataFrame, key: str, vector: Column, wide: int) -> DataFrame:
    """(key, y): sums of vectors by key, a native sum a dimension."""
    held = rows.select(key, vector.alias("_v"))
    return held.groupBy(key).agg(F.array(*[F.sum(F.col("_v")[j]) for j in range(wide)]).alias("y"))


def _gram(rows: DataFrame, wide: int) -> np.ndarray:
    """Sum of y times y over the rows: a matrix a partition, then one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((wide, wide))
        for b in batches:
            y = b.column("y").flatten().to_numpy().reshape(-1, wide)
            total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel()], pa.list_(pa.float64()))], ["g"])

    sums = rows.select("y").mapInArrow(run, "g array<double>").select(F.posexplode("g").alias("i", "x")).groupBy("i").agg(F.sum("x").alias("x")).toPandas()
    return sums.sort_values("i").x.to_numpy().reshape(wide, wide) if len(sums) else np.zeros((wide, wide))


def learned_vectors(dims: int = 32, spare: int = 8, turns: int = 2) -> Callable[[DataFrame], DataFrame]:
    """A provider whose vectors are learned from the taxonomy's own paths: the left singular vectors, times their values and
    of length 1, of the positive mutual information of segments and path parts.

    A randomised decomposition: random signs of the parts are summed by segment, ``turns`` times through the parts and
    back, made orthonormal by their Gram matrix, and rotated by that of their images. Spark sums over segments and parts;
    the driver sees matrices of dims + spare. Segments without a part have the zero vector."""

    def run(taxonomy: DataFrame) -> DataFrame:
        wide = dims + spare
        both = path_parts(taxonomy)
        by_segment, by_part = both.groupBy("segment_id").agg(F.count("*").alias("ns")), both.groupBy("token").agg(F.count("*").alias("nt"))
        n = both.count()
        info = F.greatest(F.log(F.lit(float(n)) / (F.col("ns") * F.col("nt"))), F.lit(0.0))
        a = both.join(by_segment, "segment_id").join(by_part, "token").select("segment_id", "token", info.alias("w")).persist()
        times = lambda v: F.transform(v, lambda x: x * F.col("w"))
        signs = F.array(*[(F.pmod(F.xxhash64("token", F.lit(j)), F.lit(2)) * 2 - 1).cast("double") for j in range(wide)])
        try:
            y = cut(_summed(a, "segment_id", times(signs), wide), "vectors")
            for _ in range(turns):
                y = _orthonormal(y, wide)
                back = _summed(a.join(y, "segment_id"), "token", times(F.col("y")), wide)
                y = cut(_summed(a.join(back, "token"), "segment_id", times(F.col("y")), wide), "vectors")
            y = _orthonormal(y, wide)
            image = cut(_summed(a.join(y, "segment_id"), "token", times(F.col("y")), wide), "vectors")
            e, u = np.linalg.eigh(_gram(image, wide))
            order = np.argsort(-e)[:dims]
            turn = u[:, order] * np.sqrt(np.maximum(e[order], 0))
            size = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))
            out = taxonomy.select("segment_id").distinct().join(_rotated(y, turn), "segment_id", "left")
            zero = F.array_repeat(F.lit(0.0), dims)
            return out.select("segment_id", F.coalesce(F.when(size(F.col("y")) > 1e-12, F.transform("y", lambda x: x / size(F.col("y")))), zero).alias("vector"))
        finally:
            a.unpersist()

    run.from_table = True
    return run


def _rotated(rows: DataFrame, m: np.ndarray) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            y = b.column("y").flatten().to_numpy().reshape(-1, m.shape[0]) @ m
            yield pa.RecordBatch.from_arrays([b.column("segment_id"), pa.array(list(y), pa.list_(pa.float64()))], ["segment_id", "y"])

    return rows.select("segment_id", "y").mapInArrow(run, "segment_id string, y array<double>")


def _orthonormal(rows: DataFrame, wide: int) -> DataFrame:
    """The rows' columns made orthonormal; directions that hold nothing become zero."""
    e, u = np.linalg.eigh(_gram(rows, wide))
    good = e > max(float(e[-1]), 1e-300) * 1e-12
    return _rotated(rows, u * np.where(good, 1 / np.sqrt(np.where(good, e, 1)), 0))


def lookup(taxonomy: DataFrame, provider: Callable[[list[str]], np.ndarray] | Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(segment_id, idx, vector): of each segment's path text the vector that ``provider`` gives, whatever makes it; one with
    ``from_table`` is given all segments at once, as a DataFrame. idx counts from 1 by segment, 0 stands for none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"segment_id": b.segment_id, "vector": list(provider(b.path.fillna("").tolist()) if len(b) else [])})

    plain = taxonomy.select("segment_id", "path")
    vectors = provider(plain) if getattr(provider, "from_table", False) else plain.mapInPandas(run, "segment_id string, vector array<double>")
    ids = placed(taxonomy.select("segment_id").distinct(), [F.col("segment_id")], "idx")
    return ids.join(vectors, "segment_id").select("segment_id", F.col("idx").cast("int").alias("idx"), "vector")


def fold(table: DataFrame, weights: np.ndarray) -> DataFrame:
    """The lookup with its vectors projected (weights are vector by output): a mean of projections is the projection of
    the mean, so that bags are pooled over fewer numbers. A bias is added after pooling, for empty bags too."""
    return project(table, "vector", weights.T.tolist(), [0.0] * weights.shape[1]).withColumn("vector", F.col("out")).drop("out")


def pool_groups(rows: DataFrame, columns: dict[str, str], lookups: dict[str, DataFrame]) -> DataFrame:
    """Adds v_<group>: the mean vector of the last MAX_LEN IDs of each group's ``;``-joined column, 0 for none; IDs that the
    group's lookup (segment_id, vector) does not have are left out. All groups are pooled in one pass over the rows, with
    the lookups, counted to be small, in every task; none of the rows are shuffled. Larger lookups are joined."""
    if any(t.count() > LOOKUP_ROWS for t in lookups.values()):
        return _pooled_by_join(rows, columns, lookups)
    held = {}
    for g, t in lookups.items():
        own = t.select("segment_id", "vector").toPandas()
        dims = len(own.vector.iloc[0]) if len(own) else 0
        held[g] = (pa.array(own.segment_id, pa.string()), np.concatenate([np.stack(own.vector.to_numpy()) if len(own) else np.zeros((0, dims)), np.zeros((1, dims))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = b
            for g, column in columns.items():
                names, matrix = held[g]
                bags = pc.split_pattern(pc.fill_null(b.column(column), ""), ";")
                items, size = bags.flatten(), pc.list_value_length(bags).to_numpy(zero_copy_only=False).astype(np.int64)
                owner = np.repeat(np.arange(b.num_rows), size)
                at = pc.fill_null(pc.index_in(items, value_set=names), -1).to_numpy(zero_copy_only=False)
                place = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
                keep = (at >= 0) & (place >= np.repeat(size, size) - MAX_LEN[g])
                total = np.zeros((b.num_rows, matrix.shape[1]))
                np.add.at(total, owner[keep], matrix[at[keep]])
                n = np.bincount(owner[keep], minlength=b.num_rows)
                flat = (total / np.maximum(n, 1)[:, None]).ravel()
                offsets = np.arange(b.num_rows + 1, dtype=np.int32) * matrix.shape[1]
                out = out.append_column(f"v_{g}", pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)))
            yield out

    schema = ", ".join([*[f"`{n}` {t}" for n, t in rows.dtypes], *[f"`v_{g}` array<double>" for g in columns]])
    return rows.mapInArrow(run, schema)


def _pooled_by_join(rows: DataFrame, columns: dict[str, str], lookups: dict[str, DataFrame]) -> DataFrame:
    out = rows
    for g, column in columns.items():
        own = K.last_items(F.split(F.coalesce(column, F.lit("")), ";"), MAX_LEN[g])
        table = lookups[g].select("segment_id", "vector")
        dims = table.agg(F.max(F.size("vector"))).first()[0] or 0
        items = rows.select("device_ifa", F.explode_outer(own).alias("segment_id")).join(table, "segment_id", "left").select("device_ifa", F.posexplode_outer("vector").alias("d", "x"))
        means = items.groupBy("device_ifa", "d").agg(F.avg("x").alias("x")).groupBy("device_ifa").agg(F.sort_array(F.collect_list(F.when(F.col("d").isNotNull(), F.struct("d", "x")))).alias("v"))
        out = out.join(means.select("device_ifa", F.when(F.size("v") > 0, F.col("v.x")).otherwise(F.array_repeat(F.lit(0.0), dims)).alias(f"v_{g}")), "device_ifa")
    return out


def bag_means(bags: DataFrame, vectors: DataFrame, dims: int) -> DataFrame:
    """(device_ifa, v): mean vector of each bag of lookup rows, 0 for an empty or null one; idx that the lookup does not
    have are left out. Each device has one row."""
    if vectors.count() > LOOKUP_ROWS:
        items = bags.select("device_ifa", F.explode_outer("idx").alias("idx")).join(vectors, "idx", "left")
        items = items.select("device_ifa", F.posexplode_outer(F.slice("vector", 1, dims)).alias("d", "x"))
        means = items.groupBy("device_ifa", "d").agg(F.avg("x").alias("x")).groupBy("device_ifa").agg(F.sort_array(F.collect_list(F.when(F.col("d").isNotNull(), F.struct("d", "x")))).alias("v"))
        return means.select("device_ifa", F.when(F.size("v") > 0, F.col("v.x")).otherwise(F.array_repeat(F.lit(0.0), dims)).alias("v"))
    held = vectors.select("idx", "vector").toPandas()
    ids = held.idx.to_numpy(np.int64)
    matrix = np.stack(held.vector.to_numpy())[:, :dims] if len(held) else np.zeros((0, dims))
    order = np.argsort(ids)
    ids, matrix = ids[order], np.append(matrix[order], np.zeros((1, dims)), axis=0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bag = b.column("idx")
            size = np.nan_to_num(pc.list_value_length(bag).to_numpy(zero_copy_only=False)).astype(np.int64)
            items = bag.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.minimum(np.searchsorted(ids, items), max(0, len(ids) - 1))
            known = ids[at] == items if len(ids) else np.zeros(len(items), bool)
            owner = np.repeat(np.arange(b.num_rows), size)[known]
            total, n = np.zeros((b.num_rows, dims)), np.bincount(owner, minlength=b.num_rows)
            np.add.at(total, owner, matrix[at[known]])
            yield pa.RecordBatch.from_arrays([b.column("device_ifa"), pa.array(list(total / np.maximum(n, 1)[:, None]), pa.list_(pa.float64()))], ["device_ifa", "v"])

    return bags.select("device_ifa", F.col("idx").cast("array<bigint>").alias("idx")).mapInArrow(run, "device_ifa string, v array<double>")


def project(rows: DataFrame, column: str, weights: list[list[float]], bias: list[float]) -> DataFrame:
    """Adds ``out``: weights times the array column, plus bias, as one native expression a dimension."""
    dot = lambda w: F.aggregate(F.zip_with(F.col(column), F.array(*map(F.lit, w)), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    return rows.withColumn("out", F.array(*[dot(w) + F.lit(b) for w, b in zip(weights, bias)]))


def dense_layers(rows: DataFrame, column: str, layers: list[tuple[np.ndarray, np.ndarray]], id_col: str = "device_ifa") -> DataFrame:
    """(device_ifa, out): a feed-forward network, ReLU between layers, an Arrow batch at a time."""

    def run(batches):
        for b in batches:
            x = np.stack(b[column].to_numpy()).astype(np.float64) if len(b) else np.zeros((0, 1))
            for i, (w, c) in enumerate(layers if len(b) else []):
                x = x @ w + c
                if i + 1 < len(layers):
                    x = np.maximum(x, 0)
            yield pd.DataFrame({id_col: b[id_col], "out": list(x)})

    return rows.select(id_col, column).mapInPandas(run, f"{id_col} string, out array<double>")
