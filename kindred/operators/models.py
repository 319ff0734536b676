"""Training over distributed rows: the classifiers of devices and the autoencoder of segment features.

Minibatches are cut from one order of all rows, whatever their partitions, and every epoch from another. The tasks of a
barrier stage go through an epoch's minibatches together: each sums the gradient of its own rows, the sums are added up,
and each takes the same Adam step. That is one process's training, for any partitioning, but for the rounding of sums. A
task holds its rows of one minibatch; the driver sees parameters only, and an epoch that loses an executor runs again.
Tasks find each other by the stage's allGather and then speak over sockets, as a call of allGather takes a second.

A stage of this kind needs a slot for each partition at once. ``exchange="mix"`` needs none: each partition trains by itself
from the same parameters for an epoch, and their mean, weighted by rows, starts the next; there results depend on the
partitions.
"""

from __future__ import annotations

import hashlib
import json
import math
import secrets
import socket
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark import BarrierTaskContext, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred import functions as K
from kindred.operators.features import LOOKUP_ROWS, dense_layers, fold
from kindred.operators.labels import auc, class_counts, random_places, three_way_split
from kindred.operators.populations import keep_first

Params = dict[str, np.ndarray]
#: Sums over the rows used: loss, its gradient by every parameter, and their number, given arrays by column and what
#: has ``random(shape)``.
Gradient = Callable[[Params, dict[str, np.ndarray], "np.random.Generator | Keyed"], tuple[float, Params, int]]
MODES = ("posweight", "sampler", "undersample", "none")
EXCHANGES = ("barrier", "mix")


def spread(rows: DataFrame, parts: int | None = None) -> DataFrame:
    """Rows dealt by the hash of their ID, so that each partition sees every class."""
    return rows.repartition(parts, "device_ifa") if parts else rows.repartition("device_ifa")


def _arrays(batch: pa.RecordBatch, columns: list[str]) -> dict[str, np.ndarray]:
    out = {}
    for c in columns:
        v = batch.column(c)
        if pa.types.is_list(v.type):
            out[c] = v.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(v), -1)
        else:
            out[c] = v.to_numpy(zero_copy_only=False).astype(np.float64)
    return out


def _flat(p: Params) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in sorted(p)])


def _shaped(flat: np.ndarray, like: Params) -> Params:
    out, at = {}, 0
    for k in sorted(like):
        out[k] = flat[at : at + like[k].size].reshape(like[k].shape).copy()
        at += like[k].size
    return out


@dataclass
class Adam:
    """Running moments, as flat arrays, and steps taken."""

    m: np.ndarray
    v: np.ndarray
    step: int = 0

    @staticmethod
    def new(p: Params) -> Adam:
        n = sum(x.size for x in p.values())
        return Adam(np.zeros(n), np.zeros(n))

    def moved(self, flat: np.ndarray, g: np.ndarray, rate: float) -> np.ndarray:
        self.step += 1
        self.m += 0.1 * (g - self.m)
        self.v += 0.001 * (g * g - self.v)
        return flat - rate * (self.m / (1 - 0.9**self.step)) / (np.sqrt(self.v / (1 - 0.999**self.step)) + 1e-8)


class Keyed:
    """Uniform numbers that belong to rows by their keys, so that no partitioning changes them."""

    def __init__(self, keys: np.ndarray, salt: int) -> None:
        self.keys, self.salt, self.turn = keys.astype(np.uint64), salt, 0

    def random(self, shape: int | tuple[int, int]) -> np.ndarray:
        width = shape[1] if isinstance(shape, tuple) else 1
        self.turn += 1
        other = np.random.default_rng([self.salt, self.turn]).integers(0, 1 << 63, width).astype(np.uint64)
        x = self.keys[:, None] * np.uint64(0x9E3779B97F4A7C15) + other
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        out = ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) * 2.0**-53
        return out if isinstance(shape, tuple) else out[:, 0]


def mix_round(rows: DataFrame, columns: list[str], params: Params, gradient: Gradient, batch: int = 1024, rate: float = 1e-3, seed: int = 0) -> tuple[Params, float | None]:
    """Parameters after one pass over the rows, each partition by itself, and the mean loss on the way; without rows, the
    same parameters and None."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, adam = _flat(params), Adam.new(params)
        r = np.random.default_rng([seed, TaskContext.get().partitionId()])
        n, lost = 0, 0.0
        for b in batches:
            data, order = _arrays(b, columns), r.permutation(b.num_rows)
            for at in range(0, len(order), batch):
                own = order[at : at + batch]
                loss, g, used = gradient(_shaped(flat, params), {c: x[own] for c, x in data.items()}, r)
                n, lost = n + len(own), lost + loss * len(own) / max(used, 1)
                flat = adam.moved(flat, _flat(g) / max(used, 1), rate)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([np.append(flat, lost / n)], pa.list_(pa.float64()))], ["n", "w"])

    each = rows.select(*columns).mapInArrow(run, "n bigint, w array<double>").select("n", F.posexplode("w").alias("i", "v"))
    mean = each.groupBy("i").agg((F.sum(F.col("v") * F.col("n")) / F.sum("n")).alias("v")).toPandas()  # a row a parameter
    if mean.empty:
        return params, None
    flat = mean.sort_values("i").v.to_numpy()
    return _shaped(flat[:-1], params), float(flat[-1])


# Minibatches over all partitions


class _Exchange:
    """Sums over the tasks of a barrier stage. The first task adds them up, in the order of the tasks, for all. A task that
    fails breaks the others' connections, so that the stage fails and is run again as a whole."""

    def __init__(self, context: BarrierTaskContext, seconds: float = 600) -> None:
        tasks = context.getTaskInfos()
        self.rank, self.others = context.partitionId(), []
        if len(tasks) == 1:
            return
        server = socket.create_server(("", 0), backlog=len(tasks)) if self.rank == 0 else None
        named = f"{tasks[0].address.rsplit(':', 1)[0]} {server.getsockname()[1]} {secrets.token_hex(16)}" if server else ""
        host, port, token = context.allGather(named)[0].split()
        key = bytes.fromhex(token)
        if server:
            server.settimeout(seconds)
            found = {}
            while len(found) < len(tasks) - 1:
                s, _ = server.accept()
                s.settimeout(seconds)
                s.setsockopt(socket.IPPROTO_TCP, socket.TCP_NODELAY, 1)
                hello = self._read(s, len(key) + 4)
                if hello[:-4] == key:  # one of this stage
                    found[int.from_bytes(hello[-4:], "big")] = s
            server.close()
            self.others = [found[k] for k in sorted(found)]
        else:
            s = socket.create_connection((host, int(port)), timeout=seconds)
            s.setsockopt(socket.IPPROTO_TCP, socket.TCP_NODELAY, 1)
            s.sendall(key + self.rank.to_bytes(4, "big"))
            self.others = [s]

    @staticmethod
    def _read(s: socket.socket, size: int) -> bytes:
        out = bytearray()
        while len(out) < size:
            part = s.recv(size - len(out))
            if not part:
                raise ConnectionError("another task of the stage has ended")
            out += part
        return bytes(out)

    def total(self, own: np.ndarray) -> np.ndarray:
        """The sum of all tasks' arrays, of one length, equal to the last bit in every task."""
        if self.rank == 0:
            out = own.copy()
            for s in self.others:
                out += np.frombuffer(self._read(s, own.nbytes))
            for s in self.others:
                s.sendall(out.tobytes())
            return out
        self.others[0].sendall(own.tobytes())
        return np.frombuffer(self._read(self.others[0], own.nbytes))

    def close(self) -> None:
        for s in self.others:
            s.close()


class _Steps:
    """Own rows of each minibatch in turn, of rows that come in the minibatches' order."""

    def __init__(self, batches: Iterable[pa.RecordBatch], columns: list[str]) -> None:
        self.batches, self.columns, self.rest = iter(batches), columns, None

    def take(self, step: int) -> dict[str, np.ndarray] | None:
        parts = []
        while True:
            if self.rest is None:
                b = next(self.batches, None)
                if b is None:
                    break
                if b.num_rows == 0:
                    continue
                self.rest = _arrays(b, self.columns)
            end = int(np.searchsorted(self.rest["_step"], step, "right"))
            if end:
                parts.append({c: x[:end] for c, x in self.rest.items()})
            if end < len(self.rest["_step"]):
                self.rest = {c: x[end:] for c, x in self.rest.items()}
                break
            self.rest = None
        return {c: np.concatenate([p[c] for p in parts]) for c in parts[0]} if parts else None


def sync_round(dealt: DataFrame, columns: list[str], params: Params, adam: Adam, gradient: Gradient, steps: int, rate: float = 1e-3, salt: int = 0) -> tuple[Params, Adam, float | None]:
    """Parameters and moments after ``steps`` minibatches, and the mean loss on the way.

    ``dealt`` has _step, a row's minibatch, and _key, which tells rows apart; its partitions are as many as tasks can run
    at once, or fewer."""
    if not steps:
        return params, adam, None

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, own = BarrierTaskContext.get(), _Steps(batches, ["_step", "_key", *columns])
        flat, moments = _flat(params), Adam(adam.m.copy(), adam.v.copy(), adam.step)
        n, lost, exchange = 0, 0.0, _Exchange(context)
        try:
            for step in range(steps):
                held = own.take(step)
                sums = np.zeros(len(flat) + 2)
                if held is not None:
                    loss, g, used = gradient(_shaped(flat, params), held, Keyed(held["_key"], salt))
                    sums = np.concatenate([_flat(g), [loss, used]])
                total = exchange.total(sums)
                if total[-1]:
                    flat = moments.moved(flat, total[:-2] / total[-1], rate)
                n, lost = n + total[-1], lost + total[-2]
        finally:
            exchange.close()
        if context.partitionId() == 0:
            out = np.concatenate([flat, moments.m, moments.v, [moments.step, lost / max(n, 1)]])
            yield pa.RecordBatch.from_arrays([pa.array([out], pa.list_(pa.float64()))], ["w"])

    w = np.array(dealt.sortWithinPartitions("_step", "_key").select("_step", "_key", *columns).mapInArrow(run, "w array<double>", barrier=True).collect()[0][0])  # one row
    k = (len(w) - 2) // 3
    return _shaped(w[:k], params), Adam(w[k : 2 * k], w[2 * k : 3 * k], int(w[-2])), float(w[-1])


def turned(n: int, seed: list[int]) -> tuple[int, int]:
    """a and c of the order x -> (a x + c) mod n of 0..n-1, which are in a random order already; a x keeps within 63 bits
    up to 2**33 rows."""
    r = np.random.default_rng(seed)
    while True:
        a = int(r.integers(1, max(2, min(n, 1 << 30))))
        if math.gcd(a, n) == 1:
            return a, int(r.integers(0, max(1, n)))


def _turn(x: Column, n: int, seed: list[int]) -> Column:
    a, c = turned(n, seed)
    return F.pmod(x * F.lit(a) + F.lit(c), F.lit(n))


class Minibatches:
    """Rows with their places in a fixed random order of their class, from which each epoch's minibatches are cut."""

    def __init__(self, rows: DataFrame, positive: Column, batch: int, mode: str = "none", ratio: float = 20, seed: int = 42, parts: int | None = None) -> None:
        spark = rows.sparkSession
        self.batch, self.mode, self.ratio, self.seed = batch, mode, ratio, seed
        self.parts = min(parts or spark.sparkContext.defaultParallelism, spark.sparkContext.defaultParallelism)
        placed = random_places(rows.withColumn("_pos", positive.cast("int")), seed, ["_pos"]).withColumn("_at", F.col("rn").cast("bigint") - 1).drop("rn")
        self.rows = spread(placed, self.parts).persist()
        sizes = {r._pos: r.n for r in self.rows.groupBy("_pos").agg(F.count("*").alias("n")).collect()}
        self.pos, self.neg = sizes.get(1, 0), sizes.get(0, 0)

    def unpersist(self) -> None:
        self.rows.unpersist()

    def epoch(self, turn: int) -> tuple[DataFrame, int]:
        """The rows of an epoch with _step and _key, and how many minibatches there are.

        Undersampled, the negatives that are used change with the epoch. Sampled, as many rows as there are come, each of
        either class as likely, with replacement. Else each row comes once."""
        if self.mode == "sampler" and self.pos and self.neg:
            return self._drawn(turn)
        most = min(self.neg, int(self.pos * self.ratio)) if self.mode == "undersample" else self.neg
        total = self.pos + most
        if not total:
            return self.rows.withColumns({"_step": F.lit(0), "_key": F.lit(0)}), 0
        at = F.when(F.col("_pos") == 1, F.col("_at")).otherwise(self.pos + (_turn(F.col("_at"), self.neg, [self.seed, turn, 1]) if self.neg else F.col("_at")))
        key = _turn(F.col("_key"), total, [self.seed, turn, 2])
        dealt = self.rows.withColumn("_key", at).where(F.col("_key") < total).withColumn("_key", key)
        return dealt.withColumn("_step", F.floor(F.col("_key") / self.batch)), -(-total // self.batch)

    def _drawn(self, turn: int) -> tuple[DataFrame, int]:
        total, base = self.pos + self.neg, self.seed * 1_000_003 + turn
        slots = self.rows.sparkSession.range(total).select(F.col("id").alias("_key"), F.pmod(F.xxhash64("id", F.lit(base)), F.lit(2)).cast("int").alias("_pos"), F.xxhash64("id", F.lit(-base)).alias("_h"))
        both = []
        for c, n in ((0, self.neg), (1, self.pos)):
            side = self.rows.where(F.col("_pos") == c).drop("_pos")
            own = slots.where(F.col("_pos") == c).select("_key", F.pmod("_h", F.lit(n)).alias("_at"))
            both.append(own.join(F.broadcast(side) if n <= LOOKUP_ROWS else side, "_at"))  # a rare class is drawn often
        dealt = both[0].unionByName(both[1]).repartition(self.parts, "_key")
        return dealt.withColumn("_step", F.floor(F.col("_key") / self.batch)), -(-total // self.batch)


# Classifiers


@dataclass
class Classifier:
    """Dense layers with ReLU between, a sigmoid for each label at the end."""

    params: Params
    labels: list[str]
    val_auc: float | None = None
    rounds: int = 0

    def layers(self) -> list[tuple[np.ndarray, np.ndarray]]:
        return [(self.params[f"w{i}"], self.params[f"b{i}"]) for i in range(len(self.params) // 2)]

    def score(self, rows: DataFrame, column: str = "z", first_by: str | None = "z") -> DataFrame:
        """(device_ifa, score_<label>...), one row a device: of rows that repeat it the first in the order ``first_by``.
        None leaves that out, for rows that are one a device already."""
        if first_by is not None:
            rows = keep_first([rows], first_by)
        out = dense_layers(rows, column, self.layers())
        return out.select("device_ifa", *[K.sigmoid(F.col("out")[i]).alias(f"score_{k}") for i, k in enumerate(self.labels)])


def _dense(sizes: list[int], r: np.random.Generator) -> Params:
    p = {}
    for i, (a, b) in enumerate(zip(sizes, sizes[1:])):
        p[f"w{i}"], p[f"b{i}"] = r.uniform(-1, 1, (a, b)) / np.sqrt(a), r.uniform(-1, 1, b) / np.sqrt(a)
    return p


def _classifier_gradient(columns: list[str], pos_weight: np.ndarray, mode: str, ratio: float, dropout: float, dealt: bool = False) -> Gradient:
    """``dealt`` rows were chosen already as the mode says."""

    def run(p: Params, data: dict[str, np.ndarray], r: np.random.Generator | Keyed) -> tuple[float, Params, int]:
        x, y = data["z"], np.stack([data[c] for c in columns], axis=1)
        pos = y.any(axis=1)
        keep = slice(None)
        if mode == "undersample" and not dealt:  # all positives, and of the negatives ``ratio`` for each on average
            keep = pos | (r.random(len(y)) < ratio / max(float(pos_weight.max()), 1e-12))
        elif mode == "sampler" and not dealt and pos.any() and not pos.all():  # with replacement, each class as often
            odds = np.where(pos, 0.5 / pos.sum(), 0.5 / (~pos).sum())
            keep = r.choice(len(y), len(y), p=odds)
        x, y = x[keep], y[keep]
        if not len(y):
            return 0.0, {k: np.zeros_like(v) for k, v in p.items()}, 0
        # the negatives left out count as the weight of positives does elsewhere
        weight = 1 + ({"posweight": pos_weight, "undersample": ratio}.get(mode, 1) - 1) * y
        last = len(p) // 2 - 1
        held, scale = [x], [1.0] * (last + 1)
        for i in range(last + 1):
            h = held[-1] @ p[f"w{i}"] + p[f"b{i}"]
            if i < last:
                h = np.maximum(h, 0)
            if i == last - 1 and dropout:
                scale[i] = 1 / (1 - dropout)
                h = h * (r.random(h.shape) >= dropout) * scale[i]
            held.append(h)
        logit = held.pop()
        loss = float((weight * (np.logaddexp(0, logit) - y * logit)).mean(axis=1).sum())
        d, g = weight * (1 / (1 + np.exp(-np.clip(logit, -60, 60))) - y) / y.shape[1], {}
        for i in range(last, -1, -1):
            g[f"w{i}"], g[f"b{i}"] = held[i].T @ d, d.sum(axis=0)
            if i:
                d = (d @ p[f"w{i}"].T) * (held[i] > 0) * scale[i - 1]
        return loss, g, len(y)

    return run


def fit_classifier(
    rows: DataFrame, val: DataFrame, columns: dict[str, str], hidden: tuple[int, ...] = (32,), mode: str = "posweight", rounds: int = 20, patience: int = 5, ratio: float = 20, dropout: float = 0.2,
    batch: int = 1024, rate: float = 1e-3, seed: int = 42, exchange: str = "barrier", parts: int | None = None,
) -> Classifier:
    """The round of the best mean area under the curve over ``val``.

    ``columns`` maps each label to its 0/1 column; ``rows`` and ``val`` hold device_ifa, z array<double> and those. One
    label and hidden (32,) is the binary classifier, several and (32, 32) the one with a head each. Imbalance: positives
    weighted (posweight), classes drawn alike (sampler), or ``ratio`` negatives a positive, which then weighs ``ratio``
    (undersample). Rows with a null
    vector are not used, null labels count as 0. A label that ``val`` has in one class only has no area and no say;
    without any the last round counts. Without rows there are no parameters. ``parts``: at most so many tasks."""
    if mode not in MODES or exchange not in EXCHANGES:
        raise ValueError(f"one of {MODES} and {EXCHANGES}, not {mode}, {exchange}")
    names = list(columns.values())
    rows, val = (d.where("z is not null").select("device_ifa", F.col("z").cast("array<double>").alias("z"), *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in names]) for d in (rows, val))
    any_label = F.greatest(*names, F.lit(0.0)) > 0
    deal = Minibatches(rows, any_label, batch, mode, ratio, seed, parts) if exchange == "barrier" else None
    rows, val = (deal.rows if deal else spread(rows).persist()), val.persist()
    try:
        head = rows.select(F.size("z")).first()
        if head is None:
            return Classifier({}, list(columns))
        if mode == "posweight":
            weights = np.array([class_counts(rows, c).first().pos_weight for c in names])
        else:  # of rows with any label
            weights = np.array([class_counts(rows.select(any_label.cast("double").alias("label"))).first().pos_weight])
        params = _dense([head[0], *hidden, len(names)], np.random.default_rng(seed))
        step, adam = _classifier_gradient(names, weights, mode, ratio, dropout, deal is not None), Adam.new(params)
        best = last = Classifier(params, list(columns))
        for turn in range(1, rounds + 1):
            if deal:
                dealt, steps = deal.epoch(turn)
                params, adam, _ = sync_round(dealt, ["z", *names], params, adam, step, steps, rate, seed + turn)
            else:
                params, _ = mix_round(rows, ["z", *names], params, step, batch, rate, seed + turn)
            last = Classifier(params, list(columns), None, turn)
            scored = last.score(val, first_by=None).join(val.drop("z"), "device_ifa")
            areas = [a for k, c in columns.items() if (a := auc(scored, f"score_{k}", c).first().auc) is not None]
            last.val_auc = float(np.mean(areas)) if areas else None
            if last.val_auc is None:
                best = last
            elif best.val_auc is None or last.val_auc > best.val_auc:
                best = last
            elif turn - best.rounds >= patience:
                break
        return best
    finally:
        rows.unpersist()
        val.unpersist()


def compare_imbalance(rows: DataFrame, column: str, configs: dict[str, dict], repeats: int = 3, seed: int = 42, **fit: object) -> DataFrame:
    """(config, rep, auc): a classifier of each of ``configs`` (arguments of ``fit_classifier``) for each of ``repeats``
    splits into training, validation and test rows by class; the area is that of the test rows.

    A split is made once; its configurations train at the same time, each with its share of the tasks."""
    spark, out = rows.sparkSession, []
    parts = max(1, spark.sparkContext.defaultParallelism // max(1, len(configs)))
    for rep in range(repeats):
        split = three_way_split(rows.withColumn("code", F.col(column).cast("int")), "code", seed=seed + rep).drop("code").persist()
        parted = {k: split.where(F.col("split") == k).drop("split") for k in ("train", "val", "test")}
        split.count()

        def one(name: str, rep: int = rep, parted: dict[str, DataFrame] = parted) -> tuple[str, int, float | None]:
            model = fit_classifier(parted["train"], parted["val"], {"y": column}, seed=seed + rep, **({"parts": parts} | fit | configs[name]))
            scored = model.score(parted["test"], first_by=None).join(parted["test"].drop("z"), "device_ifa")
            return name, rep, auc(scored, "score_y", column).first().auc

        with ThreadPoolExecutor(max(1, len(configs))) as pool:
            out += list(pool.map(one, configs))
        split.unpersist()
    return spark.createDataFrame(out, "config string, rep int, auc double")


def repeat_summary(results: DataFrame, config: str = "config", value: str = "auc") -> DataFrame:
    """(config, reps, mean_auc, std_auc) over repeats, the deviation that of the repeats themselves."""
    return results.groupBy(F.col(config).alias("config")).agg(F.count(value).alias("reps"), F.round(F.avg(value), 6).alias("mean_auc"), F.round(F.stddev_pop(value), 6).alias("std_auc"))


# Models as tables


def save_model(spark: SparkSession, model: Classifier | Autoencoder, path: str, **about: object) -> str:
    """Write a model as a table, a row a parameter, and return the hash that names it. ``about`` is kept with it."""
    params = sorted(model.params.items())
    digest = hashlib.sha256(b"".join(k.encode() + repr(v.shape).encode() + np.ascontiguousarray(v, np.float64).tobytes() for k, v in params)).hexdigest()
    kind = type(model).__name__
    spec = {f.name: getattr(model, f.name) for f in fields(model) if f.name != "params"} | {"about": about, "sha256": digest}
    rows = [(k, list(v.shape), v.astype(np.float64).ravel().tolist(), None) for k, v in params] + [(kind, [], [], json.dumps(spec, sort_keys=True))]
    spark.createDataFrame(rows, "name string, shape array<int>, value array<double>, spec string").coalesce(1).write.mode("errorifexists").parquet(path)
    return digest


def load_model(spark: SparkSession, path: str) -> Classifier | Autoencoder:
    """The model that ``save_model`` wrote; a table that was changed since is refused."""
    return _load(spark, path)[0]


def about_model(spark: SparkSession, path: str) -> dict:
    """What is kept with a model, with its hash."""
    return _load(spark, path)[1]


def _load(spark: SparkSession, path: str) -> tuple[Classifier | Autoencoder, dict]:
    rows = spark.read.parquet(path).collect()  # a row a parameter
    head = next(r for r in rows if r.spec is not None)
    spec, params = json.loads(head.spec), {r.name: np.array(r.value, np.float64).reshape(r.shape) for r in rows if r.spec is None}
    digest = hashlib.sha256(b"".join(k.encode() + repr(v.shape).encode() + v.tobytes() for k, v in sorted(params.items()))).hexdigest()
    if digest != spec["sha256"]:
        raise ValueError(f"{path} is not as it was written")
    own = {k: v for k, v in spec.items() if k not in ("about", "sha256")}
    return {"Classifier": Classifier, "Autoencoder": Autoencoder}[head.name](params, **own), spec["about"] | {"sha256": digest}


# Autoencoder


@dataclass
class Autoencoder:
    """A device's gender score, age token and pooled vectors to z. Age tokens have vectors, 0 (none) the zero vector; each
    group's pooled vector is projected; ReLU hidden layers stand on both sides of z."""

    params: Params
    groups: list[str]
    ages: int
    val_loss: float | None = None
    rounds: int = 0

    def encode(self, rows: DataFrame) -> DataFrame:
        """(device_ifa, z array<float>) of rows with device_ifa, gender, age and v_<group>."""
        p, groups, columns = self.params, self.groups, ["gender", "age", *[f"v_{g}" for g in self.groups]]

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    z = _encoded(p, groups, _arrays(b, columns))["z"].astype(np.float32)
                    yield pa.RecordBatch.from_arrays([b.column("device_ifa"), pa.array(list(z), pa.list_(pa.float32()))], ["device_ifa", "z"])

        return _inputs(rows, self.groups).mapInArrow(run, "device_ifa string, z array<float>")


def folded(model: Autoencoder, table: DataFrame) -> tuple[dict[str, DataFrame], Autoencoder]:
    """The lookup of each group with its vectors projected already, and the encoder that takes such bags: a mean of
    projections is the projection of the mean. The shift is added after pooling, for empty bags too."""
    lookups = {g: fold(table, model.params[f"project_{g}"]) for g in model.groups}
    own = {f"project_{g}": np.eye(model.params[f"project_{g}"].shape[1]) for g in model.groups}
    return lookups, Autoencoder(model.params | own, model.groups, model.ages, model.val_loss, model.rounds)


def _inputs(rows: DataFrame, groups: list[str]) -> DataFrame:
    """Null scores are 0, null ages the token of none."""
    return rows.select("device_ifa", F.coalesce(F.col("gender").cast("double"), F.lit(0.0)).alias("gender"), F.coalesce(F.col("age").cast("int"), F.lit(0)).alias("age"), *[F.col(f"v_{g}").cast("array<double>").alias(f"v_{g}") for g in groups])


def _encoded(p: Params, groups: list[str], data: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    age = data["age"].astype(np.int64)
    out = {f"v_{g}": data[f"v_{g}"] @ p[f"project_{g}"] + p[f"shift_{g}"] for g in groups}
    x = np.concatenate([data["gender"][:, None], p["age"][age] * (age > 0)[:, None], *out.values()], axis=1)
    h = np.maximum(x @ p["w0"] + p["b0"], 0)
    return out | {"x": x, "h": h, "z": h @ p["w1"] + p["b1"]}


def _autoencoder_gradient(groups: list[str]) -> Gradient:
    """Squared error of gender and of each group's projection, which is a fixed target, and cross-entropy of age."""

    def run(p: Params, data: dict[str, np.ndarray], r: np.random.Generator | Keyed) -> tuple[float, Params, int]:
        n, age = len(data["gender"]), data["age"].astype(np.int64)
        e = _encoded(p, groups, data)
        t = np.maximum(e["z"] @ p["w2"] + p["b2"], 0)
        out = t @ p["w3"] + p["b3"]
        ages = p["age"].shape[0]
        logit = out[:, 1 : 1 + ages] - out[:, 1 : 1 + ages].max(axis=1, keepdims=True)
        chance = np.exp(logit) / np.exp(logit).sum(axis=1, keepdims=True)
        off = out[:, 0] - data["gender"]
        loss = float((off**2).sum() - np.log(chance[np.arange(n), age] + 1e-300).sum())
        d = np.zeros_like(out)
        d[:, 0] = 2 * off
        chance[np.arange(n), age] -= 1
        d[:, 1 : 1 + ages] = chance
        at = 1 + ages
        for g in groups:
            k = e[f"v_{g}"].shape[1]
            miss = out[:, at : at + k] - e[f"v_{g}"]
            loss += float((miss**2).sum()) / k
            d[:, at : at + k] = 2 * miss / k
            at += k
        grad, held = {}, (e["x"], e["h"], e["z"], t)
        for i in (3, 2, 1, 0):
            grad[f"w{i}"], grad[f"b{i}"] = held[i].T @ d, d.sum(axis=0)
            d = d @ p[f"w{i}"].T
            if i in (3, 1):  # what a ReLU gave
                d *= held[i] > 0
        at = 1 + p["age"].shape[1]
        grad["age"] = np.zeros_like(p["age"])
        np.add.at(grad["age"], age, d[:, 1:at] * (age > 0)[:, None])
        for g in groups:
            k = e[f"v_{g}"].shape[1]
            grad[f"project_{g}"], grad[f"shift_{g}"] = data[f"v_{g}"].T @ d[:, at : at + k], d[:, at : at + k].sum(axis=0)
            at += k
        return loss, grad, n

    return run


def fit_autoencoder(
    rows: DataFrame, val: DataFrame, project: dict[str, int], ages: int, age_dims: int = 8, hidden: int = 64, dims: int = 32, rounds: int = 30, patience: int = 5, batch: int = 512, rate: float = 1e-3, seed: int = 42,
    exchange: str = "barrier", parts: int | None = None,
) -> Autoencoder:
    """The round of the least loss over ``val``.

    ``rows`` and ``val`` hold device_ifa, gender, age (a token below ``ages``) and v_<group>, the pooled vector of each
    group of ``project``, which gives its projection's dimensions. Vectors are pooled by ``features.pool_groups`` and stay
    as they are. Rows with a null vector are not used; without rows or ``val`` rows, the last round counts."""
    if exchange not in EXCHANGES:
        raise ValueError(f"one of {EXCHANGES}, not {exchange}")
    groups, ready = list(project), " and ".join(f"v_{g} is not null" for g in project) or "true"
    rows, val = _inputs(rows, groups).where(ready), _inputs(val, groups).where(ready).persist()
    deal = Minibatches(rows, F.lit(0), batch, seed=seed, parts=parts) if exchange == "barrier" else None
    rows = deal.rows if deal else spread(rows).persist()
    columns = ["gender", "age", *[f"v_{g}" for g in groups]]
    try:
        head = rows.select(*[F.size(f"v_{g}") for g in groups], F.lit(0)).first()
        if head is None:
            return Autoencoder({}, groups, ages)
        r = np.random.default_rng(seed)
        params = {"age": r.normal(0, 1, (ages, age_dims))} | _dense([1 + age_dims + sum(project.values()), hidden, dims, hidden, 1 + ages + sum(project.values())], r)
        for g, size in zip(groups, head):
            params[f"project_{g}"], params[f"shift_{g}"] = r.uniform(-1, 1, (size, project[g])) / np.sqrt(size), np.zeros(project[g])
        step, adam = _autoencoder_gradient(groups), Adam.new(params)
        best = None
        for turn in range(1, rounds + 1):
            if deal:
                dealt, steps = deal.epoch(turn)
                params, adam, _ = sync_round(dealt, columns, params, adam, step, steps, rate, seed + turn)
            else:
                params, _ = mix_round(rows, columns, params, step, batch, rate, seed + turn)
            _, loss = mix_round(val, columns, params, step, batch, 0.0, seed)
            last = Autoencoder(params, groups, ages, loss, turn)
            if best is None or loss is None or loss < best.val_loss:
                best = last
            elif turn - best.rounds >= patience:
                break
        return best or Autoencoder(params, groups, ages)
    finally:
        rows.unpersist()
        val.unpersist()
