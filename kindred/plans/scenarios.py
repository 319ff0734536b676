"""The runs from end to end: a pool with its encoder, and candidates for one or several seed lists.

``python -m kindred.plans.scenarios pool|seeds|compare CONFIG.json [--until STAGE] [--status] [--dry-run] [--explain] [--force]``

A stage that was made with other settings or inputs than a run has now is made again, and so is what follows from it. A
pool is not: encoders and other runs stand on it, so that other settings are refused.
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import cached_property, reduce
from uuid import uuid4

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred import functions as K
from kindred import sources
from kindred.operators import features, labels, models, populations, selection
from kindred.plans import runs
from kindred.plans.latest import update_latest
from kindred.sources.files import facts, files_mark, latest_partition, mark_of, partitions
from kindred.sources.tables import cut

POOL_STAGES = ("pool", "train", "encode")
SEED_STAGES = ("seed", "candidate", "encode", "train", "score", "lists", "overlap", "publish")
#: Dimensions that each group's vectors are projected to.
PROJECT = {"residence": 32, "product": 16, "content": 16, "etc": 16}
BAGS = {"residence": "residence_ids", "product": "product_interest_ids", "content": "content_interest_ids", "etc": "etc_segment_ids"}


#: What classes of an unbalanced label are compared with.
IMBALANCE = {"posweight": {"mode": "posweight"}, "sampler": {"mode": "sampler"}, "undersample": {"mode": "undersample"}, "none": {"mode": "none"}}


@dataclass
class Inputs:
    """The tables that runs read: a log of events, segment snapshots, an ID crosswalk, and segments with their groups
    and path texts (segment_id, feature_group, path). ``paths`` has where they lie, by name, as far as they are files;
    ``latest_at`` a folder for the latest snapshot of each device, which is carried on from run to run."""

    log: DataFrame
    snapshots: DataFrame
    crosswalk: DataFrame
    taxonomy: DataFrame
    provider: Callable[[list[str]], np.ndarray] | Callable[[DataFrame], DataFrame] = field(default_factory=features.hashed_vectors)
    paths: dict[str, list[str]] = field(default_factory=dict)
    latest_at: str | None = None

    def ids(self) -> dict[str, list[str]]:
        """The taxonomy's IDs by group; a table of segments is small."""
        held: dict[str, list[str]] = {g: [] for g in features.GROUPS}
        for r in self.taxonomy.select("feature_group", "segment_id").orderBy("segment_id").collect():
            held[r.feature_group].append(r.segment_id)
        return held

    @cached_property
    def latest(self) -> DataFrame:
        """(device_ifa, segments): built when first asked for and written, once for all populations of a run, or the table
        that is carried on."""
        if self.latest_at and "snapshots" in self.paths:
            return update_latest(self.snapshots.sparkSession, self.paths["snapshots"][0], self.latest_at).drop("seen")
        return cut(populations.latest_segments(self.snapshots), "latest")

    def files(self, *names: str, spans: list[tuple[str, str]] | None = None) -> dict[str, list[str]]:
        """Paths of inputs by name, of the log only the partitions of ``spans``."""
        out = {n: self.paths[n] for n in names if n in self.paths}
        if spans is not None and "log" in out:
            spark = self.log.sparkSession
            out["log"] = sorted(r.path for p in out["log"] for r in partitions(spark, p).where(K.periods(spans)).collect())
        return {n: p for n, p in out.items() if p}

    def marks(self, files: dict[str, list[str]]) -> dict[str, str]:
        """What the files are at present; seed lists by their contents."""
        return {n: files_mark(facts(self.log.sparkSession, p, hashed=n.startswith("seeds"))) for n, p in files.items()}


def encoder_inputs(rows: DataFrame, lookups: dict[str, DataFrame], vocabulary: DataFrame) -> DataFrame:
    """(device_ifa, gender, age, v_<group>) of segment features, for the autoencoder: one pass over the rows pools all
    groups, each by its own lookup, and nothing is shuffled."""
    rows = features.encode_tokens(rows.withColumn("token", K.first_id(F.col("age_bracket_ids"))), "token", vocabulary)
    plain = rows.select("device_ifa", F.col("gender_score").alias("gender"), F.col("idx").alias("age"), *BAGS.values())
    return features.pool_groups(plain, BAGS, lookups).drop(*BAGS.values())


class Scenario:
    """Stages of one folder, each made once; ``until`` names the last to be made."""

    def __init__(self, spark: SparkSession, layout: runs.Layout, root: str, stages: tuple[str, ...], force: bool = False) -> None:
        self.spark, self.layout, self.root, self.stages, self.force = spark, layout, root, stages, force

    def status(self) -> dict[str, bool]:
        return {s: runs.made(self.spark, f"{self.root}/{s}") for s in self.stages}

    def make(self, name: str, build: Callable[[], DataFrame], after: tuple[str, ...] = (), inputs: dict[str, str] | None = None, files: dict[str, list[str]] | None = None, refuse: bool = False, **params: object) -> DataFrame:
        """A stage, which depends on its parameters, on ``inputs`` (marks) and on the rows of the stages ``after``."""
        marks = {k: runs.note(self.spark, self.root, k)["mark"] for k in after}
        return runs.stage(self.spark, self.root, name, build, params, self.force, (inputs or {}) | marks, refuse, files)

    def todo(self, until: str | None) -> list[str]:
        """The stages that a run would make."""
        if until is not None and until not in self.stages:
            raise ValueError(f"one of {self.stages}, not {until}")
        last = self.stages.index(until) + 1 if until else len(self.stages)
        return [s for s, done in list(self.status().items())[:last] if self.force or not done]


class Pool(Scenario):
    """A sampled population, the autoencoder trained on it, and its devices' vectors."""

    def __init__(self, spark: SparkSession, layout: runs.Layout, pool_id: str, spec: runs.PoolSpec, inputs: Inputs, encoder: str, train: dict | None = None, max_rows: int = 0, min_freq: int = 1, force: bool = False) -> None:
        super().__init__(spark, layout, layout.pool(pool_id), POOL_STAGES, force)
        self.pool_id, self.spec, self.inputs, self.encoder, self.train, self.max_rows, self.min_freq = pool_id, spec, inputs, layout.encoder(encoder), train or {}, max_rows, min_freq

    def population(self) -> DataFrame:
        s = self.spec
        sample = K.hash_sample(F.col("device_ifa"), s.sample_percent, s.salt) if s.sample_percent else None
        log = populations.compliant(self.inputs.log, K.periods(list(s.periods)), s.region, s.android, sample)
        return features.segment_features(populations.population(log, self.inputs.latest), self.inputs.ids())

    def fit(self, rows: DataFrame) -> dict:
        """Vocabulary, lookup and model as one unit: tables of a folder of their own, which the encoder's note names once
        all are written."""
        spark, at = self.spark, f"v{uuid4().hex[:12]}"
        root = f"{self.encoder}/{at}"
        rows = labels.subsample(rows, self.max_rows)
        tokens = rows.select(K.first_id(F.col("age_bracket_ids")).alias("token"))
        marks = {}
        for name, df in (("vocabulary", features.vocabulary(tokens, min_freq=self.min_freq)), ("lookup", features.lookup(self.inputs.taxonomy, self.inputs.provider))):
            marks[name] = sources.write_rows(df, f"{root}/{name}", self.encoder)
        vocabulary, table = spark.read.parquet(f"{root}/vocabulary"), spark.read.parquet(f"{root}/lookup")
        dims = table.agg(F.max(F.size("vector"))).first()[0]
        split = labels.random_split(encoder_inputs(rows, dict.fromkeys(BAGS, table), vocabulary), 0.1)
        model = models.fit_autoencoder(split.where("split = 'train'"), split.where("split = 'val'"), PROJECT, ages=vocabulary.count() + 2, **self.train)
        digest = models.save_model(spark, model, f"{root}/model", dims=dims, pool=self.pool_id, code=runs.code_state(), train=self.train)
        note = {"at": at, "sha256": digest, "tables": marks, "structure": {"dims": dims, "ages": model.ages, "project": PROJECT, "max_len": features.MAX_LEN}}
        runs.keep(spark, f"{self.encoder}/current", note, force=True)
        return note

    def run(self, until: str | None = None) -> DataFrame:
        """The last table made."""
        self.todo(until)
        runs.keep_pool(self.spark, self.layout, self.pool_id, self.spec, self.force)
        watched = self.inputs.files("log", "snapshots", "taxonomy", spans=list(self.spec.periods))
        # what was current when a pool was made does not unmake it; its settings do
        out = self.make("pool", self.population, files=watched, refuse=True, spec=self.spec)
        if until == "pool":
            return out

        def train() -> DataFrame:
            made = self.fit(out)
            return self.spark.createDataFrame([(f"{self.encoder}/{made['at']}", made["sha256"], json.dumps(snapshot(self.inputs)))], "encoder string, sha256 string, snapshot string")

        held = self.make("train", train, after=("pool",), refuse=True, train=self.train, max_rows=self.max_rows, min_freq=self.min_freq)
        if until == "train":
            return held
        return self.make("encode", lambda: encode(self.spark, self.encoder, out), after=("pool", "train"))


def encoder_at(spark: SparkSession, encoder: str) -> str:
    """The folder of an encoder's tables: the one that its note names, or the encoder's own."""
    note = runs.held_at(spark, f"{encoder}/current")
    return f"{encoder}/{note['at']}" if note else encoder


def encode(spark: SparkSession, encoder: str, rows: DataFrame, held: DataFrame | None = None) -> DataFrame:
    """(device_ifa, z) of segment features, by a saved encoder; of devices that ``held`` does not have, if it is given.

    The lookup is projected before bags are pooled, by each group's own weights; a table that is not as its encoder's note
    has it is refused."""
    rows = rows if held is None else populations.append_new(held, rows)
    at, note = encoder_at(spark, encoder), runs.held_at(spark, f"{encoder}/current")
    table, vocabulary = spark.read.parquet(f"{at}/lookup"), spark.read.parquet(f"{at}/vocabulary")
    for name, df in (("lookup", table), ("vocabulary", vocabulary)):
        if note and mark_of(df) != note["tables"][name]:
            raise ValueError(f"{at}/{name} is not as it was written")
    lookups, model = models.folded(models.load_model(spark, f"{at}/model"), table)
    return model.encode(encoder_inputs(rows, lookups, vocabulary))


def snapshot(inputs: Inputs) -> dict | None:
    """The latest partition of the snapshots and how many there are, from their folders, for the record alone: a failure
    stops nothing."""
    try:
        return latest_partition(partitions(inputs.snapshots.sparkSession, inputs.paths["snapshots"][0])).first().asDict()
    except Exception:  # noqa: BLE001  a probe
        return None


class Seeds(Scenario):
    """Candidates for one or several seed lists: by score, for each label a share, and their union."""

    def __init__(self, spark: SparkSession, layout: runs.Layout, name: str, pool: Pool, seeds: dict[str, DataFrame], periods: list[tuple[str, str]], id_mode: str = "auto", top_percent: float = 10.0, union_target: int | None = None, fit: dict | None = None, table: str | None = None, force: bool = False, at_least: bool = False, report_percents: list[float] | None = None, model: str | None = None) -> None:
        """``seeds``: seed_id by label. ``id_mode``: auto, direct, crosswalk:uuid or crosswalk:platform_ad_id. ``table``: the
        name that results are published under, if any. ``model``: a saved classifier that scores instead of a new one."""
        stages = tuple(s for s in SEED_STAGES if (s != "publish" or table) and (s != "overlap" or len(seeds) > 1))
        super().__init__(spark, layout, layout.run(name, periods), stages, force)
        if not re_mode(id_mode):
            raise ValueError(f"auto, direct, crosswalk:uuid or crosswalk:platform_ad_id, not {id_mode}")
        self.name, self.pool, self.seeds, self.periods, self.id_mode = name, pool, seeds, periods, id_mode
        self.top_percent, self.union_target, self.fit, self.table = top_percent, union_target, fit or {}, table
        self.at_least, self.report_percents, self.model = at_least, report_percents, model

    def modes(self, latest: DataFrame) -> dict[str, str]:
        """How each list's IDs become devices: as forced, or as found for all lists in one pass."""
        if self.id_mode != "auto":
            return dict.fromkeys(self.seeds, self.id_mode)
        tagged = reduce(DataFrame.union, [s.select(F.lit(k).alias("label"), "seed_id") for k, s in self.seeds.items()])
        inputs = self.pool.inputs
        found = {r.label: r for r in populations.id_space_decision(populations.id_spaces(tagged, latest, inputs.crosswalk, inputs.log)).collect()}  # a row a list
        unclear = [k for k in self.seeds if k not in found or found[k].mode == "ambiguous"]
        if unclear:
            raise ValueError(f"the ID space of {', '.join(unclear)} is not clear; force id_mode")
        return {k: "direct" if found[k].mode == "direct" else f"crosswalk:{found[k].crosswalk_col}" for k in self.seeds}

    def resolved(self, seeds: DataFrame, mode: str) -> DataFrame:
        """(device_ifa) of a seed list."""
        if mode == "direct":
            return seeds.select(F.col("seed_id").alias("device_ifa")).distinct()
        return populations.crosswalked(seeds, self.pool.inputs.crosswalk, mode.split(":")[1])

    def run(self, until: str | None = None) -> DataFrame:
        """The last table made."""
        self.todo(until)
        spark, inputs, names = self.spark, self.pool.inputs, list(self.seeds)
        runs.refuse_overlap(spark, list(self.pool.spec.periods), self.periods)
        # vectors of another encoder would not be comparable
        digest = models.about_model(spark, f"{encoder_at(spark, self.pool.encoder)}/model")["sha256"]
        runs.keep(spark, f"{self.root}/encoder", {"sha256": digest}, self.force)
        ids = inputs.ids()

        def seed() -> DataFrame:
            latest = inputs.latest
            modes = self.modes(latest)
            parts = [self.resolved(s, modes[k]).withColumn("label", F.lit(k)) for k, s in self.seeds.items()]
            tagged = parts[0]
            for p in parts[1:]:
                tagged = tagged.unionByName(p)
            wide = tagged.groupBy("device_ifa").agg(F.sort_array(F.collect_set("label")).alias("labels"))
            return features.segment_features(latest.join(wide.select("device_ifa"), "device_ifa", "left_semi"), ids).join(wide, "device_ifa")

        watched = inputs.files(*[f"seeds {k}" for k in names], "snapshots", "crosswalk", "taxonomy")
        seeds = self.make("seed", seed, inputs=inputs.marks(watched), files=watched, id_mode=self.id_mode, labels=names)
        runs.register_seeds(self.layout, self.name, seeds)
        if until == "seed":
            return seeds

        def candidate() -> DataFrame:
            log = populations.compliant(inputs.log, K.periods(self.periods), self.pool.spec.region, self.pool.spec.android)
            return features.segment_features(populations.population(log, inputs.latest), ids)

        watched = inputs.files("log", "snapshots", "taxonomy", spans=self.periods)
        candidates = self.make("candidate", candidate, inputs=inputs.marks(watched), files=watched, periods=self.periods, pool=self.pool.spec)
        if until == "candidate":
            return candidates

        def encoded() -> DataFrame:
            both = populations.keep_first([seeds.drop("labels"), candidates], "device_ifa")
            return encode(spark, self.pool.encoder, both)

        z = self.make("encode", encoded, after=("seed", "candidate"), inputs={"encoder": digest})
        if until == "encode":
            return z

        def train() -> DataFrame:
            if self.model:
                return spark.createDataFrame([(self.model, models.about_model(spark, self.model)["sha256"], None, None)], "model string, sha256 string, val_auc double, rounds int")
            rows = self.labelled(seeds, z).withColumn("code", labels.label_code(names))
            split = labels.stratified_split(rows, "code", 0.1).drop("code")
            model = models.fit_classifier(split.where("split = 'train'"), split.where("split = 'val'"), {k: f"y_{k}" for k in names}, **({"hidden": (32,) if len(names) == 1 else (32, 32)} | self.fit))
            # a folder of its own, which counts once this stage does
            at = f"{self.root}/models/{uuid4().hex[:12]}"
            digest = models.save_model(spark, model, at, fit=self.fit)
            return spark.createDataFrame([(at, digest, model.val_auc, model.rounds)], "model string, sha256 string, val_auc double, rounds int")

        pooled = runs.note(spark, self.pool.root, "encode")
        held = self.make("train", train, after=("seed", "encode"), inputs={"pool": pooled["mark"]} if pooled else {}, fit=self.fit, model=self.model)
        if until == "train":
            return held

        def score() -> DataFrame:
            # devices that this run or any other knows as seeds are not new
            new = populations.without(z.join(candidates.select("device_ifa"), "device_ifa", "left_semi"), runs.registered_seeds(spark, self.layout).select("device_ifa"))
            # one row a device by now
            ranks = selection.ranked(models.load_model(spark, held.first().model).score(new, first_by=None), names)
            percent = self.top_percent if self.union_target is None else selection.percent_for_union(ranks, names, self.union_target, at_least=self.at_least).first().pct
            return selection.top_masks(ranks, names, percent)

        scores = self.make("score", score, after=("candidate", "encode", "train"), top_percent=self.top_percent, union_target=self.union_target, at_least=self.at_least)
        if until == "score":
            return scores

        def lists() -> DataFrame:
            """(label, device_ifa, score): each label's own list, and the union under the name of all."""
            own = [scores.where(f"in_{k} = 1").select(F.lit(k).alias("label"), "device_ifa", F.col(f"score_{k}").alias("score")) for k in names]
            whole = selection.union_output(scores, names).select(F.lit("+".join(names)), "device_ifa", F.greatest(*[F.col(f"score_{k}") for k in names], F.lit(0.0)))
            return reduce(DataFrame.union, [*own, whole])

        self.make("lists", lists, after=("score",))
        percents = self.report_percents or [self.top_percent * i / 5 for i in range(1, 6)]
        if len(names) > 1 and until != "lists":
            self.make("overlap", lambda: selection.overlaps(scores, names, percents), after=("score",), percents=percents)
        if self.table and until is None or until == "publish":
            self.make("publish", lambda: spark.createDataFrame([(self.table, sources.publish(selection.union_output(scores, names), self.table))], "table string, rows bigint"), after=("score",), table=self.table)
        return scores

    def labelled(self, seeds: DataFrame, z: DataFrame) -> DataFrame:
        """(device_ifa, z, y_<label>...): seeds by their labels, and the pool's other devices."""
        names = list(self.seeds)
        pool = populations.without(self.spark.read.parquet(f"{self.pool.root}/encode"), seeds.select("device_ifa"))
        own = z.join(seeds.select("device_ifa", "labels"), "device_ifa")
        y = [F.array_contains("labels", k).cast("int").alias(f"y_{k}") for k in names]
        return own.select("device_ifa", "z", *y).unionByName(pool.select("device_ifa", "z", *[F.lit(0).alias(f"y_{k}") for k in names]))

    def compare(self, configs: dict[str, dict] | None = None, repeats: int = 3) -> DataFrame:
        """(config, reps, mean_auc, std_auc) of ways to train on this run's vectors, a stage ``compare`` of repeats and its
        ``summary``; the run must be encoded."""
        configs = configs or IMBALANCE
        if not {"seed", "encode"} <= {k for k, made in self.status().items() if made}:
            raise ValueError(f"{self.root} is not encoded yet")
        seeds, z = (self.spark.read.parquet(f"{self.root}/{k}") for k in ("seed", "encode"))
        names = [f"y_{k}" for k in self.seeds]
        rows = self.labelled(seeds, z).withColumn("y", F.greatest(*names, F.lit(0))).select("device_ifa", "z", "y")
        self.make("compare", lambda: models.compare_imbalance(rows, "y", configs, repeats, **self.fit), after=("seed", "encode"), configs=configs, repeats=repeats, fit=self.fit)
        return self.make("summary", lambda: models.repeat_summary(self.spark.read.parquet(f"{self.root}/compare")), after=("compare",))


def re_mode(mode: str) -> bool:
    return mode in ("auto", "direct", "crosswalk:uuid", "crosswalk:platform_ad_id")


#: What gives segments their vectors, by the name that a configuration has for it.
PROVIDERS = {"hashed": features.hashed_vectors, "learned": features.learned_vectors}

DEFAULTS = {
    "root": None, "log": None, "snapshots": None, "crosswalk": None, "taxonomy": None, "taxonomy_columns": {"id": "segment_id", "group": "feature_group", "depths": ["depth1", "depth2", "depth3"], "name": "name"},
    "pool": None, "pool_spec": None, "encoder": None, "train": {}, "max_rows": 0, "min_freq": 1, "run": None, "periods": None, "seeds": {}, "id_mode": "auto", "top_percent": 10.0, "union_target": None, "at_least": False, "report_percents": None, "fit": {}, "table": None, "model": None,
    "vectors": "hashed", "latest": None, "configs": None, "repeats": 3,
}


def configured(spark: SparkSession, kind: str, config: dict, force: bool = False) -> Scenario:
    """A scenario from a configuration of DEFAULTS' keys. ``seeds`` has by label a CSV file, a folder with one, a pattern,
    a list of files, or table:column."""
    layout, columns = runs.Layout(config["root"]), config["taxonomy_columns"]
    paths = {k: [config[k]] for k in ("log", "snapshots", "crosswalk", "taxonomy")}
    seeds = {}
    for label, at in config["seeds"].items() if kind != "pool" else ():
        if isinstance(at, str) and ":" in at and "/" not in at:
            label, rows = sources.seed_table(spark, f"{label}={at}")
        else:
            found = at if isinstance(at, list) else [at] if any(c in at for c in "*?[{") else [sources.one_csv(spark, at)]
            paths[f"seeds {label}"] = found
            rows = reduce(DataFrame.union, [sources.seed_list(spark, p) for p in found])
        seeds[label] = populations.seed_source(rows, "seed_id", uuid_only=False)
    inputs = Inputs(
        sources.partitioned(spark, config["log"]), sources.partitioned(spark, config["snapshots"]), spark.read.parquet(config["crosswalk"]),
        sources.taxonomy(spark, config["taxonomy"], columns["id"], columns["group"], columns["depths"], columns["name"]), PROVIDERS[config["vectors"]](), paths=paths, latest_at=config["latest"],
    )
    spec = runs.PoolSpec(**config["pool_spec"]) if config["pool_spec"] else runs.load_pool(spark, layout, config["pool"])
    pool = Pool(spark, layout, config["pool"], spec, inputs, config["encoder"], config["train"], config["max_rows"], config["min_freq"], force and kind == "pool")
    if kind == "pool":
        return pool
    return Seeds(
        spark, layout, config["run"], pool, seeds, [tuple(p) for p in config["periods"]], config["id_mode"], config["top_percent"], config["union_target"], config["fit"], config["table"], force, config["at_least"], config["report_percents"], config["model"]
    )


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    p.add_argument("kind", choices=("pool", "seeds", "compare"))
    p.add_argument("config")
    p.add_argument("--until", metavar="STAGE", help="the last stage to make")
    p.add_argument("--status", action="store_true", help="which stages are made")
    p.add_argument("--dry-run", action="store_true", help="which stages a run would make")
    p.add_argument("--explain", action="store_true", help="the population's plan, without a run")
    p.add_argument("--force", action="store_true", help="make stages again")
    a = p.parse_args(argv)
    config, unknown = runs.settings(a.config, DEFAULTS)
    if unknown:
        print("unknown keys:", ", ".join(unknown))
    scenario = configured(SparkSession.builder.getOrCreate(), a.kind, config, a.force)
    if a.status:
        for name, done in scenario.status().items():
            print(name, "made" if done else "open")
    elif a.dry_run:
        print("would make:", ", ".join(scenario.todo(a.until)) or "nothing")
    elif a.explain:
        (scenario if isinstance(scenario, Pool) else scenario.pool).population().explain("formatted")
    elif a.kind == "compare":
        for r in scenario.compare(config["configs"], config["repeats"]).orderBy(F.desc("mean_auc")).collect():
            print(f"{r.config}: {r.mean_auc} +- {r.std_auc} over {r.reps}")
    else:
        print(scenario.run(a.until).count(), "rows")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
