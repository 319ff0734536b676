"""Runs as tables: results that are made once, what made them, and checks before a run.

A root folder holds pools, encoders, the seeds of all runs, and runs. Each result is a Parquet table, written once; beside
it lies a record, one row of a lineage table, of how it came about, and a note of what it depends on: its parameters and
the marks of its inputs, which are sums over rows or files in no order. A result counts as made only when its write was
committed and its note says what is asked for; else it is made again, or refused, and what follows from it too.
"""

from __future__ import annotations

import hashlib
import json
import re
import subprocess
import time
from collections.abc import Callable
from dataclasses import asdict, dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.functions import overlap, period, period_key
from kindred.sources import write_rows
from kindred.sources.files import facts

RECORD = "name string, status string, rows bigint, seconds double, params string, inputs array<string>, plan string, plan_sha256 string, code string, error string, mark string, changed array<string>"
FILES = "name string, path string, length bigint, modified timestamp, sha256 string"
_PART = re.compile(r"[A-Za-z0-9][A-Za-z0-9._+-]*")


@dataclass(frozen=True)
class PoolSpec:
    """What a pool is made of. None of it may change once the pool is made."""

    periods: tuple[tuple[str, str], ...]
    region: str | None = "KR"
    android: bool = True
    sample_percent: float | None = None
    salt: str = ""

    def __post_init__(self) -> None:
        object.__setattr__(self, "periods", tuple(sorted((str(a), str(b)) for a, b in self.periods)))
        for a, b in self.periods:
            period(a, b)


@dataclass(frozen=True)
class Layout:
    """Paths below a root."""

    root: str

    def at(self, *parts: str) -> str:
        for p in parts:
            if not _PART.fullmatch(p):
                raise ValueError(f"not a plain name: {p!r}")
        return "/".join([self.root.rstrip("/"), *parts])

    def pool(self, pool_id: str) -> str:
        return self.at("pools", pool_id)

    def encoder(self, name: str) -> str:
        return self.at("encoders", name)

    def run(self, name: str, periods: list[tuple[str, str]]) -> str:
        return self.at("runs", name, period_key(periods))

    @property
    def seeds(self) -> str:
        return self.at("seeds")


def settings(path: str, defaults: dict) -> tuple[dict, list[str]]:
    """A JSON file over ``defaults``, and its keys that are unknown; keys that start with _ are comments."""
    own = {k: v for k, v in json.loads(Path(path).read_text(encoding="utf-8")).items() if not k.startswith("_")}
    return defaults | {k: v for k, v in own.items() if k in defaults}, sorted(set(own) - set(defaults))


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def made(spark: SparkSession, path: str) -> bool:
    return _exists(spark, f"{path}/_SUCCESS")


def code_state(folder: str | None = None) -> str | None:
    """The commit of the code, marked if files differ from it; None outside of a repository."""
    at = folder or str(Path(__file__).parent)
    git = lambda *a: subprocess.run(["git", "-C", at, *a], capture_output=True, text=True, check=True).stdout.strip()
    try:
        return git("rev-parse", "HEAD") + ("+dirty" if git("status", "--porcelain") else "")
    except (OSError, subprocess.CalledProcessError):
        return None


def delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def depends(params: dict | None, inputs: dict[str, str] | None) -> dict[str, str]:
    """What a result depends on, by name."""
    text = lambda v: json.dumps(v, sort_keys=True, ensure_ascii=False, default=str)
    return {f"param {k}": text(v) for k, v in (params or {}).items()} | {f"input {k}": v for k, v in (inputs or {}).items()}


def note(spark: SparkSession, root: str, name: str) -> dict | None:
    """What is noted of a made stage: what it depends on, its rows and their mark."""
    return held_at(spark, f"{root.rstrip('/')}/_stages/{name}") if made(spark, f"{root.rstrip('/')}/{name}") else None


def changes(spark: SparkSession, root: str, name: str, params: dict | None, inputs: dict[str, str] | None) -> list[str] | None:
    """What a made stage depends on that is other now; None if it is not made."""
    if not made(spark, f"{root.rstrip('/')}/{name}"):
        return None
    if params is None and inputs is None:
        return []
    held, now = note(spark, root, name), depends(params, inputs)
    if held is None:  # its write was not followed by its note
        return None
    return sorted(k for k in {*held["depends"], *now} if held["depends"].get(k) != now.get(k))


def stage(
    spark: SparkSession, root: str, name: str, build: Callable[[], DataFrame], params: dict | None = None, force: bool = False, inputs: dict[str, str] | None = None, refuse: bool = False, files: dict[str, list[str]] | None = None
) -> DataFrame:
    """The table ``root``/``name``: read if it is made from the same ``params`` and ``inputs`` (marks by name), else built,
    written and recorded, also when it fails. With ``refuse`` one made from others is an error that names them. Without
    either it is taken as it is. ``files`` (paths by input, hashed if the name starts with ``seeds``) are recorded file by
    file."""
    root = root.rstrip("/")
    path, began = f"{root}/{name}", time.time()
    changed = changes(spark, root, name, params, inputs)
    if changed == [] and not force:
        return spark.read.parquet(path)
    if changed and refuse and not force:
        raise ValueError(f"{path} was made with other {', '.join(changed)}")
    status, rows, plan, error, mark = "failed", None, None, None, None
    try:
        df = build()
        plan = df._jdf.queryExecution().analyzed().toString()
        delete(spark, f"{root}/_stages/{name}")
        mark = write_rows(df, path, root)
        keep(spark, f"{root}/_stages/{name}", {"depends": depends(params, inputs), "mark": mark}, force=True)
        status, rows = "ok", int(mark.split(":")[0])
        return spark.read.parquet(path)
    except Exception as e:
        error = str(e)[:2000]
        raise
    finally:
        digest = hashlib.sha256(plan.encode()).hexdigest() if plan else None
        text = json.dumps(params or {}, sort_keys=True, ensure_ascii=False, default=str)
        sources = sorted({*(inputs or {}), *(p for x in (files or {}).values() for p in x)})
        record = (name, status, rows, time.time() - began, text, sources, plan, digest, code_state(), error, mark, changed or [])
        spark.createDataFrame([record], RECORD).coalesce(1).write.mode("append").parquet(f"{root}/_lineage")
        if status == "ok":
            for k, paths in (files or {}).items():
                facts(spark, paths, hashed=k.startswith("seeds")).select(F.lit(name).alias("name"), "path", "length", "modified", "sha256").coalesce(1).write.mode("append").parquet(f"{root}/_files")


def lineage(spark: SparkSession, root: str) -> DataFrame:
    """All records of a run."""
    return spark.read.schema(RECORD).parquet(f"{root.rstrip('/')}/_lineage")


def files(spark: SparkSession, root: str) -> DataFrame:
    """(name, path, length, modified, sha256): the input files of all stages of a run."""
    return spark.read.schema(FILES).parquet(f"{root.rstrip('/')}/_files")


def keep(spark: SparkSession, path: str, value: dict, force: bool = False) -> None:
    """Write a small document once; another one in its place is refused."""
    held = held_at(spark, path)
    if held is not None and held != json.loads(json.dumps(value)) and not force:
        changed = sorted(k for k in {*held, *value} if held.get(k) != json.loads(json.dumps(value.get(k))))
        raise ValueError(f"{path} was made with other {', '.join(changed)}")
    if held is None or force:
        spark.createDataFrame([(json.dumps(value, sort_keys=True, ensure_ascii=False),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def held_at(spark: SparkSession, path: str) -> dict | None:
    return json.loads("\n".join(r[0] for r in spark.read.text(path).collect())) if made(spark, path) else None


def keep_pool(spark: SparkSession, layout: Layout, pool_id: str, spec: PoolSpec, force: bool = False) -> None:
    """A pool keeps its spec."""
    keep(spark, f"{layout.pool(pool_id)}/spec", asdict(spec), force)


def load_pool(spark: SparkSession, layout: Layout, pool_id: str) -> PoolSpec:
    held = held_at(spark, f"{layout.pool(pool_id)}/spec")
    if held is None:
        raise ValueError(f"no pool {pool_id}")
    return PoolSpec(**held | {"periods": tuple(map(tuple, held["periods"]))})


def refuse_overlap(spark: SparkSession, pool: list[tuple[str, str]], candidates: list[tuple[str, str]]) -> None:
    """Periods (first and last day, ISO) of pool and candidates are apart."""
    a, b = (spark.createDataFrame(p, f"{n}_start string, {n}_end string") for p, n in ((pool, "a"), (candidates, "b")))
    both = a.join(F.broadcast(b), overlap(F.col("a_start"), F.col("a_end"), F.col("b_start"), F.col("b_end"))).first()  # lists of a configuration
    if both:
        raise ValueError(f"{both.a_start}..{both.a_end} of the pool meets {both.b_start}..{both.b_end} of the candidates")


def register_seeds(layout: Layout, run: str, seeds: DataFrame) -> None:
    """Keep a run's seed IDs where later runs leave them out; a run that is made again replaces its own."""
    layout.at("seeds", run)
    write_rows(seeds.select("device_ifa").distinct(), f"{layout.seeds}/run={run}", layout.root)


def registered_seeds(spark: SparkSession, layout: Layout) -> DataFrame:
    """(run, device_ifa) of all runs."""
    if not _exists(spark, layout.seeds):
        return spark.createDataFrame([], "run string, device_ifa string")
    return spark.read.option("basePath", layout.seeds).schema("device_ifa string, run string").parquet(f"{layout.seeds}/*").select("run", "device_ifa")
