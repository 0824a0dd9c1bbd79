"""Table writes: schema checks, merges, versioned publish, run records.

A published table set is a directory per run plus one manifest row naming it. Readers resolve
through the newest manifest, so a set appears all at once or not at all.
"""
from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

STAMPS = ["updated_at", "loaded_at"]
MANIFEST = "run_id string, published_at timestamp, tables map<string,bigint>"
RUNS = ("run_id string, stage string, status string, started_at timestamp, finished_at timestamp, rows_in bigint, rows_out bigint, "
        "rows_rejected bigint, details string, error string")


# ------------------------------------------------------------------ schema
def schema_drift(source: T.StructType, target: T.StructType, defaults: Sequence[str] = tuple(STAMPS)) -> list[str]:
    """Problems that must stop a load: columns the target lacks, required columns the source lacks."""
    have, want = set(source.fieldNames()), {f.name: f for f in target}
    extra = [f"unknown column {c}" for c in sorted(have - set(want))]
    missing = [f"missing required column {f.name}" for f in target if not f.nullable and f.name not in have and f.name not in defaults]
    return extra + missing


def conform(source: DataFrame, target: T.StructType, defaults: Sequence[str] = tuple(STAMPS)) -> DataFrame:
    """Columns matched by name, cast to the target's types, in its order. Raises on drift."""
    problems = schema_drift(source.schema, target, defaults)
    if problems:
        raise ValueError("; ".join(problems))
    return source.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target if f.name in source.columns])


def project(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """The columns a published table has, and the helper columns that were left out."""
    return df.select(*[c for c in df.columns if c in columns]), [c for c in df.columns if c not in columns]


# ------------------------------------------------------------------ merge
def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that stand on more than one row, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def merge(target: DataFrame, source: DataFrame, mode: str, keys: Sequence[str] = (), now: Column | None = None,
          schema: T.StructType | None = None) -> DataFrame:
    """New version of `target`:

    replace - the source rows
    upsert  - source rows by key, target rows without a source row kept
    sync    - upsert without the kept rows, so the target mirrors the source

    Stamp columns the source does not bring are set to `now`. Other columns it does not bring keep
    the target's value where the key is known. `schema` says which columns are required; without it
    the target's own flags count, which a table read from files does not have. A source that repeats
    a key is refused.
    """
    if mode not in {"replace", "upsert", "sync"}:
        raise ValueError(f"unknown mode {mode}")
    if mode != "replace" and not keys:
        raise ValueError(f"mode={mode} needs keys")
    keys, schema = list(keys), schema or target.schema
    rows = conform(source, schema)
    if keys and (bad := repeated_keys(rows, keys).first()):
        raise ValueError(f"the source repeats the key {bad.asDict()}")
    now = F.current_timestamp() if now is None else now
    lacking = [f for f in schema if f.name not in rows.columns]
    if mode != "replace" and (kept := [f.name for f in lacking if f.name not in STAMPS]):
        rows = rows.join(target.select(*keys, *kept), keys, "left")
    new = rows.select(*[F.col(f.name) if f.name in rows.columns else
                        (now if f.name in STAMPS else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])
    if mode in {"replace", "sync"}:
        return new
    return target.join(new.select(*keys), keys, "left_anti").select(*new.columns).unionByName(new)


def merge_changes(target: DataFrame, source: DataFrame, keys: Sequence[str], mode: str = "sync") -> DataFrame:
    """What a merge does, as counts: inserted, updated (present on both sides), deleted."""
    s = source.select(*keys, F.lit(1).alias("_s"), F.lit(0).alias("_t"))
    t = target.select(*keys, F.lit(0).alias("_s"), F.lit(1).alias("_t"))
    both = s.unionByName(t).groupBy(*keys).agg(F.max("_s").alias("s"), F.max("_t").alias("t"))
    gone = (F.col("s") == 0) if mode == "sync" else F.lit(False)
    return both.agg(F.count_if((F.col("s") == 1) & (F.col("t") == 0)).alias("inserted"),
                    F.count_if((F.col("s") == 1) & (F.col("t") == 1)).alias("updated"), F.count_if(gone).alias("deleted"))


# ------------------------------------------------------------------ zone writes
def write_zone(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> int:
    """Overwrite a directory and return its row count, observed in the same job."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return seen.get["n"]


def publish(spark: SparkSession, tables: dict[str, DataFrame], root: str, run_id: str, now: datetime) -> dict[str, int]:
    """Write every table under `root/version=<run_id>/`, check the stored counts, then add the
    manifest row that makes the version visible. A failure before that leaves readers where they were."""
    written = {name: write_zone(df, f"{root}/version={run_id}/{name}") for name, df in tables.items()}
    stored = {name: spark.read.parquet(f"{root}/version={run_id}/{name}").count() for name in tables}
    verify_counts(written, stored)
    (spark.createDataFrame([(run_id, now, stored)], MANIFEST).coalesce(1).write.mode("append").parquet(f"{root}/_manifest_log"))
    return stored


def verify_counts(expected: dict[str, int], stored: dict[str, int], exempt: str = "") -> None:
    """Raise on any difference; tables whose name starts with `exempt` may differ (dimensions
    keep rows of earlier loads)."""
    bad = {n: (e, stored.get(n)) for n, e in expected.items() if e != stored.get(n) and not (exempt and n.startswith(exempt))}
    if bad:
        raise RuntimeError(f"stored rows differ (expected, stored): {bad}")


def count_check(expected: dict[str, DataFrame], stored: dict[str, DataFrame], exempt: str = "dim_") -> DataFrame:
    """The same comparison as a table: table, expected, stored, verdict."""
    parts = []
    for side, tables in (("expected", expected), ("stored", stored)):
        parts += [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("table"), F.lit(side).alias("side"), "n")
                  for n, df in tables.items()]
    wide = reduce(DataFrame.unionByName, parts).groupBy("table").agg(
        *[F.coalesce(F.max(F.when(F.col("side") == s, F.col("n"))), F.lit(0)).alias(s) for s in ["expected", "stored"]])
    verdict = F.when(F.col("expected") == F.col("stored"), "equal").when(F.col("table").startswith(exempt), "exempt").otherwise("differs")
    return wide.select("table", "expected", "stored", verdict.alias("verdict"))


def current_version(spark: SparkSession, root: str) -> str:
    latest = spark.read.schema(MANIFEST).parquet(f"{root}/_manifest_log").agg(F.max_by("run_id", "published_at").alias("v"))
    return latest.first()["v"]


def read_published(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/version={current_version(spark, root)}/{name}")


# ------------------------------------------------------------------ run log
def run_record(spark: SparkSession, run_id: str, stage: str, status: str, started: datetime, finished: datetime | None = None,
               rows_in: int | None = None, rows_out: int | None = None, rows_rejected: int | None = None,
               details: dict | None = None, error: str | None = None) -> DataFrame:
    row = (run_id, stage, status, started, finished, rows_in, rows_out, rows_rejected, json.dumps(details or {}, default=str),
           error[:2000] if error else None)
    return spark.createDataFrame([row], RUNS)


class RunLog:
    """Appends one row per finished stage; a stage that raises is recorded as FAILED and re-raised."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def stage(self, run_id: str, stage: str, work, clock=datetime.now):
        started = clock()
        try:
            result = work()
        except Exception as exc:
            self._add(run_record(self.spark, run_id, stage, "FAILED", started, clock(), error=f"{type(exc).__name__}: {exc}"))
            raise
        self._add(run_record(self.spark, run_id, stage, "SUCCESS", started, clock(), **(result or {})))
        return result

    def _add(self, row: DataFrame) -> None:
        row.coalesce(1).write.mode("append").parquet(self.path)

    def read(self) -> DataFrame:
        return self.spark.read.schema(RUNS).parquet(self.path)
