"""Content-addressed prediction artifacts and review packages as Parquet.

An artifact is its frames under recording / audio hash / task / config hash, and one manifest row, written last: without a
complete manifest the frames do not exist. A package is a folder named by the fingerprint of its content.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import PACKAGE_SCHEMA, canonical_json, config_hash, fingerprint

KEY = ["recording_id", "audio_sha256", "task", "config_hash"]
MANIFEST = "recording_id string, audio_sha256 string, task string, config_hash string, status string, n_frames long, hop_sec double, window_sec double, config string, created string"


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def manifests(spark: SparkSession, root: str) -> DataFrame:
    path = f"{root}/manifests"
    return spark.read.schema(MANIFEST).parquet(path) if _exists(spark, path) else spark.createDataFrame([], MANIFEST)


def write_artifact(frames: DataFrame, root: str, key: dict[str, str], config: dict, hop: float, window: float) -> str:
    """Write frames, check their count, then the manifest. Returns the config hash. Rewriting a key replaces its partition."""
    spark = frames.sparkSession
    key = key | {"config_hash": config_hash(config)}
    rows = frames.select(*[F.lit(key[k]).alias(k) for k in KEY], *[c for c in frames.columns if c not in KEY])
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*KEY).parquet(f"{root}/frames")
    want, n = frames.count(), spark.read.parquet(f"{root}/frames").filter(_is(key)).count()
    if n != want:
        raise ValueError(f"{n} of {want} frames were written")
    manifest = spark.createDataFrame([tuple(key[k] for k in KEY) + ("complete", n, float(hop), float(window), canonical_json(config), None)], MANIFEST).withColumn("created", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    manifest.write.mode("append").parquet(f"{root}/manifests")
    return key["config_hash"]


def _is(key: dict[str, str]):
    cond = F.lit(True)
    for k in KEY:
        cond = cond & (F.col(k) == key[k])
    return cond


def list_artifacts(spark: SparkSession, root: str, **wanted: str) -> DataFrame:
    """Complete manifests, the last per key, filtered by any of the key's fields, in order."""
    return latest_manifests(manifests(spark, root), **wanted)


def latest_manifests(rows: DataFrame, **wanted: str) -> DataFrame:
    rows = rows.filter("status = 'complete'")
    for k, v in wanted.items():
        rows = rows.filter(F.col(k) == v)
    last = rows.groupBy(*KEY).agg(F.max(F.struct("created", "n_frames")).alias("_last"))
    return last.select(*KEY, F.col("_last.n_frames").alias("n_frames")).orderBy(*KEY)


def find_artifact(spark: SparkSession, root: str, key: dict[str, str]) -> DataFrame | None:
    """Frames of an exact key, or None; partition pruning reads nothing else."""
    if manifests(spark, root).filter((F.col("status") == "complete") & _is(key)).isEmpty():
        return None
    return spark.read.parquet(f"{root}/frames").filter(_is(key))


def missing_work(wanted: DataFrame, done: DataFrame) -> DataFrame:
    """Keys that have no complete manifest."""
    return wanted.join(done.filter("status = 'complete'").select(*KEY).distinct(), KEY, "left_anti")


def write_package(spark: SparkSession, root: str, payload: dict, events: DataFrame, tracks: DataFrame | None = None) -> str:
    """Write a package once: equal content has an equal id, and an existing one is only completed. Returns its id."""
    payload = {"schema": PACKAGE_SCHEMA} | payload
    mark = fingerprint(payload | {"events": content_hash(events)})
    package_id = mark[:24]
    path = f"{root}/{package_id}"
    if not _exists(spark, f"{path}/package"):
        body = canonical_json(payload | {"package_id": package_id, "package_fingerprint": mark})
        spark.createDataFrame([(package_id, mark, body)], "package_id string, package_fingerprint string, body string").write.mode("overwrite").parquet(f"{path}/package")
    for name, df in (("events", events), ("tracks", tracks)):
        if df is not None and not _exists(spark, f"{path}/{name}/_SUCCESS"):
            df.write.mode("overwrite").parquet(f"{path}/{name}")
    return package_id


def content_hash(rows: DataFrame) -> str:
    """A hash of a table's rows in any order: the sum of their hashes' leading 15 hex digits, and their number. Nothing is collected but one row."""
    one = F.conv(F.substring(F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(rows.columns)])), 256), 1, 15), 16, 10).cast("decimal(38,0)")
    total, n = rows.agg(F.sum(one).alias("total"), F.count(F.lit(1)).alias("n")).first()
    return f"{total or 0}:{n}"


def load_package(spark: SparkSession, root: str, package_id: str) -> tuple[dict, DataFrame]:
    """Body and events; an unknown schema, or content that does not match the fingerprint, is an error."""
    row = spark.read.parquet(f"{root}/{package_id}/package").first()
    if row is None:
        raise ValueError(f"package {package_id} is broken")
    body, events = json.loads(row.body), spark.read.parquet(f"{root}/{package_id}/events")
    if body.get("schema") != PACKAGE_SCHEMA:
        raise ValueError(f"unsupported package schema {body.get('schema')!r}")
    if fingerprint(body | {"events": content_hash(events)}) != row.package_fingerprint:
        raise ValueError(f"package {package_id} does not match its fingerprint")
    return body, events
