"""Verified snapshots: data in versioned folders, and one pointer file that is put in place last.

`path/_pointers` holds a numbered file for each version, which names its folders and its schema; the highest number is the present one. A reader resolves it
once (`read_snapshot`) and then sees that version only; a publish writes new folders, counts their rows, and puts the next pointer in place by a single
rename. The version before stays for readers that have resolved it; older ones go. A failed publish leaves the pointer where it was.

A table kept by `merge_snapshot` is split by a hash of its key: a change rewrites the buckets that hold changed keys, and the new
version names the old folders of all others.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from glyphatlas.session import settle

POINTERS = "_pointers"
VERSIONS = "_versions"
BUCKETS = 64


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def _pointers(spark: SparkSession, path: str) -> list:
    """The pointer files, oldest first."""
    fs, path_of = _fs(spark, path)
    where = path_of(f"{path}/{POINTERS}")
    if not fs.exists(where):
        return []
    files = [s.getPath() for s in fs.listStatus(where)]
    return sorted((f for f in files if f.getName().endswith(".json")), key=lambda f: int(f.getName()[:-5]))


def manifest(spark: SparkSession, path: str) -> dict | None:
    """{schema, parts, before, number, and for merged tables buckets and key} of the present version, or None without a pointer."""
    for _ in range(5):
        files = _pointers(spark, path)
        if not files:
            return None
        fs, _ = _fs(spark, path)
        try:
            stream = fs.open(files[-1])
            try:
                return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
            finally:
                stream.close()
        except Exception:
            if fs.exists(files[-1]):
                raise
    raise RuntimeError(f"{path} is published faster than its pointer can be read")


def point(spark: SparkSession, path: str, now: dict) -> None:
    """Put the pointer of the next version in place, and remove what neither this version nor the one before names."""
    fs, path_of = _fs(spark, path)
    old = _pointers(spark, path)
    now = {**now, "number": int(old[-1].getName()[:-5]) + 1 if old else 0}
    staged, place = path_of(f"{path}/{POINTERS}/{uuid.uuid4().hex[:12]}.new"), path_of(f"{path}/{POINTERS}/{now['number']}.json")
    stream = fs.create(staged, True)
    stream.write(bytearray(json.dumps(now).encode()))
    stream.close()
    if fs.exists(place) or not fs.rename(staged, place):
        fs.delete(staged, True)
        raise RuntimeError(f"could not put the next pointer of {path} in place; the old version stays")
    for gone in old[:-1]:
        fs.delete(gone, False)
    named = {p.split("/")[1] for p in [*now["parts"].values(), *now["before"]]}
    for status in fs.listStatus(path_of(f"{path}/{VERSIONS}")):
        if status.getPath().getName() not in named:
            fs.delete(status.getPath(), True)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a published version, or a plain table."""
    fs, path_of = _fs(spark, path)
    if not fs.exists(path_of(path)):
        return False
    return bool(_pointers(spark, path)) or any(not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(path_of(path)))


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The version that is present now; a folder without a pointer is read as a plain table."""
    now = manifest(spark, path)
    if now is None:
        return spark.read.parquet(path)
    return _read_parts(spark, path, now, list(now["parts"].values()))


def _read_parts(spark: SparkSession, path: str, now: dict, parts: list[str]) -> DataFrame:
    schema = StructType.fromJson(json.loads(now["schema"]))
    if not parts:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/{p}" for p in parts])


def _verified(df: DataFrame, place: str, codec: str, expected: int | None, *by: str) -> int:
    """Write `df` to `place` and compare the rows read back with `expected`, or with those counted on the way; a mismatch removes them and raises."""
    spark = df.sparkSession
    fs, path_of = _fs(spark, place)
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("n"))
    counted.write.option("compression", codec).partitionBy(*by).parquet(place)
    expected = seen.get["n"] if expected is None else expected
    found = spark.read.schema(df.schema).parquet(place).count()
    if found != expected:
        fs.delete(path_of(place), True)
        raise RuntimeError(f"wrote {expected} rows but read back {found}")
    return found


def publish_snapshot(df: DataFrame, path: str, codec: str = "zstd", expected: int | None = None) -> int:
    """Publish `df` as the next version of `path`; returns the number of its rows, which are counted after writing.

    The version before stays readable, so `df` may be built from it. A mismatch removes the new files and raises. `expected` is
    the number of rows to find, if the caller knows it; without it the rows of `df` are counted while they are written.
    """
    spark = df.sparkSession
    part = f"{VERSIONS}/{uuid.uuid4().hex[:12]}"
    found = _verified(df, f"{path}/{part}", codec, expected)
    old = manifest(spark, path)
    point(spark, path, {"schema": df.schema.json(), "parts": {"": part}, "before": list(old["parts"].values()) if old else []})
    return found


def merge_snapshot(
    new: DataFrame, path: str, key: str, gone: DataFrame | None = None, buckets: int = BUCKETS, codec: str = "zstd",
) -> int:
    """Replace rows of `path` by the rows of `new` with the same `key`, and remove the keys of `gone`; returns how many buckets were rewritten.

    Only buckets that hold such keys are read and written. A plain table, or one with another key, is taken over whole.
    """
    spark = new.sparkSession
    old = manifest(spark, path)
    kept_over = old is not None and old.get("key") == key
    buckets = old["buckets"] if kept_over else buckets
    bucket = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int").alias("bucket")
    fresh = settle(new.select("*", bucket))
    keys = fresh.select(key) if gone is None else settle(fresh.select(key).unionByName(gone.select(key)).distinct())
    parts: dict[str, str] = dict(old["parts"]) if kept_over else {}
    if kept_over:
        touched = sorted(r["bucket"] for r in keys.select(bucket).distinct().collect())  # at most `buckets` numbers
        if not touched:
            return 0
        held = _read_parts(spark, path, old, [parts.pop(str(b)) for b in touched if str(b) in parts])
    else:
        touched = list(range(buckets))
        held = read_snapshot(spark, path) if exists(spark, path) else None
    rows = fresh
    if held is not None:
        rows = held.join(keys, key, "left_anti").select(*new.columns).select("*", bucket).unionByName(fresh)
    place = f"{VERSIONS}/{uuid.uuid4().hex[:12]}"
    _verified(rows.hint("rebalance", "bucket"), f"{path}/{place}", codec, None, "bucket")
    fs, path_of = _fs(spark, path)
    for b in touched:
        if fs.exists(path_of(f"{path}/{place}/bucket={b}")):
            parts[str(b)] = f"{place}/bucket={b}"
    point(spark, path, {
        "schema": new.schema.json(), "parts": parts, "before": list(old["parts"].values()) if old else [], "key": key, "buckets": buckets})
    return len(touched)


def sample_path(root: str, n: int, seed: int) -> str:
    """Place of a cached sample; its parameters are part of the name."""
    return f"{root.rstrip('/')}/n={n}/seed={seed}"


def get_or_build(spark: SparkSession, path: str, build) -> DataFrame:
    """Read a cached table, or build, publish and read it."""
    if not exists(spark, path):
        publish_snapshot(build(), path)
    return read_snapshot(spark, path)
