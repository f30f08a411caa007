"""Change detection, upserts and resumable work, all as equi-joins on a key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphatlas.functions.predicates import any_null
from glyphatlas.vocab import LEGACY_TEXT_VERSION


def changed(discovered: DataFrame, cache: DataFrame, key: str = "path", version=("mtime", "size")) -> DataFrame:
    """Discovered rows that are new or whose version columns differ from the cached ones."""
    return discovered.join(cache.select(key, *version), [key, *version], "left_anti")


def purge_missing(cache: DataFrame, discovered: DataFrame, key: str = "path") -> DataFrame:
    """Cached rows whose key still exists."""
    return cache.join(discovered.select(key), key, "left_semi")


def upsert(old: DataFrame, new: DataFrame, key: str = "path") -> DataFrame:
    """New rows replace old rows with the same key."""
    return old.join(new.select(key), key, "left_anti").unionByName(new)


def pending(df: DataFrame, cache: DataFrame, key: str = "id", version_col: str | None = None, version=None) -> DataFrame:
    """Rows without a cached result; a cached result counts only with the current version."""
    return df.join(_current(cache, version_col, version).select(key), key, "left_anti")


def _current(cache: DataFrame, version_col: str | None, version) -> DataFrame:
    if version_col is None:
        return cache
    return cache.where(F.coalesce(version_col, F.lit(LEGACY_TEXT_VERSION)) == F.lit(version))


def restitch(df: DataFrame, cached: DataFrame, new: DataFrame, key: str = "id") -> DataFrame:
    """Cached and new results for exactly the keys of `df`; a new result wins over a cached one."""
    return upsert(cached, new, key).join(df.select(key), key, "left_semi")


def needs_work(df: DataFrame, cols: tuple[str, ...]) -> DataFrame:
    return df.where(any_null(cols))


def reuse_complete(df: DataFrame, cache: DataFrame, cols: tuple[str, ...], key: str = "id") -> DataFrame:
    """Fill `cols` of `df` from cached rows that have all of them; other rows keep what they hold."""
    full = cache.dropna(subset=list(cols)).select(key, *[F.col(c).alias(f"_{c}") for c in cols])
    joined = df.join(full, key, "left")
    hit = F.col(f"_{cols[0]}").isNotNull()
    own = lambda c: F.col(c) if c in df.columns else F.lit(None).cast("string")
    rest = [c for c in df.columns if c not in cols]
    return joined.select(*rest, *[F.when(hit, F.col(f"_{c}")).otherwise(own(c)).alias(c) for c in cols])
