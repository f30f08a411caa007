"""New tagged files as a stream that upserts into a record table.

The file source remembers paths, so it sees new files but not edits; run the batch ingest for those. Both read files, key
rows, rewrite the buckets of changed files only and set bad bytes aside in the same way, so they can serve the same table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from glyphatlas.operators.records import tagged_records
from glyphatlas.sources.snapshots import merge_snapshot
from glyphatlas.sources.tagged import stream_tagged


def ingest_stream(
    spark: SparkSession, root: str, table: str, checkpoint: str, glob: str = "*.seq", quarantine: str | None = None, max_files: int = 10_000,
) -> StreamingQuery:
    """Parse all files that arrived since the last run and merge them into `table`. Replaying a batch after a
    failure changes nothing, because rows are replaced by path. Files that are not UTF-8 are listed in
    `quarantine`, beside the table if not given."""
    aside = quarantine or f"{table}._quarantine"

    def merge(batch: DataFrame, _: int) -> None:
        merge_snapshot(tagged_records(batch.where("valid").drop("valid")), table, "path_rel")
        merge_snapshot(batch.where("NOT valid").select("path", "mtime", "size"), aside, "path", buckets=1)

    stream = stream_tagged(spark, root, glob, max_files)
    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
