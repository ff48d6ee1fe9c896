"""Incremental ingest of bundles and of staged rows, as streams that end when all is read.

The checkpoint holds which files are done, so a run that fails is tried again from its
last batch; a batch writes to a place of its own, so a second try replaces the first.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.derive import DEFAULT_DOMAIN
from ..operators.upsert import changes, upsert
from ..plans.build import Loader, dedup, stage
from ..schemas import STAGED
from ..sources.bundle import SUFFIX, read_bundles
from ..sources.storage import append_table, cut, read_table, replace_table


def ingest_bundles(spark: SparkSession, folder: str, work: str, domain: str = DEFAULT_DOMAIN, files_a_batch: int = 64, load: bool = True, suffix: str = SUFFIX) -> StreamingQuery:
    """Stage every bundle of ``folder`` that has not been staged yet, and load what is new.

    Files are found as a stream; a batch parses its files whole, so that a file's
    lines keep their order."""
    names = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("pathGlobFilter", f"*{suffix}")
        .option("maxFilesPerTrigger", files_a_batch)
        .load(folder)
        .select("path")
    )

    def batch(df: DataFrame, number: int) -> None:
        # As many names as a batch may have files.
        paths = [r["path"] for r in df.collect()]
        if not paths:
            return
        revisions = read_bundles(spark, paths, suffix)
        source = f"{work}/batches/{number}"
        stage(spark, revisions.drop("source_file"), source, domain, f"batch{number}")
        dedup(spark, source, f"{work}/deduped/{number}")
        if load:
            Loader(spark, f"{work}/deduped/{number}", f"{work}/served").load()

    return _run(names, batch, f"{work}/checkpoint")


def ingest_rows(spark: SparkSession, folder: str, table: str, target: str, checkpoint: str, key: list[str], policy: str) -> StreamingQuery:
    """Merge new Parquet files of staged rows into a keyed table."""
    rows = spark.readStream.schema(STAGED[table]).parquet(folder)

    def batch(df: DataFrame, number: int) -> None:
        old = read_table(spark, target, STAGED[table])
        added, changed = (cut(x, table) for x in changes(old, df, key, policy))
        if not changed.isEmpty():
            replace_table(upsert(old, added.unionByName(changed), key), target)
        elif not added.isEmpty():
            append_table(added, target)

    return _run(rows, batch, checkpoint)


def _run(rows: DataFrame, batch: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    query = rows.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
