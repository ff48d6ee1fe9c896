"""When each citation of each page was first and last seen, whether it is visible, and
where it was removed, for all revisions at once.

Everything is local to a page: histories, revisions and instances share page_id, so one
partitioning by page serves all joins and windows here.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _as_is(df: DataFrame, *keys: str) -> DataFrame:
    return df


def at_revisions(histories: DataFrame, revisions: DataFrame) -> DataFrame:
    """Histories beside what is known of their revisions, where these are of the same page.  Rows meet by revision alone, as
    they are dealt out: of two keys in a join, Spark would deal all rows anew by both."""
    rows = histories.join(revisions.withColumnRenamed("page_id", "own_page"), "revision_id")
    return rows.where((F.col("page_id") <= F.col("own_page")) & (F.col("page_id") >= F.col("own_page"))).drop("own_page")


def next_revision(revisions: DataFrame) -> DataFrame:
    """(page_id, revision_id, next_id, next_ts): the page's next revision by id, whatever its time."""
    by_id = Window.partitionBy("page_id").orderBy("revision_id")
    return revisions.select("page_id", "revision_id", F.lead("revision_id").over(by_id).alias("next_id"), F.lead("revision_timestamp").over(by_id).alias("next_ts"))


def stats(histories: DataFrame, revisions: DataFrame, deal: Callable[..., DataFrame] = _as_is) -> DataFrame:
    """Extremes of id and of time, each on its own, and the number of revisions, by page and citation."""
    stamped = histories.join(deal(revisions.select("revision_id", "revision_timestamp"), "revision_id"), "revision_id")
    return deal(stamped, "page_id", "raw_sha1").groupBy("page_id", "raw_sha1").agg(
        F.min("revision_id").alias("first_seen_id"),
        F.min("revision_timestamp").alias("first_seen_ts"),
        F.max("revision_id").alias("last_seen_id"),
        F.max("revision_timestamp").alias("last_seen_ts"),
        F.count("*").alias("appearance_count"),
    )


def lifecycle(histories: DataFrame, revisions: DataFrame, instances: DataFrame) -> DataFrame:
    """Every citation at every revision it stands in, with what its instance says."""
    rows = life(histories.distinct(), revisions).join(instances, ["page_id", "raw_sha1"])
    first = ["page_id", "revision_id", "raw_sha1", "normalized_sha1", "reference_type", "reference_name"]
    return rows.select(*first, *LIFE)


LIFE = ("first_seen_id", "first_seen_ts", "last_seen_id", "last_seen_ts", "appearance_count", "currently_visible", "removed_at_id", "removed_at_ts")


def life(histories: DataFrame, revisions: DataFrame, deal: Callable[..., DataFrame] = _as_is) -> DataFrame:
    """Every citation at every revision it stands in; histories hold each row once.

    currently_visible: last seen in the page's last revision by id; removed_at: the next
    revision by id, where the citation does not stand in it.  ``deal`` deals out rows by
    keys to as many parts as they need."""
    page, own = Window.partitionBy("page_id"), Window.partitionBy("page_id", "raw_sha1")
    by_id = page.orderBy("revision_id")
    steps = deal(revisions, "page_id").select(
        "page_id",
        "revision_id",
        "revision_timestamp",
        F.lead("revision_id").over(by_id).alias("next_id"),
        F.lead("revision_timestamp").over(by_id).alias("next_ts"),
        F.max("revision_id").over(page).alias("last_id"),
    )
    # One shuffle by page and citation serves the extremes, and the step to the next row
    # tells whether the citation stands in the page's next revision.
    rows = deal(at_revisions(histories, deal(steps, "revision_id")), "page_id", "raw_sha1")
    again = F.lead("revision_id").over(own.orderBy("revision_id"))
    gone = F.col("next_id").isNotNull() & ~F.col("again").eqNullSafe(F.col("next_id"))
    rows = rows.select(
        "*",
        again.alias("again"),
        F.min("revision_id").over(own).alias("first_seen_id"),
        F.min("revision_timestamp").over(own).alias("first_seen_ts"),
        F.max("revision_id").over(own).alias("last_seen_id"),
        F.max("revision_timestamp").over(own).alias("last_seen_ts"),
        F.count("*").over(own).alias("appearance_count"),
    )
    return rows.select(
        "page_id",
        "revision_id",
        "raw_sha1",
        "first_seen_id",
        "first_seen_ts",
        "last_seen_id",
        "last_seen_ts",
        "appearance_count",
        (F.col("last_seen_id") == F.col("last_id")).alias("currently_visible"),
        F.when(gone, F.col("next_id")).alias("removed_at_id"),
        F.when(gone, F.col("next_ts")).alias("removed_at_ts"),
    )


def presence_intervals(histories: DataFrame, revisions: DataFrame, deal: Callable[..., DataFrame] = _as_is) -> DataFrame:
    """(page_id, raw_sha1, from_revision, to_revision, n): spans of revisions that follow each
    other by id in which a citation stands; a citation put back has a span more."""
    place = deal(revisions, "page_id").select("page_id", "revision_id", F.row_number().over(Window.partitionBy("page_id").orderBy("revision_id")).alias("place"))
    own = Window.partitionBy("page_id", "raw_sha1").orderBy("place")
    rows = deal(at_revisions(histories.distinct(), deal(place, "revision_id")), "page_id", "raw_sha1")
    island = rows.withColumn("island", F.col("place") - F.row_number().over(own))
    return (
        island.groupBy("page_id", "raw_sha1", "island")
        .agg(F.min("revision_id").alias("from_revision"), F.max("revision_id").alias("to_revision"), F.count("*").alias("n"))
        .drop("island")
    )


def as_of(revisions: DataFrame, timestamp: str) -> DataFrame:
    """Each page's latest revision at a time; of one time, the highest id."""
    latest = F.max(F.struct("revision_timestamp", "revision_id")).alias("latest")
    rows = revisions.where(F.col("revision_timestamp") <= timestamp).groupBy("page_id").agg(latest)
    return rows.select("page_id", "latest.revision_id", "latest.revision_timestamp")
