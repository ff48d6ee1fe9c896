"""Staged tables as Parquet, and the older JSON-lines form."""

from __future__ import annotations

import contextlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..operators.upsert import COALESCE, IGNORE, REPLACE, merged
from ..schemas import STAGED
from .storage import empty, exists

ROWS_A_FILE = 1_000_000
#: Rows of a group in deduplicated tables, by table.
ROWS_A_GROUP = {
    "containers": 100_000, "domains": 100_000, "documents": 100_000, "web_resources": 500_000, "normalized_citations": 500_000,
    "citation_instances": 500_000, "citation_histories": 1_000_000, "revisions": 500_000, "ncwr": 500_000, "wiki_templates": 100_000,
    "template_data": 500_000,
}
ROWS_A_SHARD = 2_000_000


def write_staged(tables: dict[str, DataFrame], root: str, stem: str) -> None:
    """Each table to ``root/table/stem=...``: the rows of one run, in place of an earlier
    try of the same.  A table without rows leaves a folder without part files of data."""
    for name, df in tables.items():
        df.select(*STAGED[name].names).write.mode("overwrite").option("compression", "zstd").option(
            "maxRecordsPerFile", ROWS_A_FILE
        ).parquet(f"{root}/{name}/stem={stem}")


def read_staged(spark: SparkSession, root: str, table: str) -> DataFrame | None:
    """All staged rows of a table; None where there is no such folder."""
    if table not in STAGED:
        raise ValueError(f"unknown table: {table}")
    path = f"{root}/{table}"
    if not exists(spark, path):
        return None
    return spark.read.schema(STAGED[table]).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(path)


def write_deduped(df: DataFrame, root: str, table: str, block_mb: int = 128) -> None:
    """One Parquet folder a table; a row group ends at so many rows, or so many bytes if these come first."""
    options = {"compression": "zstd", "parquet.block.size": str(block_mb << 20), "parquet.block.row.count.limit": str(ROWS_A_GROUP[table])}
    df.write.mode("overwrite").options(**options).parquet(f"{root}/{table}")


def write_jsonl(df: DataFrame, path: str, rows_a_file: int = ROWS_A_SHARD, codec: str = "gzip") -> None:
    """Compressed JSON lines, rotated by rows; what JSON has no type for is written as text.
    The codec is one that Spark has; zstd needs a native library on the executors."""
    plain = [F.col(f.name).cast("string").alias(f.name) if f.dataType.typeName() in ("binary", "timestamp", "date", "decimal") else F.col(f.name) for f in df.schema]
    df.select(*plain).write.mode("overwrite").option("compression", codec).option("maxRecordsPerFile", rows_a_file).json(path)


def read_jsonl(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Rows of JSON lines; malformed and blank lines are passed over."""
    rows = _with_bad(spark, path, schema)
    return rows.where("_bad is null").drop("_bad")


def bad_lines(spark: SparkSession, path: str, schema: StructType) -> int:
    """How many lines ``read_jsonl`` passes over."""
    return _with_bad(spark, path, schema).where("_bad is not null").count()


def _with_bad(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    wide = StructType([*schema.fields, StructField("_bad", StringType())])
    lines = spark.read.text(path).where(F.trim("value") != "")
    parsed = F.from_json("value", wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    return lines.select(parsed.alias("r")).select("r.*")


def count_lines(spark: SparkSession, path: str) -> int:
    """Lines that are not blank; 0 for a path that cannot be read."""
    try:
        return spark.read.text(path).where(F.trim("value") != "").count()
    except Exception as e:  # Spark has a class of its own for each way a path can be missing
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            return 0
        raise


def compact_jsonl(spark: SparkSession, source: str, target: str, schema: StructType, rows_a_file: int = ROWS_A_SHARD) -> None:
    """All lines of many files, those that are no JSON dropped, in files of a number of
    rows.  Nothing is deduplicated."""
    write_jsonl(read_jsonl(spark, source, schema), target, rows_a_file)


def write_jdbc(df: DataFrame, url: str, table: str, batch: int = 5000, **options: str) -> None:
    """Append to a relational table in batches, where a driver for it is on the class path."""
    df.write.format("jdbc").options(url=url, dbtable=table, batchsize=str(batch), **options).mode("append").save()


def merge_statement(table: str, side: str, columns: list[str], key: list[str], policy: str) -> str:
    """SQL that merges a side table into a keyed one, by the policies of ``operators.upsert``."""
    rest = [c for c in columns if c not in key]
    names, on = ", ".join(columns), ", ".join(key)
    if policy == IGNORE or not rest:
        action = "NOTHING"
    else:
        own = {REPLACE: "EXCLUDED.{0}", COALESCE: "COALESCE(EXCLUDED.{0}, {1}.{0})"}[policy]
        action = "UPDATE SET " + ", ".join(f"{c} = {own.format(c, table)}" for c in rest)
    return f"INSERT INTO {table} ({names}) SELECT {names} FROM {side} WHERE true ON CONFLICT ({on}) DO {action}"


def merge_jdbc(df: DataFrame, url: str, table: str, key: list[str], policy: str = REPLACE, batch: int = 5000, **options: str) -> None:
    """Merge into a relational table with ON CONFLICT: rows, one a key, go in parallel to a side
    table, and one statement takes them over, all or none."""
    spark, side = df.sparkSession, f"{table}_{uuid.uuid4().hex[:12]}"
    columns = df.columns
    rows = merged(df.na.drop(subset=key), key, [c for c in columns if c not in key], policy).select(*columns)
    write_jdbc(rows, url, side, batch, **options)
    known = spark.sparkContext._jvm.java.util.Properties()
    for name, value in options.items():
        known.setProperty(name, value)
    with contextlib.closing(spark.sparkContext._jvm.java.sql.DriverManager.getConnection(url, known)) as connection:
        statement = connection.createStatement()
        try:
            statement.executeUpdate(merge_statement(table, side, columns, key, policy))
        finally:
            statement.executeUpdate(f"DROP TABLE {side}")


def staged_or_empty(spark: SparkSession, root: str, table: str) -> DataFrame:
    found = read_staged(spark, root, table)
    return empty(spark, STAGED[table]) if found is None else found
