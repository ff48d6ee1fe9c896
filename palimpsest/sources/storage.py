"""Written tables as cuts in the lineage, and tables that change by one new file at a time."""

from __future__ import annotations

import atexit
import contextlib
import json
import tempfile
import uuid
from collections.abc import Iterable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def scratch(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the cluster names it.

    A session on one machine (tests) that names none gets a temporary one; on a cluster
    that would be a folder of each machine's own, so there it is an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if master.split("[")[0] != "local":
            raise RuntimeError(f"spark.checkpoint.dir must name a folder that all machines of {master} share")
        folder = "file://" + tempfile.mkdtemp(prefix="palimpsest-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def cut(df: DataFrame, name: str, options: dict[str, str] | None = None) -> DataFrame:
    """Write to the shared folder and read back: lineage ends there, what is lost with an
    executor is read again, and the files go when the driver ends."""
    spark = df.sparkSession
    path = f"{scratch(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.options(**{"compression": "zstd"} | (options or {})).parquet(path)
    delete_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def delete_at_exit(spark: SparkSession, path: str) -> None:
    def gone() -> None:
        try:
            delete(spark, path)
        except Exception:  # the JVM may have ended already; the folder's owner cleans up then
            pass

    atexit.register(gone)


def _fs(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop = _fs(spark, path)
    return fs.exists(hadoop)


def sizes(spark: SparkSession, paths: Iterable[str]) -> list[int]:
    """Bytes of what stands at each path."""
    return [fs.getContentSummary(hadoop).getLength() for fs, hadoop in (_fs(spark, unquote(p)) for p in paths)]


def delete(spark: SparkSession, path: str) -> bool:
    fs, hadoop = _fs(spark, path)
    return fs.delete(hadoop, True)


def empty(spark: SparkSession, schema: StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


#: A table's folders of rows, and the files that list those of each of its states.
_ROWS, _LIST = "rows-", "_rows-"


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, hadoop = _fs(spark, path)
    return [f.getPath().getName() for f in fs.listStatus(hadoop)] if fs.exists(hadoop) else []


def _states(spark: SparkSession, path: str) -> list[str]:
    return sorted(n for n in _names(spark, path) if n.startswith(_LIST))


def _listed(spark: SparkSession, path: str, state: str) -> list[str]:
    fs, hadoop = _fs(spark, f"{path}/{state}")
    with contextlib.closing(fs.open(hadoop)) as stream:
        return json.loads(bytes(stream.readAllBytes()).decode())


def folders(spark: SparkSession, path: str) -> list[str]:
    """The folders that make up the table at ``path``: those of its last state, or the folder
    itself where it was written without one; none where there is no table."""
    states = _states(spark, path)
    if states:
        return [f"{path}/{name}" for name in _listed(spark, path, states[-1])]
    return [path] if exists(spark, path) else []


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table at ``path``, or an empty one of the schema."""
    there = folders(spark, path)
    return spark.read.schema(schema).parquet(*there) if there else empty(spark, schema)


def replace_table(df: DataFrame, path: str) -> None:
    """Put ``df``, which may read the table itself, in its place."""
    _change(df, path, keep=False)


def append_table(df: DataFrame, path: str) -> None:
    """Add rows; those that the table holds are neither read nor written."""
    _change(df, path, keep=True)


def _change(df: DataFrame, path: str, keep: bool) -> None:
    """Rows go to a folder of their own.  Then one new file lists the table's folders, and with it
    the table is another: a run that dies before leaves the old state, and nothing is ever
    moved.  The state before stays for its readers until the next change.  A table has one
    writer at a time; a second one is refused."""
    spark = df.sparkSession
    states, held = _states(spark, path), [f.removeprefix(f"{path}/") for f in folders(spark, path)]
    if keep and path in held:  # a folder without a list: what it holds gets a folder of its own
        df, keep = spark.read.schema(df.schema).parquet(path).unionByName(df), False
    rows = f"{_ROWS}{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(f"{path}/{rows}")
    if _states(spark, path) != states:
        delete(spark, f"{path}/{rows}")
        raise RuntimeError(f"{path} has been changed by another run")
    number = 1 + (int(states[-1].removeprefix(_LIST)) if states else 0)
    fs, made = _fs(spark, f"{path}/.{uuid.uuid4().hex}")
    with contextlib.closing(fs.create(made, False)) as stream:
        stream.write(bytearray(json.dumps([*(held if keep else []), rows]).encode()))
    _, state = _fs(spark, f"{path}/{_LIST}{number:012d}")
    if not fs.rename(made, state) or not fs.exists(state):
        fs.delete(made, False)
        raise RuntimeError(f"{state} cannot be written; the table is as it was")
    # What neither this state nor the one before names is waste.
    kept = {rows, *held, *states[-1:], state.getName()}
    for name in _names(spark, path):
        if name not in kept and (states or name.startswith((_ROWS, "."))):
            delete(spark, f"{path}/{name}")


def mark(spark: SparkSession, path: str) -> None:
    """Note that a step is done."""
    fs, hadoop = _fs(spark, path)
    fs.mkdirs(hadoop.getParent())
    fs.create(hadoop, True).close()
