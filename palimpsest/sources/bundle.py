"""Revision bundles: compressed line files of page revisions.

A line of # opens a revision with key=value tokens, a line that starts with a space
is a line of its text, any other line is dropped.
"""

from __future__ import annotations

import glob
import io
import os
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from ..schemas import REVISION

SUFFIX = ".mwrev.zst"
#: Compressions of which Spark reads a file as a whole, in one task.
WHOLE = (".zst", ".gz", ".deflate")


class RevisionParser:
    """Takes lines one by one; ``push`` and ``finish`` give a revision when it is whole."""

    def __init__(self) -> None:
        self.head: tuple | None = None
        self.body: list[str] = []

    def push(self, line: str) -> tuple | None:
        if line.startswith("#"):
            done = self.finish()
            self.head = _head(line[1:])
            return done
        if line.startswith(" "):
            self.body.append(line[1:])
        return None

    def finish(self) -> tuple | None:
        done = None if self.head is None else (*self.head, "\n".join(self.body))
        self.head, self.body = None, []
        return done


def _head(line: str) -> tuple:
    """The last of a repeated key counts; empty and missing numbers are null, 0 stays 0."""
    keys = dict(token.split("=", 1) for token in line.split() if "=" in token)

    def number(key: str) -> int | None:
        return int(keys[key]) if keys.get(key) else None

    stamp = keys.get("timestamp", "").replace("T", " ").replace("Z", "")
    return number("page_id"), number("ns"), number("rev_id"), number("parent_rev_id"), stamp


def parse_lines(lines: Iterable[str]) -> Iterator[tuple]:
    parser = RevisionParser()
    for line in lines:
        done = parser.push(line)
        if done:
            yield done
    done = parser.finish()
    if done:
        yield done


def render(revisions: Iterable[tuple]) -> str:
    """Text of a bundle that parses to ``revisions`` (page, ns, id, parent, timestamp, text)."""
    out = []
    for page, ns, rev, parent, stamp, text in revisions:
        keys = (("page_id", page), ("ns", ns), ("rev_id", rev), ("parent_rev_id", parent), ("timestamp", stamp.replace(" ", "T") + "Z" if stamp else ""))
        out.append("# " + " ".join(f"{k}={'' if v is None else v}" for k, v in keys) + "\n")
        out += [f" {line}\n" for line in (text.split("\n") if text else [])]
    return "".join(out)


def read_bundles(spark: SparkSession, path: str | list[str], suffix: str = SUFFIX) -> DataFrame:
    """REVISION rows and ``source_file`` of every bundle under ``path``, one or more.

    Only Spark opens the files, so any store it knows will do.  A compressed file is one
    task and streams through it; its lines keep their order there.  Files that Spark would
    split, and so cut revisions, are refused.  A number in a head that is none ends the job.
    """
    if not suffix.endswith(WHOLE):
        raise ValueError(f"bundles end in one of {WHOLE}, as others may be split between revisions")
    lines = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{suffix}").text(path)
    lines = lines.select("value", F.col("_metadata.file_path").alias("source_file"))
    schema = StructType.fromDDL(", ".join(f"{f.name} {f.dataType.simpleString()}" for f in REVISION.fields) + ", source_file string")
    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string())

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser, at, rows = RevisionParser(), None, []

        def give() -> pa.RecordBatch:
            columns = list(zip(*rows)) or [[] for _ in kinds]
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=schema.names)

        for batch in batches:
            for line, name in zip(batch["value"].to_pylist(), batch["source_file"].to_pylist()):
                if name != at:
                    done = parser.finish()
                    if done:
                        rows.append((*done, at))
                    at = name
                done = parser.push(line)
                if done:
                    rows.append((*done, at))
                if len(rows) >= 1000:
                    yield give()
        done = parser.finish()
        if done:
            rows.append((*done, at))
        yield give()

    return lines.mapInArrow(parsed, schema)


class BundleFile(InputPartition):
    def __init__(self, path: str) -> None:
        self.path = path


class BundleReader(DataSourceReader):
    def __init__(self, path: str) -> None:
        self.path = path

    def partitions(self) -> list[BundleFile]:
        """One a file, the smallest first."""
        folder = self.path.removeprefix("file://")
        files = glob.glob(f"{glob.escape(folder)}/**/*{SUFFIX}", recursive=True) if os.path.isdir(folder) else glob.glob(folder)
        return [BundleFile(f) for f in sorted(files, key=lambda f: (os.path.getsize(f), f))]

    def read(self, partition: BundleFile) -> Iterator[tuple]:
        import zstandard

        with open(partition.path, "rb") as f, zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True) as z:
            yield from parse_lines(line.removesuffix("\n") for line in io.TextIOWrapper(z, encoding="utf-8"))


class BundleDataSource(DataSource):
    """``spark.read.format("mwrev").load(folder)`` for folders that every executor can open."""

    @classmethod
    def name(cls) -> str:
        return "mwrev"

    def schema(self) -> StructType:
        return REVISION

    def reader(self, schema: StructType) -> BundleReader:
        if "path" not in self.options:
            raise ValueError("mwrev: a path is needed")
        return BundleReader(self.options["path"])


def register(spark: SparkSession) -> None:
    spark.dataSource.register(BundleDataSource)
