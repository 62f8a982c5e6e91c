"""Shard files as an ordered stream: the offset is the number of the last shard taken.

Batches follow the shards' numbers, not their arrival, and hold at most a given number of shards. So the
offset log alone says which shards a batch has, and a repeated batch has the same ones.
"""

from __future__ import annotations

import heapq
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from nearfield.sources.vecfiles import list_files

FORMAT = "shardfiles"
NUMBER = re.compile(r"(\d+)\.\w+$")


def numbered_files(folder: str, suffix: str) -> list[tuple[int, str]]:
    """(shard number, path) of the data files in a folder."""
    out = []
    for path, _ in list_files([folder], suffix):
        found = NUMBER.search(path.partition("?")[0] if "://" in path else path)
        if found is None:
            raise ValueError(f"shard file without a number in its name: {path}")
        out.append((int(found[1]), path))
    return out


class ShardReader(DataSourceStreamReader):
    """Keeps the last number handed out and the files of that batch; a batch lists the folder once."""

    def __init__(self, folder: str, suffix: str, after: int, per_batch: int):
        self.folder, self.suffix, self.per_batch = folder, suffix, per_batch
        self.first = self.last = after
        self.listed: tuple[int, list] = (after, [])  # end of the batch planned last and its files

    def initialOffset(self) -> dict:
        return {"shard": self.first}

    def latestOffset(self) -> dict:
        """The end of the next batch: at most ``per_batch`` shards further."""
        files = [f for f in numbered_files(self.folder, self.suffix) if f[0] > self.last]
        if files:
            self.last = heapq.nsmallest(self.per_batch, {no for no, _ in files})[-1]
            self.listed = self.last, [f for f in files if f[0] <= self.last]
        return {"shard": self.last}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self.last = max(self.last, end["shard"])  # a batch repeated after a restart
        upto, files = self.listed
        if upto != end["shard"]:
            files = numbered_files(self.folder, self.suffix)
        return [InputPartition(sorted(f for f in files if start["shard"] < f[0] <= end["shard"]))]

    def read(self, partition: InputPartition):
        for no, path in partition.value:
            yield path, (path.partition("?")[0] if "://" in path else path).rsplit("/", 1)[-1], no

    def commit(self, end: dict) -> None:
        self.last = max(self.last, end["shard"])

    def stop(self) -> None:
        pass


class ShardSource(DataSource):
    """Options: ``folder``, ``suffix``, ``after`` (last shard done), ``per_batch``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "path string, shard string, shard_no int"

    def streamReader(self, schema) -> ShardReader:
        o = self.options
        return ShardReader(o["folder"], o["suffix"], int(o.get("after", -1)), int(o["per_batch"]))


def stream_shards(spark: SparkSession, folder: str, suffix: str, after: int = -1, per_batch: int = 1000) -> DataFrame:
    """``path, shard, shard_no`` of new shard files in number order, ``per_batch`` a batch; their content is not read."""
    spark.dataSource.register(ShardSource)
    return (
        spark.readStream.format(FORMAT)
        .option("folder", folder).option("suffix", suffix).option("after", after).option("per_batch", per_batch)
        .load()
    )
