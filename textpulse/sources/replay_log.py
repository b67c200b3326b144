"""A message log in partitions with offsets, and a streaming source that reads it.

Every append is a folder of Parquet files that a commit names (``streaming.committed``), together
with the offset that each partition reaches. The source gives every message its partition and
offset; a query starts at the earliest or latest offsets, goes on from its checkpoint, and can be
paced to so many messages a second.
"""

from __future__ import annotations

import json
import time

import pyarrow.dataset as pads
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from textpulse.functions import md5_bucket
from textpulse.session import ready_workers
from textpulse.streaming.committed import BATCHES, COMMITS, CommitLog

FORMAT = "replay_log"
LOG = "log"
SCHEMA = "partition int, offset long, value string"
EARLIEST, LATEST = "earliest", "latest"
#: Messages that a task reads at most; a longer range is read by several tasks.
TASK_ROWS = 50_000


def append_log(messages: DataFrame, path: str, partitions: int, key: str = "key") -> None:
    """Append ``messages(key, value)``. The partition is an md5 bucket of the key, which is
    unique; offsets go on from the last append in the order of keys.

    One writer at a time; a second one fails at its commit and leaves nothing that is read. Keys spread
    evenly, so the number of partitions is the parallelism of the append.
    """
    spark = messages.sparkSession
    log = CommitLog(spark, path)
    entries = log.entries(LOG)
    reached = _reached(entries)
    ends = F.coalesce(*(F.when(F.col("partition") == int(p), F.lit(e)) for p, e in reached.items()), F.lit(0))
    ordered = Window.partitionBy("partition").orderBy(key)
    rows = messages.withColumn("partition", md5_bucket(F.col(key), partitions).cast("int"))
    rows = rows.withColumn("offset", F.row_number().over(ordered) - 1 + ends)
    folder = f"{BATCHES}/{len(entries):012d}-{time.time_ns()}"
    rows.select("partition", F.col("offset").cast("long"), "value").write.partitionBy("partition").parquet(f"{path}/{folder}")
    stored = spark.read.schema(SCHEMA).parquet(f"{path}/{folder}")
    until = {str(r["partition"]): r["e"] for r in stored.groupBy("partition").agg((F.max("offset") + 1).alias("e")).collect()}
    log.commit(LOG, len(entries), folder, {**reached, **until})


def _reached(entries: list[dict]) -> dict[str, int]:
    """The end of every partition; each commit holds all that were known to it."""
    return dict(entries[-1]["until"] or {}) if entries else {}


def read_log_stream(
    spark: SparkSession, path: str, starting: str = EARLIEST, rows_per_second: float | None = None
) -> DataFrame:
    """The log as a stream of ``partition, offset, value``.

    ``rows_per_second`` shows the messages of every partition on a schedule that begins with the first
    append. The schedule is the same after a restart, whose first batch catches up with it.
    """
    ready_workers(spark)
    spark.dataSource.register(ReplayLog)
    reader = spark.readStream.format(FORMAT).option("path", path).option("startingOffsets", starting)
    if rows_per_second is not None:
        reader = reader.option("rowsPerSecond", str(rows_per_second))
    return reader.load()


class ReplayLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema):
        return ReplayLogReader(dict(self.options))


class Range(InputPartition):
    """Messages ``first`` to ``end`` - 1 of a partition, all in one append."""

    def __init__(self, partition: int, first: int, end: int, folder: str):
        self.partition, self.first, self.end, self.folder = partition, first, end, folder


class ReplayLogReader(DataSourceStreamReader):
    """Offsets are ``{partition: next message}``; a partition that is not named is at 0."""

    def __init__(self, options: dict[str, str]):
        plain = {k.lower(): v for k, v in options.items()}
        self.path = plain["path"].rstrip("/")
        self.starting = plain.get("startingoffsets", LATEST)
        if self.starting not in (EARLIEST, LATEST):
            raise ValueError(f"startingOffsets is {EARLIEST} or {LATEST}")
        self.rate = float(plain["rowspersecond"]) if "rowspersecond" in plain else None

    def _files(self) -> tuple[pafs.FileSystem, str]:
        return pafs.FileSystem.from_uri(self.path) if ":" in self.path else (pafs.LocalFileSystem(), self.path)

    def _commits(self) -> list[dict]:
        files, folder = self._files()
        found = []
        for info in files.get_file_info(pafs.FileSelector(f"{folder}/{COMMITS}", allow_not_found=True)):
            if info.base_name.startswith(f"{LOG}.") and info.base_name.endswith(".json"):
                with files.open_input_stream(info.path) as lines:
                    found.append({**json.loads(lines.read()), "at": info.mtime.timestamp()})
        return sorted(found, key=lambda c: c["number"])

    def initialOffset(self) -> dict:
        return {} if self.starting == EARLIEST else self._ends(self._commits())

    def latestOffset(self) -> dict:
        commits = self._commits()
        ends = self._ends(commits)
        if self.rate is None or not commits:
            return ends
        shown = int((time.time() - commits[0]["at"]) * self.rate)
        return {p: min(e, shown) for p, e in ends.items()}

    @staticmethod
    def _ends(commits: list[dict]) -> dict[str, int]:
        return _reached(commits)

    def partitions(self, start: dict, end: dict) -> list[Range]:
        ranges, begins = [], {}
        for commit in self._commits():
            for partition, stop in commit["until"].items():
                first = max(begins.get(partition, 0), start.get(partition, 0))
                last = min(stop, end.get(partition, 0))
                for at in range(first, last, TASK_ROWS):
                    ranges.append(Range(int(partition), at, min(at + TASK_ROWS, last), commit["folder"]))
                begins[partition] = stop
        return ranges

    def read(self, partition: Range):
        files, folder = self._files()
        data = pads.dataset(
            f"{folder}/{partition.folder}/partition={partition.partition}", filesystem=files, format="parquet"
        )
        wanted = (pads.field("offset") >= partition.first) & (pads.field("offset") < partition.end)
        for batch in data.to_batches(columns=["offset", "value"], filter=wanted):
            for offset, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                yield partition.partition, offset, value

    def commit(self, end: dict) -> None:
        """Nothing to do: the log keeps its messages."""
