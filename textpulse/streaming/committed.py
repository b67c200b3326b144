"""A folder sink whose batches count only once they are named in a commit log.

A batch is staged in a folder of its own and then committed: a small file that names the folder
is written under another name and renamed. Readers follow the committed files, so a
batch is there as a whole or not at all, and what a crash left behind is never read.

Two ways to tell what has been stored:

* by batch: the id of the query, which a checkpoint keeps, and the number of the batch. A repeated
  batch is skipped. A new checkpoint is another query: its batches are added, none replaced.
* by position: where rows carry a partition and a rising offset, each commit says how far every
  partition has been stored, and rows up to there are skipped. That also holds for
  a new checkpoint that reads the source again, cut into other batches.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BatchWriter = Callable[[DataFrame, int], None]

COMMITS = "commits"
BATCHES = "batches"
ENTRY = "stream string, number long, folder string, until map<string, long>"


class CommitLog:
    """Commits below ``path``: ``commits/<stream>.<number>.json``, each renamed into place."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        hadoop = spark.sparkContext._jvm.org.apache.hadoop
        settings = spark.sparkContext._jsc.hadoopConfiguration()
        self._to_path = hadoop.fs.Path
        folder = self._to_path(f"{self.path}/{COMMITS}")
        self._files = folder.getFileSystem(settings)
        self._files.mkdirs(folder)
        self._context = hadoop.fs.FileContext.getFileContext(self._files.getUri(), settings)
        self._keep = spark.sparkContext._gateway.new_array(hadoop.fs.Options.Rename, 1)
        self._keep[0] = hadoop.fs.Options.Rename.NONE  # an error if the name is taken

    def _name(self, stream: str, number: int):
        return self._to_path(f"{self.path}/{COMMITS}/{stream}.{number:012d}.json")

    def entries(self, stream: str | None = None) -> list[dict]:
        """The commits, one per batch, in order; of one stream or all."""
        rows = self.spark.read.schema(ENTRY).json(f"{self.path}/{COMMITS}")
        if stream is not None:
            rows = rows.filter(F.col("stream") == stream)
        return [r.asDict() for r in rows.orderBy("stream", "number").collect()]

    def has(self, stream: str, number: int) -> bool:
        return self._files.exists(self._name(stream, number))

    def commit(self, stream: str, number: int, folder: str | None, until: dict[str, int] | None = None) -> None:
        """Name a staged folder. An error if the stream's number has been taken meanwhile."""
        entry = {"stream": stream, "number": number, "folder": folder, "until": until or {}}
        staged = self._to_path(f"{self.path}/{COMMITS}/.{uuid.uuid4().hex}")  # hidden from readers
        out = self._files.create(staged)
        out.write(bytearray(json.dumps(entry).encode()))
        out.close()
        self._context.rename(
            self._files.makeQualified(staged), self._files.makeQualified(self._name(stream, number)), self._keep
        )


def query_id(batch: DataFrame) -> str:
    """The id of the running query; it stays the same as long as its checkpoint does."""
    found = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not found:
        raise RuntimeError("not in a streaming query: name the stream")
    return found


def committed_writer(path: str, stream: str | None = None) -> BatchWriter:
    """Store every batch of a stream once, by its number. ``stream``: the query's id by default."""

    def write(batch: DataFrame, batch_id: int) -> None:
        log = CommitLog(batch.sparkSession, path)
        name = stream or query_id(batch)
        if not log.has(name, batch_id):
            log.commit(name, batch_id, _staged(batch, log))

    return write


def positioned_writer(path: str, stream: str, partition: str = "partition", offset: str = "offset") -> BatchWriter:
    """Store every row of the named stream once, by its partition and offset.

    Offsets rise within a partition from batch to batch; a batch holds what follows the last
    one in each partition it has. One row per partition reaches the driver.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        log = CommitLog(batch.sparkSession, path)
        entries = log.entries(stream)
        until: dict[str, int] = {}
        for entry in entries:
            for key, value in (entry["until"] or {}).items():
                until[key] = max(value, until.get(key, value))
        key = F.col(partition).cast("string")
        if until:
            rows = [(k, v) for k, v in until.items()]
            stored = batch.sparkSession.createDataFrame(rows, "_partition string, _until long")
            met = batch.join(F.broadcast(stored), key == F.col("_partition"), "left")
            fresh = met.filter(F.coalesce(F.col(offset) > F.col("_until"), F.lit(True))).drop("_partition", "_until")
        else:
            fresh = batch
        folder = _staged(fresh, log)
        kept = batch.sparkSession.read.schema(batch.schema).parquet(f"{log.path}/{folder}")
        reached = {r["k"]: r["o"] for r in kept.groupBy(key.alias("k")).agg(F.max(offset).alias("o")).collect()}
        if reached:
            number = entries[-1]["number"] + 1 if entries else 0
            log.commit(stream, number, folder, reached)

    return write


def _staged(batch: DataFrame, log: CommitLog) -> str:
    """The batch written to a new folder; its name below the sink."""
    folder = f"{BATCHES}/{uuid.uuid4().hex}"
    batch.write.parquet(f"{log.path}/{folder}")
    return folder


def store_writer(source: str, options: dict[str, str], log_path: str, stream: str | None = None) -> BatchWriter:
    """Append every batch to an external store through its Spark connector, noting it in a log.

    A batch that the log has is skipped. A crash after the append and before the commit lets the batch
    come again: ``batch_id`` is stored as a field for the store to tell such a repeat.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        log = CommitLog(batch.sparkSession, log_path)
        name = stream or query_id(batch)
        if log.has(name, batch_id):
            return
        marked = batch.withColumn("batch_id", F.lit(batch_id).cast("long"))
        marked.write.format(source).options(**options).mode("append").save()
        log.commit(name, batch_id, None)

    return write


def read_committed(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """All committed batches; an empty table if there are none."""
    folders = [e["folder"] for e in CommitLog(spark, path).entries() if e["folder"]]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*(f"{path.rstrip('/')}/{f}" for f in folders))
