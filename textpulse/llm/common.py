"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import os
import re
import threading
from collections.abc import Callable
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

import textpulse
from textpulse.session import new_folder

#: Rows handed to a Python step at a time; bounds what a worker holds beside one Arrow batch.
SLICE_ROWS = 512

#: A table is broadcast only when it is measured to be within this many bytes.
BROADCAST_BYTES = 16 << 20


#: After so long without a task that uses it, a worker lets go of what it holds.
IDLE_SECONDS = 3.0

#: ASCII that is no letter, digit or underscore becomes a space.
_SPACED = bytes(b if b > 127 or chr(b).isalnum() or b == 95 else 32 for b in range(256))
_OTHER_MARKS = re.compile(r"[^\x00-\x7f\w]+")


def lower_words(text: str | None) -> list[str]:
    """Runs of letters, digits and underscores (``\\w``) of the lower-case text."""
    low = (text or "").lower()
    if not low.isascii():
        low = _OTHER_MARKS.sub(" ", low)
    return low.encode("utf-8", "surrogatepass").translate(_SPACED).decode("utf-8", "surrogatepass").split()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def store(df: DataFrame, name: str) -> DataFrame:
    """The table written to the shared folder and read back: lineage ends there."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_if_small(stored: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """A broadcast hint when rows x ``row_bytes`` is within ``limit``; else a plain shuffle side.

    ``stored`` is a written table, so counting it reads only Parquet footers.
    """
    return F.broadcast(stored) if stored.count() * row_bytes <= limit else stored


class Held:
    """What the tasks of a Python worker share, such as an index: one object at a time.

    Spark keeps workers for other work, so the object goes when a task begins that has no use
    for it, or ``IDLE_SECONDS`` after the last task that had.
    """

    def __init__(self):
        self._lock, self._running, self._timer = threading.RLock(), 0, None
        self.name, self.made, self._asked = None, None, False

    def get(self, name: str, make: Callable[[], object]):
        with self._lock:
            self._asked = True
            if self.name != name:
                self.drop()
                self.name, self.made = name, make()
                give_back()
            return self.made

    def drop(self) -> None:
        with self._lock:
            if self.made is not None and not self._running:
                self.name = self.made = None
                give_back()

    @contextmanager
    def task(self, start: Callable[[], Callable[..., list]]):
        """The step that ``start()`` makes; it asks for what the task needs."""
        with self._lock:
            if self._timer:
                self._timer.cancel()
            self._asked = False
            step = start()
            if not self._asked:
                self.drop()
            self._running += 1
        try:
            yield step
        finally:
            del step
            with self._lock:
                self._running -= 1
                if self.made is not None:
                    self._timer = threading.Timer(IDLE_SECONDS, self.drop)
                    self._timer.daemon = True
                    self._timer.start()


def give_back() -> None:
    """Memory that is free in this process goes back to the system, where its allocators can do so."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


HELD = Held()


def begun(start: Callable[[], Callable[..., list]]):
    """``HELD.task`` of the process in which a task runs."""
    return HELD.task(start)


def map_columns(df: DataFrame, schema: str, start: Callable[[], Callable[..., list]]) -> DataFrame:
    """Run ``start()`` once per task, and what it returns on slices of columns.

    The step gets one Python list per input column and returns one list per output column;
    the output may have any number of rows.
    """
    ready_workers(df.sparkSession)
    arrow_schema = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        with begun(start) as step:
            for batch in batches:
                for at in range(0, batch.num_rows, SLICE_ROWS):
                    part = batch.slice(at, SLICE_ROWS)
                    made = step(*(column.to_pylist() for column in part.columns))
                    arrays = [pa.array(values, field.type) for values, field in zip(made, arrow_schema)]
                    yield pa.RecordBatch.from_arrays(arrays, schema=arrow_schema)

    return df.mapInArrow(run, schema)


def append_columns(df: DataFrame, inputs: list[str], added: str, start: Callable[[], Callable[..., list]]) -> DataFrame:
    """``df`` with the columns of the DDL ``added``, made by ``start()`` once per task.

    The step gets a Python list per input column and returns one per added column, of the
    same length; other columns pass through as Arrow data, whatever their names.
    """
    ready_workers(df.sparkSession)
    extra = StructType.fromDDL(added)
    arrow_extra = to_arrow_schema(extra)
    at = [df.columns.index(c) for c in inputs]
    count = len(df.columns)
    schema = StructType([*df.schema.fields, *extra.fields])
    # Arrow goes by position; plain names keep clashing ones apart on the way.
    names = [f"c{k}" for k in range(count + len(extra))]
    sent = StructType([StructField(n, f.dataType, True) for n, f in zip(names, schema.fields)])

    def run(batches):
        with begun(start) as step:
            for batch in batches:
                for first in range(0, batch.num_rows, SLICE_ROWS):
                    part = batch.slice(first, SLICE_ROWS)
                    made = step(*(part.column(i).to_pylist() for i in at))
                    arrays = [pa.array(values, field.type) for values, field in zip(made, arrow_extra)]
                    yield pa.RecordBatch.from_arrays([*part.columns, *arrays], names=names)

    return df.mapInArrow(run, sent).toDF(*[f.name for f in schema.fields])


def ready_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver found it.

    A cluster has the package installed or sent along by ``--py-files``; this adds the path
    for workers that share the driver's files, whatever folder the program was started in.
    """
    root = str(Path(textpulse.__file__).resolve().parent.parent)
    known = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])


def row_key(id_column: str = "doc_id", text_column: str = "text") -> Column:
    """A 64-bit key of id and text; rows equal in both are one row for every operator."""
    return F.xxhash64(
        F.col(id_column).isNull(), F.col(id_column), F.col(text_column).isNull(), F.col(text_column)
    )
