"""Word runs of texts counted in Arrow batches: vocabularies of runs, and texts as vectors over them.

``NGram`` makes a string of every run and ``CountVectorizer`` looks each of them up, one text at a time, and
every later stage that is fitted makes them anew. Here a task takes the words of many texts as one array of
bytes. A word has a 64-bit hash, a run the hash of its words; only runs that may be in a vocabulary become strings.

A vocabulary is exact. All runs are first counted by buckets of their hashes, which bounds every run's count from
above in memory that depends on the vocabulary's size alone; runs of buckets that reach a bound are then counted by
their strings. If the last one kept has less than the bound, its count is the next bound and all those of it are there.
Two different runs of one hash would be taken for one another only where one of them is in a vocabulary: for 10^9
runs and 16384 terms the odds are about one in a million.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.feature import IDF, CountVectorizer, CountVectorizerModel, IDFModel, NGram, SQLTransformer, Tokenizer
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from textpulse.operators.terms import top_counts
from textpulse.plans.fitted import in_order, vocabulary_model
from textpulse.session import new_folder, ready_workers, stored

#: Buckets that runs are counted by before they become strings, for each term a vocabulary keeps.
BUCKETS_PER_TERM = 256
#: Buckets that travel in one row.
BUCKETS_PER_ROW = 1 << 16
#: Bytes of text that a task looks at as one array; a longer text is one alone.
CHUNK_BYTES = 1 << 18
#: Hashes that wait to be counted, and different runs that a task holds before it hands them on.
WAITING = 1 << 21
HELD = 1 << 19

_WORDS, _SIZE = "_joined", "_n_words"
_POWER = 0x9E3779B97F4A7C15  # odd, so it has an inverse
_BYTES = np.random.default_rng(42).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_STEP, _MIX, _EMPTY = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xFF51AFD7ED558CCD), np.uint64(0x2545F4914F6CDD1D)


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, from the 0th on."""
    made = []
    for base in (_POWER, pow(_POWER, -1, 1 << 64)):
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        made.append(np.multiply.accumulate(steps))
    return made[0], made[1]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(29))


@dataclass(frozen=True)
class Chunk:
    """Some texts as bytes: where each word begins and ends, the text it is of, and its hash."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray
    words: np.ndarray

    def runs(self, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(n, first word, hash) of all runs of ``n`` words inside a text, for ``n`` up to ``longest``."""
        hashes = self.words
        for n in range(1, longest + 1):
            if n > 1:
                hashes = _mixed(hashes[:-1] * _STEP + self.words[n - 1 :]) if len(hashes) else hashes
            inside = np.flatnonzero(self.text[: len(hashes)] == self.text[n - 1 :]) if n > 1 else np.arange(len(hashes))
            yield n, inside, hashes[inside]

    def strings(self, n: int, first: np.ndarray) -> list[bytes]:
        """The runs of ``n`` words that begin at the words ``first``."""
        data = self.data.tobytes()
        return [data[a:b] for a, b in zip(self.starts[first].tolist(), self.ends[first + (n - 1)].tolist())]


def chunk(data: np.ndarray, offsets: np.ndarray, sizes: np.ndarray) -> Chunk:
    """Texts of words joined by a space, ``sizes`` their number of words: an empty text has none or an empty one."""
    spaces = np.flatnonzero(data == 32)
    some = sizes > 0
    starts = np.sort(np.concatenate([offsets[:-1][some], spaces + 1]), kind="stable")
    ends = np.sort(np.concatenate([spaces, offsets[1:][some]]), kind="stable")
    places = 1 << max(CHUNK_BYTES - 1, len(data)).bit_length()
    powers, inverse = _powers(places)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * powers[: len(data)], out=sums[1:])
    words = _mixed((sums[ends] - sums[starts]) * inverse[starts] + _EMPTY)
    return Chunk(data, starts, ends, np.repeat(np.arange(len(sizes)), np.maximum(sizes, 0)), words)


def chunks(batch: pa.RecordBatch, most: int) -> Iterator[tuple[int, int, Chunk]]:
    """(first row, row after the last, chunk of ``most`` bytes) of a batch with the joined words and their number."""
    joined = batch.column(batch.schema.get_field_index(_WORDS))
    sizes = batch.column(batch.schema.get_field_index(_SIZE)).to_numpy(zero_copy_only=False)
    kind = np.int64 if pa.types.is_large_string(joined.type) else np.int32
    offsets = np.frombuffer(joined.buffers()[1], kind)[joined.offset : joined.offset + len(joined) + 1].astype(np.int64)
    data = np.frombuffer(joined.buffers()[2] or b"", np.uint8)
    row = 0
    while row < len(joined):
        last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, side="right")) - 1)
        last = min(last, len(joined))
        part = data[offsets[row] : offsets[last]]
        yield row, last, chunk(part, offsets[row : last + 1] - offsets[row], sizes[row:last])
        row = last


def joined_words(words: str, *keep: str) -> list[Column]:
    """Columns for ``chunks``: words have no white space in them, so the joined text tells them apart."""
    return [*(F.col(name) for name in keep), F.concat_ws(" ", words).alias(_WORDS), F.size(words).alias(_SIZE)]


def _bits(size: int) -> int:
    return max(BUCKETS_PER_ROW, size * BUCKETS_PER_TERM - 1).bit_length()


def _bucket(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def _sketch(longest: int, bits: int):
    most, per_row = CHUNK_BYTES, BUCKETS_PER_ROW

    def count(batches):
        totals = np.zeros((longest, 1 << bits), np.uint32)
        waiting, held = [[] for _ in range(longest)], [0] * longest

        def counted(n):
            if held[n]:
                totals[n] += np.bincount(np.concatenate(waiting[n]), minlength=1 << bits).astype(np.uint32)
                waiting[n].clear()
                held[n] = 0

        for batch in batches:
            for _, _, part in chunks(batch, most):
                for n, _, hashes in part.runs(longest):
                    waiting[n - 1].append(_bucket(hashes, bits))
                    held[n - 1] += len(hashes)
                    if held[n - 1] >= WAITING:
                        counted(n - 1)
        for n in range(longest):
            counted(n)
            rows = totals[n].reshape(-1, per_row)
            for at in range(len(rows)):
                if rows[at].any():
                    yield pa.record_batch([pa.array([n + 1], pa.int32()), pa.array([at], pa.int32()), pa.array([rows[at].tobytes()])], names=["run", "part", "counts"])

    return count


def _summed(table: pa.Table) -> pa.Table:
    """One row for all rows of a run length and part: the sum of their buckets."""
    total = np.int64(0)
    for blob in table.column("counts"):
        total = total + np.frombuffer(blob.as_buffer(), np.uint32).astype(np.int64)
    return pa.table({"run": table.column("run")[:1], "part": table.column("part")[:1], "totals": pa.array([total.tobytes()])})


def _histogram(batches):
    for batch in batches:
        for run, blob in zip(batch.column(0), batch.column(1)):
            values, buckets = np.unique(np.frombuffer(blob.as_buffer(), np.int64), return_counts=True)
            columns = [pa.array(np.full(len(values), run.as_py()), pa.int32()), pa.array(values), pa.array(buckets.astype(np.int64))]
            yield pa.record_batch(columns, names=["run", "n", "buckets"])


def _reached(bounds: dict[int, int]):
    def mark(batches):
        for batch in batches:
            marks = [
                np.packbits(np.frombuffer(blob.as_buffer(), np.int64) >= bounds[run.as_py()]).tobytes()
                for run, blob in zip(batch.column(0), batch.column(2))
            ]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(marks, pa.binary())], names=["run", "part", "marks"])

    return mark


def _counted(longest: int, bits: int, reached):
    most = CHUNK_BYTES

    def count(batches):
        marks = {n: np.unpackbits(np.frombuffer(m, np.uint8)).astype(bool) for n, m in reached.value.items()}
        none = np.zeros(0, np.uint64)
        known = {n: none for n in marks}
        order = {n: np.zeros(0, np.int64) for n in marks}  # where a known hash has its count and string
        counts = {n: np.zeros(0, np.int64) for n in marks}
        strings: dict[int, list[bytes]] = {n: [] for n in marks}

        def taken(n):
            made = pa.record_batch(
                [pa.array(np.full(len(strings[n]), n), pa.int32()), pa.array(strings[n], pa.binary()).cast(pa.string()), pa.array(counts[n])],
                names=["run", "term", "n"],
            )
            known[n], order[n], counts[n], strings[n] = none, order[n][:0], counts[n][:0], []
            return made

        for batch in batches:
            for _, _, part in chunks(batch, most):
                for n, first, hashes in part.runs(longest):
                    if n not in marks:
                        continue
                    may = np.flatnonzero(marks[n][_bucket(hashes, bits)])
                    found, where, times = np.unique(hashes[may], return_index=True, return_counts=True)
                    at = np.searchsorted(known[n], found)
                    old = np.zeros(len(found), bool)
                    inside = at < len(known[n])
                    old[inside] = known[n][at[inside]] == found[inside]
                    counts[n][order[n][at[old]]] += times[old]
                    new = ~old
                    if new.any():
                        places = len(strings[n]) + np.arange(int(new.sum()))
                        strings[n].extend(part.strings(n, first[may[where[new]]]))
                        counts[n] = np.concatenate([counts[n], times[new]])
                        known[n] = np.insert(known[n], at[new], found[new])
                        order[n] = np.insert(order[n], at[new], places)
                    if len(strings[n]) >= HELD:
                        yield taken(n)
        for n in marks:
            if strings[n]:
                yield taken(n)

    return count


def top_runs(joined: DataFrame, sizes: dict[int, int]) -> DataFrame:
    """(run, index, term, n): for each run length the ``sizes`` most frequent runs, ties in term order.

    ``joined`` has the columns of ``joined_words``; it is read twice, a third time only for a vocabulary whose
    last term turned out rarer than half the bucket of its rank.
    """
    spark = joined.sparkSession
    ready_workers(spark)
    longest, most = max(sizes), max(sizes.values())
    bits = _bits(most)
    size = F.element_at(F.create_map(*[F.lit(x) for pair in sizes.items() for x in pair]), F.col("run"))
    texts = joined.select(_WORDS, _SIZE)
    parts = texts.mapInArrow(_sketch(longest, bits), "run int, part int, counts binary")
    parts = parts.filter(F.col("run").isin(list(sizes)))
    sums = stored(parts.groupBy("run", "part").applyInArrow(_summed, "run int, part int, totals binary"), "run-buckets")
    bounds = {r["run"]: r["bound"] for r in _first_bounds(sums, size).collect()}  # run lengths
    found = spark.range(0).select(*(F.lit(None).cast(t).alias(c) for c, t in zip(("run", "index", "term", "n"), ("int", "int", "string", "long"))))
    while bounds:
        marked = sums.filter(F.col("run").isin(list(bounds))).mapInArrow(_reached(bounds), "run int, part int, marks binary")
        marks = {run: bytearray((1 << bits) // 8) for run in bounds}
        step = BUCKETS_PER_ROW // 8
        for r in marked.collect():  # a bit per bucket
            marks[r["run"]][r["part"] * step : (r["part"] + 1) * step] = r["marks"]
        shared = spark.sparkContext.broadcast({run: bytes(m) for run, m in marks.items()})
        exact = texts.mapInArrow(_counted(longest, bits, shared), "run int, term string, n long")
        exact = stored(exact.groupBy("run", "term").agg(F.sum("n").alias("n")), "run-counts")
        top = top_counts(exact, most, "run").filter(F.col("index") < size).select("run", "index", "term", "n")
        top = stored(top, "top-runs")
        last = {r["run"]: r for r in top.groupBy("run").agg(F.count("*").alias("terms"), F.min("n").alias("n")).collect()}
        again = {}
        for run, bound in bounds.items():
            whole = run in last and last[run]["terms"] == sizes[run]
            lowest = last[run]["n"] if whole else 1
            if lowest < bound:
                again[run] = lowest
        found = found.unionByName(top.filter(~F.col("run").isin(list(again))) if again else top)
        bounds = again
    return found


def _first_bounds(sums: DataFrame, size: Column) -> DataFrame:
    """(run, bound): half of what the bucket at the vocabulary's last rank holds; 1 if there are fewer buckets."""
    values = sums.select("run", "totals").mapInArrow(_histogram, "run int, n long, buckets long")
    values = values.filter("n > 0").groupBy("run", "n").agg(F.sum("buckets").alias("buckets"))
    # The running sum is over one row per distinct count of a run length.
    upto = F.sum("buckets").over(Window.partitionBy("run").orderBy(F.col("n").desc()))
    ranked = values.withColumn("upto", upto).groupBy("run")
    last = F.max(F.when(F.col("upto") >= size, F.col("n")))
    return ranked.agg(F.coalesce(F.greatest(F.floor(last / 2), F.lit(1)), F.lit(1)).cast("long").alias("bound"))


@dataclass(frozen=True)
class Vocabulary:
    """The column that counts go to, the run length, the size, whether only presence counts, and the terms' hashes in order."""

    column: str
    run: int
    size: int
    binary: bool
    hashes: np.ndarray
    indices: np.ndarray


def vocabulary_of(model: CountVectorizerModel, run: int) -> Vocabulary:
    terms = [t.encode("utf-8", "surrogatepass") for t in model.vocabulary]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in terms], dtype=np.int64)])
    data = np.frombuffer(b"".join(terms), np.uint8)
    made = chunk(data, offsets, np.full(len(terms), run))
    hashes = next((h for n, _, h in made.runs(run) if n == run), np.zeros(0, np.uint64))
    order = np.argsort(hashes, kind="stable")
    return Vocabulary(model.getOutputCol(), run, len(terms), model.getBinary(), hashes[order], order)


_FILTER_BITS = 20


def _vectors(vocabularies, n_keep: int, names: list[str]):
    most = CHUNK_BYTES

    def count(batches):
        known = {v.run: v for v in vocabularies.value}
        filters = {n: np.zeros(1 << _FILTER_BITS, bool) for n in known}
        for n, v in known.items():
            filters[n][_bucket(v.hashes, _FILTER_BITS)] = True
        for batch in batches:
            for row, last, part in chunks(batch, most):
                texts = last - row
                columns = [batch.column(i).slice(row, texts) for i in range(n_keep)]
                made = {}
                for n, first, hashes in part.runs(max(known)):
                    if n not in known:
                        continue
                    v = known[n]
                    may = np.flatnonzero(filters[n][_bucket(hashes, _FILTER_BITS)])
                    at = np.searchsorted(v.hashes, hashes[may])
                    hit = at < v.size
                    hit[hit] = v.hashes[at[hit]] == hashes[may[hit]]
                    keys, times = np.unique(part.text[first[may[hit]]] * np.int64(v.size) + v.indices[at[hit]], return_counts=True)
                    offsets = np.searchsorted(keys, np.arange(texts + 1) * np.int64(v.size))
                    values = np.ones(len(keys)) if v.binary else times.astype(float)
                    indices = (keys % v.size if v.size else keys).astype(np.int32)
                    offsets = pa.array(offsets.astype(np.int32))
                    made[v.column] = pa.StructArray.from_arrays(
                        [
                            pa.array(np.zeros(texts, np.int8)),
                            pa.array(np.full(texts, v.size, np.int32)),
                            pa.ListArray.from_arrays(offsets, pa.array(indices)),
                            pa.ListArray.from_arrays(offsets, pa.array(values)),
                        ],
                        names=["type", "size", "indices", "values"],
                    )
                yield pa.record_batch([*columns, *(made[name] for name in names)], names=[*batch.schema.names[:n_keep], *names])

    return count


def run_vectors(joined: DataFrame, vocabularies: Sequence[Vocabulary]) -> DataFrame:
    """Rows of ``joined_words`` with the vectors that the counters give instead of the words, stored.

    A task writes the parts of a vector; read back, they are one.
    """
    spark = joined.sparkSession
    ready_workers(spark)
    shared = spark.sparkContext.broadcast(list(vocabularies))
    names = [v.column for v in vocabularies]
    keep = [f for f in joined.schema.fields if f.name not in (_WORDS, _SIZE)]
    source = joined.select(*(f.name for f in keep), _WORDS, _SIZE)
    parts = [StructField(name, VectorUDT.sqlType()) for name in names]
    counted = source.mapInArrow(_vectors(shared, len(keep), names), StructType([*keep, *parts]))
    path = new_folder(spark, "run-vectors")
    counted.write.parquet(path)
    return spark.read.schema(StructType([*keep, *(StructField(name, VectorUDT()) for name in names)])).parquet(path)


@dataclass(frozen=True)
class RunStages:
    """A pipeline's stages: up to the words, then (run, counter, weigher) for each run length, then the others."""

    before: list
    runs: list[tuple]
    after: list

    @property
    def words(self) -> str:
        return self.before[-1].getOutputCol()


def run_stages(stages: Sequence) -> RunStages | None:
    """The parts of a pipeline, fitted or not, that counts word runs; None for another or one with rarer settings."""
    first = 1 if stages and isinstance(stages[0], SQLTransformer) else 0
    if len(stages) <= first or not isinstance(stages[first], Tokenizer):
        return None
    words, at, runs = stages[first].getOutputCol(), first + 1, []
    while at + 2 < len(stages) and isinstance(stages[at], NGram):
        run, counter, weigher = stages[at : at + 3]
        if not isinstance(counter, (CountVectorizer, CountVectorizerModel)) or not isinstance(weigher, (IDF, IDFModel)):
            return None
        if (run.getInputCol(), counter.getInputCol(), weigher.getInputCol()) != (words, run.getOutputCol(), counter.getOutputCol()):
            return None
        fitted_counter = isinstance(counter, CountVectorizerModel)
        if counter.getMinTF() != 1.0 or (not fitted_counter and (counter.getMinDF() > 1 or counter.isSet(counter.maxDF))):
            return None
        runs.append((run, counter, weigher))
        at += 3
    lengths = [run.getN() for run, _, _ in runs]
    if not runs or len(set(lengths)) < len(lengths):
        return None
    return RunStages(list(stages[: first + 1]), runs, list(stages[at:]))


def inputs_of(stages: Sequence, rows: DataFrame) -> list[str]:
    """Columns of the rows that the stages read, by the names that their parameters hold."""
    read = set()
    for stage in stages:
        for param in ("inputCol", "inputCols", "labelCol", "featuresCol", "weightCol"):
            if stage.hasParam(param) and stage.isDefined(param):
                value = stage.getOrDefault(param)
                read.update(value if isinstance(value, list) else [value])
    return [name for name in rows.columns if name in read]


def fit_runs(parts: RunStages, rows: DataFrame) -> tuple[list, DataFrame]:
    """(fitted counters of all run lengths, stored rows with their counts).

    The rows keep the columns that later stages read. The texts' words are stored once: they are read for the
    buckets, the terms and the vectors.
    """
    keep = inputs_of([*(w for _, _, w in parts.runs), *parts.after], rows)
    worded = PipelineModel(parts.before).transform(rows)
    joined = stored(worded.select(*joined_words(parts.words, *keep)), "joined-words")
    top = top_runs(joined, {run.getN(): counter.getVocabSize() for run, counter, _ in parts.runs})
    models = [
        vocabulary_model(counter, in_order(top.filter(F.col("run") == run.getN()), "term", "vocabulary"))
        for run, counter, _ in parts.runs
    ]
    vocabularies = [vocabulary_of(model, run.getN()) for model, (run, _, _) in zip(models, parts.runs)]
    return models, run_vectors(joined, vocabularies)


def transform(model: PipelineModel, rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``columns`` of what ``model.transform(rows)`` gives; word runs are counted in Arrow batches."""
    parts = run_stages(model.stages)
    if parts is None:
        return model.transform(rows).select(*columns)
    weighers = [w for _, _, w in parts.runs]
    keep = [name for name in rows.columns if name in {*inputs_of([*weighers, *parts.after], rows), *columns}]
    worded = PipelineModel(parts.before).transform(rows)
    vocabularies = [vocabulary_of(counter, run.getN()) for run, counter, _ in parts.runs]
    counted = run_vectors(worded.select(*joined_words(parts.words, *keep)), vocabularies)
    return PipelineModel([*weighers, *parts.after]).transform(counted).select(*columns)
