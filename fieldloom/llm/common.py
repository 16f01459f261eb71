"""What the operators of this package share: stored stages, tables, distributed ranks, words."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.session import CHECKPOINT_DIR

#: Narrow rows of a file of a stage, about, where it is known before how many rows come at most.
FILE_ROWS = 100_000

#: Rows of whole texts that go to a Python worker at once; executor and worker each hold a few times as much.
BATCH_ROWS = 1000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"

_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: White space between words: space and the five control characters from tab to carriage return.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Lower case A-Z; every other ASCII character but letters and digits becomes a space.
ALNUM_LOWER = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, or the one set on the context.

    Only a local session without either gets a temporary folder of its own.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if not folder:
        on_context = spark.sparkContext._jsc.sc().getCheckpointDir()
        folder = on_context.get() if on_context.isDefined() else None
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{CHECKPOINT_DIR} must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="stages-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def stage(df: DataFrame, name: str, rows: int | None = None, file_rows: int = FILE_ROWS) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it again: it survives lost executors.

    Where it is known that at most ``rows`` rows come, they go to a file for each ``file_rows``
    of these, not to one for each partition; what is read for them after the last shuffle should
    not be much more.  Each file in a local folder has its rights set
    by processes that the executor starts, which cost time and, until they run on their own,
    count with all of its memory.

    The shuffle files behind it are of no more use then; Spark is told to remove them
    when the write ends instead of when the driver next collects its garbage.
    """
    if rows is not None:
        df = df.coalesce(1 + rows // file_rows)
    conf = df.sparkSession.conf
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    before = conf.get(_CLEAN_UP, None)
    conf.set(_CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.set(_CLEAN_UP, before) if before is not None else conf.unset(_CLEAN_UP)
    _written.append(path)
    staged = df.sparkSession.read.schema(df.schema).parquet(path)
    staged._stage_path = path
    return staged


#: Folders of stages that were written and not removed, in order.
_written: list[str] = []


def _remove(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    if path in _written:
        _written.remove(path)


def discard(*stages: DataFrame) -> None:
    """Remove stages that no later step reads."""
    for df in stages:
        _remove(df.sparkSession, df._stage_path)


@contextmanager
def step(spark: SparkSession):
    """Remove the stages written inside, but for those that are handed to the function given."""
    before, kept = len(_written), set()
    yield lambda df: kept.add(df._stage_path) or df
    for path in _written[before:]:
        if path not in kept:
            _remove(spark, path)


def importable(spark: SparkSession) -> None:
    """Let the Python workers that start from now on import this package from where the driver has it.

    Unless the session says otherwise, they get BATCH_ROWS rows at a time.
    """
    if spark.conf.get(_BATCH, None) is None:
        spark.conf.set(_BATCH, BATCH_ROWS)
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, body): the whole text as UTF-8 bytes, null as empty; other columns fall away."""
    return docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary").alias("body"),
    )


def by_rows(process, schema: str):
    """For ``mapInArrow``: ``process(id, bytes)`` yields tuples in the order of the schema's columns.

    An id that is a struct comes as a dict."""
    import pyarrow as pa
    from pyspark.sql.types import _parse_datatype_string

    from pyspark.sql.pandas.types import to_arrow_schema

    target = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches):
        for batch in batches:
            ids, bodies = batch.column(0), batch.column(1)
            # a slice at a time: the rows of long texts are not held together
            for start in range(0, batch.num_rows, 512):
                rows = []
                for key, body in zip(ids.slice(start, 512).to_pylist(), bodies.slice(start, 512).to_pylist(), strict=True):
                    rows.extend(process(key, body))
                    if len(rows) > 50_000:
                        yield _batch(pa, rows, target)
                        rows = []
                if rows:
                    yield _batch(pa, rows, target)

    return run


def _batch(pa, rows, target):
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, target, strict=True)], schema=target
    )


def ranked(df: DataFrame, keys: list[str], order: list[Column], spread: Column, buckets: int, name: str = "rank") -> DataFrame:
    """Rows with a gapless rank from 0 within ``keys``, without any key in one task.

    Rows of a key are dealt to ``buckets`` buckets by ``spread``; a row's rank is the
    size of the earlier buckets of its key plus its place in its own bucket.  Only the
    counts (keys times buckets rows) are summed over a window per key.
    """
    from pyspark.sql import Window as W

    dealt = df.withColumn("_bucket", F.pmod(spread, F.lit(buckets)).cast("int"))
    sizes = dealt.groupBy(*keys, "_bucket").agg(F.count("*").alias("_size"))
    before = W.partitionBy(*keys).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select(*keys, "_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    place = F.row_number().over(W.partitionBy(*keys, "_bucket").orderBy(*order)) - 1
    return (
        dealt.withColumn("_place", place.cast("long"))
        .join(starts, [*keys, "_bucket"])
        .withColumn(name, F.col("_start") + F.col("_place"))
        .drop("_bucket", "_place", "_start")
    )


# Rolling hashes of word sequences -------------------------------------------------

_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def _byte_codes() -> np.ndarray:
    return np.random.default_rng(20240229).integers(1, 1 << 63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class WordHasher:
    """64-bit hashes of every run of ``words`` consecutive words of a text."""

    def __init__(self, words: int):
        self.words = words
        self.codes = _byte_codes()
        self.inverse = pow(_BASE, -1, 1 << 64)
        self._grow(1 << 14)

    def _grow(self, size: int) -> None:
        with np.errstate(over="ignore"):
            full = np.full(size, _BASE, dtype=np.uint64)
            full[0] = 1
            self.powers = np.multiply.accumulate(full)
            full = np.full(size, self.inverse, dtype=np.uint64)
            full[0] = 1
            self.inverses = np.multiply.accumulate(full)

    def shingles(self, body: bytes) -> np.ndarray:
        """Sorted distinct hashes; fewer words than ``words`` give one, no words none.

        Words are what stands between white space, lower case A-Z; the hash covers the
        bytes of the words and one space between two.
        """
        words = body.translate(LOWER).split()
        if not words:
            return np.empty(0, dtype=np.uint64)
        joined = np.frombuffer(b" ".join(words), dtype=np.uint8)
        n = len(joined)
        if n + 1 > len(self.powers):
            self._grow(1 << (n + 1).bit_length())
        with np.errstate(over="ignore"):
            sums = np.zeros(n + 1, dtype=np.uint64)
            np.cumsum(self.codes[joined] * self.powers[:n], out=sums[1:])
            gaps = np.flatnonzero(joined == 32)
            starts = np.concatenate(([0], gaps + 1))
            ends = np.concatenate((gaps, [n]))
            if len(words) >= self.words:
                ends = ends[self.words - 1 :]
                starts = starts[: len(ends)]
            else:
                starts, ends = starts[:1], ends[-1:]
            mixed = (sums[ends] - sums[starts]) * self.inverses[starts] + (ends - starts).astype(np.uint64)
            mixed ^= mixed >> np.uint64(32)
            mixed *= np.uint64(0xD6E8FEB86659FD93)
            mixed ^= mixed >> np.uint64(32)
        return np.unique(mixed)
