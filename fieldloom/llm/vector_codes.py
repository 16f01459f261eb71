"""Vector code compression: one codebook per part of the vectors, nearest entries found by LAESA pivots."""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldloom.llm.common import importable, stage

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: Fixed pivots of a part position.
PIVOTS = 4
#: Pivot distances are kept as 32-bit floats: a bound gives way by this share of the two distances it comes from.
SLACK = 2.5e-7
SALTS = 16


@dataclass
class Codebooks:
    """``entries[part]``: (entries, width) integers; vectors of ``length`` are padded with zeros to equal parts."""

    length: int
    entries: list[np.ndarray]

    @property
    def width(self) -> int:
        return self.entries[0].shape[1]

    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(c) for book in self.entries for c in book.ravel().tolist()).encode()).hexdigest()

    def decoded(self, code: str) -> list[int]:
        """The integers that a code stands for, entry after entry."""
        out = [c for j, book in enumerate(self.entries) for c in book[int(code[2 * j : 2 * j + 2], 16)].tolist()]
        return out[: self.length]


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distance of each row of ``x`` to each row of ``y``, in exact integers."""
    return np.stack([((x - row) ** 2).sum(axis=1) for row in y], axis=1)


def fixed_pivots(book: np.ndarray, pivots: int) -> np.ndarray:
    """Entries far from each other: the first one, then those of the greatest summed distance to the pivots so far."""
    chosen, far = [0], np.sqrt(distances(book, book[:1])[:, 0].astype(float))
    while len(chosen) < min(pivots, len(book)):
        far[chosen] = -1.0
        chosen.append(int(far.argmax()))
        far += np.sqrt(distances(book, book[chosen[-1:]])[:, 0].astype(float))
    return book[chosen]


def nearest(x: np.ndarray, to_pivots: np.ndarray, book: np.ndarray, book_to_pivots: np.ndarray):
    """(entry, squared distance, evaluations): the nearest entry of each row, ties to the lower index.

    The difference of two distances to one pivot is a lower bound of the distance.  Entries
    are met in the order of their largest bound; a row is done when the bound of its next
    entry exceeds the best exact distance, and only the other rows are evaluated.
    """
    rows, k = len(x), len(book)
    bound = np.zeros((rows, k))
    for p in range(to_pivots.shape[1]):
        a, b = to_pivots[:, p, None].astype(float), book_to_pivots[None, :, p]
        np.maximum(bound, np.abs(a - b) - SLACK * (a + b), out=bound)
    order = np.argsort(bound, axis=1, kind="stable")
    best = np.full(rows, np.iinfo(np.int64).max, dtype=np.int64)
    code = np.full(rows, k, dtype=np.int64)
    open_rows, evaluated = np.arange(rows), 0
    for turn in range(k):
        entry = order[open_rows, turn]
        alive = bound[open_rows, entry] <= np.sqrt(best[open_rows].astype(float)) * (1 + 1e-9)
        open_rows, entry = open_rows[alive], entry[alive]
        if not len(open_rows):
            break
        evaluated += len(open_rows)
        d = ((x[open_rows] - book[entry]) ** 2).sum(axis=1)
        better = (d < best[open_rows]) | ((d == best[open_rows]) & (entry < code[open_rows]))
        best[open_rows[better]], code[open_rows[better]] = d[better], entry[better]
    return code, best, evaluated


def _limit(length: int) -> int:
    """The largest absolute integer component whose squared distances over a whole vector fit 64 bits."""
    return min(math.isqrt((2**63 - 1) // max(length, 1)) // 2 - 1, 2**31 - 1)


def _parts(floats: np.ndarray, scale: int, parts: int, width: int) -> np.ndarray:
    """(rows, parts, width) integers of (rows, length) components."""
    whole = np.floor(floats * float(scale))
    if len(whole) and np.abs(whole).max() > _limit(parts * width):
        raise ValueError(f"a component times {scale} exceeds {_limit(parts * width)}: squared distances would leave 64 bits")
    out = np.zeros((len(whole), parts * width), dtype=np.int64)
    out[:, : whole.shape[1]] = whole
    return out.reshape(len(whole), parts, width)


def _usable(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    rows = vectors.select(
        F.col(f"`{id_col}`").alias("vec_id"),
        F.col(f"`{vector_col}`").cast("array<double>").alias("vector"),
        F.col(f"`{label_col}`").alias("label"),
    )
    infinite = F.lit(float("inf"))
    return rows.filter(F.col("vector").isNotNull()).filter(
        ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == infinite))
    )


def _with_pivots(usable: DataFrame, first: Codebooks, scale: int, pivots: int) -> DataFrame:
    """(vec_id, label, ints, far): the integers of every vector and its parts' distances to their fixed pivots, once."""
    parts, width, length = len(first.entries), first.width, first.length
    fixed = [fixed_pivots(book, pivots) for book in first.entries]
    schema = T.StructType([usable.schema["vec_id"], usable.schema["label"]])
    schema = schema.add("ints", T.ArrayType(T.IntegerType())).add("far", T.ArrayType(T.FloatType()))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            floats = batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, length)
            x = _parts(floats, scale, parts, width)
            far = [np.sqrt(distances(x[:, j], fixed[j]).astype(float)) for j in range(parts)]
            columns = [np.ascontiguousarray(x.reshape(len(x), -1), dtype=np.int32), np.concatenate(far, axis=1).astype(np.float32)]
            lists = [pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * c.shape[1], pa.array(c.ravel())) for c in columns]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), *lists], names=schema.names)

    return stage(usable.filter(F.size("vector") == length).mapInArrow(run, schema), "vector-parts")


def _assigned(batch, books: Codebooks, book_to_pivots: list[np.ndarray]):
    """Per part position: the integers of a batch, their entries and squared distances."""
    parts, rows = len(books.entries), batch.num_rows
    x = batch.column("ints").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(rows, parts, books.width)
    far = batch.column("far").flatten().to_numpy(zero_copy_only=False).reshape(rows, parts, -1)
    for j, book in enumerate(books.entries):
        code, error, _ = nearest(x[:, j], far[:, j], book, book_to_pivots[j])
        yield j, x[:, j], code, error


def _entry_distances(books: Codebooks, fixed: list[np.ndarray]) -> list[np.ndarray]:
    return [np.sqrt(distances(book, pivot).astype(float)) for book, pivot in zip(books.entries, fixed, strict=True)]


def _round(rows: DataFrame, books: Codebooks, fixed: list[np.ndarray]) -> Codebooks:
    """The codebooks after one round: each entry the floor of the mean of its parts, unused ones as they are.

    A task adds up its own rows, so what is shuffled is one line per task, part, entry and
    position; what the driver reads is the codebooks' size.
    """
    book_to_pivots = _entry_distances(books, fixed)

    def run(batches):
        import pyarrow as pa

        sums = [np.zeros(book.shape, dtype=np.int64) for book in books.entries]
        counts = [np.zeros(len(book), dtype=np.int64) for book in books.entries]
        for batch in batches:
            for j, x, code, _ in _assigned(batch, books, book_to_pivots):
                counts[j] += np.bincount(code, minlength=len(counts[j]))
                np.add.at(sums[j], code, x)
        place = [(j, e, i) for j, book in enumerate(books.entries) for e in range(len(book)) for i in range(books.width) if counts[j][e]]
        yield pa.RecordBatch.from_pydict(
            {
                "part": pa.array([j for j, _, _ in place], pa.int32()),
                "entry": pa.array([e for _, e, _ in place], pa.int32()),
                "position": pa.array([i for _, _, i in place], pa.int32()),
                "total": pa.array([int(sums[j][e, i]) for j, e, i in place], pa.int64()),
                "n": pa.array([int(counts[j][e]) for j, e, _ in place], pa.int64()),
            }
        )

    partial = rows.select("ints", "far").mapInArrow(run, "part int, entry int, position int, total long, n long")
    entries = [book.copy() for book in books.entries]
    for row in partial.groupBy("part", "entry", "position").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():
        entries[row.part][row.entry, row.position] = row.total // row.n
    return Codebooks(books.length, entries)


def compress(
    vectors: DataFrame,
    scale: int = SCALE,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    pivots: int = PIVOTS,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> tuple[DataFrame, Codebooks | None]:
    """((vec_id, label, code, error), codebooks): every vector as one entry number per part.

    Components become integers ``floor(scale * x)``, vectors ``parts`` equal pieces.  The
    codebook of a piece starts with that piece of the ``entries`` smallest ids; in each of
    ``rounds`` rounds every piece goes to its nearest entry and every entry becomes the
    floor of the mean of its pieces.  ``code`` holds two hex digits a part, ``error`` the
    squared distance over all parts.  All arithmetic that decides is in integers, so the
    result does not depend on how rows are dealt.

    Rows with a null vector, or with null or non-finite components, fall away; so do
    vectors of another length than the one that the smallest id has.  Lengths that
    ``parts`` does not divide are padded with zeros behind.  Rows that repeat an id are
    coded each; among them the smaller vector comes first, null ids come last, where
    the first entries are taken.  With fewer rows than entries the codebooks are that
    much smaller; a table without usable rows gives no row and no codebooks.  A
    component too large for exact 64-bit distances (about 46,000 at 64 dimensions) is
    refused with an error.  Other columns are not read.

    Distances to the fixed pivots (far entries of the first codebooks) are worked out
    once and written beside the integers; rounds read that table.  Tasks add up their
    own rows, and the driver reads the codebooks only.
    """
    spark = vectors.sparkSession
    importable(spark)
    usable = _usable(vectors, id_col, vector_col, label_col)
    start = usable.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).select("vector").collect()
    if not start:
        return usable.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")).filter("false"), None
    length = len(start[0].vector)
    width = max(1, -(-length // parts))
    chosen = [row.vector for row in start if len(row.vector) == length]
    if len(chosen) < len(start):
        same = usable.filter(F.size("vector") == length)
        chosen = [r.vector for r in same.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).collect()]
    first = _parts(np.array(chosen, dtype=float).reshape(len(chosen), length), scale, parts, width)
    books = Codebooks(length, [first[:, j].copy() for j in range(parts)])
    fixed = [fixed_pivots(book, pivots) for book in books.entries]
    rows = _with_pivots(usable, books, scale, pivots)
    for _ in range(rounds):
        before, books = books, _round(rows, books, fixed)
        if all(np.array_equal(a, b) for a, b in zip(before.entries, books.entries, strict=True)):
            break  # further rounds would change nothing
    return _coded(rows, books, fixed), books


def _coded(rows: DataFrame, books: Codebooks, fixed: list[np.ndarray]) -> DataFrame:
    book_to_pivots = _entry_distances(books, fixed)
    schema = T.StructType([rows.schema["vec_id"], rows.schema["label"]]).add("code", "string").add("error", "long")

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            codes = np.zeros((batch.num_rows, len(books.entries)), dtype=np.uint8)
            errors = np.zeros(batch.num_rows, dtype=np.int64)
            for j, _, code, error in _assigned(batch, books, book_to_pivots):
                codes[:, j] = code
                errors += error
            text = pa.array([row.tobytes().hex() for row in codes], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), text, pa.array(errors)], names=schema.names)

    return rows.mapInArrow(run, schema)


def decompress(coded: DataFrame, books: Codebooks, scale: int = SCALE) -> DataFrame:
    """``coded`` with ``approximation``: the vector that each code stands for."""
    entries = F.array(*[F.array(*[F.array(*[F.lit(c / scale) for c in e]) for e in book.tolist()]) for book in books.entries])
    pieces = F.transform(
        F.sequence(F.lit(0), F.lit(len(books.entries) - 1)),
        lambda j: F.get(F.get(entries, j), F.conv(F.substring("code", 2 * j + 1, F.lit(2)), 16, 10).cast("int")),
    )
    return coded.withColumn("approximation", F.slice(F.flatten(pieces), 1, books.length))


def vector_codes(vectors: DataFrame, **options) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every usable vector, see :func:`compress`.

    ``label_error`` sums the errors of all vectors with the same label, null labels
    together.  A label may hold most rows: sums are combined before the shuffle and go
    back by (label, salt), so no label meets in one task.
    """
    coded, books = compress(vectors, **options)
    if books is None:
        return coded.select("vec_id", "code", "error", F.col("error").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    coded = stage(coded, "vector-codes")
    salt = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    sums = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumn("salt", salt)
    rows = coded.withColumn("salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)).cast("int")).alias("r")
    sums = sums.alias("s")
    joined = rows.join(sums, F.col("r.label").eqNullSafe(F.col("s.label")) & (F.col("r.salt") == F.col("s.salt")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))


def _oracle(rounds: int = ROUNDS) -> str:
    """The same in SQL: every distance of every round worked out."""
    steps = ["b0 AS MATERIALIZED (SELECT j, row_number() OVER (PARTITION BY j ORDER BY vec_id) - 1 AS e, part FROM p QUALIFY e < 16)"]
    square = "list_sum(list_transform(range(1, len(p.part) + 1), lambda i: (p.part[i] - b.part[i]) * (p.part[i] - b.part[i])))::BIGINT"
    for r in range(rounds + 1):
        steps.append(
            f"""a{r} AS MATERIALIZED (SELECT vec_id, label, j, any_value(part) AS part, min(m) AS m FROM (
  SELECT p.vec_id, p.label, p.j, p.part, {{'d': {square}, 'e': b.e}} AS m FROM p JOIN b{r} b USING (j)) GROUP BY vec_id, label, j)"""
        )
        if r < rounds:
            steps.append(
                f"""s{r} AS (SELECT j, e, list((t - ((t % c) + c) % c) // c ORDER BY i) AS part FROM (
  SELECT j, m.e AS e, i, sum(part[i])::BIGINT AS t, count(*) AS c FROM a{r}, (SELECT unnest(range(1, 1 + (SELECT max(len(part)) FROM p))) AS i)
  GROUP BY ALL) GROUP BY j, e)"""
            )
            steps.append(f"b{r + 1} AS MATERIALIZED (SELECT j, e, coalesce(s.part, b.part) AS part FROM b{r} b LEFT JOIN s{r} s USING (j, e))")
    return f"""
WITH v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS whole FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS MATERIALIZED (
  SELECT vec_id, label, j, whole[(j * len(whole)) // 8 + 1 : ((j + 1) * len(whole)) // 8] AS part FROM v, (SELECT unnest(range(8)) AS j)
), {", ".join(steps)},
books AS (SELECT sha256(string_agg(array_to_string(part, ','), ',' ORDER BY j, e)) AS codebooks_sha256 FROM b{rounds}),
coded AS (SELECT vec_id, label, string_agg(printf('%02x', m.e), '' ORDER BY j) AS code, sum(m.d)::BIGINT AS error FROM a{rounds} GROUP BY vec_id, label)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM coded, books
"""


ORACLE = _oracle()
