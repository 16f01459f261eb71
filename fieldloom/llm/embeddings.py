"""Near-duplicate vectors by cross-polytope hashing, with multiprobe buckets and verified pairs."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.llm.common import importable, stage
from fieldloom.llm.components import components

COSINE = 0.9
#: The share of pairs at exactly the threshold that the tables are made for; nearer pairs meet more often.
RECALL = 0.99
PROBES = 4
#: Rows of one side of a block; larger buckets are compared block against block.
BLOCK = 1024
SEED = 11
#: Pairs at the threshold drawn to see how often a table lets them meet.
TRIALS = 4000


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of each row; the width is a power of two."""
    n, width = x.shape
    half = 1
    while half < width:
        x = x.reshape(n, width // (2 * half), 2, half)
        x = np.stack((x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]), axis=2)
        half *= 2
    return x.reshape(n, width) / math.sqrt(width)


class CrossPolytope:
    """Buckets of unit vectors: per table, ``depth`` nearest signed axes after random rotations."""

    def __init__(self, width: int, depth: int, tables: int, probes: int = PROBES, seed: int = SEED):
        self.width = 1 << max(1, (width - 1).bit_length())
        self.depth, self.tables, self.probes = depth, tables, probes
        rng = np.random.default_rng([seed, self.width])
        self.signs = rng.choice((-1.0, 1.0), size=(tables, depth, 3, self.width))

    def buckets(self, units: np.ndarray) -> np.ndarray:
        """(rows, tables, 1 + probes) bucket numbers; the probes change the closest calls."""
        padded = np.zeros((len(units), self.width))
        padded[:, : units.shape[1]] = units
        rows = np.arange(len(units))
        out = np.empty((len(units), self.tables, 1 + self.probes), dtype=np.int64)
        for t in range(self.tables):
            first, others, gaps = [], [], []
            for k in range(self.depth):
                x = padded
                for sign in self.signs[t, k]:
                    x = hadamard(x * sign)
                size = np.abs(x)
                order = np.argsort(-size, axis=1, kind="stable")[:, : 1 + self.probes]
                code = 2 * order + (x[rows[:, None], order] < 0)
                first.append(code[:, 0])
                for r in range(1, order.shape[1]):
                    others.append((k, code[:, r]))
                    gaps.append(size[rows, order[:, 0]] - size[rows, order[:, r]])
            base = np.zeros(len(units), dtype=np.int64)
            for code in first:
                base = base * (2 * self.width) + code
            out[:, t, 0] = base
            closest = np.argsort(np.stack(gaps, axis=1), axis=1, kind="stable")[:, : self.probes]
            moved = np.stack(
                [base + (code - first[k]) * (2 * self.width) ** (self.depth - 1 - k) for k, code in others], axis=1
            )
            out[:, t, 1:] = np.take_along_axis(moved, closest, axis=1)
        return out


def fitted(n: int, width: int, cosine: float = COSINE, recall: float = RECALL, probes: int = PROBES) -> tuple[int, int]:
    """(depth, tables): about as many buckets as vectors; tables enough for the recall, from drawn pairs."""
    padded = 1 << max(1, (width - 1).bit_length())
    depth = min(max(1, math.ceil(math.log(max(n, 2)) / math.log(2 * padded))), 62 // (2 * padded).bit_length())
    rng = np.random.default_rng(SEED + 1)
    x, y = rng.normal(size=(2, TRIALS, padded))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y -= x * (x * y).sum(axis=1, keepdims=True)
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    y = cosine * x + math.sqrt(1 - cosine * cosine) * y
    one = CrossPolytope(padded, depth, 1, min(probes, depth * (padded - 1)))
    a, b = one.buckets(x)[:, 0], one.buckets(y)[:, 0]
    meet = max((a[:, :, None] == b[:, None, :]).any(axis=(1, 2)).mean(), 1 / TRIALS)
    return depth, max(1, math.ceil(math.log(1 - recall) / math.log(1 - meet))) if meet < 1 else 1


def _unit(arrays) -> np.ndarray:
    x = np.array(arrays, dtype=np.float64)
    # scaled first, so that neither very large nor very small components lose their square
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _hashed(hashers: dict[int, CrossPolytope]):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                by_width: dict[int, list[tuple[int, list]]] = {}
                for key, vector in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    by_width.setdefault(len(vector), []).append((key, vector))
                for width, rows in sorted(by_width.items()):
                    hasher = hashers[width]
                    found = hasher.buckets(_unit([v for _, v in rows])).reshape(len(rows), -1)
                    # one number for (width, table, bucket)
                    table = np.repeat(np.arange(hasher.tables), 1 + hasher.probes)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([k for k, _ in rows], pa.int64()),
                            pa.array([[f"{width}/{t}/{b}" for t, b in zip(table, row, strict=True)] for row in found.tolist()], pa.list_(pa.string())),
                        ],
                        names=["rep", "codes"],
                    )

    return run


def _linked(cosine: float):
    """Verified links of each block: (rep, n_links, root) for every row that has one."""

    def block(rows):
        reps = [r["rep"] for r in rows]
        units = _unit([r["embedding"] for r in rows])
        sides = np.array([r["block"] == r["hi"] for r in rows])
        close = units @ units.T >= cosine
        np.fill_diagonal(close, False)
        if rows[0]["lo"] != rows[0]["hi"]:
            close &= sides[:, None] != sides[None, :]  # pairs inside one side belong to its own block
        parent = list(range(len(rows)))

        def root(i):
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        counts = [0] * len(rows)
        codes = [set(r["codes"]) for r in rows]
        bucket = rows[0]["bucket"]
        for i, j in zip(*np.nonzero(np.triu(close)), strict=True):
            x, y = root(int(i)), root(int(j))
            if x != y:
                low, high = (x, y) if reps[x] < reps[y] else (y, x)
                parent[high] = low
            # a pair that meets in several buckets counts in the first of them
            if bucket == min(codes[i] & codes[j]):
                counts[i] += rows[j]["n"]
                counts[j] += rows[i]["n"]
        for i, r in enumerate(rows):
            if close[i].any():
                yield reps[i], counts[i], reps[root(i)]

    def run(batches):
        import pyarrow as pa

        def made(out):
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["rep", "n_links", "root"])

        held, key, out = [], None, []
        for batch in batches:
            for row in batch.to_pylist():
                here = (row["bucket"], row["lo"], row["hi"])
                if here != key:
                    out.extend(block(held) if len(held) > 1 else ())
                    held, key = [], here
                    if len(out) > 20_000:
                        yield made(out)
                        out = []
                held.append(row)
        out.extend(block(held) if len(held) > 1 else ())
        if out:
            yield made(out)

    return run


def near_duplicate_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = COSINE, recall: float = RECALL
) -> DataFrame:
    """(vec_id, n_links, component_id, kept): one row for each row of ``vectors``.

    Vectors link when their cosine, in double precision, is ``cosine`` or more.  Null,
    empty and zero vectors and vectors with a null or non-finite component link with
    nothing, nor do vectors of different widths.  ``n_links`` counts the other rows that
    link directly, ``component_id`` is the smallest vec_id reachable, ``kept`` says that
    it is the row's own.  A null vec_id is no component of its own: a row without links
    has itself, so null; kept is true there.  An empty table gives an empty result; other
    columns, labels too, are not read.

    Equal vectors are one class, combined before the shuffle.  Classes are hashed into
    tables of buckets; narrow rows (bucket, class) show which buckets are shared, and
    only their vectors travel.  Buckets of more than BLOCK classes are compared block
    against block, so no task holds a whole one.  A block gives counts and a root per
    class, never its pairs.
    """
    spark = vectors.sparkSession
    importable(spark)
    rows = vectors.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("embedding"))
    largest = F.array_max(F.transform("embedding", F.abs))
    sound = (
        F.col("embedding").isNotNull()
        & (F.size("embedding") > 0)
        & ~F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
        & (largest > 0)
    )
    rows = rows.withColumn("embedding", F.when(F.coalesce(sound, F.lit(False)), F.col("embedding")))
    valid = rows.filter("embedding is not null")
    classes = stage(
        valid.groupBy("embedding")
        .agg(F.min("vec_id").alias("least"), F.count("*").alias("n"))
        .withColumn("rep", F.monotonically_increasing_id()),
        "vector-classes",
    )
    widths = classes.groupBy(F.size("embedding").alias("width")).count().collect()
    hashers = {}
    for r in widths:
        depth, tables = fitted(r["count"], r["width"], cosine, recall)
        padded = 1 << max(1, (r["width"] - 1).bit_length())
        hashers[r["width"]] = CrossPolytope(r["width"], depth, tables, min(PROBES, depth * (padded - 1)))
    codes = stage(classes.select("rep", "embedding").mapInArrow(_hashed(hashers), "rep long, codes array<string>"), "vector-codes")
    entries = codes.select("rep", F.explode(F.array_distinct("codes")).alias("bucket"))
    sizes = entries.groupBy("bucket").agg(F.count("*").alias("members")).filter("members > 1")
    shared = (
        entries.join(sizes, "bucket")
        .withColumn("blocks", F.ceil(F.col("members") / BLOCK).cast("int"))
        .withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
        .select("bucket", "rep", "block", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"))
    )
    full = shared.join(classes.select("rep", "n", "embedding").join(codes, "rep"), "rep")
    links = stage(
        full.repartition("bucket", "lo", "hi")
        .sortWithinPartitions("bucket", "lo", "hi")
        .select("bucket", "lo", "hi", "block", "rep", "n", "embedding", "codes")
        .mapInArrow(_linked(cosine), "rep long, n_links long, root long"),
        "vector-links",
    )
    labels = components(links.filter("rep <> root").select(F.col("rep").alias("a"), F.col("root").alias("b")))
    # components are numbered by class; their smallest vec_id is what counts
    named = labels.join(classes.select(F.col("rep").alias("node"), "least"), "node")
    named = named.join(named.groupBy("component").agg(F.min("least").alias("component_id")), "component").select(F.col("node").alias("rep"), "component_id")
    counted = links.groupBy("rep").agg(F.sum("n_links").alias("linked"))
    known = (
        classes.join(counted, "rep", "left")
        .join(named, "rep", "left")
        .select(
            "embedding",
            (F.col("n") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"),
            F.coalesce("component_id", "least").alias("component_id"),
        )
    )
    return (
        rows.join(known, "embedding", "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).alias("n_links"),
            F.coalesce("component_id", "vec_id").alias("component_id"),
        )
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    )
