"""Documents packed into token windows by non-negative least squares over length combinations."""

from __future__ import annotations

import zlib
from collections import Counter
from itertools import combinations_with_replacement

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from fieldloom.llm.common import by_rows, ranked, stage, texts

WINDOW = 4096
END = 2
TOKENIZER = "word_bpe_49k.json"
#: Combinations of three draw two of their lengths from so many of the most frequent ones.
FREQUENT = 96
SWEEPS = 40


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def tokenized(docs: DataFrame, path: str, end: int = END) -> DataFrame:
    """(doc_id, n, ids): the ids of each text and the closing id, little-endian, two or four bytes each."""

    def process(key, body):
        from fieldloom.llm.wordpieces import encoder

        words = encoder(path)
        ids = words.ids(body.decode("utf-8", "replace")) + np.array([end], dtype=words.type).tobytes()
        yield key, len(ids) // int(words.type[-1]), int(words.type[-1]), ids

    schema = "doc_id long, n long, width int, ids binary"
    return texts(docs).mapInArrow(by_rows(process, schema), schema)


def combinations(histogram: dict[int, int], window: int, frequent: int = FREQUENT) -> list[tuple[int, ...]]:
    """Two or three lengths that fill the window exactly, each of them present."""
    lengths = sorted(histogram)
    found = {(a, window - a) for a in lengths if a <= window - a and window - a in histogram}
    often = sorted(sorted(histogram, key=lambda n: (-histogram[n], n))[:frequent])
    for a, b in combinations_with_replacement(often, 2):
        if window - a - b in histogram:
            found.add(tuple(sorted((a, b, window - a - b))))
    return sorted(found)


def repeats(histogram: dict[int, int], columns: list[tuple[int, ...]], sweeps: int = SWEEPS) -> list[float]:
    """Non-negative x that minimises |A x - h|, A[n, c] = how often c holds n: cyclic coordinate descent."""
    left = {n: float(k) for n, k in histogram.items()}
    parts = [list(Counter(c).items()) for c in columns]
    norms = [sum(k * k for _, k in p) for p in parts]
    x = [0.0] * len(columns)
    for _ in range(sweeps):
        moved = 0.0
        for c, part in enumerate(parts):
            new = max(0.0, x[c] + sum(k * left[n] for n, k in part) / norms[c])
            if step := new - x[c]:
                for n, k in part:
                    left[n] -= k * step
                x[c] = new
                moved = max(moved, abs(step))
        if moved < 0.01:
            break
    return x


def planned(histogram: dict[int, int], window: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Whole repeats of the combinations: (length, first rank, end rank, first sequence, offset); sequences used."""
    columns = combinations(histogram, window)
    x = repeats(histogram, columns)
    free, times = dict(histogram), {}
    fits = lambda c: min(free[n] // k for n, k in Counter(c).items())
    for wanted in (lambda i: int(x[i] + 0.5), lambda i: 1 << 62):  # rounded, then what still fits whole
        for i in sorted(range(len(columns)), key=lambda i: (-x[i], i)):
            if k := min(wanted(i), fits(columns[i])):
                times[i] = times.get(i, 0) + k
                for n in columns[i]:
                    free[n] -= k
    used, rows, sequence = Counter(), [], 0
    for i, k in sorted(times.items()):
        offset = 0
        for n in columns[i]:
            rows.append((n, used[n], used[n] + k, sequence, offset))
            used[n] += k
            offset += n
        sequence += k
    return rows, sequence


def _running(df: DataFrame, weight: str, buckets: int, name: str) -> DataFrame:
    """The sum of ``weight`` over the rows before, in an order of buckets: no task sees all rows."""
    dealt = df.withColumn("_bucket", F.pmod(F.xxhash64("nid"), F.lit(buckets)).cast("int"))
    sums = dealt.groupBy("_bucket").agg(F.sum(weight).alias("_sum"))
    before = W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = sums.select("_bucket", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    within = W.partitionBy("_bucket").orderBy("nid").rowsBetween(W.unboundedPreceding, -1)
    return (
        dealt.withColumn("_before", F.coalesce(F.sum(weight).over(within), F.lit(0)))
        .join(starts, "_bucket")
        .withColumn(name, (F.col("_start") + F.col("_before")).cast("long"))
        .drop("_bucket", "_before", "_start")
    )


def pack(docs: DataFrame, path: str | None = None, window: int = WINDOW, end: int = END) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, kind, ids, width.

    A text's ids are those of the tokenizer at ``path`` plus the id ``end``; null counts
    as an empty text, which is that id alone.  Rows that repeat a doc_id are packed each
    for itself.  An empty table gives no piece; other columns are not read.

    Whole windows of a long document are sequences of their own.  The histogram of what
    is left (fewer bins than ``window``, so bounded) goes to the driver, which enumerates
    combinations of two or three lengths that fill a window, solves for their repeats by
    non-negative least squares and rounds.  Documents meet their place by their rank
    within their length.  What no combination takes is laid end to end and cut at each
    window; the end of that is cut into powers of two, so no sequence needs padding.
    """
    spark = docs.sparkSession
    path = path or tokenizer_path()
    held = stage(tokenized(docs, path, end).withColumn("nid", F.monotonically_increasing_id()), "tokens")
    sizes = held.select("nid", "n", (F.col("n") % window).alias("rest"), F.expr(f"n div {window}").alias("wholes"))
    counts = sizes.groupBy("rest").agg(F.count("*").alias("rows"), F.sum("wholes").alias("wholes")).collect()
    histogram = {r["rest"]: r["rows"] for r in counts if r["rest"]}
    n_rows, n_wholes = sum(r["rows"] for r in counts), sum(r["wholes"] for r in counts)
    buckets = max(16, n_rows // 20_000)
    rows, combined = planned(histogram, window)
    by_length: dict[int, list] = {}
    for n, *place in rows:
        by_length.setdefault(n, []).append(tuple(place))
    places = spark.createDataFrame(
        [(n, p) for n, p in by_length.items()],
        "rest long, places array<struct<lo:long,hi:long,sequence:long,offset:long>>",
    )

    whole_rows = _running(sizes.filter("wholes > 0"), "wholes", buckets, "before")
    whole = whole_rows.select("nid", "before", F.posexplode(F.sequence(F.lit(0), (F.col("wholes") - 1).cast("int"))).alias("k", "_")).select(
        "nid",
        (F.col("k") * window).cast("long").alias("start"),
        F.lit(window).cast("long").alias("length"),
        (F.lit(combined) + F.col("before") + F.col("k")).cast("long").alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
        F.lit("window").alias("kind"),
    )
    rests = ranked(sizes.filter("rest > 0"), ["rest"], [F.col("nid")], F.xxhash64("nid"), buckets)
    placed = rests.join(places, "rest", "left").withColumn(
        "place", F.expr("get(filter(places, p -> p.lo <= rank and rank < p.hi), 0)")
    )
    placed = stage(placed.select("nid", "n", "rest", "rank", "place"), "places", n_rows)
    start = F.col("n") - F.col("rest")
    fitted = placed.filter("place is not null").select(
        "nid",
        start.alias("start"),
        F.col("rest").alias("length"),
        (F.col("place.sequence") + F.col("rank") - F.col("place.lo")).alias("sequence_id"),
        F.col("place.offset").alias("offset"),
        F.lit("combination").alias("kind"),
    )
    loose = sum(histogram.values()) - sum(r[2] - r[1] for r in rows)
    tokens = sum(n * k for n, k in histogram.items()) - sum(r[0] * (r[2] - r[1]) for r in rows)
    # cuts of the residual stream: every window, then powers of two
    tail, at = [], tokens - tokens % window
    for bit in range(window.bit_length(), -1, -1):
        if (tokens % window) >> bit & 1:
            tail.append((at, 1 << bit))
            at += 1 << bit
    first = combined + n_wholes
    laid = _running(placed.filter("place is null").select("nid", "n", "rest"), "rest", max(16, loose // 20_000), "at")
    last = F.col("at") + F.col("rest")
    body = tokens - tokens % window
    cuts = F.expr(
        f"transform(sequence(at div {window}, greatest(at div {window}, (least(at + rest, {body}L) - 1) div {window})), "
        f"w -> struct(w * {window} as a, w * {window} + {window} as b, w as s))"
    )
    bodied = F.when(F.col("at") < body, cuts).otherwise(F.expr("cast(array() as array<struct<a:bigint,b:bigint,s:bigint>>)"))
    ends = F.array(*[F.struct(F.lit(a).cast("long").alias("a"), F.lit(a + k).cast("long").alias("b"), F.lit(body // window + i).cast("long").alias("s")) for i, (a, k) in enumerate(tail)]) if tail else None
    spans = F.concat(bodied, ends) if tail else bodied
    cut = laid.select("nid", "n", "rest", "at", F.explode(spans).alias("c")).filter((F.col("c.a") < last) & (F.col("c.b") > F.col("at")))
    low, high = F.greatest("at", "c.a"), F.least(last, F.col("c.b"))
    residual = cut.select(
        "nid",
        (start + low - F.col("at")).alias("start"),
        (high - low).alias("length"),
        (F.lit(first) + F.col("c.s")).cast("long").alias("sequence_id"),
        (low - F.col("c.a")).alias("offset"),
        F.lit("residual").alias("kind"),
    )
    pieces = whole.unionByName(fitted).unionByName(residual)
    return _with_ids(pieces.join(held, "nid"))


def _with_ids(pieces: DataFrame) -> DataFrame:
    """Cut the ids of each piece out of its document's and sum them up."""
    schema = T.StructType.fromDDL(
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, kind string, width int, ids binary"
    )

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(schema)
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                column = lambda name: batch.column(batch.schema.get_field_index(name))  # noqa: B023, E731
                sums, cuts = [], []
                for ids, width, start, length in zip(*(column(c).to_pylist() for c in ("ids", "width", "start", "length")), strict=True):
                    cut = ids[start * width : (start + length) * width]
                    cuts.append(cut)
                    sums.append(zlib.crc32(np.frombuffer(cut, dtype=f"<u{width}").astype("<u4").tobytes()))
                made = {"ids_crc32": pa.array(sums, pa.int64()), "ids": pa.array(cuts, pa.binary()), "doc_tokens": column("n")}
                yield pa.RecordBatch.from_arrays([(made[f.name] if f.name in made else column(f.name)).cast(f.type) for f in target], schema=target)

    return pieces.mapInArrow(run, schema)
