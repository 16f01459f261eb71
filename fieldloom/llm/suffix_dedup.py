"""Bytes of texts that stand earlier in the corpus, found by suffix arrays of aligned blocks."""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from fieldloom.llm.common import _BASE, _byte_codes, importable, stage, texts
from fieldloom.llm.suffixes import block, repeated_starts

#: Length in bytes of a string that counts as repeated.
LENGTH = 100
#: Bytes of an anchor; every string of LENGTH bytes holds LENGTH - GRAM + 1 of them.
GRAM = 32
#: Bytes of contexts sorted at once.  A whole anchor group goes into one block, up to GROUP contexts;
#: the strings of larger groups are spread by their digests instead, with the same result.
BLOCK_BYTES = 1 << 20
GROUP = 16_384
#: Bytes of texts that are anchored at once, about, and texts whose spans are cut at once.
ROW_BYTES = 1 << 17
TEXTS = 64

ANCHORS = "doc_id long, u long, h long, at long, back int, more int"
CONTEXTS = "doc_id long, u long, h long, c binary, lo long, size int"


def anchors(body: bytes, length: int = LENGTH, gram: int = GRAM, begins: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """(hash, place, first string, last string) for each anchor of a text, or of texts in a row that begin at ``begins``.

    A string of ``length`` bytes is anchored at the leftmost of its grams of least hash, by the
    upper 32 bits, so equal strings are anchored alike wherever they stand.  An anchor owns
    the strings that start from its first to its last; no string reaches from one text into the next.
    """
    n = len(body)
    with np.errstate(over="ignore"):
        hashes = _byte_codes_cached()[np.frombuffer(body, dtype=np.uint8)]
        size, power = 1, _BASE
        while size < gram:
            hashes = hashes[:-size] * np.uint64(power) + hashes[size:]
            power = power * power & (1 << 64) - 1
            size *= 2
        hashes ^= hashes >> np.uint64(31)
        hashes *= np.uint64(0x9FB21C651E98DF25)
        hashes ^= hashes >> np.uint64(28)
    # the place stands in the lower bits, so the least is the leftmost of the least
    low = np.uint64((1 << 32) - 1)
    least, span, size = hashes & ~low | np.arange(len(hashes), dtype=np.uint64), length - gram + 1, 1
    while size < span:
        step = min(size, span - size)  # the last step overlaps what is already covered
        least = np.minimum(least[:-step], least[step:])
        size += step
    place = (least & low).astype(np.int64)
    starts = np.arange(n - length + 1)
    if begins is not None and len(begins) > 1:
        own = np.ones(len(starts), dtype=bool)
        own[begins[1:, None] - np.arange(1, length)] = False
        place, starts = place[own], starts[own]
    changes = np.flatnonzero(np.diff(place)) + 1
    first = np.concatenate(([0], changes))
    at = place[first]
    return hashes[at].view(np.int64), at, starts[first], starts[np.concatenate((changes - 1, [len(starts) - 1]))]


_CODES: list[np.ndarray] = []


def _byte_codes_cached() -> np.ndarray:
    if not _CODES:
        _CODES.append(_byte_codes())
    return _CODES[0]


def _keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, u, body): u tells texts of one doc_id apart."""
    return texts(docs, id_col, text_col).withColumn("u", F.xxhash64("body")).select("doc_id", "u", "body")


def _lengths(column) -> np.ndarray:
    """Of the bytes or the list in each row; null counts as empty."""
    import pyarrow as pa
    import pyarrow.compute as pc

    count = pc.list_value_length if pa.types.is_list(column.type) else pc.binary_length
    return pc.fill_null(count(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def _anchored(batches):
    import pyarrow as pa

    for batch in batches:
        if not batch.num_rows:
            continue
        ids, us, bodies = batch.columns
        sizes = _lengths(bodies)
        # texts in a row, about ROW_BYTES of them at once
        ends = np.flatnonzero(np.diff((np.cumsum(sizes) - sizes) // ROW_BYTES)) + 1
        for a, b in zip([0, *ends.tolist()], [*ends.tolist(), len(sizes)], strict=True):
            begins = np.cumsum(sizes[a:b]) - sizes[a:b]
            h, at, first, last = anchors(b"".join(bodies.slice(a, b - a).to_pylist()), begins=begins)
            own = np.searchsorted(begins, first, side="right") - 1
            whose = pa.array(own + a)
            columns = [ids.take(whose).cast(pa.int64()), us.take(whose), pa.array(h), pa.array(at - begins[own])]
            more = [pa.array((at - first).astype(np.int32)), pa.array((last - first).astype(np.int32))]
            yield pa.RecordBatch.from_arrays([*columns, *more], names=["doc_id", "u", "h", "at", "back", "more"])


def _stored(batches):
    """A few texts at a time: doc_id and u of each of their spans, the columns of the spans, and their bytes."""
    import pyarrow as pa

    for batch in batches:
        for start in range(0, batch.num_rows, TEXTS):
            part = batch.slice(start, TEXTS)
            spans = part.column(3)
            many = _lengths(spans)
            flat = spans.flatten()
            owner = np.repeat(np.arange(len(many)), many)
            columns = {f.name: flat.field(i) for i, f in enumerate(flat.type)}
            bodies, lo = part.column(2).to_pylist(), columns["lo"].to_pylist()
            cuts = [bodies[o][a : a + n] for o, a, n in zip(owner.tolist(), lo, columns["size"].to_pylist(), strict=True)]
            whose = pa.array(owner)
            yield {"doc_id": part.column(0).take(whose).cast(pa.int64()), "u": part.column(1).take(whose), **columns}, cuts


def _digested(batches):
    """Digests of the contexts of repeated anchors: the bytes of all strings an anchor owns."""
    import pyarrow as pa

    for columns, cuts in _stored(batches):
        columns["c"] = pa.array([hashlib.blake2b(c, digest_size=16).digest() for c in cuts], pa.binary())
        names = ["doc_id", "u", "h", "c", "lo", "size"]
        yield pa.RecordBatch.from_arrays([columns[n] for n in names], names=names)


def _cut(batches):
    import pyarrow as pa

    for columns, cuts in _stored(batches):
        columns["context"] = pa.array(cuts, pa.binary())
        names = ["doc_id", "u", "h", "lo", "crowd", "context"]
        yield pa.RecordBatch.from_arrays([columns[n] for n in names], names=names)


def _spans(rows: list[tuple], starts: np.ndarray, begins: np.ndarray, length: int):
    """Runs of repeated starts as (doc_id, u, lo, hi)."""
    if not len(starts):
        return
    owner = np.searchsorted(begins, starts, side="right") - 1
    breaks = np.flatnonzero((np.diff(starts) != 1) | (np.diff(owner) != 0)) + 1
    for a, b in zip(np.concatenate(([0], breaks)).tolist(), np.concatenate((breaks, [len(starts)])).tolist(), strict=True):
        key, u, lo = rows[int(owner[a])]
        base = lo - int(begins[owner[a]])
        yield key, u, base + int(starts[a]), base + int(starts[b - 1]) + length


def _sorted_blocks(length: int):
    """Suffix-sort whole anchor groups, a block of them at a time; rows come by group, earliest first."""

    def run(batches):
        import pyarrow as pa

        rows, contexts, held, last = [], [], 0, None

        def found():
            text, begins = block(contexts)
            out = list(_spans(rows, repeated_starts(text, length), begins, length))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["doc_id", "u", "lo", "hi"])

        for batch in batches:
            for key, u, h, lo, context in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if h != last and held > BLOCK_BYTES:
                    yield from found()
                    rows, contexts, held = [], [], 0
                last = h
                rows.append((key, u, lo))
                contexts.append(context)
                held += len(context) + 1
        if rows:
            yield from found()

    return run


def _strings(length: int):
    """Every string of a context with its digest: for groups too large for a block."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for key, u, lo, context in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                n = len(context) - length + 1
                digests = [hashlib.blake2b(context[i : i + length], digest_size=16).digest() for i in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key] * n, pa.int64()), pa.array([u] * n, pa.int64()), pa.array(range(lo, lo + n), pa.int64()), pa.array(digests, pa.binary())],
                    names=["doc_id", "u", "lo", "digest"],
                )

    return run


def _merged(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of spans that overlap or touch, ascending."""
    order = np.argsort(lo)
    lo, reach = lo[order], np.maximum.accumulate(hi[order])
    first = np.flatnonzero(np.concatenate(([True], lo[1:] > reach[:-1])))
    return lo[first], reach[np.concatenate((first[1:] - 1, [len(lo) - 1]))]


def _kept(batches):
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans) of each text and its repeated spans."""
    import pyarrow as pa

    for batch in batches:
        for start in range(0, batch.num_rows, 512):
            part = batch.slice(start, 512)
            bodies, spans = part.column(1).to_pylist(), part.column(2)
            sizes, many = np.array([len(b) for b in bodies], dtype=np.int64), _lengths(spans)
            # the texts side by side with a gap between two, so no run reaches into the next text
            begins = np.cumsum(sizes + 1) - sizes - 1
            shift = np.repeat(begins, many)
            flat = spans.flatten()
            lo, hi = (flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) + shift for i in range(2))
            if len(lo):
                lo, hi = _merged(lo, hi)
            own = np.searchsorted(begins, lo, side="right") - 1
            lo, hi = lo - begins[own], hi - begins[own]
            runs = np.bincount(own, minlength=len(bodies))
            ends = np.cumsum(runs)
            removed, digests, los, his = np.zeros(len(bodies), dtype=np.int64), [], lo.tolist(), hi.tolist()
            np.add.at(removed, own, hi - lo)
            for body, n, end in zip(bodies, runs.tolist(), ends.tolist(), strict=True):
                kept, free = hashlib.sha256(), 0
                for i in range(end - n, end):
                    kept.update(body[free : los[i]])
                    free = his[i]
                kept.update(body[free:])
                digests.append(kept.hexdigest())
            runs_of = pa.ListArray.from_arrays(
                pa.array(np.concatenate(([0], ends)), pa.int32()), pa.StructArray.from_arrays([pa.array(lo), pa.array(hi)], names=["lo", "hi"])
            )
            columns = [part.column(0).cast(pa.int64()), pa.array(sizes), pa.array(removed), pa.array(runs), pa.array(digests, pa.string()), runs_of]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<lo:long,hi:long>>"


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """(doc_id, u, lo, hi): spans of bytes covered by strings of ``length`` bytes that also start earlier.

    Earlier: in a smaller doc_id (null is the largest), or in the same one at an earlier
    start.  The spans of a document may overlap.
    """
    spark = docs.sparkSession
    importable(spark)
    keyed = _keyed(docs, id_col, text_col)
    order = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("doc_id"))
    # texts that another row with a smaller id repeats as a whole need no sorting
    sizes = stage(
        keyed.select("doc_id", "u", F.octet_length("body").cast("long").alias("n"), F.sha2("body", 256).alias("sha")).filter(F.col("n") >= length),
        "text-sizes",
    )
    earliest = sizes.groupBy("sha").agg(F.min(order).alias("first"))
    copies = sizes.join(earliest, "sha").select("doc_id", "u", "n", order.eqNullSafe(F.col("first")).alias("first")).distinct()
    copies = stage(copies, "text-copies")
    whole = copies.filter(~F.col("first")).select("doc_id", "u", F.lit(0).cast("long").alias("lo"), F.col("n").alias("hi"))
    same = lambda a, b: a.doc_id.eqNullSafe(b.doc_id) & (a.u == b.u)
    later = copies.filter(~F.col("first"))
    long = keyed.filter(F.octet_length("body") >= length)
    fresh = long.join(later, same(long, later), "left_anti")

    marked = fresh.mapInArrow(_anchored, ANCHORS)
    by_anchor = W.partitionBy("h")
    repeated = (
        marked.withColumn("places", F.count("*").over(by_anchor)).filter("places > 1")
        .select("doc_id", "u", "h", (F.col("at") - F.col("back")).alias("lo"), (F.col("more") + length).cast("int").alias("size"))
    )
    listed = stage(repeated.groupBy("doc_id", "u").agg(F.collect_set(F.struct("h", "lo", "size")).alias("spans")), "anchors")
    # rows that repeat a document would meet themselves
    twice = sizes.groupBy("doc_id", "u").agg(F.count("*").alias("rows")).filter("rows > 1")
    single = keyed if twice.isEmpty() else keyed.dropDuplicates(["doc_id", "u"])

    def with_texts(spans: DataFrame, name: str) -> DataFrame:
        return single.join(spans, same(single, spans)).select(single.doc_id, single.u, "body", F.col(name).alias("spans"))

    contexts = with_texts(listed, "spans").mapInArrow(_digested, CONTEXTS)
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "lo", "u")
    same_context = W.partitionBy("h", "c")
    ranked = contexts.withColumn("first", F.min(place).over(same_context)).withColumn("is_first", F.col("first").eqNullSafe(place))
    crowd = F.sum(F.col("is_first").cast("long")).over(by_anchor)
    ranked = stage(ranked.withColumn("crowd", crowd).select("doc_id", "u", "h", "lo", "size", "is_first", "crowd"), "contexts")
    copied = ranked.filter(~F.col("is_first")).select("doc_id", "u", "lo", (F.col("lo") + F.col("size")).alias("hi"))

    open_ = ranked.filter(F.col("is_first") & (F.col("crowd") > 1)).groupBy("doc_id", "u").agg(F.collect_list(F.struct("h", "lo", "size", "crowd")).alias("open"))
    cut = with_texts(open_, "open").mapInArrow(_cut, "doc_id long, u long, h long, lo long, crowd long, context binary")
    cut = stage(cut, "open-contexts")
    in_order = [F.col("h"), F.col("doc_id").asc_nulls_last(), F.col("lo")]
    from_blocks = (
        cut.filter(F.col("crowd") <= group).repartition("h").sortWithinPartitions(*in_order)
        .select("doc_id", "u", "h", "lo", "context").mapInArrow(_sorted_blocks(length), "doc_id long, u long, lo long, hi long")
    )
    strings = cut.filter(F.col("crowd") > group).select("doc_id", "u", "lo", "context").mapInArrow(
        _strings(length), "doc_id long, u long, lo long, digest binary"
    )
    first = strings.groupBy("digest").agg(F.min(place).alias("first"))
    from_strings = (
        strings.join(first, "digest").filter(~F.col("first").eqNullSafe(place))
        .select("doc_id", "u", "lo", (F.col("lo") + length).alias("hi"))
    )
    return stage(whole.unionByName(copied).unionByName(from_blocks).unionByName(from_strings), "repeated-spans")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans): one row for each row of ``docs``.

    ``spans`` are the maximal runs of removed bytes, ``kept_sha256`` the digest of what
    stays.  A byte goes when a string of ``length`` bytes that covers it also starts
    earlier in the input; matches never cross documents.  Null counts as empty; texts
    shorter than ``length`` keep everything; rows that repeat a doc_id and its text are the
    same document, at the same place; an empty table gives an empty result; other columns
    are not read.

    Every string is anchored at its gram of least hash, so equal strings meet under equal
    anchors, and only anchors that occur twice go on.  Contexts that are wholly equal are
    settled by digest: all but the earliest are repeats.  The different contexts of an
    anchor are suffix-sorted together, in two stages, and adjacent common prefixes of
    ``length`` bytes show the rest.
    """
    keyed = _keyed(docs, id_col, text_col)
    spans = repeated_spans(docs, id_col, text_col, length, group)
    listed = spans.groupBy("doc_id", "u").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    joined = keyed.join(listed, keyed.doc_id.eqNullSafe(listed.doc_id) & (keyed.u == listed.u), "left")
    return joined.select(keyed.doc_id, "body", "spans").mapInArrow(_kept, RESULT)
