"""Exact join of word-shingle sets under the Jaccard distance, by pivots, regions and triangle windows."""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from fieldloom.llm.common import WordHasher, discard, importable, ranked, stage, texts
from fieldloom.llm.components import components

#: Classes of each of the two tables that count shingles, and how many of them go in a row.  The
#: counts set the order of the one-shingle pivots, never the result.
COUNTED = 1 << 20
STRETCH = 1 << 13
#: Pivots a region takes in its second round; each later round takes GROWTH times as many.
PIVOTS = 8
GROWTH = 128

#: Fixed classes of shingles for sets of up to 16 times as many, twice the classes for each doubling beyond;
#: the counts of a set in them bound its distance to any other set from below.
CLASSES = 64
#: Words of 64 bits that hold the parities of a set's counts in as many fixed classes as they have bits.
PARITIES = 4

#: Members of a block, at most, and shingles of a block, about; a longer member is a block of its own.
BLOCK = 128
BLOCK_SHINGLES = 1 << 21
#: Shingles that two blocks are compared by at a time.
COLUMNS = 8192

SETS = "doc_id long, n_shingles long, sig binary, profile binary, odd array<long>, homes array<struct<s:long,reach:long>>"


def _classes(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The class of each shingle in either table, by other bits of its hash."""
    return (found % np.uint64(COUNTED)).astype(np.int64), (found >> np.uint64(40)).astype(np.int64) % COUNTED


def _common(docs: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """How often a shingle of each class is held, in two tables, over all shingles of all documents.

    A shingle is held by no more documents than the lesser of its two counts says.  The
    tables have the same size for any number of documents, in a task and on the driver.
    """
    row = "at long, counts binary"

    def run(batches):
        import pyarrow as pa

        hasher, tables, one = WordHasher(words), np.zeros((2, COUNTED), dtype="<u4"), np.uint32(1)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                found = np.concatenate([hasher.shingles(body) for body in batch.column(1).slice(at, 512).to_pylist()])
                for table, classes in zip(tables, _classes(found), strict=True):
                    np.add.at(table, classes, one)  # with a number of the table's type: several times as fast
        parts = tables.reshape(-1, STRETCH)
        held = np.flatnonzero(parts.any(axis=1)).tolist()
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array([parts[i].tobytes() for i in held], pa.binary())], names=["at", "counts"])

    def summed(rows):
        import pyarrow as pa

        total = np.zeros(STRETCH, dtype="<u4")
        for part in rows.column("counts").to_pylist():
            total += np.frombuffer(part, dtype="<u4")
        return pa.table({"at": rows.column("at").slice(0, 1), "counts": pa.array([total.tobytes()], pa.binary())})

    tables = np.zeros((2 * COUNTED // STRETCH, STRETCH), dtype=np.int64)
    for r in texts(docs).mapInArrow(run, row).groupBy("at").applyInArrow(summed, row).collect():
        tables[r["at"]] = np.frombuffer(r["counts"], dtype="<u4")
    return tuple(tables.reshape(2, COUNTED).astype("<u4"))


def _counts(found: np.ndarray, classes: int) -> np.ndarray:
    return np.bincount((found % np.uint64(classes)).astype(np.int64), minlength=classes)


def _sets(words: int, num: int, den: int, common: tuple[np.ndarray, np.ndarray]):
    """(doc_id, n_shingles, sig, profile, odd, homes) of each document.

    ``profile``: how many shingles fall into each of the fixed classes.  ``odd``: a bit for
    each of other classes, set where an odd number does.  ``homes``: the one-shingle
    regions that the document enters, with its reach there, the number of its shingles
    from that one on in the global order: those of the least counts in ``common`` first.
    """
    target = to_arrow_schema(StructType.fromDDL(SETS))

    def run(batches):
        import pyarrow as pa

        hasher = WordHasher(words)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                rows = []
                for body in part.column(1).to_pylist():
                    found = hasher.shingles(body)
                    n = len(found)
                    homes = []
                    if n:
                        often = [table[classes] for table, classes in zip(common, _classes(found), strict=True) if len(table)]
                        rank = np.minimum.reduce(often) if often else np.zeros(n, dtype=np.int64)
                        first = found[np.lexsort((found, rank))[: n - -(-num * n // den) + 1]]
                        homes = [{"s": s, "reach": n - i} for i, s in enumerate(first.view(np.int64).tolist())]
                    profile = _counts(found, CLASSES << (n // (16 * CLASSES)).bit_length()).astype("<u4").tobytes()
                    odd = np.packbits(_counts(found >> np.uint64(32), 64 * PARITIES) & 1).view(np.int64).tolist()
                    rows.append((n, hashlib.blake2b(found.tobytes(), digest_size=16).digest(), profile, odd, homes))
                columns = [part.column(0), *(pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), list(target)[1:], strict=True))]
                yield pa.RecordBatch.from_arrays(columns, schema=target)

    return run


def _distances(words: int):
    """(x, p, both, any): sizes of intersection and union for each pair of texts; rows come sorted by p."""

    def run(batches):
        import pyarrow as pa

        hasher, last, pivot = WordHasher(words), None, None
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part, rows = batch.slice(at, 256), []
                for x, p, body, other in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    if p != last:
                        last, pivot = p, hasher.shingles(other)
                    found = hasher.shingles(body)
                    both = len(np.intersect1d(found, pivot, assume_unique=True))
                    rows.append((x, p, both, len(found) + len(pivot) - both))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=["x", "p", "both", "any"])

    return run


def _held(sets: list[np.ndarray], keys: np.ndarray) -> np.ndarray:
    """A row for each set: 1 where it holds the key."""
    out = np.zeros((len(sets), len(keys)), dtype=np.float32)
    for row, own in zip(out, sets, strict=True):
        place = np.searchsorted(keys, own)
        place[place == len(keys)] = 0
        row[place[keys[place] == own]] = 1
    return out


def _overlaps(mine: list[np.ndarray], theirs: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every set of one block with every one of the other."""
    keys = np.intersect1d(np.concatenate(mine), np.concatenate(theirs))
    both = np.zeros((len(mine), len(theirs)), dtype=np.int64)
    for at in range(0, len(keys), COLUMNS):
        part = keys[at : at + COLUMNS]
        both += (_held(mine, part) @ _held(theirs, part).T).astype(np.int64)  # counts up to COLUMNS are exact
    return both


LINKS = "nid long, weight long, linked array<struct<nid:long,both:long,any:long>>"


def _block_links(words: int, num: int, den: int):
    """For each member of two blocks its links into the other one, or within a block that meets itself.

    ``weight``: the rows of the classes linked with it; ``linked``: these classes, each
    link at one of its ends.
    """
    target = to_arrow_schema(StructType.fromDDL(LINKS))

    def run(batches):
        import pyarrow as pa

        hasher = WordHasher(words)
        for batch in batches:
            for a, b in zip(batch.column(0), batch.column(1), strict=True):
                mine = a.as_py()
                theirs = b.as_py() if b.is_valid else mine
                own = [hasher.shingles(m["body"]) for m in mine]
                other = [hasher.shingles(m["body"]) for m in theirs] if b.is_valid else own
                both = _overlaps(own, other)
                any_ = np.array([len(s) for s in own])[:, None] + np.array([len(s) for s in other])[None, :] - both
                near = both * den >= any_ * num
                if not b.is_valid:
                    np.fill_diagonal(near, False)
                rows = []
                counted = near @ np.array([m["copies"] for m in theirs])
                for i in np.flatnonzero(near.any(axis=1)).tolist():
                    to = np.flatnonzero(near[i]).tolist()
                    listed = [{"nid": theirs[j]["nid"], "both": both[i, j], "any": any_[i, j]} for j in to if b.is_valid or j > i]
                    rows.append((mine[i]["nid"], counted[i], listed))
                if b.is_valid:
                    counted = np.array([m["copies"] for m in mine]) @ near
                    rows += [(theirs[j]["nid"], counted[j], []) for j in np.flatnonzero(near.any(axis=0)).tolist()]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), target, strict=True)], schema=target)

    return run


def _may_link(a: str, b: str, num: int, den: int) -> Column:
    """Sizes and reaches of two members of a region under which they may link, their first common shingle being its pivot."""
    n, m, r, q = (F.col(f"{side}.{c}") for c in ("n", "reach") for side in (a, b))
    return (F.least(n, m) * den >= F.greatest(n, m) * num) & (F.least(r, q) * (num + den) >= (n + m) * num)


def _near_parities(a: str, b: str, num: int, den: int) -> Column:
    """Parities under which two sets may link: each that differs stands for a shingle that one of them lacks."""
    apart = sum((F.bit_count(F.col(f"{a}.odd")[i].bitwiseXOR(F.col(f"{b}.odd")[i])) for i in range(PARITIES)), F.lit(0))
    return apart * (num + den) <= (F.col(f"{a}.n") + F.col(f"{b}.n")) * (den - num)


def _apart(mine: bytes, theirs: bytes) -> int:
    """The sum of the differences of two profiles, at the classes of the coarser one."""
    counts = [np.frombuffer(p, dtype="<u4").astype(np.int64) for p in (mine, theirs)]
    least = min(map(len, counts))
    a, b = (c.reshape(-1, least).sum(axis=0) for c in counts)
    return int(np.abs(a - b).sum())


def _near_profiles(num: int, den: int):
    """Pairs whose profiles allow a link: the classes' counts differ by at most what two linked sets may.

    The sum of the differences never exceeds the size of the symmetric difference.
    """

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            x, p, n, m, mine, theirs = batch.columns
            if not batch.num_rows:
                continue
            apart = np.array([_apart(a, b) for a, b in zip(mine.to_pylist(), theirs.to_pylist(), strict=True)])
            both = n.to_numpy() + m.to_numpy()
            near = pa.array(apart * (num + den) <= both * (den - num))
            yield pa.RecordBatch.from_arrays([x.filter(near), p.filter(near)], names=["x", "p"])

    return run


class _Measure:
    """Distances of pairs of classes, on whole texts, after a look at their profiles."""

    def __init__(self, docs: DataFrame, sets: DataFrame, words: int, num: int, den: int):
        self.docs, self.sets, self.words, self.num, self.den = docs, sets, words, num, den
        #: Pairs that were measured so far.
        self.pairs = 0

    def __call__(self, pairs: DataFrame) -> DataFrame:
        """(x, p, both, any) of the pairs that may link; the others are farther apart than the threshold."""
        own = self.sets.select(F.col("nid").alias("x"), F.col("n_shingles").alias("n"), F.col("profile").alias("mine"))
        other = self.sets.select(F.col("nid").alias("p"), F.col("n_shingles").alias("m"), F.col("profile").alias("theirs"))
        near = stage(
            pairs.join(own, "x").join(other, "p").select("x", "p", "n", "m", "mine", "theirs")
            .mapInArrow(_near_profiles(self.num, self.den), "x long, p long"),
            "near-pairs",
        )
        n = near.count()
        self.pairs += n
        ids = near.select(F.col("x").alias("nid")).unionByName(near.select(F.col("p").alias("nid"))).distinct()
        wanted = ids.join(self.sets.select("nid", "doc_id", "sig"), "nid")
        bodies = stage(_bodies(self.docs, wanted, self.words), "pair-texts")
        joined = near.join(bodies.select(F.col("nid").alias("x"), "body"), "x").join(
            bodies.select(F.col("nid").alias("p"), F.col("body").alias("other")), "p"
        )
        measured = joined.select("x", "p", "body", "other").mapInArrow(_distances(self.words), "x long, p long, both long, any long")
        # rows that repeat a document give its pairs again
        distances = stage(measured.distinct(), "distances", n)
        discard(near, bodies)
        return distances


def linked_texts(
    docs: DataFrame, words: int = 4, num: int = 85, den: int = 100, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """The rows of similar_texts with class_id and n_links, and the links of the classes.

    ``class_id`` is the digest of the row's set of shingles, so rows with equal sets share
    it; ``n_links`` counts the rows whose text links with the row's: the others of its
    class and all rows of the linked classes.  A text without words has no link.  The
    second result has each pair of different linked classes once: (class_a, class_b, doc_a,
    doc_b, both, any), with a doc_id of each class and the sizes of the intersection and the
    union.

    No link leaves a component, so the classes of each component are dealt to blocks by
    size, those with the same least shingle hash side by side.  Two blocks meet once, and
    only where members of both are in one region, as both ends of a link are.  All pairs
    of blocks that meet are then compared on whole texts by products of incidence matrices,
    whether or not a pivot has connected them before.  A group of m texts that all
    link has m * (m - 1) / 2 links and costs as much; its rows on the way are blocks.
    """
    spark = docs.sparkSession
    importable(spark)
    renamed = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    rows, sets, classes, shared, named = _grouped(renamed, words, num, den)
    named = stage(named, "members")
    least = shared.groupBy("nid").agg(F.min(F.xxhash64("s")).alias("home"), F.first("n").alias("n"))
    band = F.floor(F.log2(F.col("n").cast("double"))).cast("int")
    near = named.join(least, "nid").withColumn("band", band)
    # the places of like homes are next to each other; a home that all share is dealt to eight of the buckets
    spread = F.pmod(F.col("home"), F.lit(64)) * 8 + F.pmod(F.xxhash64("nid"), F.lit(8))
    per = F.greatest(F.lit(1), F.least(F.lit(BLOCK), F.floor(F.lit(BLOCK_SHINGLES) / F.pow(F.lit(2.0), F.col("band") + 1))))
    placed = stage(
        ranked(near, ["component", "band"], [F.col("home"), F.col("nid")], spread, 512)
        .select("nid", "component", F.concat_ws(":", "component", "band", F.floor(F.col("rank") / per)).alias("block")),
        "blocks",
    )
    inside = stage(shared.select("nid", "s").join(placed, "nid").select("component", "s", "block").distinct(), "region-blocks")
    meeting = (
        inside.alias("a").join(inside.alias("b"), ["component", "s"]).filter(F.col("a.block") < F.col("b.block"))
        .select(F.col("a.block").alias("block"), F.col("b.block").alias("other")).distinct()
    )
    copies = classes.select("nid", "copies")
    wanted = placed.select("nid").join(sets.select("nid", "doc_id", "sig"), "nid")
    bodies = _bodies(renamed, wanted, words).dropDuplicates(["nid"])
    content = stage(
        placed.join(copies, "nid").join(bodies, "nid").groupBy("block").agg(F.collect_list(F.struct("nid", "copies", "body")).alias("members")),
        "block-texts",
    )
    kind = content.schema["members"].dataType
    own = content.filter(F.size("members") > 1).select("members", F.lit(None).cast(kind).alias("others"))
    across = (
        meeting.join(content, "block")
        .join(content.select(F.col("block").alias("other"), F.col("members").alias("others")), "other")
        .select("members", "others")
    )
    found = stage(own.unionByName(across).mapInArrow(_block_links(words, num, den), LINKS), "class-links")
    discard(content, inside, shared, placed)
    counted = classes.join(found.groupBy("nid").agg(F.sum("weight").alias("weight")), "nid", "left").select(
        "sig", (F.col("copies") - 1 + F.coalesce("weight", F.lit(0))).alias("n_links")
    )
    ends = classes.join(sets.select("nid", "doc_id"), "nid").select("nid", F.lower(F.hex("sig")).alias("class"), "doc_id")
    links = (
        found.select("nid", F.explode("linked").alias("to"))
        .select(F.col("nid").alias("a"), F.col("to.nid").alias("b"), F.col("to.both").alias("both"), F.col("to.any").alias("any"))
        .join(ends.select(F.col("nid").alias("a"), F.col("class").alias("class_a"), F.col("doc_id").alias("doc_a")), "a")
        .join(ends.select(F.col("nid").alias("b"), F.col("class").alias("class_b"), F.col("doc_id").alias("doc_b")), "b")
        .select("class_a", "class_b", "doc_a", "doc_b", "both", "any")
    )
    return (
        rows.join(counted, "sig", "left")
        .select(
            "doc_id", "n_shingles", "component_id", F.lower(F.hex("sig")).alias("class_id"),
            F.when(F.col("n_shingles") > 0, F.col("n_links")).otherwise(0).cast("long").alias("n_links"),
        ),
        links,
    )


def similar_texts(
    docs: DataFrame, words: int = 4, num: int = 85, den: int = 100, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, n_shingles, component_id): one row for each row of ``docs``.

    Two texts link when den * |intersection| >= num * |union| of their sets of shingles
    of ``words`` words (see WordHasher.shingles; a shorter text is one shingle).  A text
    without words - null and empty ones too - has no shingle and links with nothing.
    ``component_id`` is the smallest doc_id reachable by links, the row's own where there
    are none; null ids never name a component that has another one.  Repeated rows are
    members of one class and each listed; an empty table gives an empty result; other
    columns are not read.  The links themselves are given by linked_texts.

    Texts with equal sets are one class.  The first pivots are sets of one shingle: a
    set's distance to one of them is below 1 only if it holds it, all others are equally
    far, so the home of a set is its first shingle in a global order, common ones last.
    A set linked with one at home there misses at most the allowed share of its
    shingles, so it enters the regions of so many of its first shingles: that is the
    window, and each link has both ends in the region of their first common shingle.
    (Whole documents alone would be poor first pivots: nearly all lie at distance 1 from
    each of them, and the window would copy every document into every region.)  Within a
    region the pivots are documents, the most central first.  Whatever lies within the threshold of a pivot is
    its core and linked with it; no pair inside the core is needed for components.  The
    rest become pivots in turn, in rounds of growing number, against the members of the
    region whose distance to the first pivot differs by at most the threshold, whose
    sizes allow a link, and which are not known to be connected.  A pair is looked at
    once, whatever number of regions it shares: first at the parities, then at the counts
    of its shingles in fixed classes, which bound the distance from below, then at the
    whole texts.
    """
    spark = docs.sparkSession
    importable(spark)
    renamed = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return _grouped(renamed, words, num, den)[0].drop("sig")


def _grouped(renamed: DataFrame, words: int, num: int, den: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, DataFrame]:
    """The rows of similar_texts with ``sig``, and the sets, classes, regions' members and components behind them."""
    cut = 1 - num / den + 1e-9

    made = texts(renamed).mapInArrow(_sets(words, num, den, _common(renamed, words)), SETS)
    sets = stage(made.withColumn("nid", F.monotonically_increasing_id()), "shingle-sets")
    classes = stage(
        sets.filter("n_shingles > 0").groupBy("sig").agg(F.min(F.struct("doc_id", "nid")).alias("r"), F.min("doc_id").alias("least"), F.count("*").alias("copies"))
        .select("sig", F.col("r.nid").alias("nid"), "least", "copies"),
        "shingle-classes",
        sets.count(),
    )
    entered = (
        sets.join(classes.select("nid"), "nid")
        .select("nid", F.col("n_shingles").alias("n"), F.explode("homes").alias("h"))
        .select("nid", "n", F.col("h.s").alias("s"), F.col("h.reach").alias("reach"))
    )
    region = W.partitionBy("s")
    # shingles that the same sets share are one region, where each member has its farthest reach;
    # sets that only seem the same by their hashes make a larger region, which is right too
    shared = stage(
        entered.withColumn("members", F.count("*").over(region)).filter("members > 1")
        .withColumn("same", F.bit_xor(F.xxhash64("nid")).over(region))
        .groupBy(F.col("same").alias("s"), "nid")
        .agg(F.first("n").alias("n"), F.max("reach").alias("reach"), F.max("members").alias("members"), F.count("*").alias("shingles")),
        "shared-shingles",
    )
    n_shared = shared.count()
    # the first pivot is the member whose shingles most others hold: copies lie around what they were made from
    central = shared.groupBy("nid").agg((F.sum(F.col("members") * F.col("shingles")) / F.first("n")).alias("central"))
    first = F.max_by(F.struct("nid", "n", "reach"), F.struct("central", F.xxhash64("nid"), "nid")).over(region)
    regions = stage(
        shared.join(central, "nid").withColumn("first", first).select("s", "nid", "n", "reach", "central", "first"), "regions", n_shared
    )
    measure = _Measure(renamed, sets, words, num, den)

    # first round: one pivot for each region
    member = regions.withColumn("self", F.struct("n", "reach"))
    pairs = member.filter("nid <> first.nid").filter(_may_link("self", "first", num, den))
    known = measure(pairs.select(F.col("nid").alias("x"), F.col("first.nid").alias("p")).distinct())
    distance = 1 - F.col("both") / F.col("any")
    linked = F.col("both") * den >= F.col("any") * num
    links = known.filter(linked).select("x", "p")

    toward = known.select(F.col("x").alias("nid"), F.col("p").alias("first_nid"), distance.alias("d"), linked.alias("core"))
    placed = (
        regions.withColumn("first_nid", F.col("first.nid"))
        .join(toward, ["nid", "first_nid"], "left")
        .withColumn("is_first", F.col("nid") == F.col("first_nid"))
        .withColumn("far", ~F.col("is_first") & ~F.coalesce("core", F.lit(False)))
        .filter(~F.col("is_first"))
    )
    turn = F.row_number().over(region.orderBy(F.desc("far"), F.desc("central"), F.xxhash64("nid"), "nid"))
    rest = stage(
        placed.withColumn("far_members", F.sum(F.col("far").cast("int")).over(region))
        .withColumn("members", F.count("*").over(region))
        .filter("far_members > 0 and members > 1")
        .withColumn("turn", F.when(F.col("far"), turn - 1))
        .select("s", "nid", "n", "reach", "d", "far", "turn", "far_members"),
        "far-members",
        n_shared,
    )
    discard(regions)
    most = rest.agg(F.max("far_members")).first()[0] or 0
    done, size, measured = 0, PIVOTS, [known]
    while done < most:
        named = _connected(links, measure.pairs)
        here = (
            rest.filter(F.col("far_members") > done).join(named, "nid", "left").withColumn("label", F.coalesce("label", "nid"))
            .join(sets.select("nid", "odd"), "nid")
        )
        pivots = here.filter(F.col("far") & (F.col("turn") >= done) & (F.col("turn") < done + size))
        pairs = (
            here.alias("a").join(
                pivots.alias("b"),
                (F.col("a.s") == F.col("b.s"))
                & (~F.col("a.far") | (F.col("a.turn") > F.col("b.turn")))
                & (F.col("a.label") != F.col("b.label"))
                & _may_link("a", "b", num, den)
                & _near_parities("a", "b", num, den)
                & (F.col("a.d").isNull() | F.col("b.d").isNull() | (F.abs(F.col("a.d") - F.col("b.d")) <= cut)),
            )
            .select(F.least("a.nid", "b.nid").alias("x"), F.greatest("a.nid", "b.nid").alias("p"))
            .distinct()
        )
        for old in measured:
            seen = old.select(F.least("x", "p").alias("x"), F.greatest("x", "p").alias("p"))
            pairs = pairs.join(seen, ["x", "p"], "left_anti")
        measured.append(measure(pairs))
        links = stage(links.unionByName(measured[-1].filter(linked).select("x", "p")), "links", measure.pairs)
        done, size = done + size, size * GROWTH

    named = components(links, "x", "p", measure.pairs).withColumnRenamed("node", "nid")
    discard(rest)
    numbered = classes.join(named, "nid").groupBy("component").agg(F.min("least").alias("component_id"))
    of_class = (
        classes.join(named, "nid", "left").join(numbered, "component", "left")
        .select("sig", F.coalesce("component_id", "least").alias("component_id"))
    )
    rows = sets.select("doc_id", "n_shingles", "sig").join(of_class, "sig", "left").select(
        "doc_id", "n_shingles", "sig",
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )
    return rows, sets, classes, shared, named


def _connected(links: DataFrame, rows: int) -> DataFrame:
    """(nid, label): equal labels lie in one component; two hops, enough to spare most known pairs."""
    both = links.unionByName(links.select(F.col("p").alias("x"), F.col("x").alias("p")))
    near = both.groupBy("x").agg(F.least(F.min("p"), F.col("x")).alias("label"))
    return stage(
        both.join(near.select(F.col("x").alias("p"), F.col("label").alias("theirs")), "p")
        .groupBy("x").agg(F.min("theirs").alias("label")).withColumnRenamed("x", "nid"),
        "labels",
        2 * rows,
    )


def _bodies(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(nid, body): the whole text of each wanted class.

    Where rows repeat a doc_id with other texts, the digest of the set tells them apart.
    """
    named = wanted.select("nid", F.col("doc_id").alias("key"), "sig")
    found = texts(docs).join(named, F.col("doc_id").eqNullSafe(F.col("key"))).select("nid", "sig", "body")

    def run(batches):
        import pyarrow as pa

        hasher = WordHasher(words)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                mine = [
                    hashlib.blake2b(hasher.shingles(body).tobytes(), digest_size=16).digest() == sig
                    for sig, body in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True)
                ]
                yield pa.RecordBatch.from_arrays([part.column(0).filter(pa.array(mine)), part.column(2).filter(pa.array(mine))], names=["nid", "body"])

    return found.mapInArrow(run, "nid long, body binary")
