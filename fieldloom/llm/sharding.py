"""Balanced label propagation: linked documents drawn to one shard under exact quotas."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from fieldloom.llm.common import ranked, stage, texts

SHARDS = 16
ROUNDS = 2
#: Rows of one bucket of a distributed rank, about.
BUCKET_ROWS = 20_000
_FINE = 256
#: Units larger than this share of all rows are placed one by one, so the driver holds at most as many;
#: smaller ones go in shards times _FINE bundles.
LARGE = 1 << 16


def _moves(nodes: DataFrame, links: DataFrame, shards: int, target: list[int], turn: int) -> DataFrame:
    """One round: (nid, shard) after the accepted moves.

    A node's neighbours are the nodes that share a key with it.  Its wish is the shard
    where most of them are.  Ties of a node with one key go by an order of shards
    drawn from the key, which all of its nodes share; a node with several keys then stays
    where it is, and only every other one of these, drawn anew each round, may move.  So
    neighbours do not change places for ever.
    Wishes for a shard are accepted by size of the key's group, large ones first, up to
    what the shard's target leaves beside the linked nodes that stay there.
    """
    here = links.join(nodes, "nid")
    counts = here.groupBy("key").agg(
        F.array(*[F.sum((F.col("shard") == s).cast("long")) for s in range(shards)]).alias("around"),
    )
    met = here.select("nid", "key").join(counts, "key").withColumn("group", F.aggregate("around", F.lit(0).cast("long"), lambda a, b: a + b))
    score = F.array(*[F.sum(F.col("around")[s]) for s in range(shards)])
    wished = (
        met.groupBy("nid")
        .agg(score.alias("score"), F.max(F.struct("group", "key")).alias("largest"), F.count("*").alias("keys"))
        .join(nodes, "nid")
        .withColumn("group", F.col("largest.group"))
        .withColumn("key", F.col("largest.key"))
    )
    options = F.array(
        *[
            F.struct(
                # a node with several keys does not count itself
                (F.col("score")[s] - F.when((F.col("shard") == s) & (F.col("keys") > 1), F.col("keys")).otherwise(0)).alias("n"),
                ((F.col("shard") == s) & (F.col("keys") > 1)).alias("own"),
                F.pmod(F.xxhash64("key", F.lit(s)), F.lit(1 << 31)).alias("draw"),
                F.lit(s).alias("to"),
            )
            for s in range(shards)
        ]
    )
    may_move = (F.col("keys") == 1) | (F.pmod(F.xxhash64("nid", F.lit(turn)), F.lit(2)) == 0)
    wished = wished.withColumn("to", F.when(may_move, F.array_max(options)["to"]).otherwise(F.col("shard")))
    linked = stage(
        wished.select(
            "nid", "shard", "to", "group",
            # groups of a like size in one band, large ones first, finely cut by key within it
            ((63 - F.floor(F.log2(F.col("group").cast("double")))) * _FINE + F.pmod(F.xxhash64("key"), F.lit(_FINE))).cast("long").alias("band"),
        ),
        "wishes",
    )
    # bounded: at most shards x 64 x _FINE rows
    bands = linked.filter("to <> shard").groupBy("to", "band").agg(F.count("*").alias("wishes"))
    staying = linked.filter("to = shard").groupBy("to").agg(F.count("*").alias("staying"))
    targets = linked.sparkSession.createDataFrame([(s, n) for s, n in enumerate(target)], "to int, target long")
    before = W.partitionBy("to").orderBy("band").rowsBetween(W.unboundedPreceding, -1)
    quotas = (
        bands.withColumn("before", F.coalesce(F.sum("wishes").over(before), F.lit(0)))
        .join(targets, "to")
        .join(staying, "to", "left")
        .withColumn("free", F.col("target") - F.coalesce("staying", F.lit(0)) - F.col("before"))
        .select("to", "band", (F.least(F.col("free"), F.col("wishes")) / F.col("wishes")).alias("share"))
    )
    draw = F.pmod(F.xxhash64("nid"), F.lit(1 << 20)) / float(1 << 20)
    accepted = linked.join(quotas, ["to", "band"], "left").select(
        "nid", F.when((F.col("to") == F.col("shard")) | (draw < F.col("share")), F.col("to")).otherwise(F.col("shard")).alias("moved")
    )
    return nodes.join(accepted, "nid", "left").select("nid", F.coalesce("moved", "shard").cast("int").alias("shard"))


def _fitted(units: list[tuple[str, int, int]], target: list[int]) -> tuple[list[tuple[str, int, int, int]], list[int]]:
    """(unit, first, end, shard) for all places of (unit, size, wished shard), and the room that is left.

    Units beyond a shard fill whole shards first.  Then each unit, large ones first, goes
    whole where it wishes or else where it leaves the least room.  What fits nowhere whole
    is cut last, in as few parts as the room allows.
    """
    room, out, rest, late = list(target), [], [], []
    ordered = sorted(units, key=lambda u: (-u[1], u[0]))
    for unit, size, wish in ordered:
        first = 0
        while size - first > max(target):
            s = max(range(len(room)), key=lambda s: (room[s], s == wish))
            if room[s] < target[s]:
                break
            out.append((unit, first, first + room[s], s))
            first, room[s] = first + room[s], 0
        rest.append((unit, first, size, wish))
    for unit, first, size, wish in sorted(rest, key=lambda u: (u[1] - u[2], u[0])):
        fits = [s for s in range(len(room)) if room[s] >= size - first]
        if not fits:
            late.append((unit, first, size))
        elif size > first:
            s = wish if wish in fits else min(fits, key=lambda s: (room[s], s))
            out.append((unit, first, size, s))
            room[s] -= size - first
    for unit, first, size in late:
        while first < size:
            fits = [s for s in range(len(room)) if room[s] >= size - first]
            s = min(fits, key=lambda s: (room[s], s)) if fits else max(range(len(room)), key=lambda s: (room[s], -s))
            end = min(size, first + room[s])
            out.append((unit, first, end, s))
            first, room[s] = end, room[s] - (end - first)
    return out, room


def _together(held: DataFrame, n: int, shards: int, target: list[int], buckets: int) -> tuple[DataFrame, list[int]]:
    """(nid, shard) of the linked nodes (nid, key, shard), whole units as far as they fit, and the room left."""
    spark = held.sparkSession
    units = (
        held.groupBy("key", "shard").agg(F.count("*").alias("n"))
        .groupBy("key").agg(F.sum("n").alias("size"), F.max(F.struct("n", "shard"))["shard"].alias("wish"))
    )
    bundle = F.concat_ws(":", F.lit("b"), "wish", F.pmod(F.xxhash64("key"), F.lit(_FINE)))
    units = stage(units.withColumn("unit", F.when(F.col("size") > n // LARGE, F.concat(F.lit("k"), "key")).otherwise(bundle)), "units")
    # bounded: LARGE units and shards x _FINE bundles
    rows = units.groupBy("unit").agg(F.sum("size").alias("size"), F.first("wish").alias("wish")).collect()
    sizes = {r["unit"]: r["size"] for r in rows}
    parts, room = _fitted([(r["unit"], r["size"], r["wish"]) for r in rows], target)
    whole = spark.createDataFrame([(u, s) for u, a, b, s in parts if b - a == sizes[u]], "unit string, shard int")
    cut = spark.createDataFrame([p for p in parts if p[2] - p[1] < sizes[p[0]]], "unit string, first long, end long, shard int")
    member = stage(held.select("nid", "key").join(units.select("key", "unit"), "key"), "unit-members")
    # the groups of a bundle stand one after another, so that a cut goes through one of them
    spread = F.when(F.col("unit").startswith("k"), F.xxhash64("nid")).otherwise(F.xxhash64("key"))
    divided = ranked(member.join(cut.select("unit").distinct(), "unit", "left_semi"), ["unit"], [F.col("key"), F.col("nid")], spread, buckets)
    placed = divided.join(cut, "unit").filter((F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("end"))).select("nid", "shard")
    return stage(member.join(whole, "unit").select("nid", "shard").unionByName(placed), "linked-places"), room


def balanced_propagation(nodes: DataFrame, links: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """(nid, shard): counts at most one apart, nodes that share a key together as far as that allows.

    ``nodes`` has distinct ``nid``; ``links`` has (nid, key), and nodes with a key in
    common are neighbours, so a group of any size is a row per member, never its pairs.
    The rounds draw neighbours to one shard.  Then the nodes of a key - of several, the one
    with most nodes - are a unit and go to the shard where most of them are, or to one that
    has room for all of them; a unit is cut only where no shard has (see _fitted).
    Unlinked nodes fill the places that are free.
    """
    n = nodes.count()
    buckets = max(16, n // BUCKET_ROWS)
    target = [n // shards + (s < n % shards) for s in range(shards)]
    keys = links.groupBy("key").agg(F.count("*").alias("members")).filter("members > 1")
    shared = stage(links.join(keys, "key").select("nid", "key", "members"), "links")
    placed = nodes.select("nid", F.pmod(F.xxhash64("nid"), F.lit(shards)).cast("int").alias("shard"))
    for turn in range(rounds):
        placed = stage(_moves(placed, shared.select("nid", "key"), shards, target, turn), "shards")
    linked = shared.groupBy("nid").agg(F.max(F.struct("members", F.col("key").cast("string").alias("key")))["key"].alias("key"))
    together, room = _together(placed.join(linked, "nid"), n, shards, target, buckets)
    order = ranked(placed.join(linked, "nid", "left_anti"), ["shard"], [F.col("nid")], F.xxhash64("nid"), buckets)
    rooms = nodes.sparkSession.createDataFrame(list(enumerate(room)), "shard int, room long")
    fate = stage(order.join(rooms, "shard").select("nid", "shard", (F.col("rank") < F.col("room")).alias("stays")), "fates")
    kept = {r["shard"]: r["count"] for r in fate.filter("stays").groupBy("shard").count().collect()}
    gaps, at = [], 0
    for s, k in enumerate(room):
        gaps.append((s, at, at + k - kept.get(s, 0)))
        at = gaps[-1][2]
    spilled = ranked(fate.filter(~F.col("stays")).select("nid", F.lit(0).alias("pool")), ["pool"], [F.col("nid")], F.xxhash64("nid"), buckets)
    free = F.coalesce(*[F.when((F.col("rank") >= lo) & (F.col("rank") < hi), F.lit(s)) for s, lo, hi in gaps])
    return (
        together.unionByName(fate.filter("stays").select("nid", "shard"))
        .unionByName(spilled.select("nid", free.cast("int").alias("shard")))
    )


def shard_documents(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard): every row in one shard, under the law ``rows``.

    Documents are linked when their texts are equal (null counts as empty).  Size: UTF-8
    bytes plus one.  Shard counts are at most one apart; slots number a shard's rows from
    0 without a gap; ``grown_shard`` is null under this law.  Rows that repeat a doc_id
    are placed each for itself, null ids too.  An empty table gives an empty result;
    other columns are not read.  A group larger than a shard fills
    whole shards, and one that has room nowhere is cut in as few parts as the room allows.
    """
    base = stage(
        texts(docs, id_col, text_col).select(
            "doc_id",
            F.monotonically_increasing_id().alias("nid"),
            (F.octet_length("body") + 1).cast("long").alias("size"),
            F.crc32("body").alias("text_crc32"),
            F.sha2("body", 256).alias("key"),
        ),
        "sizes",
    )
    placed = stage(balanced_propagation(base.select("nid"), base.select("nid", "key"), shards, rounds), "placed")
    n = base.count()
    slots = ranked(placed, ["shard"], [F.col("nid")], F.xxhash64("nid"), max(16, n // BUCKET_ROWS), "slot")
    return base.join(slots, "nid").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
