"""Exact duplicates, similar texts, repeated strings, shards."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fieldloom.llm import common, components, exact_dedup, jaccard, sharding, suffix_dedup, suffixes
from fieldloom.llm.common import WordHasher
from tests.llm import brute


@pytest.mark.parametrize("weak", [False, True])
def test_exact_duplicates(odd_docs, odd_rows, weak):
    # a digest of one hex digit makes different texts meet
    digest = (lambda c: F.substring(F.sha2(c.cast("binary"), 256), 1, 1)) if weak else exact_dedup.sha256
    want = brute.exact(odd_rows)
    got = sorted(tuple(r) for r in exact_dedup.exact_duplicates(odd_docs, digest=digest).select("text_sha256", "doc_id", "keep_id", "group_size", "kept").fillna(-1).collect())
    none = lambda k: -1 if k is None else k
    rows = []
    for key, text in odd_rows:
        body = brute.normalised(text)
        keep, size = want[body]
        rows.append((hashlib.sha256(body.encode()).hexdigest(), none(key), none(keep), size, key == keep))
    assert got == sorted(rows)


def test_similar_texts_on_odd_rows(spark, odd_docs, odd_rows):
    got = jaccard.similar_texts(odd_docs).collect()
    assert len(got) == len(odd_rows)
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    assert by_id[7].component_id == by_id[3].component_id == 3
    # the text with a null id has one more word: 17 of its 18 shingles are those of 3
    assert {(r.n_shingles, r.component_id) for r in got if r.doc_id is None} == {(18, 3), (0, None)}
    assert by_id[9].n_shingles == by_id[11].n_shingles == by_id[12].n_shingles == 0
    assert [by_id[k].component_id for k in (9, 11, 12)] == [9, 11, 12]
    assert by_id[14].component_id == 13 and by_id[22].component_id == 21 and by_id[20].n_shingles == 1


@pytest.mark.parametrize(("words", "num"), [(4, 85), (5, 80)])
def test_similar_texts_against_brute_force(table, table_rows, words, num):
    sizes, component = brute.similar(table_rows, words, num, 100)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.similar_texts(table, words, num, 100).collect()}
    assert got == {k: (sizes[k], component[k]) for k in sizes}


def test_similar_texts_in_rounds(spark, monkeypatch):
    """Families whose members are linked by chains, and more far members than pivots in a round."""
    monkeypatch.setattr(jaccard, "PIVOTS", 2)
    monkeypatch.setattr(jaccard, "GROWTH", 2)
    rng = random.Random(5)
    rows = []
    for family in range(3):
        base = [f"f{family}x{i}" for i in range(60)]
        for member in range(40):
            text = list(base)
            for _ in range(rng.randint(0, 8)):
                text[rng.randrange(60)] = f"m{rng.randrange(9)}"
            rows.append((1000 - len(rows), " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    sizes, component = brute.similar(rows, 2, 60, 100)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.similar_texts(docs, 2, 60, 100).collect()}
    assert got == {k: (sizes[k], component[k]) for k in sizes}
    assert 3 < len(set(component.values())) < len(rows)


@pytest.mark.parametrize("block", [jaccard.BLOCK, 7])
def test_every_link_is_listed(spark, monkeypatch, block):
    """Near copies of one text, most pairs linked, copies among them, and a small block so that many meet."""
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "COLUMNS", 16)
    rng = random.Random(9)
    rows = [(None, "other words alone here"), (500, ""), (501, None)]
    for family in range(2):
        base = [f"f{family}x{i}" for i in range(60)]
        for member in range(60):
            text = list(base)
            for _ in range(rng.randint(0, 6)):
                text[rng.randrange(60)] = f"m{rng.randrange(9)}"
            rows += [(len(rows), " ".join(text))] * rng.choice((1, 1, 2))
    count, pairs = brute.linked(rows, 2, 75, 100)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got, links = jaccard.linked_texts(docs, 2, 75, 100)
    none = lambda k: -1 if k is None else k
    got = got.collect()
    assert sorted((none(r.doc_id), r.n_links) for r in got) == sorted((none(k), n) for (k, _), n in zip(rows, count, strict=True))
    text = dict(rows)
    listed = [frozenset(frozenset(brute.shingles(text[k], 2)) for k in (r.doc_a, r.doc_b)) for r in links.collect()]
    assert len(listed) == len(set(listed)) and set(listed) == pairs
    assert len(pairs) > 400
    assert len({r.class_id for r in got if r.n_shingles}) == len({frozenset(brute.shingles(t, 2)) for _, t in rows if t})


def test_links_on_odd_rows(odd_docs, odd_rows, no_docs):
    count, _ = brute.linked(odd_rows, 4, 85, 100)
    got = jaccard.linked_texts(odd_docs)[0].collect()
    none = lambda k: -1 if k is None else k
    assert sorted((none(r.doc_id), r.n_links) for r in got) == sorted((none(k), n) for (k, _), n in zip(odd_rows, count, strict=True))
    assert jaccard.linked_texts(no_docs)[0].count() == 0


def test_repeats_on_odd_rows(odd_docs, odd_rows):
    distinct = {k: t for k, t in odd_rows if k is not None}
    # rows with a null id come last; one of them is empty
    want = brute.without_repeats([*distinct.items(), (None, odd_rows[8][1])], suffix_dedup.LENGTH)
    got = suffix_dedup.without_repeats(odd_docs).collect()
    assert len(got) == len(odd_rows)
    for r in got:
        if r.doc_id is not None or r.n_bytes:
            assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id]


@pytest.mark.parametrize("group", [suffix_dedup.GROUP, 1])
def test_repeats_against_brute_force(table, table_rows, group):
    """``group`` 1: all strings go by their digests."""
    want = brute.without_repeats(table_rows, suffix_dedup.LENGTH)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.without_repeats(table, group=group).collect()}
    assert got == want


def test_suffix_order_and_repeats():
    rng = random.Random(2)
    for _ in range(200):
        strings = [bytes(rng.choice(b"ab\x00") for _ in range(rng.randint(1, 40))) if rng.random() < 0.8 else b"a" * rng.randint(1, 40) for _ in range(rng.randint(1, 5))]
        depth = rng.choice([3, 8, 11])
        text, _ = suffixes.block(strings)
        order = suffixes.suffix_array(text, depth)
        keys = [bytes(text[i : i + depth]) for i in order]
        assert sorted(order) == list(range(len(text))) and keys == sorted(keys)
        seen, want = set(), []
        for i in range(len(text) - depth + 1):
            string = bytes(text[i : i + depth])
            if suffixes.STOP not in string:
                want += [i] if string in seen else []
                seen.add(string)
        assert suffixes.repeated_starts(text, depth).tolist() == want


def test_anchors_own_each_string_once():
    rng = np.random.default_rng(0)
    body = bytes(rng.integers(97, 100, 500).astype(np.uint8)) + b"z" * 300
    _, at, first, last = suffix_dedup.anchors(body)
    assert first[0] == 0 and last[-1] == len(body) - 100 and (first[1:] == last[:-1] + 1).all()
    assert ((at >= last) & (at + 32 <= first + 100)).all()


def test_a_stage_of_few_rows_has_few_files(spark):
    """Every file of a local folder costs processes of the executor that count with its memory."""
    rows = spark.range(0, 5000, 1, 50)
    files = lambda df: len(df.inputFiles())
    assert files(common.stage(rows, "many")) == 50
    few = common.stage(rows, "few", 5000)
    assert files(few) == 1 and few.distinct().count() == 5000
    some = common.stage(rows, "some", 5000, 1000)
    assert files(some) == 6 and some.distinct().count() == 5000
    assert common.stage(rows.filter("id < 0"), "none", 0).count() == 0


def test_workers_get_few_whole_texts_at_a_time(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], names=["n"])

    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key, None)
    try:
        for own, want in ((None, common.BATCH_ROWS), ("77", 77)):
            spark.conf.set(key, own) if own else spark.conf.unset(key)
            common.importable(spark)
            assert max(r.n for r in spark.range(0, 3000, 1, 1).mapInArrow(sizes, "n long").collect()) == want
    finally:
        spark.conf.set(key, before) if before else spark.conf.unset(key)


def test_links_that_become_few_have_few_files(spark, monkeypatch):
    written = []
    monkeypatch.setattr(components, "stage", lambda *a: written.append(common.stage(*a)) or written[-1])
    links = spark.range(0, 2000, 1, 40).selectExpr("id AS a", "id + 1 AS b").filter("a % 10 <> 9").repartition(40)
    found = {r.node: r.component for r in components.components(links, rows=1800).collect()}
    assert found == {i: i - i % 10 for i in range(2000)}
    assert len(written) > 1 and max(len(w.inputFiles()) for w in written) == 1


def test_anchors_of_texts_in_a_row_are_those_of_each():
    rng = np.random.default_rng(1)
    bodies = [bytes(rng.integers(97, 100, n).astype(np.uint8)) for n in (100, 101, 700, 250, 100)] + [b"z" * 400]
    begins = np.cumsum([0, *map(len, bodies[:-1])])
    want = [(h, at + b, first + b, last + b) for b, body in zip(begins, bodies, strict=True) for h, at, first, last in zip(*suffix_dedup.anchors(body), strict=True)]
    assert list(zip(*suffix_dedup.anchors(b"".join(bodies), begins=begins), strict=True)) == want


def test_ranks_of_prefixes():
    """Equal ranks of the first and of the last symbols: equal prefixes; the ranks order them."""
    rng = np.random.default_rng(2)
    for depth in (1, 7, 8, 9, 24, 25, 100):
        text = np.concatenate([rng.integers(1, 3, 300), np.tile(rng.integers(1, 4, 60), 6)]).astype(np.uint8)
        ranks, size = suffixes.prefix_ranks(text, depth)
        assert size <= depth <= 2 * size or size == depth
        keys = [bytes(text[i : i + depth]) for i in range(len(text))]
        pairs = [(ranks[i], ranks[i + depth - size]) for i in range(len(text))]
        assert [sorted(set(keys)).index(k) for k in keys] == [sorted(set(pairs)).index(p) for p in pairs]


def _law(rows, shards):
    counts = [sum(r.shard == s for r in rows) for s in range(shards)]
    assert max(counts) - min(counts) <= 1
    for s in range(shards):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(counts[s]))


def test_shards(spark, odd_docs, odd_rows, table, table_rows):
    rows = sharding.shard_documents(odd_docs).collect()
    assert sorted(r.size for r in rows) == sorted(len((t or "").encode()) + 1 for _, t in odd_rows)
    _law(rows, 16)
    rows = sharding.shard_documents(table).collect()
    _law(rows, 16)
    where = {}
    for r in rows:
        where.setdefault((r.text_crc32, r.size), set()).add(r.shard)
    assert all(len(s) == 1 for s in where.values())


def test_a_group_beyond_a_shard_is_cut_at_the_quota(spark):
    docs = spark.createDataFrame([(i, "same" if i % 3 else f"own {i}") for i in range(300)], "doc_id long, text string")
    rows = sharding.shard_documents(docs, shards=8, rounds=2).collect()
    _law(rows, 8)


def test_groups_stay_whole_where_a_shard_has_room(spark):
    """16 groups of 60 in 16 shards of 100, all whole; a group of a third of all rows cut as little as can be."""
    docs = spark.createDataFrame([(i, f"group {i % 16}" if i < 960 else f"own {i}") for i in range(1600)], "doc_id long, text string")
    rows = sharding.shard_documents(docs).collect()
    _law(rows, 16)
    assert all(len({r.shard for r in rows if r.doc_id < 960 and r.doc_id % 16 == g}) == 1 for g in range(16))
    docs = spark.createDataFrame([(i, "same" if i < 533 else f"pair {i // 2}") for i in range(1600)], "doc_id long, text string")
    rows = sharding.shard_documents(docs).collect()
    _law(rows, 16)
    spread = sorted([sum(r.shard == s for r in rows if r.doc_id < 533) for s in range(16)], reverse=True)
    assert spread[:7] == [100, 100, 100, 100, 100, 33, 0]
    pairs = {}
    for r in rows:
        if r.doc_id >= 534:
            pairs.setdefault(r.doc_id // 2, set()).add(r.shard)
    assert sum(len(s) > 1 for s in pairs.values()) <= 16


def test_units_are_cut_last():
    parts, room = sharding._fitted([("a", 6, 0), ("b", 6, 0), ("c", 5, 0), ("d", 3, 1)], [10, 10])
    assert {u for u, *_ in parts if sum(p[0] == u for p in parts) == 1} == {"a", "b", "d"} and room == [0, 0]


def test_chains_of_links_are_drawn_together(spark):
    """Nodes 0-9 of a chain share a key with the next one each."""
    nodes = spark.range(80).withColumnRenamed("id", "nid")
    links = spark.createDataFrame([(i + j, f"k{i}") for c in range(8) for i in range(10 * c, 10 * c + 9) for j in (0, 1)], "nid long, key string")
    placed = {r.nid: r.shard for r in sharding.balanced_propagation(nodes, links, 4, 8).collect()}
    cut = sum(placed[i] != placed[i + 1] for c in range(8) for i in range(10 * c, 10 * c + 9))
    spread = [sum(s == k for s in placed.values()) for k in range(4)]
    assert spread == [20] * 4
    assert cut < 45, cut  # 54 of 72 links are cut by chance


def test_empty_tables(no_docs):
    assert exact_dedup.exact_duplicates(no_docs).count() == 0
    assert jaccard.similar_texts(no_docs).count() == 0
    assert suffix_dedup.without_repeats(no_docs).count() == 0
    assert sharding.shard_documents(no_docs).count() == 0


def _set_rows(bodies, num=85, den=100):
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(bodies)), pa.int64()), pa.array(bodies, pa.binary())], names=["doc_id", "body"])
    none = np.array([], dtype=np.uint64), np.array([], dtype=np.int64)
    return pa.Table.from_batches(list(jaccard._sets(4, num, den, none)([batch]))).to_pylist()


def test_profiles_and_parities_bound_the_difference_of_sets_and_tell_long_texts_apart():
    rng = random.Random(3)
    hasher = WordHasher(4)
    for size in (5, 300, 1100, 4000, 12_000):
        words = [str(rng.randrange(10**6)) for _ in range(size)]
        near, longer = list(words), [*words, *map(str, range(size // 8 + 1))]
        near[size // 2] = "other"
        other = [str(rng.randrange(10**6)) for _ in range(size)]
        bodies = [" ".join(w).encode() for w in (words, near, longer, other)]
        rows, sets = _set_rows(bodies), [hasher.shingles(b) for b in bodies]
        for i, j in ((0, 1), (0, 2), (1, 2), (0, 3), (2, 3)):
            apart = len(np.setxor1d(sets[i], sets[j]))
            bits = sum((a & (1 << 64) - 1 ^ b & (1 << 64) - 1).bit_count() for a, b in zip(rows[i]["odd"], rows[j]["odd"], strict=True))
            assert bits <= apart and jaccard._apart(rows[i]["profile"], rows[j]["profile"]) <= apart
        n, m, mine, theirs = rows[0]["n_shingles"], rows[3]["n_shingles"], rows[0]["profile"], rows[3]["profile"]
        pair = pa.RecordBatch.from_pylist([{"x": 0, "p": 3, "n": n, "m": m, "mine": mine, "theirs": theirs}])
        assert not sum(b.num_rows for b in jaccard._near_profiles(85, 100)([pair])), size


def test_shingles_of_the_same_sets_are_one_region(spark):
    words = [f"w{i}" for i in range(200)]
    texts = [" ".join(words), " ".join([*words, "x"]), " ".join([*words, "y", "z"]), "nothing like the others at all"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows, *_, shared, _ = jaccard._grouped(docs, 4, 85, 100)
    assert shared.groupBy("nid").count().agg(F.max("count")).first()[0] <= 4
    assert sorted((r.doc_id, r.component_id) for r in rows.collect()) == [(0, 0), (1, 0), (2, 0), (3, 3)]


def test_common_shingles_are_counted_over_all_documents(spark):
    """Every shingle of more texts than a sample would take, and none is left out for being rare."""
    n = 25_000
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.lit("the words of every text "), F.col("id").cast("string")).alias("text"))
    tables = jaccard._common(docs, 4)
    assert [int(t.sum()) for t in tables] == [3 * n, 3 * n]
    held = lambda text: min(int(t[c][0]) for t, c in zip(tables, jaccard._classes(WordHasher(4).shingles(text)), strict=True))
    assert n <= held(b"the words of every") < n + 20 and n <= held(b"words of every text") < n + 20
    assert all(1 <= held(b"of every text %d" % i) < 20 for i in (0, 17, n - 1))
