"""Vector codes: the pivot search, the whole query against its SQL and a plain version, odd rows."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from fieldloom.llm import vector_codes
from fieldloom.llm.queries import op13_vector_codes
from tests.compare import connect

SCHEMA = "vec_id long, embedding array<float>, label int, code string, ints int, error string"


def plain_version(rows, parts=8, entries=16, rounds=6):
    """(vec_id, code, error, label_error, sha) of (vec_id, vector, label), everything worked out."""
    usable = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    if not usable:
        return Counter()
    length = len(min(usable, key=key)[1])
    usable = sorted((r for r in usable if len(r[1]) == length), key=key)
    width = -(-length // parts)
    whole = [[math.floor(4096 * float(np.float32(x))) for x in r[1]] + [0] * (width * parts - length) for r in usable]
    cut = [[v[j * width : (j + 1) * width] for j in range(parts)] for v in whole]
    books = [[v[j] for v in cut[:entries]] for j in range(parts)]

    def best(j, part):
        return min((sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), i) for i, e in enumerate(books[j]))

    for _ in range(rounds):
        met = defaultdict(list)
        for v in cut:
            for j in range(parts):
                met[j, best(j, v[j])[1]].append(v[j])
        for (j, i), members in met.items():
            books[j][i] = [sum(c) // len(members) for c in zip(*members, strict=True)]
    sha = hashlib.sha256(",".join(str(c) for book in books for e in book for c in e).encode()).hexdigest()
    found = [[best(j, v[j]) for j in range(parts)] for v in cut]
    label_error = Counter()
    for r, f in zip(usable, found, strict=True):
        label_error[r[2]] += sum(d for d, _ in f)
    return Counter(
        (r[0], "".join(f"{i:02x}" for _, i in f), sum(d for d, _ in f), label_error[r[2]], sha) for r, f in zip(usable, found, strict=True)
    )


@pytest.mark.parametrize("seed", range(6))
def test_pivot_search_is_exact_and_saves_work(seed):
    rng = np.random.default_rng(seed)
    centres = rng.integers(-3000, 3000, size=(16, 8))
    x = centres[rng.integers(0, 16, 500)] + rng.integers(-200, 200, size=(500, 8))
    book = centres.copy()
    book[9] = book[4]  # ties go to the lower index
    pivots = vector_codes.fixed_pivots(book, 4)
    far = [np.sqrt(vector_codes.distances(y, pivots).astype(float)) for y in (x, book)]
    code, error, evaluated = vector_codes.nearest(x, far[0].astype(np.float32), book, far[1])
    every = vector_codes.distances(x, book)
    assert (code == every.argmin(axis=1)).all() and (error == every.min(axis=1)).all() and 9 not in code
    assert evaluated < 500 * 16 / 3


def test_pivot_search_on_large_and_equal_numbers():
    big = 2**27
    x = np.array([[big, -big] * 4, [0] * 8, [big - 1] * 8, [1] * 8])
    book = np.array([[0] * 8, [big] * 8, [0] * 8, [-big] * 8])
    pivots = vector_codes.fixed_pivots(book, 4)
    far = [np.sqrt(vector_codes.distances(y, pivots).astype(float)) for y in (x, book)]
    code, error, _ = vector_codes.nearest(x, far[0].astype(np.float32), book, far[1])
    every = vector_codes.distances(x, book)
    assert code.tolist() == every.argmin(axis=1).tolist() and error.tolist() == every.min(axis=1).tolist()


def test_query_equals_sql(spark, tables_dir):
    df = op13_vector_codes(spark, tables_dir)
    cursor = connect(tables_dir).execute(vector_codes.ORACLE)
    names = [d[0] for d in cursor.description]
    assert Counter(map(tuple, df.collect())) == Counter(tuple(row[names.index(c)] for c in df.columns) for row in cursor.fetchall())


def _frame(spark, rows):
    return spark.createDataFrame([(*r, "c", 1, "e") for r in rows], SCHEMA).repartition(3)


def test_odd_rows_against_plain_version(spark):
    rng = random.Random(8)
    vector = lambda n=16: [float(np.float32(rng.gauss(0, 1))) for _ in range(n)]
    rows = [(i, vector(), rng.choice([None, None, 1, 2])) for i in range(60)]
    rows += [(5, rows[7][1], None), (5, rows[7][1], None), (0, rows[0][1], 2), (None, vector(), 1), (None, None, None)]
    rows += [(70, None, 1), (71, [None] * 16, 1), (72, [float("nan")] + [0.0] * 15, 1), (73, [float("inf")] * 16, 2)]
    rows += [(74, [], 1), (75, vector(8), 1), (76, [0.0] * 16, None), (77, [-0.0] * 16, None)]
    assert Counter(map(tuple, vector_codes.vector_codes(_frame(spark, rows)).collect())) == plain_version(rows)


@pytest.mark.parametrize("length", [8, 11, 3, 1])
def test_few_rows_and_uneven_lengths(spark, length):
    rng = random.Random(length)
    rows = [(-i, [float(np.float32(rng.uniform(-2, 2))) for _ in range(length)], i % 3) for i in range(7)]
    # the shorter vector of a larger id is not what sets the length
    rows.append((9, [1.0] * (length + 1), 1))
    assert Counter(map(tuple, vector_codes.vector_codes(_frame(spark, rows)).collect())) == plain_version(rows)


def test_empty_table_and_large_components(spark):
    assert vector_codes.vector_codes(_frame(spark, [])).collect() == []
    assert vector_codes.vector_codes(_frame(spark, [(1, None, 1)])).collect() == []
    with pytest.raises(Exception, match="64 bits"):
        vector_codes.vector_codes(_frame(spark, [(1, [3e38] * 8, 1)])).collect()


def test_decompress(spark):
    rows = [(i, [float(i), i / 2, 0.25, -i / 4] * 4, 0) for i in range(8)]
    coded, books = vector_codes.compress(_frame(spark, rows))
    # fewer vectors than entries: every one is an entry of its own
    back = {r.vec_id: r.approximation for r in vector_codes.decompress(coded, books).collect()}
    assert back == {i: v for i, v, _ in rows}
    assert books.decoded(coded.filter("vec_id = 3").first().code) == [round(4096 * x) for x in rows[3][1]]
