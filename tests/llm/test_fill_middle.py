"""Fill-in-middle: rotations, the whole query against its SQL and a plain version, odd rows."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import pytest

from fieldloom.llm import fill_middle
from fieldloom.llm.queries import op11_fill_in_middle
from tests.compare import connect


def plain_version(key, text, fim=100, spm=50, seed=7):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in range(0, 32, 8))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= fim:
        return key, n, "plain", None, None, text
    if h4 % 100 < spm:
        return key, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return key, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("chunk", [1, 3, 1 << 16])
def test_rotation_in_place(monkeypatch, chunk):
    monkeypatch.setattr(fill_middle, "CHUNK", chunk)
    rng = random.Random(chunk)
    for size in [0, 1, 2, 7, 20, 51]:
        for _ in range(20):
            start, middle, end = sorted(rng.randint(0, size) for _ in range(3))
            body = rng.randbytes(size)
            buffer = bytearray(body)
            fill_middle.rotate(buffer, start, middle, end)
            assert bytes(buffer) == body[:start] + body[middle:end] + body[start:middle] + body[end:]


@pytest.mark.parametrize("seed", range(40))
def test_one_text_there_and_back(seed):
    rng = random.Random(seed)
    for key in range(50):
        # parts of marks stand next to the cuts
        text = "".join(rng.choice(["a", "é", "\n", "<", "S", "M>", "<P", ">", "\r", "𝄞"]) for _ in range(rng.randint(0, 30)))
        got = fill_middle.transformed(text.encode(), fill_middle.draws(seed, key), 90, 30)
        assert (key, *got[:4], got[4].decode()) == plain_version(key, text, 90, 30, seed)
        assert fill_middle.restored(got[4], got[1]).decode() == text


def test_query_equals_sql(spark, tables_dir):
    df = op11_fill_in_middle(spark, tables_dir)
    cursor = connect(tables_dir).execute(fill_middle.ORACLE)
    names = [d[0] for d in cursor.description]
    want = Counter(tuple(row[names.index(c)] for c in df.columns) for row in cursor.fetchall())
    assert Counter(map(tuple, df.collect())) == want
    assert {row[2] for row in want} >= {"psm", "spm"}


def test_odd_rows(odd_docs, odd_rows, no_docs):
    odd = [(row.doc_id, row.text) for row in odd_docs.collect()]
    want = Counter((*plain_version(*row)[:5], sha(plain_version(*row)[5]), sha(row[1] or "")) for row in odd)
    assert Counter(map(tuple, fill_middle.fill_in_middle_digest(odd_docs).collect())) == want
    assert fill_middle.fill_in_middle_digest(no_docs).count() == 0


def test_marks_in_the_text_and_rates(spark):
    texts = ["<P>", "a\n<M>\nb", "line\n" * 9, "\n\n\n", "one line"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = {r.doc_id: r for r in fill_middle.restore(fill_middle.fill_in_middle(docs)).collect()}
    assert all(rows[i].text == t for i, t in enumerate(texts))
    assert rows[0].form == rows[1].form == "plain" and rows[2].form != "plain" and rows[2].n == 9
    kept = fill_middle.fill_in_middle(docs, fim_percent=0).collect()
    assert {r.form for r in kept} == {"plain"} and all(bytes(r.output).decode() == texts[r.doc_id] for r in kept)
    assert {r.form for r in fill_middle.fill_in_middle(docs, spm_percent=0).collect()} == {"plain", "psm"}
