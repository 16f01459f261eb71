"""SentencePiece, packing, vectors, the pipeline, the registered queries."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from fieldloom.llm import common, embeddings, exact_dedup, packing, pieces, queries, toxicity, wordpieces
from fieldloom.llm.transducer import transducer
from fieldloom.llm.wordpieces import encoder
from tests.llm import brute

tokenizers = pytest.importorskip("tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")
pytest.importorskip("public_tokenizers")


def _texts(rng, n):
    for k in range(n):
        alphabet = "abcdeghiorst  \n\té你ß▁01,.'" if k % 2 else ["  ", " ", "the", "ing", "er", "tion", "   ", "Wh", "un", "\U0001f600", "İ", "é"]
        yield "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30)))


def test_transducer_gives_the_ids_of_the_library():
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())
    own = transducer(pieces.model_path())
    for text in _texts(random.Random(1), 3000):
        ids = own.encode(text)
        assert np.frombuffer(ids, dtype="<i4").tolist() == library.encode(text)
        assert own.decode(ids) == library.decode(library.encode(text)) == text.replace("▁", " ")


def test_encode_and_decode_tables(odd_docs, odd_rows, no_docs, table, table_rows):
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())
    encoded = pieces.encode(odd_docs)
    got = sorted(np.frombuffer(bytes(r.ids), dtype="<i4").tolist() for r in encoded.collect())
    assert got == sorted(library.encode(t or "") for _, t in odd_rows)
    assert sorted(r.text for r in pieces.decode(encoded).collect()) == sorted(t or "" for _, t in odd_rows)
    assert pieces.round_trips(no_docs).count() == 0
    want = {k: zlib.crc32(np.array(library.encode(t), dtype="<i4").tobytes()) for k, t in table_rows}
    assert {r.doc_id: r.ids_crc32 for r in pieces.round_trips(table).collect()} == want


def test_word_encoder_gives_the_ids_of_the_library():
    library = tokenizers.Tokenizer.from_file(packing.tokenizer_path())
    own = encoder(packing.tokenizer_path())
    odd = ["<|endoftext|>", "a<|startoftext|>b", "don't I'LL x's", "ÀÉ Ÿ ß ÿ×÷", "a b c\x85d", "Ab, ab. AB; c:!?", "é" * 500, "x" * 5000, "ΣΑΣ Σ", "1234 ½"]
    for text in [*odd, *_texts(random.Random(2), 2000)]:
        assert np.frombuffer(own.ids(text), dtype=own.type).tolist() == library.encode(text, add_special_tokens=False).ids


def test_word_encoder_meets_every_letter_and_sign():
    library = tokenizers.Tokenizer.from_file(packing.tokenizer_path())
    own = encoder(packing.tokenizer_path())
    rng = random.Random(4)
    letters = [chr(c) for c in range(256) if chr(c).isalpha()]
    signs = [chr(c) for c in range(33, 127) if not chr(c).isalnum()]
    words = ["".join(rng.choices(letters, k=rng.randint(1, 12)) + rng.choices(signs, k=rng.randint(0, 4))) for _ in range(5000)]
    odd = ["<|endoftext|>$", "a<|endoftext|>", "b<|", "<|ENDOFTEXT|>", "x''", "it's'", "J\u030c,", "e\u0301!", "_", "a_", "$$$", "ªº", "µ"]
    for text in [*words, *odd, " ".join(words)]:
        assert np.frombuffer(own.ids(text), dtype=own.type).tolist() == library.encode(text, add_special_tokens=False).ids


def test_words_of_letters_and_signs_take_no_whole_run_of_the_tokenizer(monkeypatch):
    own = wordpieces.WordEncoder(packing.tokenizer_path())
    whole, fresh = [], own._fresh
    monkeypatch.setattr(own, "_fresh", lambda part: whole.append(part) or fresh(part))
    own.ids("Été, été. ÉTÉ*** the*** größe%%% the of, größe\nthe%%%")
    assert sorted(whole) == ["%%%", "***", ",", "."]


def test_full_tables_of_words_change_no_ids(monkeypatch):
    library = tokenizers.Tokenizer.from_file(packing.tokenizer_path())
    monkeypatch.setattr(wordpieces, "_MOST_KEPT", 7)
    own = wordpieces.WordEncoder(packing.tokenizer_path())
    for text in [*_texts(random.Random(5), 500), "The the, THE. été Été, a b c d e f g h i j The été"]:
        assert np.frombuffer(own.ids(text), dtype=own.type).tolist() == library.encode(text, add_special_tokens=False).ids
        assert len(own.known) <= 7 and len(own.older) <= 7


def _check_packing(rows, texts, window=4096):
    """``texts``: the multiset of all texts by doc_id."""
    library = tokenizers.Tokenizer.from_file(packing.tokenizer_path())
    want = sorted(library.encode(t or "", add_special_tokens=False).ids + [2] for _, t in texts)
    by_doc = {}
    for r in rows:
        ids = np.frombuffer(bytes(r.ids), dtype=f"<u{r.width}").astype("<u4")
        assert len(ids) == r.length and zlib.crc32(ids.tobytes()) == r.ids_crc32
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, ids.tolist()))
    if len({k for k, _ in texts}) == len(texts):
        got = []
        for (_, n), parts in by_doc.items():
            ids = []
            for start, part in sorted(parts):
                assert start == len(ids)
                ids += part
            assert len(ids) == n
            got.append(ids)
        assert sorted(got) == want
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= window and (end == window or end & (end - 1) == 0)
    assert sorted(sequences) == list(range(len(sequences)))
    assert sum(r.length for r in rows) == sum(map(len, want))


def test_packing(odd_docs, odd_rows, table, table_rows, no_docs):
    _check_packing(packing.pack(odd_docs).collect(), odd_rows)
    _check_packing(packing.pack(table).collect(), table_rows)
    assert packing.pack(no_docs).count() == 0


def test_combinations_fit_the_histogram():
    rng = random.Random(3)
    histogram = {rng.randint(1, 63): rng.randint(1, 50) for _ in range(40)}
    rows, sequences = packing.planned(histogram, 64)
    used, filled = {}, {}
    for n, lo, hi, first, offset in sorted(rows):
        assert lo == used.get(n, 0)
        used[n] = hi
        for i in range(first, first + hi - lo):
            filled.setdefault(i, []).append((offset, n))
    assert all(used[n] <= histogram[n] for n in used) and len(filled) == sequences
    for parts in filled.values():
        end = 0
        for offset, n in sorted(parts):
            assert offset == end
            end += n
        assert end == 64


def _vectors(rng):
    rows = []
    for _ in range(30):
        base = rng.normal(size=32)
        for _ in range(rng.integers(1, 12)):
            rows.append((base + rng.normal(size=32) * rng.choice([0.0, 0.1, 0.25, 0.45])).astype(np.float32).tolist())
    rows += [rows[0]] * 5 + [(np.array(rows[0]) * 3).astype(np.float32).tolist()]
    rows += [None, [], [0.0] * 32, [float("nan")] * 32, [None] * 32, [float("inf")] + [1.0] * 31, [1.0, 2.0], [2.0, 4.0], [1e-30] * 32, [1e30] * 32]
    return [(len(rows) - i, v, i % 3, "x", 1) for i, v in enumerate(rows)]


def _linked(rows):
    sound = {k: np.array(v, dtype=float) for k, v in rows if v and None not in v and np.isfinite(v).all() and np.any(v)}
    links = []
    for a, x in sound.items():
        for b, y in sound.items():
            if a < b and len(x) == len(y):
                x_, y_ = x / np.abs(x).max(), y / np.abs(y).max()
                if x_ @ y_ / np.linalg.norm(x_) / np.linalg.norm(y_) >= 0.9:
                    links.append((a, b))
    return links


@pytest.mark.parametrize("block", [embeddings.BLOCK, 3])
def test_near_duplicate_vectors(spark, monkeypatch, block):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    rows = _vectors(np.random.default_rng(8))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, rep string, bucket int").repartition(4)
    got = {r.vec_id: r for r in embeddings.near_duplicate_vectors(df).collect()}
    links = _linked([r[:2] for r in rows])
    assert len(got) == len(rows)
    found, want = sum(r.n_links for r in got.values()), 2 * len(links)
    assert 0.97 * want <= found <= want
    component = brute.components([r[0] for r in rows], links)
    assert sum(got[k].component_id == c for k, c in component.items()) >= 0.95 * len(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())
    counts = {k: sum(k in pair for pair in links) for k in got}
    assert all(got[k].n_links <= counts[k] for k in got)


def test_no_vectors(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert embeddings.near_duplicate_vectors(empty).count() == 0
    unsound = spark.createDataFrame([(1, None), (2, [0.0])], "vec_id long, embedding array<float>")
    assert {tuple(r) for r in embeddings.near_duplicate_vectors(unsound).collect()} == {(1, 0, 1, True), (2, 0, 2, True)}


def test_rotation_keeps_lengths():
    x = np.random.default_rng(0).normal(size=(5, 64))
    assert np.allclose(np.linalg.norm(embeddings.hadamard(x), axis=1), np.linalg.norm(x, axis=1))


def test_pipeline_against_brute_force(spark, tables_dir, table, table_rows):
    labels = spark.read.parquet(f"{tables_dir}/labels.parquet")
    rejected = {r.doc_id for r in toxicity.toxicity(table, labels).filter("predicted = 1").collect()}
    rows = [(k, t) for k, t in table_rows if k not in rejected]
    groups = brute.exact(rows)
    rows = [(k, t) for k, t in rows if groups[brute.normalised(t)][0] == k]
    _, component = brute.similar(rows, 5, 80, 100)
    rows = [(k, t) for k, t in rows if component[k] == k]
    clean = []
    for key, text in rows:
        for kind, a, b in reversed([s for s in brute.secrets(text) if s[0] != "hex"]):
            text = text[:a] + f"[{kind.upper()}]" + text[b:]
        clean.append((key, text))
    got = corpus_pipeline.run(spark, tables_dir).collect()
    assert {r.doc_id for r in got} == {k for k, _ in rows} and len(rows) < len(table_rows)
    if not any(s[0] == "hex" and not any(a <= s[1] and s[2] <= b for k, a, b in brute.secrets(t) if k == "assign") for _, t in rows for s in brute.secrets(t)):
        _check_packing(got, clean)


def test_pipeline_stages_keep_the_columns_and_take_odd_rows(spark, tables_dir, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for _, apply in corpus_pipeline.STAGES[:-1]:
            out = apply(spark, docs, tables_dir)
            assert out.columns == docs.columns and out.count() <= docs.count()


def _rows(df):
    return sorted((tuple(r[c] for c in ("doc_id", "text")) for r in df.select("doc_id", "text").collect()), key=str)


def test_pipeline_decides_by_row(spark, tables_dir):
    """Null and repeated ids: one row of each group stays, the others go, and no row goes for another one's text."""
    a, b, c = ("one two three four five six seven", "eight nine ten eleven twelve thirteen", " ".join(f"w{i}" for i in range(60)))
    near = c + " more"
    given = [(None, a), (None, a), (None, b), (5, a), (5, a), (5, a), (5, near), (8, b), (8, b), (8, c), (None, None), (3, ""), (None, c)]
    docs = spark.createDataFrame([(k, t, "en", "s", len(t or "")) for k, t in given], "doc_id long, text string, lang string, source string, n_chars long")
    stages = dict(corpus_pipeline.STAGES)
    assert _rows(stages["exact dedup"](spark, docs, tables_dir)) == sorted([(5, a), (8, b), (8, c), (5, near), (3, "")], key=str)
    assert _rows(stages["n-gram jaccard join"](spark, docs, tables_dir)) == sorted(
        [(5, a), (8, b), (5, near), (3, ""), (None, None)], key=str
    )
    # a toxic text does not take along, nor is saved by, another row of its id
    words = [f"vile{i} filth{i}" for i in range(3)]
    texts = [(i, f"{words[i % 3]} vile filth common{i % 7} words") for i in range(60)] + [(i, f"kind calm common{i % 7} words here") for i in range(60, 140)]
    labels = spark.createDataFrame([(i, 1, int(i < 60)) for i in range(140)], "doc_id long, quality int, toxic int")
    more = [(None, "vile filth again"), (None, "kind calm again"), (60, "vile filth vile"), (0, "kind calm words")]
    docs = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in texts + more], docs.schema)
    rows = corpus_pipeline._numbered(docs)
    scored = {(r.doc_id, r.text): r.predicted for r in toxicity.toxicity(rows, labels, corpus_pipeline.ROW).join(rows.select(corpus_pipeline.ROW, "text"), F.col("row") == F.col(corpus_pipeline.ROW)).collect()}
    assert [scored[m] for m in more] == [1, 0, 1, 0]


def test_stages_that_nothing_reads_are_removed(spark, tables_dir):
    before = set(common._written)
    out = corpus_pipeline.run(spark, tables_dir)
    left = set(common._written) - before
    assert len(left) == 1 and out._stage_path in left and out.count() > 0


def test_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14)) and set(queries.QUERIES) | {"pipeline"} <= set(contract.queries())


def test_exact_dedup_equals_sql(spark, tables_dir):
    import duckdb

    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tables_dir}/documents.parquet')")
        want = sorted(db.execute(f"SELECT doc_id, keep_id, group_size, kept, text_sha256 FROM ({exact_dedup.ORACLE})").fetchall())
    got = queries.QUERIES["op9_exact_dedup"](spark, tables_dir).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert sorted(tuple(r) for r in got.collect()) == want
