"""SentencePiece encoding and decoding of document tables."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame

from fieldloom.llm.common import by_rows, texts

MODEL = "piece_bpe_32k.model"


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encode(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_ids, ids) of every row; ids are little-endian int32, see ``transducer.Transducer``.

    Null and empty texts have no id; repeated rows are encoded each; an empty table gives
    none; other columns are not read.  A text is encoded whole where it is read; the words
    met before are known to the worker, in a bounded table.
    """
    path = path or model_path()

    def process(key, body):
        from fieldloom.llm.transducer import transducer

        ids = transducer(path).encode(body.decode("utf-8", "replace"))
        yield key, len(ids) // 4, ids

    schema = "doc_id long, n_ids long, ids binary"
    return texts(docs, id_col, text_col).mapInArrow(by_rows(process, schema), schema)


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, text) of rows (doc_id, ids); null ids count as none and give an empty text."""
    path = path or model_path()

    def process(key, ids):
        from fieldloom.llm.transducer import transducer

        yield key, transducer(path).decode(ids or b"")

    return encoded.select("doc_id", "ids").mapInArrow(by_rows(process, "doc_id long, text string"), "doc_id long, text string")


def round_trips(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_ids, ids_crc32, n_chars, decoded_crc32, same): each text encoded, and decoded again.

    ``ids_crc32`` is over little-endian int32 ids.  ``same``: the decoded text is the text.
    A space mark (U+2581) in a text comes back as a blank, so such a text is not the same.
    """
    path = path or model_path()

    def process(key, body):
        from fieldloom.llm.transducer import transducer

        text = body.decode("utf-8", "replace")
        ids = transducer(path).encode(text)
        back = transducer(path).decode(ids)
        yield key, len(ids) // 4, zlib.crc32(ids), len(text), zlib.crc32(back.encode()), back == text

    schema = "doc_id long, n_ids long, ids_crc32 long, n_chars long, decoded_crc32 long, same boolean"
    return texts(docs).mapInArrow(by_rows(process, schema), schema)
