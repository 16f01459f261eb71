"""Fill-in-middle transformation by in-place block rotation."""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.llm.common import by_rows, texts

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Bytes that a reversal holds beside the text itself.
CHUNK = 1 << 16
FORMS = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output binary"
FORMS_COLUMNS = [field.split()[0] for field in FORMS.split(", ")]


def reverse(view: np.ndarray, start: int, end: int) -> None:
    """Turn ``view[start:end]`` round in place, a chunk from both ends at a time."""
    while end - start > 1:
        size = min(CHUNK, (end - start + 1) // 2)
        if end - start <= 2 * size:
            view[start:end] = view[start:end][::-1].copy()
            return
        head = view[start : start + size][::-1].copy()
        view[start : start + size] = view[end - size : end][::-1]
        view[end - size : end] = head
        start, end = start + size, end - size


def rotate(buffer: bytearray, start: int, middle: int, end: int) -> None:
    """Exchange the blocks ``[start, middle)`` and ``[middle, end)`` of ``buffer`` by three reversals."""
    view = np.frombuffer(buffer, dtype=np.uint8)
    reverse(view, start, middle)
    reverse(view, middle, end)
    reverse(view, start, end)


def draws(seed: int, doc_id: int | None) -> list[int]:
    """The first four groups of eight hex digits of sha256(``seed:doc_id``); a null id counts as no digits."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[i : i + 4], "big") for i in range(0, 16, 4)]


def line_ends(body: bytes) -> np.ndarray:
    """The byte after each line; a line ends behind its line feed or with the text."""
    ends = np.flatnonzero(np.frombuffer(body, dtype=np.uint8) == 10) + 1
    return ends if not body or body.endswith(b"\n") else np.append(ends, len(body))


def code_points(view: np.ndarray) -> int:
    return int(np.count_nonzero((view & 0xC0) != 0x80))


def transformed(body: bytes, random: list[int], fim_percent: int, spm_percent: int):
    """(lines, form, prefix_chars, middle_chars, output) of one text, see :func:`fill_in_middle`."""
    ends = line_ends(body)
    n = len(ends)
    h1, h2, h3, h4 = random
    if not body or any(mark in body for mark in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= fim_percent:
        return n, "plain", None, None, body
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    cut, end = (int(ends[k - 1]) if k else 0 for k in (first, second))
    view = np.frombuffer(body, dtype=np.uint8)
    prefix_chars, middle_chars = code_points(view[:cut]), code_points(view[cut:end])
    buffer = bytearray(body)
    for at, mark in ((end, SUFFIX), (cut, MIDDLE), (0, PREFIX)):
        buffer[at:at] = mark
    cut, end = cut + len(PREFIX), end + len(PREFIX) + len(MIDDLE)
    # <P>prefix<M>middle<S>suffix: the suffix goes before the middle, or before all
    form = "spm" if h4 % 100 < spm_percent else "psm"
    rotate(buffer, cut if form == "psm" else 0, end, len(buffer))
    return n, form, prefix_chars, middle_chars, bytes(buffer)


def restored(output: bytes, form: str) -> bytes:
    """The text behind ``output``: the inverse rotation, then the three marks are taken out.

    The text holds no mark, and no mark overlaps another one, so the first place of each is the one that was put in.
    """
    if form == "plain":
        return output
    buffer = bytearray(output)
    total = len(buffer)
    if form == "psm":
        suffix, middle = buffer.index(SUFFIX), buffer.index(MIDDLE)
        rotate(buffer, suffix, middle, total)
        marks = (0, suffix, suffix + total - middle)
    else:
        prefix, middle = buffer.index(PREFIX), buffer.index(MIDDLE)
        rotate(buffer, 0, prefix, total)
        marks = (0, middle - prefix, total - prefix)
    for at in reversed(marks):
        del buffer[at : at + 3]
    return bytes(buffer)


def fill_in_middle(
    docs: DataFrame, fim_percent: int = 100, spm_percent: int = 50, seed: int = 7, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output): every text cut at two line ends and laid out anew.

    ``n`` lines make n + 1 places; two of them, drawn by hash of seed and id, end the
    prefix and the middle.  Form ``psm`` is ``<P>prefix<S>suffix<M>middle``, ``spm``
    ``<S>suffix<P>prefix<M>middle``, ``plain`` the text as it is: where it is empty,
    holds one of the three marks already, or the draw says so (``fim_percent`` of the
    texts are laid out anew, ``spm_percent`` of these as spm).  ``output`` is UTF-8.

    A text is one byte array: the marks go in where the cuts are, and blocks change
    places by three reversals within it, so a long text costs its length and one chunk.
    Null and empty texts are plain, with n = 0; characters are null where the form is
    plain; rows that repeat an id are laid out alike, each for itself; a null id draws
    as an id without digits; an empty table gives none; other columns are not read.
    Rows stay where they are read: nothing is shuffled.
    """

    def process(key, body):
        yield key, *transformed(body, draws(seed, key), fim_percent, spm_percent)

    return texts(docs, id_col, text_col).mapInArrow(by_rows(process, FORMS), FORMS)


def restore(laid_out: DataFrame) -> DataFrame:
    """The rows of :func:`fill_in_middle` with ``text``, rebuilt from ``output`` and ``form`` alone."""
    schema = FORMS + ", text binary"

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                pairs = zip(part.column("output").to_pylist(), part.column("form").to_pylist(), strict=True)
                text = pa.array([restored(output, form) for output, form in pairs], type=pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, text], names=[*part.schema.names, "text"])

    rows = laid_out.select(*FORMS_COLUMNS).mapInArrow(run, schema)
    return rows.withColumn("text", F.col("text").cast("string"))


def fill_in_middle_digest(docs: DataFrame) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256) of every text and its way back."""
    return restore(fill_in_middle(docs)).select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("restored_sha256"),
    )


ORACLE = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS body, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h,
    regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units
  FROM documents
), d AS (
  SELECT doc_id, body, units, len(units) AS n,
    ('0x' || h[1:8])::UBIGINT AS h1, ('0x' || h[9:16])::UBIGINT AS h2, ('0x' || h[17:24])::UBIGINT AS h3, ('0x' || h[25:32])::UBIGINT AS h4
  FROM t
), c AS (
  SELECT doc_id, body, n, h4,
    body = '' OR contains(body, '<P>') OR contains(body, '<S>') OR contains(body, '<M>') OR h3 % 100 >= 100 AS plain,
    array_to_string(units[1 : least(h1 % (n + 1), h2 % (n + 1))], '') AS prefix,
    array_to_string(units[least(h1 % (n + 1), h2 % (n + 1)) + 1 : greatest(h1 % (n + 1), h2 % (n + 1))], '') AS middle,
    array_to_string(units[greatest(h1 % (n + 1), h2 % (n + 1)) + 1 : n], '') AS suffix
  FROM d
), f AS (SELECT *, CASE WHEN plain THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM c)
SELECT doc_id, n::BIGINT AS n, form,
  CASE WHEN NOT plain THEN length(prefix) END AS prefix_chars, CASE WHEN NOT plain THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN body WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(body) AS restored_sha256
FROM f
"""
