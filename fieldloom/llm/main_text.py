"""Main text of web pages: the maximum-scoring region of words and tags, with weights from labelled pages."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.llm.common import importable
from fieldloom.llm.markup import BLOCK, TEXT_BLOCKS, Page

#: Weights before any page was seen, and how many tokens of a class they count as.
PRIOR = {"text": 1.0, "link": 0.25}
PRIOR_TAG, PRIOR_TOKENS = -3.25, 200
#: Words stay positive and tags negative, within these bounds.
WORD_BOUNDS, TAG_BOUNDS = (0.1, 2.0), (-4.0, -0.5)
#: Words outside the element by which a page marks its content.
OUTSIDE = -1.0
#: Sections that are the page rather than a part of it.
WHOLE = ("#page", "html", "body", "center", "form")
TAG_CLASSES = BLOCK | frozenset("a abbr b br cite code del em i img input ins kbd mark q s samp small span strike strong sub sup u var".split())


def item_class(name: str) -> str:
    return name if name in PRIOR or name in TAG_CLASSES else "other"


def counted(page: Page) -> dict[str, list[int]]:
    """Tokens by class inside and outside the content of a page that marks it; none for other pages."""
    counts: dict[str, list[int]] = {}
    if any(mark and not apart for *_, apart, mark in page.items):
        for name, count, _, apart, mark in page.items:
            counts.setdefault(item_class(name), [0, 0])[0 if mark and not apart else 1] += count
    return counts


def weights(counts: dict[str, tuple[int, int]]) -> dict[str, float]:
    """The weight of every class of tokens: the log odds of content, drawn towards the prior where tokens are few."""
    inside, outside = (sum(c[i] for c in counts.values()) for i in (0, 1))
    out = {}
    for name in sorted({*PRIOR, *TAG_CLASSES, "other"}):
        n_in, n_out = counts.get(name, (0, 0))
        odds = math.log((n_in + 0.5) / (inside + 1)) - math.log((n_out + 0.5) / (outside + 1))
        seen = n_in + n_out
        mixed = (seen * odds + PRIOR_TOKENS * PRIOR.get(name, PRIOR_TAG)) / (seen + PRIOR_TOKENS)
        low, high = WORD_BOUNDS if name in PRIOR else TAG_BOUNDS
        out[name] = min(high, max(low, mixed))
    return out


def best_region(scores: list[float]) -> tuple[int, int]:
    """The slice of the greatest positive sum, found in one scan; the first one of several, (0, 0) without any."""
    best, found, total, start = 0.0, (0, 0), 0.0, 0
    for i, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += score
        if total > best:
            best, found = total, (start, i + 1)
    return found


def _spans(page: Page) -> tuple[list[int], list[int]]:
    """By element: the last element within it (numbers run in page order), and the section it stands in or is."""
    last, section = list(range(len(page.parent))), [0] * len(page.parent)
    for e in range(len(last) - 1, 0, -1):
        last[page.parent[e]] = max(last[page.parent[e]], last[e])
    for e in range(1, len(last)):
        name = page.tag[e]
        section[e] = e if name in BLOCK and name not in TEXT_BLOCKS else section[page.parent[e]]
    return last, section


def content_pieces(page: Page, weight: dict[str, float]) -> list[list]:
    """The pieces of text in the best region, drawn out to whole blocks of the element that holds it.

    Words score their weight, tags theirs; the zones that stand apart have no words, and of
    their tags only their own two count.  Where a page marks its content, words outside the
    mark score below nothing.  The region then grows to the section that holds all of it:
    the marked element, else the nearest section that is not the whole page; right under
    the page itself, to the running text next to it.
    """
    marked = {page.mark[page.pieces[p][1]] for _, _, p, _, mark in page.items if p >= 0 and mark}
    kind = next((m for m in ("article", "body", "main") if m in marked), None)
    inside = [kind is None or page.mark[block] == kind for _, block, _ in page.pieces]
    scores, at = [], []
    for name, count, piece, apart, _ in page.items:
        w = weight[item_class(name)]
        if piece >= 0:
            scores.append(w * count if inside[piece] else OUTSIDE * count)
        else:
            scores.append(0.0 if apart and name in PRIOR else w)
        at.append(piece)
    start, end = best_region(scores)
    region = [p for p in at[start:end] if p >= 0]
    if not region:
        return []
    ends, section = _spans(page)
    blocks = [page.pieces[p][1] for p in region]
    low, high, holder = min(blocks), max(blocks), blocks[0]
    while holder > low or ends[holder] < high:
        holder = page.parent[holder]
    if kind and page.mark[holder] == kind:
        while page.mark[page.parent[holder]] == kind:
            holder = page.parent[holder]
    else:
        holder = section[holder]
    whole_page = page.tag[holder] in WHOLE

    def belongs(p: int) -> bool:
        block = page.pieces[p][1]
        return inside[p] and holder <= block <= ends[holder] and (not whole_page or section[block] == holder)

    first, last = region[0], region[-1]
    while first > 0 and belongs(first - 1):
        first -= 1
    while last + 1 < len(page.pieces) and belongs(last + 1):
        last += 1
    return [page.pieces[p] for p in range(first, last + 1) if inside[p]]


def main_text(source: str, weight: dict[str, float]) -> str:
    """The text of the content: white space becomes one space, blocks are joined by one."""
    pieces = content_pieces(Page(source), weight)
    return " ".join("".join(" " + text if new else text for text, _, new in pieces).split())


def _sources(batch):
    for start in range(0, batch.num_rows, 256):
        yield from batch.column("html").slice(start, 256).to_pylist()


def page_weights(pages: DataFrame, html_col: str = "html") -> dict[str, float]:
    """Weights learned from all pages that mark their content themselves.

    The labels are the pages' own: ``<article>``, ``<main>``, ``role="main"``,
    ``itemprop="articleBody"``.  Tasks count tokens by class, inside the mark and outside;
    the driver gets one line per class.  Without a marked page the prior weights hold.
    """
    importable(pages.sparkSession)

    def run(batches):
        import pyarrow as pa

        totals: dict[str, list[int]] = {}
        for batch in batches:
            for source in _sources(batch):
                for name, (n_in, n_out) in counted(Page(source or "")).items():
                    total = totals.setdefault(name, [0, 0])
                    total[0] += n_in
                    total[1] += n_out
        yield pa.RecordBatch.from_pydict(
            {
                "name": pa.array(list(totals), pa.string()),
                "n_in": pa.array([t[0] for t in totals.values()], pa.int64()),
                "n_out": pa.array([t[1] for t in totals.values()], pa.int64()),
            }
        )

    rows = pages.select(F.col(f"`{html_col}`").cast("string").alias("html")).mapInArrow(run, "name string, n_in long, n_out long")
    found = rows.groupBy("name").agg(F.sum("n_in").alias("n_in"), F.sum("n_out").alias("n_out")).collect()
    return weights({r.name: (r.n_in, r.n_out) for r in found})


def extract(
    pages: DataFrame,
    weight: dict[str, float] | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """(page_id, url, text, n_chars): the main text of every page, read whole.

    The page is read once as words and tags.  Menus, headers and footers of the page,
    sidebars, notices, adverts, forms, scripts, styles and reader comments are told by
    their tags, roles and names and have no words; among the rest a linear scan finds the
    region of the greatest sum of weights (:func:`content_pieces`).  ``weight`` comes from
    :func:`page_weights` of the same pages if not given.  Character references are
    decoded in text only, so a reference to a bracket makes no tag.

    Null and empty pages, and pages without any word of content, give an empty text;
    rows that repeat an id are read each; broken markup is read as browsers do (open
    elements end with those around them, an unfinished tag ends the page); an empty table
    gives none; other columns are not read.  Rows stay where they are read.
    """
    weight = page_weights(pages, html_col) if weight is None else weight
    importable(pages.sparkSession)
    rows = pages.select(
        F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"), F.col(f"`{html_col}`").cast("string").alias("html")
    )
    schema = rows.drop("html").schema.add("text", "string").add("n_chars", "long")

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = [main_text(source or "", weight) for source in _sources(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=schema.names,
            )

    return rows.mapInArrow(run, schema)
