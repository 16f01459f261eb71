"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index."""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from fieldloom.llm.common import ALNUM_LOWER, by_rows, importable, stage, texts

#: Examples of an index at most, about; more of them are dealt to several, which every text is held against.
EXAMPLES = 16_384
#: Texts of different features that are held against an index in one task, at most, about.
QUERIES = 20_000
#: Features of the index at most; what a feature must show among the examples: seen in so many,
#: toxic in at least this share of them, by a log-likelihood ratio of so much.
VOCABULARY = 4096
SEEN_IN = 4
PRECISION = 0.7
SIGNIFICANT = 15.0
#: Beginnings of longer words are features too: inflected words share them.
BEGINNINGS = (4, 6, 8)
NEIGHBOURS = 15
BLOCK = 64
#: Blocks that are looked into before the others are held against what they gave.
FIRST = 2
#: Texts of a file of those with their nearest examples.
NEAR_ROWS = 2000
#: What the votes count against: the share of toxic examples has this weight.
PRIOR_WEIGHT = 0.5


def features(body: bytes) -> Counter[bytes]:
    """Words, A-Z in lower case, and the beginnings of longer words, with their counts."""
    found = Counter(body.translate(ALNUM_LOWER).split())
    for word, n in list(found.items()):
        for size in BEGINNINGS:
            if len(word) <= size:
                break
            found[word[:size] + b"*"] += n
    return found


def _statistics(batches):
    """(term, examples, toxic ones) of each slice of a partition: combined before the shuffle."""
    import pyarrow as pa

    seen: Counter[bytes] = Counter()
    toxic: Counter[bytes] = Counter()

    def made():
        return pa.RecordBatch.from_arrays(
            [pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64()), pa.array([toxic[t] for t in seen], pa.int64())],
            names=["term", "n", "k"],
        )

    for batch in batches:
        for label, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            found = features(body).keys()
            seen.update(found)
            if label:
                toxic.update(found)
            if len(seen) > 300_000:
                yield made()
                seen.clear()
                toxic.clear()
    if seen:
        yield made()


def _largest(scores: np.ndarray, at: np.ndarray, k: int) -> list[tuple[float, int]]:
    """The ``k`` largest scores with their positions, ties by position."""
    if len(scores) > k:
        kept = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
        scores, at = scores[kept], at[kept]
    order = np.lexsort((at, -scores))[:k]
    return list(zip(scores[order].tolist(), at[order].tolist(), strict=True))


@dataclass
class BlockMaxIndex:
    """Postings of the examples by feature, in blocks of examples with the largest weight of each block."""

    terms: int
    idf: np.ndarray
    ids: list[int]
    toxic: np.ndarray
    prior: float
    block: int = BLOCK
    postings: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)
    tops: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))

    def weights(self, counts: dict[int, int]) -> dict[int, float]:
        """Unit TF-IDF vector: (1 + ln tf) idf over the index's features."""
        raw = {t: (1 + math.log(n)) * float(self.idf[t]) for t, n in sorted(counts.items())}
        norm = math.sqrt(sum(w * w for w in raw.values()))
        return {t: w / norm for t, w in raw.items()} if norm else {}

    def build(self, examples: list[dict[int, int]]) -> None:
        blocks = max(1, -(-len(examples) // self.block))
        self.tops = np.zeros((self.terms, blocks))
        rows: list[list[tuple[int, float]]] = [[] for _ in range(self.terms)]
        for i, counts in enumerate(examples):
            for t, w in self.weights(counts).items():
                rows[t].append((i, w))
        for t, row in enumerate(rows):
            at = np.array([i for i, _ in row], dtype=np.int64)
            weight = np.array([w for _, w in row])
            np.maximum.at(self.tops[t], at // self.block, weight)
            self.postings.append((at, weight, np.searchsorted(at, np.arange(blocks + 1) * self.block)))

    def nearest(self, query: dict[int, float], k: int) -> list[tuple[float, int]]:
        """The ``k`` examples of largest cosine over 0, ties by position: exact.

        Blocks come in the order of their bounds: the first few give k cosines, and of the
        others only those whose bound is not below the k-th of these are looked into.
        """
        if not query:
            return []
        terms = list(query)
        bounds = np.array([query[t] for t in terms]) @ self.tops[terms]
        blocks = np.argsort(-bounds, kind="stable")[: np.count_nonzero(bounds > 0)]
        found = self._scored(query, blocks[:FIRST])
        best, rest = _largest(*found, k), blocks[FIRST:]
        if len(best) == k:
            # a hair of slack: a bound and a cosine are sums in different orders
            rest = rest[bounds[rest] * (1 + 1e-9) >= best[-1][0]]
        if not len(rest):
            return best
        return _largest(*map(np.concatenate, zip(found, self._scored(query, rest), strict=True)), k)

    def _scored(self, query: dict[int, float], blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cosines over 0 of the examples in ``blocks``, and their positions; a feature's weights add up in the query's order."""
        scores = np.zeros(self.tops.shape[1] * self.block)
        if len(blocks) <= FIRST:
            for b in blocks.tolist():
                for t in query:
                    at, weight, starts = self.postings[t]
                    lo, hi = starts[b], starts[b + 1]
                    scores[at[lo:hi]] += query[t] * weight[lo:hi]
            at = np.flatnonzero(scores)
        else:
            # so many blocks are read faster with those between them
            for t in query:
                at, weight, _ = self.postings[t]
                scores[at] += query[t] * weight
            wanted = np.zeros(self.tops.shape[1], dtype=bool)
            wanted[blocks] = True
            at = np.flatnonzero(scores)
            at = at[wanted[at // self.block]]
        return scores[at], at

    def vote(self, near: list[tuple[float, int]]) -> float:
        """Share of toxic votes, each weighed by the inverse of its distance; the prior stands in where few are near."""
        total, toxic = PRIOR_WEIGHT, PRIOR_WEIGHT * self.prior
        for cosine, i in near:
            weight = cosine / (1 - min(cosine, 1.0) + 0.1)
            total += weight
            toxic += weight * float(self.toxic[i])
        return toxic / total


@dataclass
class Calibration:
    """What votes count as: a logistic curve over their log odds."""

    toxic: float
    slope: float = 1.0
    shift: float = 0.0

    def vote(self, near: list[dict]) -> float:
        """As :meth:`BlockMaxIndex.vote`, of neighbours from several indexes."""
        total, toxic = PRIOR_WEIGHT, PRIOR_WEIGHT * self.toxic
        for n in near:
            weight = -n["far"] / (1 - min(-n["far"], 1.0) + 0.1)
            total += weight
            toxic += weight * n["toxic"]
        return toxic / total

    def score(self, near: list[dict]) -> float:
        z = self.slope * log_odds(self.vote(near)) + self.shift
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def log_odds(vote: float) -> float:
    return math.log(max(vote, 1e-9) / max(1 - vote, 1e-9))


def calibrate(votes: DataFrame) -> tuple[float, float]:
    """Slope and shift of the logistic fit to (x, y, n): log odds of a vote, its label, how many there are.

    Each of Newton's steps is one aggregate over all of them; a little ridge keeps separable labels finite.
    """
    a, c = 1.0, 0.0
    for _ in range(50):
        z = F.greatest(F.lit(-30.0), F.least(F.lit(30.0), F.lit(a) * F.col("x") + F.lit(c)))
        p = 1 / (1 + F.exp(-z))
        w = F.greatest(p * (1 - p), F.lit(1e-6)) * F.col("n")
        off = (F.col("y") - p) * F.col("n")
        x = F.col("x")
        sums = votes.agg(*[F.sum(v) for v in (w * x * x, w * x, w, off * x, off)]).first()
        h = np.array([[sums[0] + 1, sums[1]], [sums[1], sums[2] + 1]])
        step = np.linalg.solve(h, np.array([sums[3] - (a - 1), sums[4] - c]))
        a, c = a + step[0], c + step[1]
        if np.abs(step).max() < 1e-8:
            break
    return (float(a), float(c)) if a > 0 else (1.0, 0.0)


WORDS = "doc_id long, body binary"


def _distinct_words(key, body: bytes):
    """The words of a text, each once: they have the features of the text, and are less to shuffle."""
    yield key, b" ".join(sorted(set(body.translate(ALNUM_LOWER).split())))


def may_teach(doc_id: Column) -> Column:
    """Whether labels of this id may be learnt."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 != 0


def chosen_terms(docs: DataFrame, examples: DataFrame, vocabulary: int = VOCABULARY) -> list[bytes]:
    """The features that speak for toxic among the examples, at most ``vocabulary``: so they may go through the driver."""
    able = texts(docs).withColumn("doc_id", F.col("doc_id").cast("long")).filter(may_teach(F.col("doc_id")))
    # a merge join at any size: what is shuffled grows with the input, not by leaps
    words = able.mapInArrow(by_rows(_distinct_words, WORDS), WORDS).join(examples.hint("merge"), "doc_id")
    bodies = words.select("toxic", "body")
    total = examples.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("k")).first()
    big, toxic = float(total["n"]), float(total["k"])
    counts = bodies.mapInArrow(_statistics, "term binary, n long, k long").groupBy("term")
    seen = counts.agg(F.sum("n").alias("n"), F.sum("k").alias("k")).filter((F.col("n") >= SEEN_IN) & (F.col("k") >= PRECISION * F.col("n")))
    n, k = F.col("n").cast("double"), F.col("k").cast("double")
    cell = lambda o, e: F.when((o > 0) & (e > 0), o * F.log(o * F.lit(big) / e)).otherwise(0.0)
    ratio = 2 * (
        cell(k, n * toxic) + cell(n - k, n * (big - toxic))
        + cell(toxic - k, (big - n) * toxic) + cell(big - n - toxic + k, (big - n) * (big - toxic))
    )
    best = seen.withColumn("ratio", ratio).filter(F.col("ratio") >= SIGNIFICANT).orderBy(F.desc("ratio"), "term").limit(vocabulary)
    return sorted(bytes(r["term"]) for r in best.select("term").collect())


COUNTED = "doc_id long, row long, terms array<int>, counts array<int>"


def counted(docs: DataFrame, terms: list[bytes], row_col: str | None = None) -> DataFrame:
    """(doc_id, row, terms, counts): how often each row's whole text has each chosen feature.

    ``row`` is the column that tells rows of a doc_id apart, null if there is none.
    """
    numbers = {t: i for i, t in enumerate(terms)}
    row = F.col(f"`{row_col}`").cast("long") if row_col else F.lit(None).cast("long")
    keyed = docs.select(F.struct(F.col("doc_id").cast("long").alias("doc_id"), row.alias("row")).alias("key"), F.col("text"))

    def process(key, body):
        found = features(body)
        rows = sorted((numbers[t], found[t]) for t in found.keys() & numbers.keys())
        yield key["doc_id"], key["row"], [t for t, _ in rows], [n for _, n in rows]

    return texts(keyed, "key").mapInArrow(by_rows(process, COUNTED), COUNTED)


MARK = ["terms", "counts"]
NEAR = "terms array<int>, counts array<int>, near array<struct<far:double,doc_id:long,toxic:int>>"


def neighbours(marks: DataFrame, examples: DataFrame, idf: np.ndarray, k: int, size: int = EXAMPLES) -> DataFrame:
    """(terms, counts, near): the ``k`` examples of largest cosine for each of ``marks``, ties by doc_id.

    Of examples with the same features only the first ``k`` can be near anything.  These are
    dealt to indexes of about ``size``, marks to slices; each slice meets each index in a task
    of its own, and the best of all indexes are the result.
    """
    first = F.row_number().over(W.partitionBy(*MARK).orderBy("doc_id"))
    kept = stage(examples.filter(F.size("terms") > 0).withColumn("place", first).filter(F.col("place") <= k).drop("place"), "toxicity-kept", examples.count())
    context = marks.sparkSession.sparkContext
    n_marks = marks.count()
    indexes = max(1, -(-kept.count() // size))
    slices = max(-(-n_marks // QUERIES), min(4 * context.defaultParallelism, n_marks // 64 + 1))
    shared = context.broadcast(idf)  # bounded by VOCABULARY
    schema = to_arrow_schema(_parse_datatype_string(NEAR))

    def meet(texts, held):
        import pyarrow as pa

        rows = sorted(held.select(["doc_id", "toxic", *MARK]).to_pylist(), key=lambda r: r["doc_id"])
        labels = np.array([r["toxic"] for r in rows], dtype=np.int64)
        index = BlockMaxIndex(len(shared.value), shared.value, [r["doc_id"] for r in rows], labels, 0.0)
        index.build([dict(zip(r["terms"], r["counts"], strict=True)) for r in rows])
        found = []
        for r in texts.select(MARK).to_pylist():
            near = index.nearest(index.weights(dict(zip(r["terms"], r["counts"], strict=True))), k)
            found.append({**r, "near": [{"far": -c, "doc_id": index.ids[i], "toxic": int(index.toxic[i])} for c, i in near]})
        return pa.Table.from_pylist(found, schema=schema)

    by, tasks = ["index", "slice"], indexes * slices
    dealt = lambda n: F.pmod(F.xxhash64(*MARK), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = marks.withColumn("slice", dealt(slices)).withColumn("index", every(indexes)).repartition(tasks, *by)
    right = kept.withColumn("index", dealt(indexes)).withColumn("slice", every(slices)).repartition(tasks, *by)
    met = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(meet, NEAR)
    best = F.slice(F.sort_array(F.flatten(F.collect_list("near"))), 1, k)
    return met.groupBy(*MARK).agg(best.alias("near"))


def fit(
    docs: DataFrame, labels: DataFrame, size: int = EXAMPLES, vocabulary: int = VOCABULARY, row_col: str | None = None
) -> tuple[Calibration, DataFrame]:
    """The calibration, and (doc_id, row, near): every document with its nearest examples.

    Examples are all labelled rows whose crc32(doc_id) mod 5 is not 0.  The document
    frequencies of the features are counted over all documents.  A doc_id with several
    labels is toxic if one of them says so; of documents that repeat a doc_id one is an
    example, the one whose features come first; null ids and labels are passed over.
    """
    spark = docs.sparkSession
    importable(spark)
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).dropna()
    labelled = stage(
        known.filter(may_teach(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .join(docs.select(F.col("doc_id").cast("long").alias("doc_id")).distinct(), "doc_id", "left_semi"),
        "toxicity-examples",
    )
    terms = chosen_terms(docs, labelled, vocabulary)
    counts = stage(counted(docs, terms, row_col), "toxicity-counts")
    frequency = counts.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).collect()
    df = {r["term"]: r["df"] for r in frequency}
    n_docs = counts.count()
    idf = np.array([math.log((1 + n_docs) / (1 + df.get(i, 0))) + 1 for i in range(len(terms))])
    one = F.min(F.struct(*MARK)).alias("one")
    examples = stage(
        counts.join(labelled, "doc_id").groupBy("doc_id", "toxic").agg(one).select("doc_id", "toxic", "one.*"), "toxicity-marks", n_docs
    )
    total = examples.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("k")).first()
    marks = stage(counts.filter(F.size("terms") > 0).select(*MARK).distinct(), "toxicity-texts", n_docs)
    near = stage(neighbours(marks, examples, idf, NEIGHBOURS + 1, size), "toxicity-near", marks.count(), NEAR_ROWS)

    def met(rows: DataFrame) -> DataFrame:
        """Rows with their neighbours; those without a feature, however many, do not pass the join."""
        bare = rows.filter(F.size("terms") == 0).withColumn("near", F.array().cast(near.schema["near"].dataType))
        return rows.filter(F.size("terms") > 0).join(near, MARK).unionByName(bare).drop(*MARK)

    curve = Calibration(total["k"] / total["n"] if total["n"] else 0.0)
    if 0 < total["k"] < total["n"]:

        def left_out(batches):
            import pyarrow as pa

            for batch in batches:
                ids, found = batch.column("doc_id").to_pylist(), batch.column("near").to_pylist()
                xs = [log_odds(curve.vote([n for n in near if n["doc_id"] != i][:NEIGHBOURS])) for i, near in zip(ids, found, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(xs, pa.float64()), batch.column("toxic")], names=["x", "y"])

        votes = met(examples).mapInArrow(left_out, "x double, y int").groupBy("x", "y").agg(F.count("*").alias("n"))
        curve.slope, curve.shift = calibrate(stage(votes, "toxicity-votes", total["n"]))
    return curve, met(counts)


SCHEMA = "doc_id long, row long, score double, evidence array<struct<doc_id:long,cosine:double,toxic:int>>"


def score(met: DataFrame, curve: Calibration, neighbours: int = NEIGHBOURS) -> DataFrame:
    """(doc_id, row, score, evidence) of every row, from its nearest examples.

    ``score`` is the calibrated share of the distance-weighted votes of the nearest
    examples; ``evidence`` lists them, nearest first, ties by doc_id.  A text without a
    feature of the index - null and empty ones too - has no neighbour and the calibrated
    prior for a score.
    """

    def run(batches):
        import pyarrow as pa

        evidence = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.int32())]))
        for batch in batches:
            near = [found[:neighbours] for found in batch.column("near").to_pylist()]
            told = [[{"doc_id": n["doc_id"], "cosine": -n["far"], "toxic": n["toxic"]} for n in found] for found in near]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row"), pa.array([curve.score(n) for n in near], pa.float64()), pa.array(told, evidence)],
                names=["doc_id", "row", "score", "evidence"],
            )

    return met.mapInArrow(run, SCHEMA)


def toxicity(docs: DataFrame, labels: DataFrame, row_col: str | None = None) -> DataFrame:
    """(doc_id, held_out, score, predicted, evidence): one row for each row of ``docs``.

    With ``row_col``, a column of row ids, these come too, as ``row``: they tell rows apart
    that share a doc_id, or have none.

    Null and empty texts get a score too (see ``score``); repeated rows are scored each; a
    null doc_id is not held out; an empty table gives none; without labels, or with one
    kind of them, no feature is chosen and every score is the prior.  Only doc_id and text
    of ``docs``, doc_id and toxic of ``labels`` are read.
    """
    curve, met = fit(docs, labels, row_col=row_col)
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    return score(met, curve).select(
        "doc_id",
        *(["row"] if row_col else []),
        F.coalesce(remainder == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "evidence",
    )
