"""Toxicity scores from positive and unlabelled texts (operator 2).

Only confirmed toxic documents are taken as labels. Every other training text is unlabelled:
a mixture that holds toxic texts at the class prior. Linear classifiers in numpy minimise the
non-negative positive-unlabelled risk (Kiryo et al., 2017),

    prior * E_P[loss(+)] + max(0, E_U[loss(-)] - prior * E_P[loss(-)]),

with the logistic loss, so that the sigmoid of their mean output estimates the probability of
label 1. A text is the set of its words and of their beginnings and ends, hashed, and of those that repeat.

Training texts are a bounded sample of labelled rows and as many more; scoring covers every
whole text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearspan.llm.common import need
from clearspan.llm.spans import blocks, hash_spans, lowered, words_of

HASH_BITS = 22
#: Largest numbers of positive and of unlabelled texts that a fit takes, by least hash of the id.
MAX_POSITIVE, MAX_UNLABELLED = 4000, 8000
#: Features a classifier may use, and positives that a feature must occur in.
MAX_FEATURES, MIN_POSITIVES = 4096, 4
CLASSIFIERS = 3
#: Numbers of occurrences that make a feature of their own.
REPEATS = (2, 4)
#: How many standard errors a feature's shares must lie apart.
LEAST_Z = 4.0

_APART = np.ones(256, bool)
_APART[48:58] = _APART[65:91] = _APART[97:123] = False
_APART[128:] = False


def held_out(doc_id: Column, folds: int) -> Column:
    """Whether a document is kept from training: crc32 of its id as text is divisible by ``folds``. A null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == 0


def features(data: np.ndarray, offsets: np.ndarray, bits: int = HASH_BITS) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) of all words of the texts, with repeats: a word, its first 4, 5 and 6 bytes, its last 4 and 5.

    Words are runs of letters and digits, ASCII in lower case; any byte from 128 on counts as a letter.
    """
    data = lowered(data)
    starts, ends, before = words_of(data, offsets, _APART)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(before))
    lengths = ends - starts
    texts, hashes = [text], [hash_spans(data, starts, ends)]
    for salt, n, front in ((1, 4, True), (2, 5, True), (3, 6, True), (4, 4, False), (5, 5, False)):
        longer = lengths > n
        a = starts[longer] if front else ends[longer] - n
        texts.append(text[longer])
        hashes.append(hash_spans(data, a, a + n) * np.uint64(2 * salt + 1))
    return np.concatenate(texts), (np.concatenate(hashes) >> np.uint64(64 - bits)).astype(np.int64)


def again(feature: np.ndarray, times: int) -> np.ndarray:
    """The feature that says that ``feature`` occurs at least ``times`` times."""
    return (feature * (2 * times + 1) + times * 0x2545F) & ((1 << HASH_BITS) - 1)


def counted(text: np.ndarray, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, feature), with the features of those that repeat, ordered by text."""
    pairs, counts = np.unique(text << HASH_BITS | feature, return_counts=True)
    t, f = pairs >> HASH_BITS, pairs & ((1 << HASH_BITS) - 1)
    parts = [pairs] + [t[counts >= k] << HASH_BITS | again(f[counts >= k], k) for k in REPEATS]
    pairs = np.unique(np.concatenate(parts))
    return pairs >> HASH_BITS, pairs & ((1 << HASH_BITS) - 1)


def _log1pexp(x: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, x)


def fit_nnpu(rows: list[np.ndarray], positive: np.ndarray, prior: float, steps: int = 400, rate: float = 0.1, decay: float = 1e-5) -> np.ndarray:
    """Weights (and a last one, the bias) of a linear classifier by the non-negative PU risk.

    ``rows`` holds the feature numbers of each text, dense from 0. Every step takes the whole sample
    (Adam). Where the corrected negative risk falls below 0, its gradient is turned round, so that
    the classifier cannot go on to overfit the positives among the unlabelled texts.
    """
    n = 1 + max((int(r.max()) for r in rows if len(r)), default=-1)
    w, m, v = np.zeros(n + 1), np.zeros(n + 1), np.zeros(n + 1)
    w[n] = np.log(prior / (1 - prior))
    n_pos, n_unl = int(positive.sum()), int((~positive).sum())
    if not n_pos or not n_unl:
        return w
    flat = np.concatenate(rows)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    for t in range(1, steps + 1):
        g = np.bincount(owner, w[flat], len(rows)) + w[n]
        s = 1 / (1 + np.exp(-g))
        negative = _log1pexp(g[~positive]).mean() - prior * _log1pexp(g[positive]).mean()
        minus = np.where(positive, -prior * s / n_pos, s / n_unl)  # gradient of the corrected negative risk
        plus = np.where(positive, prior * (s - 1) / n_pos, 0.0)
        each = plus + minus if negative >= 0 else -minus
        grad = np.append(np.bincount(flat, each[owner], n)[:n] + decay * w[:n], each.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def train(rows: list[np.ndarray], positive: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray, float]:
    """Chosen features, their weights and the bias: the mean of ``CLASSIFIERS`` fits over parts of the unlabelled texts.

    Features are those whose share among positives differs most from their share among unlabelled texts.
    """
    size = 1 << HASH_BITS
    n_pos, n_unl = int(positive.sum()), int((~positive).sum())
    in_pos, in_unl = np.zeros(size, np.int32), np.zeros(size, np.int32)
    for r, is_pos in zip(rows, positive.tolist(), strict=True):
        (in_pos if is_pos else in_unl)[r] += 1
    a, b = in_pos / max(1, n_pos), in_unl / max(1, n_unl)
    spread = (a * (1 - a) + 1e-3) / max(1, n_pos) + (b * (1 - b) + 1e-3) / max(1, n_unl)
    z = np.where(in_pos >= MIN_POSITIVES, (a - b) / np.sqrt(spread), 0)
    chosen = np.sort(np.argsort(-z, kind="stable")[:MAX_FEATURES])
    chosen = chosen[z[chosen] > LEAST_Z]
    number = np.full(size, -1, np.int64)
    number[chosen] = np.arange(len(chosen))
    small = [x[x >= 0] for x in (number[r] for r in rows)]
    total = np.zeros(len(chosen) + 1)
    unlabelled = np.flatnonzero(~positive)
    for seed in range(CLASSIFIERS):
        part = np.random.default_rng(seed).permutation(unlabelled)[: max(1, len(unlabelled) * 2 // 3)]
        take = np.concatenate([np.flatnonzero(positive), part])
        w = fit_nnpu([small[i] for i in take], positive[take], prior)
        total[: len(w) - 1] += w[:-1] / CLASSIFIERS
        total[-1] += w[-1] / CLASSIFIERS
    return chosen, total[:-1], float(total[-1])


def _sample(docs: DataFrame, labels: DataFrame, folds: int) -> tuple[DataFrame, float]:
    """Training texts with ``positive``, and the class prior: the share of label 1 among labelled training rows.

    Ids with labels 0 and 1 count as 1. Ids of each kind are chosen by least hash, each once however many rows it has; of rows that
    share an id the text of least hash stands for it. The threshold on the hash comes from the counts, so that no task gathers
    more than the sample.
    """
    known = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), folds))
    known = known.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    n_known, n_toxic = known.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    prior = min(0.9, max(1e-4, n_toxic / n_known)) if n_known else 1e-4
    n_docs = docs.count()
    chance = F.xxhash64(F.lit(2), "doc_id").bitwiseAND(F.lit((1 << 40) - 1).cast("bigint")) / float(1 << 40)

    def few(rows: DataFrame, n: int, most: int) -> DataFrame:
        return rows.filter(chance < min(1.0, 1.2 * most / max(1, n))).distinct().orderBy(chance, "doc_id").limit(most)

    toxic_ids = few(known.filter("toxic = 1").select("doc_id"), n_toxic, MAX_POSITIVE)
    other_ids = few(docs.filter(~held_out(F.col("doc_id"), folds)).select("doc_id"), n_docs * (folds - 1) // folds, MAX_UNLABELLED)
    wanted = toxic_ids.select("doc_id", F.lit(True).alias("positive")).union(other_ids.select("doc_id", F.lit(False).alias("positive")))
    rows = docs.join(F.broadcast(wanted), "doc_id").groupBy("doc_id", "positive")
    return rows.agg(F.min_by(F.coalesce("text", F.lit("")), F.xxhash64(F.coalesce("text", F.lit("")))).alias("text")), prior


def fit(docs: DataFrame, labels: DataFrame, folds: int = 5) -> tuple[np.ndarray, np.ndarray, float]:
    """Features, weights and bias from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic).

    Rows whose id falls into the held-out fold are never read for training. Without toxic labels
    every text gets the prior. The bounded sample is gathered into one task.
    """
    need(docs, "doc_id", "text")
    need(labels, "doc_id", "toxic")
    sample, prior = _sample(docs, labels, folds)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in blocks(batches):
            text, own = counted(*features(data, offsets))
            cuts = np.searchsorted(text, np.arange(len(offsets)))
            own = own.astype("<i4")
            parts = [own[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(parts, pa.binary())], ["doc_id", "positive", "own"])

    def learn(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("positive", "ascending")])
        rows = [np.frombuffer(x, "<i4").astype(np.int64) for x in table.column("own").to_pylist()]
        positive = np.array(table.column("positive").to_pylist(), bool)
        chosen, weights, bias = train(rows, positive, prior)
        return pa.table({"feature": pa.array([*chosen.tolist(), -1], pa.int64()), "weight": pa.array([*weights.tolist(), bias], pa.float64())})

    drawn = sample.mapInArrow(extract, "doc_id bigint, positive boolean, own binary").withColumn("one", F.lit(1))
    model = drawn.groupBy("one").applyInArrow(learn_without_key(learn), "feature bigint, weight double").collect()
    if not model:
        return np.zeros(0, np.int64), np.zeros(0), float(np.log(prior / (1 - prior)))
    feature = np.array([r[0] for r in model], np.int64)
    weight = np.array([r[1] for r in model])
    bias = float(weight[feature == -1][0])
    return feature[feature >= 0], weight[feature >= 0], bias


def learn_without_key(learn):
    """``learn`` of a group's table without its constant key."""

    def run(table: pa.Table) -> pa.Table:
        return learn(table.drop_columns("one"))

    return run


def scored(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float]) -> DataFrame:
    """(doc_id, score) of every whole text; null and empty texts get the score of no feature."""
    feature, weight, bias = model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << HASH_BITS, np.float32)
        table[feature] = weight
        useful = np.zeros(1 << HASH_BITS, bool)
        useful[feature] = True
        every = np.arange(1 << HASH_BITS)
        wanted = useful.copy()
        for k in REPEATS:
            wanted |= useful[again(every, k)]
        for batch, data, offsets in blocks(batches):
            text, own = features(data, offsets)
            hit = wanted[own]
            text, own = counted(text[hit], own[hit])
            total = np.bincount(text, table[own], len(offsets) - 1) + bias
            score = 1 / (1 + np.exp(-np.clip(total, -500, 500)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score, pa.float64())], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id bigint, score double"
    )


def op2_toxicity(spark, sf_dir: str) -> DataFrame:
    """A toxicity score for every document, learned outside the held-out fifth."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    rows = scored(docs, fit(docs, labels))
    return rows.select("doc_id", held_out(F.col("doc_id"), 5).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
