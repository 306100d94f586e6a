"""Toxicity by non-negative positive-unlabelled learning.

Only confirmed toxic examples are labels; every other text is unlabelled, toxic
or not. With class prior p and losses of a classifier g, the risk is

    p * R+(positives as positive) + max(0, R-(unlabelled) - p * R-(positives as negative))

where the last term corrects for the toxic texts among the unlabelled ones and
is kept from falling below zero, which stops the model from learning to tell
the labelled examples apart (a step against it is taken instead).

Features are hashed words and word beginnings. Their document frequencies are
counted over all documents outside the held-out fold; those more frequent in
confirmed examples are kept. The model is trained in numpy on a bounded sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.textkit import Words, slices

BITS = 17
PREFIXES = (4, 5, 6, 7, 8)     # bytes of a word's beginning
POSITIVES = 8192               # confirmed examples used, unless told otherwise
UNLABELLED = 12288             # unlabelled texts in the training sample, likewise
FEATURES = 768                 # features kept, likewise
STANDS_OUT = 5.0               # standard deviations above the unlabelled frequency
SCALE = 4.0


def _features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) of every word and word beginning."""
    doc = words.doc_of()
    docs, found = [doc], [words.hashes(fold_case=True)]
    for at, h in words.prefix_hashes(PREFIXES):
        docs.append(doc[at])
        found.append(h)
    return np.concatenate(docs), (np.concatenate(found) >> np.uint64(64 - BITS)).astype(np.int64)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many texts, and confirmed texts, of a partition each feature occurs."""
    every, toxic = np.zeros(1 << BITS, np.int64), np.zeros(1 << BITS, np.int64)
    for batch in batches:
        is_toxic = batch.column(1).to_numpy(zero_copy_only=False)
        for lo, hi, words in slices(batch.column(0), letters=True):
            doc, feature = _features(words)
            once = np.unique(doc << BITS | feature)
            doc, feature = once >> BITS, once & ((1 << BITS) - 1)
            every += np.bincount(feature, minlength=1 << BITS)
            toxic += np.bincount(feature[is_toxic[lo:hi][doc]], minlength=1 << BITS)
    seen = np.flatnonzero(every)
    yield pa.record_batch([pa.array(seen.astype(np.int32)), pa.array(every[seen]),
                           pa.array(toxic[seen])], names=["feature", "every", "toxic"])


def _densities(kept: np.ndarray):
    place = np.full(1 << BITS, -1, np.int64)
    place[kept] = np.arange(len(kept))

    def run(texts: pa.Array) -> pa.Array:
        rows = []
        for _, _, words in slices(texts, letters=True):
            doc, feature = _features(words)
            hit = place[feature] >= 0
            key, n = np.unique(doc[hit] * len(kept) + place[feature[hit]], return_counts=True)
            doc = key // max(len(kept), 1)
            value = SCALE * n / np.sqrt(np.maximum(words.counts[doc], 1))
            cut = np.searchsorted(doc, np.arange(len(words.counts) + 1))
            for a, b in zip(cut[:-1], cut[1:]):
                rows.append({"at": (key[a:b] % len(kept)).astype(np.int32), "x": value[a:b]})
        return pa.array(rows, pa.struct([("at", pa.list_(pa.int32())),
                                         ("x", pa.list_(pa.float64()))]))

    return F.arrow_udf(run, "struct<at:array<int>,x:array<double>>")


@dataclass
class Model:
    """Linear score over kept features, squeezed to 0..1."""

    kept: np.ndarray
    weights: np.ndarray
    bias: float


def train_nnpu(toxic: np.ndarray, free: np.ndarray, prior: float, epochs: int = 60,
               seed: int = 7) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic model; rows are feature vectors."""
    rng = np.random.default_rng(seed)
    w = np.zeros(toxic.shape[1] + 1)
    w[-1] = -1.0
    m, v, step = np.zeros_like(w), np.zeros_like(w), 0
    one = lambda x: np.hstack([x, np.ones((len(x), 1), x.dtype)])
    toxic, free = one(toxic), one(free)
    for _ in range(epochs):
        order = rng.permutation(len(free))
        for part in np.array_split(order, max(1, len(free) // 1024)):
            p = toxic[rng.integers(0, len(toxic), min(len(toxic), 256))]
            u = free[part]
            sp, su = (1 / (1 + np.exp(-np.clip(x @ w, -30, 30))) for x in (p, u))
            rest = -np.log(1 - su + 1e-12).mean() + prior * np.log(1 - sp + 1e-12).mean()
            if rest >= 0:
                g = prior * ((sp - 1) @ p - sp @ p) / len(p) + su @ u / len(u)
            else:
                g = prior * (sp @ p) / len(p) - su @ u / len(u)
            g = g + np.append(1e-4 * w[:-1], 0)
            step += 1
            m = 0.9 * m + 0.1 * g
            v = 0.999 * v + 0.001 * g * g
            w -= 0.05 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "toxic", prior: float | None = None,
        positives: int = POSITIVES, unlabelled: int = UNLABELLED, features: int = FEATURES) -> Model:
    """Model from the rows that ``learn`` admits, an expression over the id.

    ``prior`` is the share of toxic texts among all, which positive and unlabelled
    texts alone do not tell; unless given, it is the share of label 1 among the
    labelled rows. Training takes at most ``positives`` confirmed and ``unlabelled``
    other texts, chosen by hash of the id, and at most ``features`` features;
    document frequencies are counted over all texts. With no positive example all
    texts score alike, near zero.
    """
    if prior is not None and not 0 < prior < 1:
        raise ValueError("prior must lie between 0 and 1")
    key = F.col(f"`{id_col}`").alias("id")
    known = labels.where(learn).select(key, F.col(f"`{label_col}`").alias("y")).where("y IS NOT NULL")
    if prior is None:
        prior = known.agg(F.avg((F.col("y") == 1).cast("double"))).first()[0] or 0.0
    pick = lambda ids, n: ids.distinct().orderBy(F.xxhash64("id"), "id").limit(n)
    positive = pick(known.where("y = 1").select("id"), positives).withColumn("toxic", F.lit(True))
    rows = docs.where(learn).select(key, F.col(f"`{text_col}`").alias("text"))
    # both id lists have a fixed bound, so they may be broadcast
    marked = rows.join(F.broadcast(positive), "id", "left").select(
        "id", "text", F.coalesce("toxic", F.lit(False)).alias("toxic"))
    counts = (marked.select("text", "toxic")
              .mapInArrow(_frequencies, "feature int, every bigint, toxic bigint")
              .groupBy("feature").agg(F.sum("every").alias("every"), F.sum("toxic").alias("toxic")))
    n, n_toxic = marked.agg(F.count("*"), F.count_if("toxic")).first()
    if not n_toxic or not prior:
        return Model(np.zeros(0, np.int64), np.zeros(0), -10.0)
    share = F.col("every") / n
    above = (F.col("toxic") / n_toxic - share) / F.sqrt(share * (1 - share) / n_toxic + 1e-12)
    best = (counts.select("feature", "toxic", above.alias("z")).where(f"z > {STANDS_OUT} AND toxic >= 3")
            .orderBy(F.desc("z"), "feature").limit(features))
    kept = np.sort(np.array([r["feature"] for r in best.collect()], np.int64))
    free = pick(rows.select("id"), unlabelled).withColumn("free", F.lit(True))
    sample = (marked.join(F.broadcast(free), "id", "left").where("toxic OR free")
              .select("toxic", F.coalesce("free", F.lit(False)).alias("free"),
                      _densities(kept)("text").alias("f")).toArrow())
    x = np.zeros((sample.num_rows, len(kept)), np.float32)
    f = sample["f"].combine_chunks()
    at, value = f.field("at"), f.field("x")
    row = np.repeat(np.arange(len(at)), np.diff(at.offsets.to_numpy()))
    x[row, at.flatten().to_numpy()] = value.flatten().to_numpy()
    is_toxic, is_free = (sample[c].to_numpy() for c in ("toxic", "free"))
    weights, bias = train_nnpu(x[is_toxic], x[is_free], float(prior))
    return Model(kept, weights, bias)


def score(model: Model, docs: DataFrame, text_col: str = "text") -> Column:
    """Column: score from 0 to 1 of each whole text; null and empty texts too."""
    table = np.zeros(1 << BITS, np.float32)
    table[model.kept] = model.weights
    shared = docs.sparkSession.sparkContext.broadcast(table)
    bias = model.bias

    def run(texts: pa.Array) -> pa.Array:
        out = []
        for _, _, words in slices(texts, letters=True):
            doc, feature = _features(words)
            n = words.counts
            z = np.bincount(doc, shared.value[feature], minlength=len(n))
            z = bias + SCALE * z / np.sqrt(np.maximum(n, 1))
            out.append(1 / (1 + np.exp(-np.clip(z, -30, 30))))
        return pa.array(np.concatenate(out) if out else np.zeros(0))

    return F.arrow_udf(run, "double")(F.col(f"`{text_col}`"))
