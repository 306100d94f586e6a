"""Quality classifier: a factorisation machine.

A text's features are its hashed words' shares of the text, statistics of its
structure and its recorded length (metadata). The model scores

    w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j

where low-rank vectors v model how features act together. The pairwise sum
takes time linear in the number of features, by the sum-of-squares identity
``sum_{i<j} <v_i, v_j> x_i x_j = 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i (v_if x_i)^2)``.

Trained in numpy on a bounded sample of labelled rows; scoring is one pass over
the whole texts, with a model of fixed size.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.textkit import Words, slices, tidied

BITS = 13                # hashed words
RANK = 8
SAMPLE = 16384           # labelled rows used, unless told otherwise
WORD_SCALE = 4.0
STATS = ("log_words", "word_bytes", "upper", "digit", "symbol", "not_ascii", "line_words",
         "repeat_next", "distinct", "top_word", "bare_symbol", "symbol_end", "log_chars")
SIZE = (1 << BITS) + len(STATS)


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def _features(words: Words, chars: np.ndarray):
    """Hashed words (text, feature, share of the text) sorted by text, and statistics."""
    n, doc, h = words.counts, words.doc_of(), words.hashes(fold_case=True)
    texts, raw = len(n), words.buf
    key, count = np.unique(doc << BITS | (h >> np.uint64(64 - BITS)).astype(np.int64),
                           return_counts=True)
    at, feature = key >> BITS, key & ((1 << BITS) - 1)
    x = WORD_SCALE * count / np.sqrt(np.maximum(n[at], 1) * 8.0)

    def bytes_in(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask)])
        return np.diff(total[words.offsets])

    def words_in(mask: np.ndarray) -> np.ndarray:
        return np.bincount(doc[mask], minlength=texts)

    size = np.diff(words.offsets)
    upper = (raw >= 65) & (raw <= 90)
    lower = (raw >= 97) & (raw <= 122)
    digit = (raw >= 48) & (raw <= 57)
    wide = raw >= 128
    symbol = (raw > 32) & ~upper & ~lower & ~digit & ~wide & ~np.isin(raw, list(b".,'\"-:;?()"))
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    pair = np.sort(doc.astype(np.uint64) << np.uint64(40) | h >> np.uint64(24))
    new = np.ones(len(pair), bool)
    new[1:] = pair[1:] != pair[:-1]
    run = np.diff(np.append(np.flatnonzero(new), len(pair)))
    of = (pair[new] >> np.uint64(40)).astype(np.int64)
    top = np.zeros(texts)
    np.maximum.at(top, of, run)
    symbols = np.concatenate([[0], np.cumsum(symbol)])
    inside = symbols[words.ends] - symbols[words.starts]
    lens = words.ends - words.starts
    last = symbol[words.ends - 1] if len(lens) else np.zeros(0, bool)
    stats = np.column_stack([
        np.log1p(n), np.minimum(_share(np.bincount(doc, lens, minlength=texts), n), 50),
        _share(bytes_in(upper), bytes_in(upper | lower)), _share(bytes_in(digit), size),
        _share(bytes_in(symbol), size), _share(bytes_in(wide), size),
        np.log1p(_share(n, bytes_in(raw == 10) + 1)), _share(words_in(same), n),
        _share(np.bincount(of, minlength=texts), n), _share(top, n),
        _share(words_in(inside == lens), n), _share(words_in(last), n),
        np.log1p(np.maximum(chars, 0))])
    return at, feature, x, stats


def _columns(docs: DataFrame, text_col: str, chars_col: str | None) -> tuple[Column, Column]:
    text = F.col(f"`{text_col}`")
    known = F.col(f"`{chars_col}`").cast("long") if chars_col in docs.columns else F.lit(None)
    return text, F.coalesce(known, F.length(text), F.lit(0)).cast("long")


def _sample_features():
    @tidied
    def run(texts: pa.Array, chars: pa.Array) -> pa.Array:
        rows, count = [], chars.to_numpy()
        for lo, hi, words in slices(texts):
            at, feature, x, stats = _features(words, count[lo:hi])
            cut = np.searchsorted(at, np.arange(hi - lo + 1))
            rows += [{"at": feature[a:b].astype(np.int32), "x": x[a:b].astype(np.float32),
                      "stats": s} for a, b, s in zip(cut[:-1], cut[1:], stats)]
        return pa.array(rows, pa.struct([("at", pa.list_(pa.int32())), ("x", pa.list_(pa.float32())),
                                         ("stats", pa.list_(pa.float64()))]))

    return F.arrow_udf(run, "struct<at:array<int>,x:array<float>,stats:array<double>>")


@dataclass
class Machine:
    """Bias, linear weights, factors, and how statistics are brought to scale."""

    w0: float
    w: np.ndarray            # SIZE
    v: np.ndarray            # SIZE x RANK
    mean: np.ndarray
    spread: np.ndarray

    def scaled(self, stats: np.ndarray) -> np.ndarray:
        return np.clip((stats - self.mean) / self.spread, -4, 4) / 2


def train(at: list[np.ndarray], x: list[np.ndarray], stats: np.ndarray, y: np.ndarray,
          epochs: int = 10, seed: int = 11) -> Machine:
    """Factorisation machine by Adam on the logistic loss, in batches."""
    rng = np.random.default_rng(seed)
    mean, spread = stats.mean(0), np.maximum(stats.std(0), 1e-3)
    prior = np.clip(y.mean(), 0.01, 0.99)
    fm = Machine(float(np.log(prior / (1 - prior))), np.zeros(SIZE, np.float32),
                 rng.normal(0, 0.05, (SIZE, RANK)).astype(np.float32), mean, spread)
    stats = fm.scaled(stats).astype(np.float32)
    moments = [np.zeros_like(a) for a in (fm.w, fm.w, fm.v, fm.v)]
    words, step = 1 << BITS, 0
    keep = np.full(SIZE, 2e-4, np.float32)       # words are held back more than statistics
    keep[words:] = 1e-5
    for _ in range(epochs):
        for part in np.array_split(rng.permutation(len(y)), max(1, len(y) // 256)):
            dense = np.zeros((len(part), SIZE), np.float32)
            for r, i in enumerate(part):
                dense[r, at[i]] = x[i]
            dense[:, words:] = stats[part]
            s = dense @ fm.v
            z = fm.w0 + dense @ fm.w + 0.5 * ((s * s).sum(1) - ((dense ** 2) @ (fm.v ** 2)).sum(1))
            g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[part]).astype(np.float32) / len(part)
            gw = g @ dense + keep * fm.w
            gv = dense.T @ (g[:, None] * s) - ((g @ dense ** 2)[:, None]) * fm.v + keep[:, None] * fm.v
            step += 1
            fm.w0 -= 0.05 * float(g.sum())
            for a, grad, k in ((fm.w, gw, 0), (fm.v, gv, 2)):
                m, q = moments[k], moments[k + 1]
                m *= 0.9
                m += 0.1 * grad
                q *= 0.999
                q += 0.001 * grad * grad
                a -= 0.02 * (m / (1 - 0.9 ** step)) / (np.sqrt(q / (1 - 0.999 ** step)) + 1e-7)
    return fm


def fit(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id",
        text_col: str = "text", chars_col: str | None = "n_chars",
        label_col: str = "quality", sample_rows: int = SAMPLE) -> Machine:
    """Model from the labelled rows that ``learn`` (over the id) admits, at most
    ``sample_rows`` of them, by hash of the id. A row of the sample brings at most
    one number a hashed word (2^13) to the driver, however long its text. Null labels and null ids are left out; of
    conflicting labels of one id the smaller counts. Without any label every
    text scores near 1, so that nothing is rejected unjudged.
    """
    known = (labels.where(learn).select(F.col(f"`{id_col}`").alias("id"),
                                        F.col(f"`{label_col}`").alias("y"))
             .where("id IS NOT NULL AND y IS NOT NULL").groupBy("id").agg(F.min("y").alias("y"))
             .orderBy(F.xxhash64("id"), "id").limit(sample_rows))
    text, chars = _columns(docs, text_col, chars_col)
    rows = docs.where(learn).select(F.col(f"`{id_col}`").alias("id"), text.alias("text"),
                                    chars.alias("chars"))
    # the sample has a fixed bound, so it may be broadcast
    sample = rows.join(F.broadcast(known), "id").select(
        "id", "y", _sample_features()("text", "chars").alias("f")).toArrow()
    if not sample.num_rows:
        return Machine(10.0, np.zeros(SIZE, np.float32), np.zeros((SIZE, RANK), np.float32),
                       np.zeros(len(STATS)), np.ones(len(STATS)))
    order = np.argsort(sample["id"].to_numpy(), kind="stable")
    f = sample["f"].combine_chunks()
    split = lambda a: np.split(a.flatten().to_numpy(), a.offsets.to_numpy()[1:-1] - a.offsets[0].as_py())
    at, x = split(f.field("at")), split(f.field("x"))
    stats = np.array(split(f.field("stats")))
    y = (sample["y"].to_numpy() == 1).astype(np.float32)
    return train([at[i] for i in order], [x[i] for i in order], stats[order], y[order])


def score(fm: Machine, docs: DataFrame, text_col: str = "text",
          chars_col: str | None = "n_chars") -> Column:
    """Column: score from 0 to 1 of each whole text; null and empty texts too."""
    shared = docs.sparkSession.sparkContext.broadcast(fm)

    @tidied
    def run(texts: pa.Array, chars: pa.Array) -> pa.Array:
        fm, out, count = shared.value, [], chars.to_numpy()
        words_size = 1 << BITS
        for lo, hi, words in slices(texts):
            at, feature, x, stats = _features(words, count[lo:hi])
            stats, n = fm.scaled(stats), hi - lo
            w, v = fm.w.astype(np.float64), fm.v.astype(np.float64)
            z = fm.w0 + np.bincount(at, w[feature] * x, minlength=n) + stats @ w[words_size:]
            for f in range(RANK):
                part = v[feature, f] * x
                s = np.bincount(at, part, minlength=n) + stats @ v[words_size:, f]
                q = np.bincount(at, part * part, minlength=n) + stats ** 2 @ v[words_size:, f] ** 2
                z += 0.5 * (s * s - q)
            out.append(1 / (1 + np.exp(-np.clip(z, -30, 30))))
        return pa.array(np.concatenate(out) if out else np.zeros(0))

    return F.arrow_udf(run, "double")(*_columns(docs, text_col, chars_col))
