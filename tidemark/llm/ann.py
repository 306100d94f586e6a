"""Approximate nearest neighbours over learned partitions.

On a bounded sample, the neighbour graph is cut into balanced parts by
recursive spectral bisection, so that near vectors tend to share a part. A
small classifier learns to tell a vector's part; it places every row of the
table. A part that holds many rows is cut again in the same way, on a bounded
sample of its own, so leaves grow in number with the table (up to PARTS squared)
and a query reads a smaller share of a larger table. Queries go to their most
probable leaves, where distances are exact, in double precision on the original
vectors. How many leaves are asked is measured, for a recall of TARGET, on HELD
vectors compared with all rows; the classifiers do not learn from them, unless the
table has no others.

Equal vectors are one candidate with its smallest ids, as many as can matter.
Leaves are dealt into cells of bounded size, so a large leaf is many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.embedding_dedup import matrix
from tidemark.llm.embeddings import usable
from tidemark.session import work_dir

SAMPLE = 4096            # distinct vectors that a classifier is fitted on, at most
PARTS = 32               # parts of the table, and of a part, at most
PART_SAMPLE = 64         # sample vectors a part at least
LEAF = 4096              # candidates a part of a part, at least about
HELD = 256               # vectors that the number of asked leaves is measured on
HIDDEN = 128
NEIGHBOURS = 10          # edges a vector of the sample's graph
TARGET = 0.95            # recall that the number of asked leaves must reach
CELL = 16384             # candidates a task, about
QUERIES = 4096           # queries a task, about


def _distances(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances, to within rounding."""
    return np.maximum((q * q).sum(1)[:, None] + (c * c).sum(1)[None, :] - 2 * (q @ c.T), 0)


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """Symmetric 0/1 matrix of each vector's k nearest."""
    n = len(x)
    graph = np.zeros((n, n), np.float32)
    for lo in range(0, n, 512):
        d = _distances(x[lo:lo + 512], x)
        d[np.arange(len(d)), np.arange(lo, lo + len(d))] = np.inf
        near = np.argpartition(d, min(k, n - 1) - 1, axis=1)[:, :k]
        graph[np.repeat(np.arange(lo, lo + len(d)), near.shape[1]), near.reshape(-1)] = 1
    return np.maximum(graph, graph.T)


def bisect(graph: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Two halves of equal size with few edges between them: the second eigenvector
    of the normalised graph, cut at its median, then swaps that lose edges."""
    n = len(graph)
    root = np.sqrt(np.maximum(graph.sum(1), 1e-6))
    top = root / np.linalg.norm(root)
    v = rng.normal(size=n).astype(np.float32)
    for _ in range(60):
        v = v + (graph @ (v / root)) / root          # shifted: all eigenvalues positive
        v -= top * (top @ v)
        v /= np.linalg.norm(v) + 1e-12
    side = np.zeros(n, bool)
    side[np.argsort(v / root, kind="stable")[n // 2:]] = True
    for _ in range(20):
        pull = graph @ np.where(side, 1.0, -1.0).astype(np.float32)
        gain = np.where(side, -pull, pull)           # of changing sides
        a, b = np.flatnonzero(side), np.flatnonzero(~side)
        a, b = a[np.argsort(-gain[a])][:n // 50 + 1], b[np.argsort(-gain[b])][:n // 50 + 1]
        m = min(len(a), len(b))
        swap = gain[a[:m]] + gain[b[:m]] > 2 * graph[a[:m], b[:m]]
        if not swap.any():
            break
        before, cut = side.copy(), (graph @ side.astype(np.float32))[~side].sum()
        side[a[:m][swap]], side[b[:m][swap]] = False, True
        if (graph @ side.astype(np.float32))[~side].sum() >= cut:
            side = before
            break
    return side


def balanced_parts(graph: np.ndarray, parts: int, rng: np.random.Generator) -> np.ndarray:
    """A part from 0 for each vertex; parts, a power of two, are of equal size."""
    label = np.zeros(len(graph), np.int64)
    while parts > 1:
        parts //= 2
        halves = label * 2
        for p in np.unique(label):
            of = np.flatnonzero(label == p)
            halves[of] += bisect(graph[np.ix_(of, of)], rng)
        label = halves
    return label


@dataclass
class Router:
    """Classifier of parts with one hidden layer."""

    layers: list[np.ndarray]
    parts: int

    def chances(self, x: np.ndarray) -> np.ndarray:
        """Logarithms of the parts' probabilities."""
        w1, b1, w2, b2 = self.layers
        norm = np.sqrt((x * x).sum(1, keepdims=True))
        z = np.maximum(x / norm @ w1 + b1, 0) @ w2 + b2
        z -= z.max(1, keepdims=True)
        return z - np.log(np.exp(z).sum(1, keepdims=True))


@dataclass
class Index:
    """Leaves: the parts of the table, or of a part that is cut again. They are
    numbered by part, then within it."""

    top: Router
    below: dict[int, Router]
    probes: int = 1

    @property
    def first(self) -> np.ndarray:
        """The first leaf of each part, and the number of leaves."""
        own = [self.below[p].parts if p in self.below else 1 for p in range(self.top.parts)]
        return np.concatenate([[0], np.cumsum(own)])

    def place(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector: the most probable part, then its most probable part."""
        part = self.top.chances(x).argmax(1)
        leaf = self.first[part]
        for p in self.below:
            of = np.flatnonzero(part == p)
            if len(of):
                leaf[of] += self.below[p].chances(x[of]).argmax(1)
        return leaf

    def order(self, x: np.ndarray) -> np.ndarray:
        """All leaves by probability, best first, for each vector."""
        chance, first = self.top.chances(x), self.first
        leaves = np.empty((len(x), first[-1]))
        for p in range(self.top.parts):
            leaves[:, first[p]:first[p + 1]] = chance[:, p:p + 1]
            if p in self.below:
                leaves[:, first[p]:first[p + 1]] += self.below[p].chances(x)
        return np.argsort(-leaves, axis=1, kind="stable")


def train_router(x: np.ndarray, label: np.ndarray, parts: int,
                 rng: np.random.Generator) -> list[np.ndarray]:
    width = x.shape[1]
    x = x / np.sqrt((x * x).sum(1, keepdims=True))
    layers = [rng.normal(0, 1.5 / np.sqrt(width) * 2, (width, HIDDEN)), np.zeros(HIDDEN),
              rng.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, parts)), np.zeros(parts)]
    m, v = [np.zeros_like(a) for a in layers], [np.zeros_like(a) for a in layers]
    step = 0
    for _ in range(40):
        for part in np.array_split(rng.permutation(len(x)), max(1, len(x) // 256)):
            xb = x[part]
            h = np.maximum(xb @ layers[0] + layers[1], 0)
            z = h @ layers[2] + layers[3]
            z = np.exp(z - z.max(1, keepdims=True))
            g = z / z.sum(1, keepdims=True)
            g[np.arange(len(part)), label[part]] -= 1
            g /= len(part)
            back = (g @ layers[2].T) * (h > 0)
            step += 1
            for i, grad in enumerate((xb.T @ back, back.sum(0), h.T @ g, g.sum(0))):
                grad = grad + 1e-3 * layers[i] * (i % 2 == 0)
                m[i] = 0.9 * m[i] + 0.1 * grad
                v[i] = 0.999 * v[i] + 0.001 * grad * grad
                layers[i] -= 0.003 * (m[i] / (1 - 0.9 ** step)) / (np.sqrt(v[i] / (1 - 0.999 ** step)) + 1e-8)
    return layers


def fit_router(x: np.ndarray, most: int, seed: int = 5) -> Router:
    """Router from a sample of vectors (rows) to at most ``most`` parts."""
    rng = np.random.default_rng(seed)
    parts = 1
    while parts * 2 <= min(PARTS, most, len(x) // PART_SAMPLE):
        parts *= 2
    label = balanced_parts(neighbour_graph(x, min(NEIGHBOURS, len(x) - 1)), parts, rng) \
        if parts > 1 else np.zeros(len(x), np.int64)
    return Router(train_router(x, label, parts, rng), parts)


def _fit_part(width: int, most: dict[int, int]):
    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        part = key[0].as_py()
        router = fit_router(matrix(rows.sort_by("at")["vector"], width), most[part])
        flat = np.concatenate([a.reshape(-1) for a in router.layers])
        return pa.table([pa.array([part], pa.int32()), pa.array([router.parts], pa.int32()),
                         pa.array([flat], pa.list_(pa.float64()))], names=["part", "parts", "layers"])

    return run


def _cut_again(placed: DataFrame, width: int) -> dict[int, Router]:
    """Routers of the parts (``leaf`` of the first level) that hold enough rows to be
    cut. Each is fitted by a task of its own; the driver holds at most PARTS of them."""
    sizes = {p: n for p, n in placed.groupBy("leaf").count().collect() if n >= 2 * LEAF}
    if not sizes:
        return {}
    # about twice SAMPLE vectors of each part by hash, then exactly SAMPLE
    share = F.create_map(*(F.lit(v) for p, n in sizes.items() for v in (p, min(1.0, 2 * SAMPLE / n))))
    h = F.xxhash64("vector")
    near = h.cast("double") < share[F.col("leaf")] * 2.0 ** 64 - 2.0 ** 63
    at = F.row_number().over(Window.partitionBy("leaf").orderBy("h", "vector"))
    sample = (placed.where(F.col("leaf").isin(list(sizes)) & near).select("leaf", "vector", h.alias("h"))
              .withColumn("at", at).where(F.col("at") <= SAMPLE).select("leaf", "vector", "at"))
    fitted = sample.groupBy("leaf").applyInArrow(
        _fit_part(width, {p: n // LEAF for p, n in sizes.items()}),
        "part int, parts int, layers array<double>").collect()
    below = {}
    for part, parts, flat in fitted:
        shapes = [(width, HIDDEN), (HIDDEN,), (HIDDEN, parts), (parts,)]
        ends = np.cumsum([int(np.prod(shape)) for shape in shapes])[:-1]
        below[part] = Router([a.reshape(shape) for a, shape in
                              zip(np.split(np.array(flat), ends), shapes)], parts)
    return below


def _held_nearest(held: np.ndarray, width: int, k: int):
    """The k nearest rows of a partition, with their leaves, to each held vector."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        far, leaf = np.zeros((len(held), 0)), np.zeros((len(held), 0), np.int32)
        for batch in batches:
            x, at = matrix(pa.chunked_array([batch.column(0)]), width), batch.column(1).to_numpy()
            for lo in range(0, len(x), 4096):
                far = np.hstack([far, _distances(held, x[lo:lo + 4096])])
                leaf = np.hstack([leaf, np.broadcast_to(at[lo:lo + 4096], (len(held), len(x[lo:lo + 4096])))])
                if far.shape[1] > k:
                    near = np.argpartition(far, k - 1, axis=1)[:, :k]
                    far, leaf = np.take_along_axis(far, near, 1), np.take_along_axis(leaf, near, 1)
        if far.shape[1]:
            who = np.repeat(np.arange(len(held), dtype=np.int32), far.shape[1])
            yield pa.record_batch([pa.array(who), pa.array(far.reshape(-1)), pa.array(leaf.reshape(-1))],
                                  names=["who", "far", "leaf"])

    return run


def _leaves_to_ask(index: Index, placed: DataFrame, width: int, k: int, target: float) -> int:
    """The fewest leaves that hold ``target`` of the k nearest of the held vectors."""
    leaves = int(index.first[-1])
    held = placed.orderBy(F.xxhash64("vector").desc()).limit(HELD).select("vector").toArrow()
    x = matrix(held["vector"], width)
    # a held vector is its own nearest; all others are distinct from it
    first = Window.partitionBy("who").orderBy("far", "leaf")
    near = (placed.select("vector", "leaf")
            .mapInArrow(_held_nearest(x, width, k + 1), "who int, far double, leaf int")
            .withColumn("n", F.row_number().over(first)).where(F.col("n") <= k + 1)
            .where("n > 1").select("who", "leaf").toArrow())
    if not near.num_rows:
        return leaves
    place = np.argsort(index.order(x), axis=1)
    rank = place[near["who"].to_numpy(), near["leaf"].to_numpy()]
    share = np.cumsum(np.bincount(rank, minlength=leaves)) / near.num_rows
    return int(np.argmax(share >= target)) + 1 if target <= 1 else leaves


def fit_index(own: DataFrame, width: int, k: int, target: float) -> tuple[Index, DataFrame]:
    """Index of distinct vectors of one length, and all of them with their ``leaf``."""
    sample = own.orderBy(F.xxhash64("vector")).limit(SAMPLE).select("vector").toArrow()
    index = Index(fit_router(matrix(sample["vector"], width), PARTS), {})
    place = lambda: own.select("*", _route(index, width, False)("vector")[0].alias("leaf")).checkpoint()
    placed = place()
    index.below = _cut_again(placed, width)
    if index.below:
        placed = place()
    index.probes = _leaves_to_ask(index, placed, width, k, target)
    return index, placed


def _route(index: Index, width: int, all_asked: bool):
    def run(vectors: pa.Array) -> pa.Array:
        if not len(vectors):
            return pa.array([], pa.list_(pa.int32()))
        x, to = matrix(pa.chunked_array([vectors]), width), []
        for lo in range(0, len(x), 1024):
            part = x[lo:lo + 1024]
            to.append(index.order(part)[:, :index.probes] if all_asked else index.place(part)[:, None])
        return pa.array(list(np.concatenate(to).astype(np.int32)), pa.list_(pa.int32()))

    return F.arrow_udf(run, "array<int>")


def _rerank(width: int, k: int):
    def run(key: tuple[pa.Scalar, ...], queries: pa.Table, rows: pa.Table) -> pa.Table:
        asked, found, score = [], [], []
        if queries.num_rows and rows.num_rows:
            q, c = matrix(queries["vector"], width), matrix(rows["vector"], width)
            ids, qid = rows["ids"].combine_chunks(), queries["id"].to_numpy()
            ends, flat = ids.offsets.to_numpy(), ids.values.to_numpy()
            most = min(k + 1, len(c))               # a query's own vector may be among them
            for lo in range(0, len(q), 256):
                d = _distances(q[lo:lo + 256], c)
                edge = np.partition(d, most - 1, axis=1)[:, most - 1]
                for i in range(len(d)):
                    near = np.flatnonzero(d[i] <= edge[i] * (1 + 1e-9) + 1e-9)
                    exact = np.sqrt(((q[lo + i] - c[near]) ** 2).sum(1))
                    n = ends[near + 1] - ends[near]
                    own = np.concatenate([flat[ends[a]:ends[a + 1]] for a in near])
                    far = np.repeat(exact, n)[own != qid[lo + i]]
                    own = own[own != qid[lo + i]]
                    best = np.lexsort((own, far))[:k]
                    asked.append(np.full(len(best), qid[lo + i]))
                    found.append(own[best])
                    score.append(far[best])
        join = lambda a, t: np.concatenate(a).astype(t) if a else np.zeros(0, t)
        return pa.table([join(asked, np.int64), join(found, np.int64), join(score, np.float64)],
                        names=["query_id", "vec_id", "score"])

    return run


def nearest(rows: DataFrame, queries: DataFrame, id_col: str = "vec_id",
            vector_col: str = "embedding", k: int = 10, target: float = TARGET) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``queries`` the k nearest rows
    found in ``rows`` but its own id, by Euclidean distance, ties to the smaller id.

    Vectors that are null, zero or hold a null or non-finite component take no
    part, nor do null ids. Queries meet candidates of their own length only. With
    fewer than k candidates, all come back; an empty table gives no row. Rows that
    share an id are candidates of their own under one name, which may come back more
    than once; queries that share an id are one query, and each candidate is met
    once by each of its vectors. Other columns are not read.
    """
    work_dir(rows.sparkSession)

    def read(df):
        df = df.select(F.col(f"`{id_col}`").alias("id"),
                       F.col(f"`{vector_col}`").cast("array<double>").alias("vector"))
        return df.where(F.col("id").isNotNull() & usable(F.col("vector")))

    # of equal vectors, the k + 1 smallest ids are all that can be among the k nearest
    order = Window.partitionBy("vector").orderBy("id")
    nodes = (read(rows).withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1)
             .groupBy("vector").agg(F.array_sort(F.collect_list("id")).alias("ids"))
             .withColumn("width", F.size("vector")).checkpoint())
    asked = read(queries).dropDuplicates(["id", "vector"])
    out = None
    for (width,) in sorted(nodes.select("width").distinct().collect()):
        own = nodes.where(F.col("width") == width)
        index, placed = fit_index(own.select("vector", "ids"), width, k, target)
        here = (asked.where(F.size("vector") == width)
                .select("id", "vector", F.explode(_route(index, width, True)("vector")).alias("leaf"))
                .checkpoint())
        # a grid of cells in each leaf: candidates by queries, both of bounded size
        grid = (placed.groupBy("leaf").agg(F.ceil(F.count("*") / CELL).alias("cells"))
                .join(here.groupBy("leaf").agg(F.ceil(F.count("*") / QUERIES).alias("blocks")), "leaf"))
        cell = F.pmod(F.xxhash64("vector"), F.col("cells"))
        block = F.pmod(F.xxhash64("id"), F.col("blocks"))
        to = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
        left = here.join(grid, "leaf").select("leaf", to("cells").alias("cell"), block.alias("block"),
                                              "id", "vector")
        right = placed.join(grid, "leaf").select("leaf", cell.alias("cell"), to("blocks").alias("block"),
                                                 "vector", "ids")
        keys = ("leaf", "cell", "block")
        best = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
            _rerank(width, k), "query_id bigint, vec_id bigint, score double")
        out = best if out is None else out.unionByName(best)
    if out is None:
        out = nodes.select(F.lit(0).cast("long").alias("query_id"), F.lit(0).cast("long").alias("vec_id"),
                           F.lit(0.0).alias("score")).limit(0)
    first = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (out.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
