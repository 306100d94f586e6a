"""Embedding near-dedup by PCA-ordered tiled comparison.

Unit vectors are rotated to their principal axes, strongest first. Distinct
vectors are dealt into strips by their leading coordinates, halved again and
again where they spread most. A pair of strips whose coordinates and suffix
norms cannot reach the threshold is left out before any vector moves; each
other pair is one task that compares tile by tile. A tile's products accumulate
over the leading axes, and what the remaining axes can add is at most the
product of the two suffix norms: pairs that cannot reach the threshold any more
stop there. Survivors are decided in double precision on the original vectors.

Equal vectors are one node with a count. A task returns a number of links for
each vector and a spanning forest of the links it found, never the pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.embeddings import distinct_vectors, usable
from tidemark.llm.graph import components, star_edges
from tidemark.session import work_dir

STRIP = 8192             # distinct vectors a strip, about
STRIPS = 1024            # strips by coordinates, at most; larger ones are dealt by hash as well
LEAD = 16                # leading axes that strips are made from
LEAST, GAP = 0.3, 0.2    # share of a node on either side of a gap, and its width in deviations
SAMPLED = 32             # sampled vectors a strip, from which the halving planes come
TILE = 1024              # vectors compared at once
STAGES = (0.2, 0.45, 1.0)    # shares of the axes after which hopeless pairs stop
SLACK = 1e-4             # single precision sums are off by far less


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, in double precision and without overflow."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    flat = np.concatenate([c.flatten().to_numpy() for c in column.chunks] or [np.zeros(0)])
    return flat.reshape(-1, width)


def _moments(width: int):
    def run(batches):
        total = np.zeros((width, width))
        for b in batches:
            if b.num_rows:
                x = unit(matrix(pa.chunked_array([b.column(0)]), width))
                total += x.T @ x
        yield pa.record_batch([pa.array([total.tobytes()], pa.binary())], names=["m"])

    return run


def _sum(width: int):
    def run(batches):
        total = np.zeros((width, width))
        for b in batches:
            for m in b.column(0).to_pylist():
                total += np.frombuffer(m).reshape(width, width)
        yield pa.record_batch([pa.array([total.tobytes()], pa.binary())], names=["m"])

    return run


def principal_axes(vectors: DataFrame, width: int) -> np.ndarray:
    """Orthonormal axes, strongest first, of all rows of column ``vector``. Sums of
    outer products, a matrix a task, are added up in 8 tasks and then here."""
    parts = vectors.select("vector").mapInArrow(_moments(width), "m binary")
    total = np.zeros((width, width))
    for row in parts.repartition(8).mapInArrow(_sum(width), "m binary").collect():
        total += np.frombuffer(row["m"]).reshape(width, width)
    _, axes = np.linalg.eigh(total)
    return np.ascontiguousarray(axes[:, ::-1])


# --- strips ----------------------------------------------------------------------

def planes(sample: np.ndarray, strips: int) -> tuple[np.ndarray, np.ndarray]:
    """(axis, cut) of each inner node of a tree over leading coordinates: node i has
    children 2i and 2i + 1. A node is cut in the middle of the widest gap that leaves
    enough on both sides, so that clusters stay whole, or where no gap stands out, at
    the median of its most spread axis."""
    axis, cut = np.zeros(strips, np.int64), np.zeros(strips)
    inside = {1: sample}
    for node in range(1, strips):
        x = inside.pop(node)
        if len(x):
            axis[node] = int(np.argmax(x.var(axis=0)))
            cut[node] = np.median(x[:, axis[node]])
        if len(x) >= 4:
            lo, hi = (int(share * (len(x) - 1)) for share in (LEAST, 1 - LEAST))
            middle = np.sort(x, axis=0)[lo:hi + 2]
            gaps = np.diff(middle, axis=0)
            at, best = np.unravel_index(np.argmax(gaps), gaps.shape)
            if gaps[at, best] > GAP * x[:, axis[node]].std():
                axis[node], cut[node] = best, middle[at:at + 2, best].mean()
        above = x[:, axis[node]] > cut[node]
        inside[2 * node], inside[2 * node + 1] = x[~above], x[above]
    return axis, cut


def strip_of(lead: np.ndarray, axis: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """The strip, from 0, of each row of leading coordinates."""
    strips = len(axis)
    node = np.ones(len(lead), np.int64)
    for _ in range(strips.bit_length() - 1):
        node = 2 * node + (lead[np.arange(len(lead)), axis[node]] > cut[node])
    return node - strips


def may_link(low: np.ndarray, high: np.ndarray, tail: np.ndarray, threshold: float) -> np.ndarray:
    """Matrix of strip pairs that can hold a link. ``low`` and ``high`` are the limits of a
    strip's leading coordinates, ``tail`` its largest suffix norm. The product of two unit
    vectors is at most the largest product of leading coordinates plus that of the suffix
    norms, and at most 1 - d^2 / 2 if they are at least d apart."""
    out = np.zeros((len(low), len(low)), bool)
    for i in range(len(low)):
        corners = [a * b for a in (low[i], high[i]) for b in (low, high)]
        product = np.maximum.reduce(corners).sum(1) + tail[i] * tail
        gap = np.maximum(0, np.maximum(low - high[i], low[i] - high))
        out[i] = np.minimum(product, 1 - (gap * gap).sum(1) / 2) >= threshold - SLACK
    return out


def _leading(width: int, axes: np.ndarray):
    """Leading coordinates of a vector, its suffix norm last."""
    lead = min(LEAD, width)

    def run(vectors: pa.Array) -> pa.Array:
        if not len(vectors):
            return pa.array([], pa.list_(pa.float64()))
        r = unit(matrix(pa.chunked_array([vectors]), width)) @ axes
        tail = np.sqrt((r[:, lead:] ** 2).sum(1))
        return pa.array(list(np.column_stack([r[:, :lead], tail])), pa.list_(pa.float64()))

    return F.arrow_udf(run, "array<double>")


def _placed(axis: np.ndarray, cut: np.ndarray):
    def run(lead: pa.Array) -> pa.Array:
        if not len(lead):
            return pa.array([], pa.int32())
        x = matrix(pa.chunked_array([lead]), len(lead[0]))
        return pa.array(strip_of(x, axis, cut).astype(np.int32))

    return F.arrow_udf(run, "int")


def strip_count(n: int, cores: int) -> int:
    """A power of two: strips of about STRIP vectors, or fewer where the pairs of strips
    would not keep the cores busy."""
    strips = 1
    while strips < STRIPS and (n > STRIP * strips or (strips * strips < 8 * cores
                                                      and n >= 1024 * strips)):
        strips *= 2
    return strips


def strip_pairs(own: DataFrame, n: int, width: int, axes: np.ndarray, threshold: float) -> DataFrame:
    """``own`` (rep, copies, vector) once for each pair (a, b) of strips that it is compared
    in; ``strip`` is its own. To the driver come at most STRIPS rows of limits and SAMPLED
    times as many of leading coordinates."""
    spark = own.sparkSession
    strips = strip_count(n, spark.sparkContext.defaultParallelism)
    if strips == 1:
        one = F.lit(0).cast("long")
        return own.select(one.alias("a"), one.alias("b"), one.alias("strip"), "rep", "copies", "vector")
    lead = own.withColumn("lead", _leading(width, axes)("vector"))
    sample = lead.orderBy(F.xxhash64("rep")).limit(SAMPLED * strips).select("lead").toArrow()
    coordinates = matrix(sample["lead"], min(LEAD, width) + 1)[:, :-1]
    placed = lead.withColumn("at", _placed(*planes(coordinates, strips))("lead")).checkpoint()
    at = range(coordinates.shape[1] + 1)
    limits = placed.groupBy("at").agg(
        F.count("*").alias("n"),
        F.array(*[F.min(F.col("lead")[i]) for i in at]).alias("low"),
        F.array(*[F.max(F.col("lead")[i]) for i in at]).alias("high")).orderBy("at").collect()
    low, high = (np.array([r[c] for r in limits]) for c in ("low", "high"))
    meet = may_link(low[:, :-1], high[:, :-1], high[:, -1], threshold)
    cells = [max(1, -(-r["n"] // (2 * STRIP))) for r in limits]
    partners = spark.createDataFrame(
        [(r["at"], cells[i], [(limits[int(j)]["at"], cells[j]) for j in np.flatnonzero(meet[i])])
         for i, r in enumerate(limits)],
        "at int, cells int, others array<struct<at:int,cells:int>>")
    name = lambda at, cell: F.shiftleft(F.col(at).cast("long"), 32) + cell
    return (placed.join(F.broadcast(partners), "at")              # at most STRIPS rows
            .withColumn("strip", name("at", F.pmod(F.xxhash64("rep"), F.col("cells"))))
            .select("strip", "rep", "copies", "vector", F.explode("others").alias("other"))
            .withColumn("cell", F.explode(F.sequence(F.lit(0), F.col("other.cells") - 1)))
            .withColumn("with", name("other.at", F.col("cell")))
            .select(F.least("strip", "with").alias("a"), F.greatest("strip", "with").alias("b"),
                    "strip", "rep", "copies", "vector"))


def _compare(threshold: float, width: int, axes: np.ndarray):
    cuts = sorted({max(1, round(s * width)) for s in STAGES})

    def links(a: np.ndarray, b: np.ndarray, ra, rb, na, nb) -> tuple[np.ndarray, np.ndarray]:
        """Index pairs of one tile with cosine at or above the threshold."""
        part = ra[:, :cuts[0]] @ rb[:, :cuts[0]].T
        i, j = np.nonzero(part + na[0][:, None] * nb[0][None, :] >= threshold - SLACK)
        value = part[i, j]
        for k in range(1, len(cuts)):
            s = slice(cuts[k - 1], cuts[k])
            value = value + np.einsum("ij,ij->i", ra[i, s], rb[j, s])
            live = value + na[k][i] * nb[k][j] >= threshold - SLACK
            i, j, value = i[live], j[live], value[live]
        exact = np.einsum("ij,ij->i", a[i], b[j]) >= threshold
        return i[exact], j[exact]

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        first = table["strip"].to_numpy()
        sides = {}
        for s in (key[0].as_py(), key[1].as_py()):
            rows = table.filter(pa.array(first == s))
            x = unit(matrix(rows["vector"], width))
            r = (x @ axes).astype(np.float32)
            norms = [np.sqrt((r[:, c:].astype(np.float64) ** 2).sum(1)).astype(np.float32) for c in cuts]
            sides[s] = (rows["rep"].to_numpy(), rows["copies"].to_numpy(), x, r, norms)
        (ida, ca, xa, ra, na), (idb, cb, xb, rb, nb) = (sides[k.as_py()] for k in key)
        own = key[0].as_py() == key[1].as_py()
        la, lb = np.zeros(len(ida), np.int64), np.zeros(len(idb), np.int64)
        u, v = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for p in range(0, len(ida), TILE):
            for q in range(p if own else 0, len(idb), TILE):
                sa, sb = slice(p, p + TILE), slice(q, q + TILE)
                i, j = links(xa[sa], xb[sb], ra[sa], rb[sb],
                             [n[sa] for n in na], [n[sb] for n in nb])
                i, j = i + p, j + q
                if own:
                    i, j = i[i < j], j[i < j]
                if len(i):
                    la += np.bincount(i, cb[j], len(la)).astype(np.int64)
                    lb += np.bincount(j, ca[i], len(lb)).astype(np.int64)
                    u, v = star_edges(np.concatenate([u, ida[i]]), np.concatenate([v, idb[j]]))
        n, m = np.flatnonzero(la), np.flatnonzero(lb)
        none = np.zeros(len(u), np.int64)
        return pa.table([np.concatenate([ida[n], idb[m], u]), np.concatenate([la[n], lb[m], none]),
                         pa.array(np.concatenate([np.zeros(len(n) + len(m), np.int64), v]),
                                  mask=np.concatenate([np.ones(len(n) + len(m), bool), none > 0]))],
                        names=["rep", "links", "other"])

    return run


def near_duplicates(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    threshold: float = 0.9) -> DataFrame:
    """(id, n_links, component, kept) of each row: other vectors with a cosine of at
    least ``threshold``, the smallest id reachable by links, and whether it is its own.

    Vectors that are null, zero or hold a null or non-finite component link with
    nothing; nor do vectors of different lengths, or rows with a null id. Rows that
    share an id are separate vectors with one name.
    """
    spark = rows.sparkSession
    work_dir(spark)
    every = rows.select(F.col(f"`{id_col}`").alias("id"),
                        F.col(f"`{vector_col}`").cast("array<double>").alias("vector"))
    every = every.withColumn("ok", usable(F.col("vector")) & F.col("id").isNotNull())
    good = every.where("ok").select("id", "vector")
    nodes = distinct_vectors(good).withColumn("width", F.size("vector")).checkpoint()
    found = []
    for width, n in sorted(nodes.groupBy("width").agg(F.count("*")).collect()):
        own = nodes.where(F.col("width") == width)
        axes = principal_axes(own, width)
        pairs = strip_pairs(own, n, width, axes, threshold)
        found.append(pairs.groupBy("a", "b")
                     .applyInArrow(_compare(threshold, width, axes),
                                   "rep bigint, links bigint, other bigint"))
    if not found:
        return every.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component"),
                            F.lit(True).alias("kept"))
    links = found[0]
    for more in found[1:]:
        links = links.unionByName(more)
    links = links.checkpoint()
    roots = components(links.where("other IS NOT NULL").select("rep", "other"))
    counts = links.where("other IS NULL").groupBy("rep").agg(F.sum("links").alias("links"))
    named = (nodes.select("vector", "rep", "copies").join(counts, "rep", "left")
             .join(roots.withColumnRenamed("node", "rep"), "rep", "left")
             .select("vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                     F.coalesce("root", "rep").alias("component")))
    linked = good.join(named, "vector").select("id", "n_links", "component")
    alone = every.where("NOT ok").select("id", F.lit(0).cast("long").alias("n_links"),
                                         F.col("id").alias("component"))
    return linked.unionByName(alone).withColumn("kept", F.col("id").eqNullSafe(F.col("component")))
