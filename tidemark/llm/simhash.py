"""SimHash near-dedup with pigeonring filtering.

A 64-bit fingerprint is cut into tau + 1 segments, seen as a ring. If two
fingerprints differ in at most tau bits, some segment starts a chain whose
every prefix of l segments differs in at most l * tau / (tau + 1) bits (the
pigeonring principle): nothing in the first segment, at most one bit in the
first two, and so on. Chains of two segments serve as join keys, with every
change of up to one bit of the second segment enumerated on the probing side;
longer prefixes and then the full Hamming distance are checked on what meets.
The filter loses no pair.

Equal fingerprints are one node. Within a task, links shrink to one edge a
node, so a dense group of near copies costs rows in proportion to its size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.graph import components, star_edges
from tidemark.llm.textkit import joined, slices, tidied
from tidemark.operators.joins import sized_broadcast
from tidemark.operators.keyfilter import holds_not, key_filter, might_hold
from tidemark.session import work_dir

BITS = 64
SEED = 42
HOT = 4096               # chain keys with more index rows are split into cells of about this
BLOCK = 4 * HOT          # probes of such a key that one task takes, about
PAIRS = 1 << 21          # candidate pairs compared at once in a task
_BLOCK = 1 << 17         # shingles whose bits are counted at once


def _fingerprints(shingle: int):
    @tidied
    def fingerprint(texts: pa.Array) -> pa.Array:
        out = np.zeros(len(texts), np.uint64)
        for lo, hi, words in slices(texts):
            raw, starts, ends = joined(words, fold_case=True)
            counts = words.counts
            # shingles of each text: one a word that has enough after it, or the whole text
            heads = np.where(counts >= shingle, counts - shingle + 1, (counts > 0).astype(np.int64))
            doc = np.repeat(np.arange(hi - lo), heads)
            at = np.arange(len(doc)) - np.repeat(np.cumsum(heads) - heads, heads) + words.first[doc]
            last = np.minimum(at + shingle, words.first[doc + 1]) - 1
            digest = xxhash.xxh64_intdigest
            spans = zip(starts[at].tolist(), ends[last].tolist())
            h = np.array([digest(raw[a:b], SEED) for a, b in spans], np.uint64)
            ones = np.zeros((hi - lo, BITS), np.int64)
            for i in range(0, len(h), _BLOCK):
                part, d = h[i:i + _BLOCK], doc[i:i + _BLOCK]
                bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1,
                                     bitorder="little")
                first = np.flatnonzero(np.diff(d, prepend=-1))
                ones[d[first]] += np.add.reduceat(bits, first, axis=0, dtype=np.int64)
            over = (2 * ones > heads[:, None]).astype(np.uint8)
            out[lo:hi] = np.packbits(over, axis=1, bitorder="little").view("<u8").reshape(-1)
        return pa.array(out.view(np.int64))

    return F.arrow_udf(fingerprint, "bigint")


def fingerprint(text: str, shingle: int = 3):
    """Column: 64-bit SimHash of a text column, as a long.

    Words are lower-cased in A-Z; a shingle is ``shingle`` words joined by one
    space, repeats counted; a shorter text is one shingle; a null or wordless
    text has fingerprint zero.
    """
    return _fingerprints(shingle)(F.col(text))


def _segments(distance: int) -> list[tuple[int, int]]:
    """(first bit, width) of each segment."""
    edges = [round(i * BITS / (distance + 1)) for i in range(distance + 2)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _chains(distance: int) -> list[tuple]:
    """(start, first segment, second segment, width of the second) of each chain of two."""
    fp, segs = F.col("fp"), _segments(distance)

    def seg(i):
        at, width = segs[i % len(segs)]
        return F.shiftrightunsigned(fp, at).bitwiseAND(F.lit((1 << width) - 1))

    return [(i, seg(i), seg(i + 1), segs[(i + 1) % len(segs)][1]) for i in range(len(segs))]


def _near_keys(start: int, first, second, width: int, distance: int) -> list:
    """The key of a chain of two, then those of all chains within its budget."""
    keys = [F.xxhash64(F.lit(start), first, second)]
    if (2 * distance) // (distance + 1) >= 1:
        keys += [F.xxhash64(F.lit(start), first, second.bitwiseXOR(F.lit(1 << j)))
                 for j in range(width)]
    return keys


def _links(distance: int):
    segs = _segments(distance)
    masks = []            # for each start, the bits of the chain prefixes and their budgets
    for i in range(len(segs)):
        chain, bits = [], 0
        for n in range(1, len(segs) + 1):
            at, width = segs[(i + n - 1) % len(segs)]
            bits |= ((1 << width) - 1) << at
            chain.append((np.uint64(bits), n * distance // (distance + 1)))
        masks.append(chain)

    def near(diff: np.ndarray) -> np.ndarray:
        """Some chain keeps every prefix within its budget; its last prefix is all bits."""
        found = np.zeros(len(diff), bool)
        for chain in masks:
            left = np.flatnonzero(~found)
            for bits, budget in chain:
                left = left[np.bitwise_count(diff[left] & bits) <= budget]
            found[left] = True
        return found

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        table = pa.Table.from_batches(got)
        del got
        key, cell, fp, probe = (table[c].to_numpy() for c in ("key", "cell", "fp", "probe"))
        # one number for (key, cell): equal ones meet; others are told apart by the check
        key = key.view(np.uint64) + cell.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        fp = fp.view(np.uint64)
        ikey, ifp = key[~probe], fp[~probe]
        order = np.argsort(ikey, kind="stable")
        ikey, ifp = ikey[order], ifp[order]
        pkey, pfp = key[probe], fp[probe]
        lo = np.searchsorted(ikey, pkey, side="left")
        n = np.searchsorted(ikey, pkey, side="right") - lo
        some = n > 0
        lo, n, pfp = lo[some], n[some], pfp[some]
        total = np.cumsum(n)
        u, v = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        at = 0
        while at < len(n):
            done = total[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(total, done + PAIRS, side="right")))
            a = np.repeat(pfp[at:to], n[at:to])
            step = np.arange(len(a)) - np.repeat(total[at:to] - n[at:to] - done, n[at:to])
            b = ifp[np.repeat(lo[at:to], n[at:to]) + step]
            up = a < b
            a, b = a[up], b[up]
            ok = near(a ^ b)
            if ok.any():
                u, v = star_edges(np.concatenate([u, a[ok]]), np.concatenate([v, b[ok]]))
            at = to
        if len(u):
            yield pa.record_batch([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))],
                                  names=["u", "v"])

    return link


def _grid(fps: DataFrame, distance: int) -> DataFrame:
    """(key, cells, blocks) of the hot chain keys: parts of about HOT index rows and of
    about BLOCK probes. A key's probes come from its neighbours, the chains within the
    budget; those with few rows of their own cannot make it hot, so they are left out
    and one more block stands for them."""
    chains = _chains(distance)
    met = max(w for *_, w in chains) + 1          # neighbours a key has, at most
    parts = F.array(*[F.struct(F.lit(i).alias("start"), a.alias("first"), b.alias("second"))
                      for i, a, b, _ in chains])
    warm = (fps.select(F.explode(parts).alias("chain")).select("chain.*")
            .groupBy("start", "first", "second").agg(F.count("*").alias("n"))
            .where(F.col("n") > F.least(F.lit(HOT), F.lit(BLOCK // met))).checkpoint())
    near = F.lit(None).cast("array<bigint>")
    for i, _, _, width in chains:
        keys = _near_keys(i, F.col("first"), F.col("second"), width, distance)
        near = F.when(F.col("start") == i, F.array(*keys)).otherwise(near)
    index = warm.select(F.xxhash64("start", "first", "second").alias("key"),
                        F.col("n").alias("rows"), F.lit(0).cast("long").alias("probes"))
    probes = warm.select(F.explode(near).alias("key"), F.lit(0).cast("long").alias("rows"),
                         F.col("n").alias("probes"))
    both = index.unionByName(probes).groupBy("key").agg(F.sum("rows").alias("rows"),
                                                        F.sum("probes").alias("probes"))
    parts_of = lambda n, size, more: (F.when(F.col(n) > size, F.ceil(F.col(n) / size) + more)
                                      .otherwise(1).cast("int"))
    return (both.select("key", parts_of("rows", HOT, 0).alias("cells"),
                        parts_of("probes", BLOCK, 1).alias("blocks"))
            .where("cells > 1 OR blocks > 1").checkpoint())


def dealt_keys(fps: DataFrame, distance: int) -> DataFrame:
    """(key, cell, fp, probe): the chain keys of each fingerprint, for the index and for
    probing, dealt so that rows that must meet share key and cell."""
    near = [_near_keys(*chain, distance) for chain in _chains(distance)]
    rows = fps.select("fp", F.explode(F.array(*[keys[0] for keys in near])).alias("key"))
    probes = fps.select("fp", F.explode(F.array(*[k for keys in near for k in keys])).alias("key"))
    grid = _grid(fps, distance)
    if grid.isEmpty():               # one cell a key: nothing to look up
        both = rows.withColumn("probe", F.lit(False)).unionByName(
            probes.withColumn("probe", F.lit(True)))
        return both.select("key", F.lit(0).alias("cell"), "fp", "probe")
    # A hot key is a grid: index rows are dealt to cells and probes to blocks, and each
    # task holds one cell and one block, however many of both there are.
    grid = sized_broadcast(grid)
    cells, blocks = (F.coalesce(F.col(c), F.lit(1)) for c in ("cells", "blocks"))
    at = F.xxhash64("fp")
    place = {False: (F.pmod(at, cells), F.sequence(F.lit(0), blocks - 1)),
             True: (F.pmod(at, blocks), F.sequence(F.lit(0), cells - 1))}

    def dealt(side: DataFrame, probing: bool) -> DataFrame:
        own, others = place[probing]
        cell, block = ("other", "own") if probing else ("own", "other")
        return (side.join(grid, "key", "left")
                .select("key", own.cast("int").alias("own"), F.explode(others).alias("other"),
                        "fp", F.lit(probing).alias("probe"), cells.alias("n"))
                .select("key", (F.col(block) * F.col("n") + F.col(cell)).alias("cell"), "fp", "probe"))

    return dealt(rows, False).unionByName(dealt(probes, True))


def link_fingerprints(fps: DataFrame, distance: int) -> DataFrame:
    """Edges (u, v) that connect the distinct longs of ``fps.fp`` that differ in at
    most ``distance`` bits: per task a spanning forest of the links found there."""
    if not 0 < distance < BITS // 2:
        raise ValueError("distance must be between 1 and 31")
    work_dir(fps.sparkSession)
    return (dealt_keys(fps, distance).repartition("key", "cell")
            .mapInArrow(_links(distance), "u bigint, v bigint"))


def fingerprint_groups(fps: DataFrame, distance: int = 3) -> DataFrame:
    """(fp, group, component) of each fingerprint of ``fps`` (id, fp), see
    :func:`simhash_groups`."""
    nodes = fps.groupBy("fp").agg(F.min("id").alias("first")).checkpoint()
    roots = components(link_fingerprints(nodes.select("fp"), distance))
    named = (nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
             .select("fp", "first", F.coalesce("root", "fp").alias("group")).checkpoint())
    least = named.groupBy("group").agg(F.min("first").alias("component"))
    return named.join(least, "group").select("fp", "group", "component")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   shingle: int = 3, distance: int = 3) -> DataFrame:
    """The input's columns in struct ``row``, with ``fp`` (long), ``group`` (the
    smallest fingerprint reachable by links of at most ``distance`` bits) and
    ``component`` (the smallest id in that group).

    Null ids take no part in the smallest id; a group with none has a null
    component. Null, empty and wordless texts have fingerprint zero, and link
    like any other. Rows that share an id are separate rows of the result.
    """
    work_dir(docs.sparkSession)
    fp = fingerprint(f"`{text_col}`", shingle)
    named = fingerprint_groups(
        docs.select(F.col(f"`{id_col}`").alias("id"), fp.alias("fp")), distance)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    return docs.select(row, fp.alias("fp")).join(named, "fp").select(
        "row", "fp", "group", "component")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             shingle: int = 3, distance: int = 3) -> DataFrame:
    """The documents with one of each group left: the one with the smallest id
    (of rows that share it, the smallest fingerprint and then the first by text;
    a group without any id keeps one row likewise).

    Survivors are chosen on ids and fingerprints alone. An id that one row has, which
    survives, stays where it is: only rows whose id is in a bit set of all other ids
    are fingerprinted again and shuffled, by a key of id and fingerprint, so that
    copies of one text, however many, spread over all tasks.
    """
    work_dir(docs.sparkSession)
    fp, ident = fingerprint(f"`{text_col}`", shingle), F.col(f"`{id_col}`")
    fps = docs.select(ident.alias("id"), fp.alias("fp")).checkpoint()
    first = (fps.join(fingerprint_groups(fps, distance), "fp")
             .where(F.col("id").eqNullSafe(F.col("component")))
             .groupBy("group").agg(F.min(F.struct("fp", "id")).alias("one"))
             .select(F.xxhash64("one.id", "one.fp").alias("key"), "one").checkpoint())
    seen = fps.select(F.xxhash64("id").alias("slot"), F.lit(0).alias("stays")).unionByName(
        first.select(F.xxhash64("one.id").alias("slot"), F.lit(1).alias("stays")))
    # 1 row and 1 survivor: nothing to decide
    unsure = (seen.groupBy("slot").agg(F.sum("stays").alias("stay"), F.count("*").alias("n"))
              .where("stay != 1 OR n != 2").select("slot"))
    bits = key_filter(unsure, ["slot"]).checkpoint()
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(row, ident.alias("id"), F.col(f"`{text_col}`").alias("text"),
                       F.xxhash64(ident).alias("slot"))
    kept = holds_not(rows, bits, ["slot"])
    met = (might_hold(rows, bits, ["slot"]).withColumn("fp", fingerprint("text", shingle))
           .withColumn("key", F.xxhash64("id", "fp")).join(first, "key")
           .where(F.col("id").eqNullSafe(F.col("one.id")) & (F.col("fp") == F.col("one.fp"))))
    order = Window.partitionBy("key", "fp", "id").orderBy(F.col("text").asc_nulls_last())
    met = met.withColumn("rank", F.row_number().over(order)).where("rank = 1")
    return kept.select("row.*").unionByName(met.select("row.*"))
