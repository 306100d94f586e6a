"""Substring dedup with fixed-block anchors.

Every text is cut into non-overlapping reference blocks of half a window
(10 words for windows of 20). Any window holds one whole block, so a window
that occurs twice has a block of one occurrence inside the other. Steps:

1. *Index and probe.* Every rolling 10-word hash of every text probes the
   index of block hashes. Both sides travel as sorted, delta-coded sets, one
   per (chunk of documents, hash range): about 3 bytes a word, each hash once
   a chunk however often it repeats.
2. *Extend.* Windows around a hit are compared as whole 20-word windows by a
   96-bit fingerprint with the smallest document that holds them. Windows next
   to each other join to maximal repeats, so the extension stops exactly where
   the texts start to differ. One row a (window, chunk) is enough, so a passage
   that all documents share costs one entry a chunk, never a pair of documents.
3. *Remove.* Each chunk learns which of its windows start in an earlier
   document; those and all but the first within the chunk are covered words.

Documents are shuffled once, by chunk, and the three steps reuse that exchange.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import packing
from tidemark.llm.textkit import mix, slices, tidied, windows

WINDOW = 20
ANCHOR_BITS = 40
CHUNK_BYTES = 32 << 20   # text that a task holds at once, about
_ID, _TEXT, _REST, _CHUNK = "_id", "_text", "_rest", "_chunk"
_HITS = "_bucket int, _chunk int, _blob binary"
_LAST = np.int64(2**63 - 1)      # a null id comes after all others


def _ordered(table: pa.Table) -> pa.Table:
    """Rows by id (null last), then text: the order in which a window is 'earlier'."""
    return table.take(pc.sort_indices(table.select([_ID, _TEXT]), sort_keys=[
        (_ID, "ascending"), (_TEXT, "ascending")])).combine_chunks()


def _ids(table: pa.Table) -> np.ndarray:
    return pc.fill_null(table[_ID].combine_chunks().cast(pa.int64()), _LAST).to_numpy()


def _rows(keys: list[int], chunks: list[int], blobs: list[bytes]) -> pa.Table:
    names = ["_bucket", "_chunk", "_blob"]
    return pa.table([pa.array(keys, pa.int32()), pa.array(chunks, pa.int32()),
                     pa.array(blobs, pa.binary())], names=names)


def _probes(window: int, parts: int):
    """Step 1, map side: the rolling half-window hashes of a chunk by hash range."""
    half = window // 2

    @tidied
    def emit(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        found = []
        for _, _, words in slices(table[_TEXT]):
            h, whole = windows(words, words.hashes(), half)
            whole &= np.repeat(words.counts >= window, words.counts)
            anchor = (h >> np.uint64(64 - ANCHOR_BITS)) << np.uint64(1)
            anchor |= (words.index_in_doc() % half == 0).astype(np.uint64)
            found.append(anchor[whole])
        v = np.sort(np.concatenate(found)) if found else np.zeros(0, np.uint64)
        # per hash: bit 0 if a block has it, bit 1 if it occurs more than once here
        h = v >> np.uint64(1)
        at = np.flatnonzero(np.diff(h, prepend=~h[:1]))
        if not len(at):
            return _rows([], [], [])
        n = np.diff(np.append(at, len(v)))
        block = np.maximum.reduceat(v & np.uint64(1), at)
        v = (h[at] << np.uint64(2)) | block | ((n > 1).astype(np.uint64) << np.uint64(1))
        cut = packing.bounds(v, ANCHOR_BITS + 2, parts)
        use = np.flatnonzero(np.diff(cut))
        blobs = [packing.pack_sorted(v[cut[b]:cut[b + 1]]) for b in use]
        return _rows(list(use), [key[0].as_py()] * len(use), blobs)

    return emit


@tidied
def _match(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Step 1, hash range side: hashes of a block that occur again, back to their chunks."""
    chunks = table["_chunk"].to_numpy()
    sets = [packing.unpack_sorted(b) for b in table["_blob"].to_pylist()]
    v = np.concatenate(sets)
    of = np.repeat(np.arange(len(sets), dtype=np.int32), [len(s) for s in sets])
    del sets
    order = np.argsort(v, kind="stable")
    v, of = v[order], of[order]
    h = v >> np.uint64(2)
    at = np.flatnonzero(np.diff(h, prepend=~h[:1]))
    n = np.diff(np.append(at, len(v)))
    block = np.maximum.reduceat(v & np.uint64(1), at) > 0
    again = (n > 1) | (np.maximum.reduceat(v & np.uint64(2), at) > 0)
    keep = np.repeat(block & again, n)
    return _back(key[0].as_py(), h[keep], of[keep], chunks)


def _back(bucket: int, h: np.ndarray, of: np.ndarray, chunks: np.ndarray) -> pa.Table:
    """Ascending values h with the index of their chunk, as one row a chunk."""
    order = np.argsort(of, kind="stable")
    h, of = h[order], of[order]
    use, at = np.unique(of, return_index=True)
    blobs = [packing.pack_sorted(x) for x in np.split(h, at[1:])] if len(use) else []
    return _rows([bucket] * len(use), [int(chunks[i]) for i in use], blobs)


def _values(hits: pa.Table) -> np.ndarray:
    found = [packing.unpack_sorted(b) for b in hits["_blob"].to_pylist()]
    return np.sort(np.concatenate(found)) if found else np.zeros(0, np.uint64)


def _pairs(hits: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(hash, check) of windows, by hash."""
    sets = [_parts(b) for b in hits["_blob"].to_pylist()]
    if not sets:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    h = np.concatenate([packing.unpack_sorted(s[0]) for s in sets])
    check = np.concatenate([packing.unpack(s[1]) for s in sets])
    order = np.lexsort((check, h))
    return h[order], check[order]


def _among(h: np.ndarray, check: np.ndarray, pairs: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Whether hash and check of each window are a pair among ``pairs``."""
    ph, pcheck = pairs
    lo = np.searchsorted(ph, h, side="left")
    n = np.searchsorted(ph, h, side="right") - lo
    found = np.zeros(len(h), bool)
    left = np.flatnonzero(n)
    for step in range(int(n.max(initial=0))):    # one step, but for windows that share a hash
        left = left[n[left] > step]
        found[left] |= pcheck[lo[left] + step] == check[left]
    return found


def _isin(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    if not len(among):
        return np.zeros(len(values), bool)
    return among[np.minimum(np.searchsorted(among, values), len(among) - 1)] == values


def _check(words, h: np.ndarray, window: int) -> np.ndarray:
    """32 more bits of each window, from other word values."""
    second, _ = windows(words, mix(h ^ np.uint64(0x5851F42D4C957F2D)), window)
    return second >> np.uint64(32)


def _extend(window: int, parts: int):
    """Step 2, map side: whole windows around a hit, each once with its first id here."""
    half = window // 2

    @tidied
    def emit(key: tuple[pa.Scalar, ...], docs: pa.Table, hits: pa.Table) -> pa.Table:
        among = _values(hits)
        if not len(among) or not docs.num_rows:
            return _rows([], [], [])
        docs = _ordered(docs)
        ids, found = _ids(docs), []
        for lo, _, words in slices(docs[_TEXT]):
            wh = words.hashes()
            h, _ = windows(words, wh, half)
            hit = _isin(h >> np.uint64(64 - ANCHOR_BITS), among)
            full, whole = windows(words, wh, window)
            seen = np.concatenate([[0], np.cumsum(hit)])
            to = np.minimum(np.arange(len(h)) + half + 1, len(h))
            at = np.flatnonzero(whole & (seen[to] > seen[:-1]))
            found.append((full[at], _check(words, wh, window)[at], ids[lo + words.doc_of()[at]]))
        h, check, doc = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((doc, check, h))
        h, check, doc = h[order], check[order], doc[order]
        if not len(h):
            return _rows([], [], [])
        first = np.ones(len(h), bool)
        first[1:] = (h[1:] != h[:-1]) | (check[1:] != check[:-1])
        h, check, doc = h[first], check[first], doc[first].view(np.uint64)
        cut = packing.bounds(h, 64, parts)
        use = np.flatnonzero(np.diff(cut))
        blobs = []
        for b in use:
            x = slice(cut[b], cut[b + 1])
            blobs.append(_joined(packing.pack_sorted(h[x]), packing.pack(check[x]),
                                 packing.pack(doc[x])))
        return _rows(list(use), [key[0].as_py()] * len(use), blobs)

    return emit


def _joined(*parts: bytes) -> bytes:
    return b"".join(len(p).to_bytes(4, "little") + p for p in parts)


def _parts(blob: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(blob):
        n = int.from_bytes(blob[at:at + 4], "little")
        out.append(blob[at + 4:at + 4 + n])
        at += 4 + n
    return out


@tidied
def _earlier(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Step 2, hash range side: to each chunk, (hash, check) of its windows that an earlier
    document has."""
    chunks = table["_chunk"].to_numpy()
    sets = [_parts(b) for b in table["_blob"].to_pylist()]
    h = [packing.unpack_sorted(s[0]) for s in sets]
    of = np.repeat(np.arange(len(sets), dtype=np.int32), [len(x) for x in h])
    h = np.concatenate(h)
    check = np.concatenate([packing.unpack(s[1]) for s in sets])
    doc = np.concatenate([packing.unpack(s[2]) for s in sets]).view(np.int64)
    del sets
    order = np.lexsort((doc, check, h))
    h, check, of = h[order], check[order], of[order]
    later = np.zeros(len(h), bool)
    later[1:] = (h[1:] == h[:-1]) & (check[1:] == check[:-1])
    h, check, of = h[later], check[later], of[later]
    order = np.argsort(of, kind="stable")          # by chunk, then by hash
    h, check, of = h[order], check[order], of[order]
    use, at = np.unique(of, return_index=True)
    blobs = [_joined(packing.pack_sorted(x), packing.pack(c))
             for x, c in zip(np.split(h, at[1:]), np.split(check, at[1:]))] if len(use) else []
    return _rows([key[0].as_py()] * len(use), [int(chunks[i]) for i in use], blobs)


def _remove(window: int):
    """Step 3: cut covered words out of each text of a chunk."""

    @tidied
    def cut(key: tuple[pa.Scalar, ...], docs: pa.Table, hits: pa.Table) -> pa.Table:
        among, docs = _pairs(hits), _ordered(docs)
        heads = []                                 # (hash, check) of each window, in order
        for _, _, words in slices(docs[_TEXT]):
            wh = words.hashes()
            full, whole = windows(words, wh, window)
            heads.append((full[whole], _check(words, wh, window)[whole]))
        h = np.concatenate([x[0] for x in heads]) if heads else np.zeros(0, np.uint64)
        check = np.concatenate([x[1] for x in heads]) if heads else h
        del heads
        order = np.lexsort((check, h))             # stable: earlier windows first
        again = np.zeros(len(h), bool)
        a, b = order[1:], order[:-1]
        again[a] = (h[a] == h[b]) & (check[a] == check[b])
        again |= _among(h, check, among)
        texts, n_words, n_removed, spans, at = [], [], [], [], 0
        for _, _, words in slices(docs[_TEXT]):
            n = len(words.starts)
            whole = (np.repeat(words.first[1:], words.counts) - np.arange(n)) >= window
            size = int(whole.sum())
            edge = np.zeros(n + 1, np.int64)
            lead = np.flatnonzero(whole)[again[at:at + size]]
            at += size
            np.add.at(edge, lead, 1)
            np.add.at(edge, lead + window, -1)
            gone = np.cumsum(edge[:n]) > 0
            raw = words.buf.tobytes()
            for d in range(len(words.first) - 1):
                lo, hi = words.first[d], words.first[d + 1]
                g = gone[lo:hi]
                keep = np.flatnonzero(~g) + lo
                pairs = zip(words.starts[keep].tolist(), words.ends[keep].tolist())
                texts.append(b" ".join([raw[s:e] for s, e in pairs]))
                n_words.append(int(hi - lo))
                n_removed.append(int(g.sum()))
                turn = np.flatnonzero(np.diff(g.astype(np.int8), prepend=0, append=0))
                spans.append([{"start": int(s), "end": int(e)}
                              for s, e in zip(turn[::2], turn[1::2])])
        kept = pa.array(texts, pa.binary()).cast(pa.string())
        pair = pa.struct([("start", pa.int64()), ("end", pa.int64())])
        return pa.table([docs[_ID], docs[_REST], kept, pa.array(n_words, pa.int64()),
                         pa.array(n_removed, pa.int64()), pa.array(spans, pa.list_(pair))],
                        names=[_ID, _REST, "text", "n_words", "n_removed", "removed"])

    return cut


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   window: int = WINDOW, chunks: int | None = None) -> DataFrame:
    """Remove every word covered by a ``window``-word passage that also starts
    earlier: in a document with a smaller id, or before it in the same one.

    Returns one row per input row: struct ``row`` with the input's columns, the
    text replaced by its kept words joined by one space, and ``n_words``,
    ``n_removed`` and ``removed`` (word ranges). Rows are judged on the input.

    A null text has no words and stays null. Texts under ``window`` words keep
    all words. Rows that share an id count as one after the other, in text
    order; a null id comes last. Ids are integers of any width; other types raise, as
    their order would be unclear. Other columns may have any names and types.

    ``chunks``: groups of documents, each of which a task holds at once. By default one
    for each CHUNK_BYTES of text, which a pass over the texts' lengths measures, and at
    least two a shuffle partition.
    """
    if window < 2 or window % 2:
        raise ValueError("window must be even")
    if not isinstance(docs.schema[id_col].dataType, T.IntegralType):
        raise TypeError(f"{id_col} must be an integer column")
    parts = chunks
    if not parts:
        size = docs.agg(F.sum(F.octet_length(F.col(f"`{text_col}`")).cast("long"))).first()[0] or 0
        parts = max(-(-size // CHUNK_BYTES),
                    2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rest = [c for c in docs.columns if c not in (id_col, text_col)]
    chunk = F.pmod(F.xxhash64(F.col(f"`{id_col}`")), F.lit(parts)).cast("int")
    base = docs.select(
        chunk.alias(_CHUNK), F.col(f"`{id_col}`").cast("long").alias(_ID),
        F.col(f"`{text_col}`").alias(_TEXT),
        F.struct(F.col(f"`{text_col}`").isNull().alias("_no_text"),
                 *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)]).alias(_REST))
    by_chunk = base.groupBy(_CHUNK)

    probes = by_chunk.applyInArrow(_probes(window, parts), _HITS)
    hits = probes.groupBy("_bucket").applyInArrow(_match, _HITS)
    extended = by_chunk.cogroup(hits.groupBy(_CHUNK)).applyInArrow(_extend(window, parts), _HITS)
    later = extended.groupBy("_bucket").applyInArrow(_earlier, _HITS)
    # the carried columns keep their exact type, nullability included
    result = T.StructType([
        T.StructField(_ID, T.LongType()), base.schema[_REST],
        *T.StructType.fromDDL("text string, n_words bigint, n_removed bigint, "
                                  "removed array<struct<start:bigint,end:bigint>>").fields])
    out = by_chunk.cogroup(later.groupBy(_CHUNK)).applyInArrow(_remove(window), result)
    place = {c: i for i, c in enumerate(rest)}
    kept = F.when(~F.col(f"{_REST}._no_text"), F.col("text"))
    cols = [F.col(_ID).cast(docs.schema[c].dataType).alias(c) if c == id_col
            else kept.alias(c) if c == text_col
            else F.col(f"{_REST}.c{place[c]}").alias(c) for c in docs.columns]
    return out.select(F.struct(*cols).alias("row"), "n_words", "n_removed", "removed")
