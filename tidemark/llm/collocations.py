"""Phrase collocations, counted on a prefix-free parse.

Each text is cut where its own words say so: at every window of three words whose
hash is a trigger. A chunk runs from one trigger window through the next, so
neighbouring chunks share three words, and equal passages give equal chunks wherever
they stand. Chunks with their frequencies are the dictionary; phrases are counted
inside distinct chunks only, weighted by frequency. A phrase of up to four words that
begins in the shared last three words of a chunk belongs to the next chunk, all others
lie whole in theirs, so each occurrence counts once.

A phrase is as frequent as its parts at most. Words are counted first, then pairs of
frequent words, then longer phrases of frequent pairs. Tasks learn what was frequent
from a bit set of fixed size: a false hit costs time, never a count.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import textkit
from tidemark.llm.places import places
from tidemark.llm.textkit import Words, tidied
from tidemark.session import fresh_dir

SHARED = 3               # words that neighbouring chunks share
LONGEST = SHARED + 1     # words of the longest phrase
TRIGGER = 24             # one window in so many cuts
FILTER_BITS = 26         # the bit set of frequent phrases: 2^26 bits, 8 MiB
HELD_BYTES = 4 << 20     # chunks that are counted together in a task
UNDEFINED = "und"        # the language of texts without one

SPACE, BREAK = 0x20, 0x0A
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ENDS_PIECE = np.zeros(256, bool)
_ENDS_PIECE[list(b".,;:!?\x0a\x0b\x0c\x0d")] = True
_GAP = _ENDS_PIECE.copy()
_GAP[[0x20, 0x09]] = True
_CHUNK_GAP = np.zeros(256, bool)
_CHUNK_GAP[[SPACE, BREAK]] = True


def _gather(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Strings ``buf[starts[i]:ends[i]]``, which may overlap."""
    lens = ends - starts
    offsets = np.concatenate([[0], np.cumsum(lens)])
    out = np.empty(int(offsets[-1]), np.uint8)
    for lo in range(0, len(lens), 1 << 17):            # keeps the index array small
        s = slice(lo, lo + (1 << 17))
        a, b = offsets[lo], offsets[min(lo + (1 << 17), len(lens))]
        out[a:b] = buf[np.arange(a, b) + np.repeat(starts[s] - offsets[:-1][s], lens[s])]
    kind, width = (pa.string(), np.int32) if offsets[-1] < 2**31 else (pa.large_string(), np.int64)
    return pa.Array.from_buffers(kind, len(lens), [None, pa.py_buffer(offsets.astype(width)),
                                                   pa.py_buffer(out)])


def _chunks(words: Words, trigger: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(chunk texts, whether each is its text's last, text that each belongs to). Words of
    one piece are joined by a space, those of two by a line feed."""
    n = len(words.starts)
    if not n:
        return pa.array([], pa.string()), np.zeros(0, bool), np.zeros(0, np.int64)
    lens = words.ends - words.starts
    ends = np.cumsum(lens + 1) - 1
    starts = ends - lens
    clean = np.empty(int(ends[-1]) + 1, np.uint8)
    for lo in range(0, n, 1 << 17):
        s = slice(lo, lo + (1 << 17))
        a, b = int(starts[s][0]), int(ends[s][-1]) + 1
        at = np.arange(a, b) + np.repeat(words.starts[s] - starts[s], lens[s] + 1)
        clean[a:b] = words.buf[np.minimum(at, len(words.buf) - 1)]
    clean = _LOWER[clean]
    breaks = np.concatenate([[0], np.cumsum(_ENDS_PIECE[words.buf])])
    apart = np.zeros(n, bool)
    apart[:-1] = breaks[words.starts[1:]] > breaks[words.ends[:-1]]
    clean[ends] = np.where(apart, BREAK, SPACE)
    h, whole = textkit.windows(words, words.hashes(fold_case=True), SHARED)
    index = words.index_in_doc()
    cut = whole & (h % np.uint64(trigger) == 0) & (index > 0)
    first = np.flatnonzero(cut | (index == 0))
    doc = np.repeat(np.arange(len(words.first) - 1), words.counts)[first]
    last = np.append(doc[1:] != doc[:-1], True)
    until = np.where(last, words.first[doc + 1], np.append(first[1:], 0) + SHARED)
    return _gather(clean, starts[first], ends[until - 1]), last, doc


_PARSED = T.StructType([T.StructField("lang", T.StringType()), T.StructField("chunk", T.StringType()),
                        T.StructField("last", T.BooleanType())])


def _parse(batch: pa.RecordBatch, trigger: int) -> Iterator[pa.RecordBatch]:
    """Chunks of a batch of texts, worked on in slices of bounded size."""
    lang = batch.column("lang")
    buf, offsets = textkit._buffers(batch.column("text"))
    n, at = len(offsets) - 1, 0
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + textkit.SLICE_BYTES, side="right")) - 1
        to = min(max(to, at + 1), n)
        lo, hi = offsets[at], offsets[to]
        words = textkit._split(buf[lo:hi], offsets[at:to + 1] - lo, _GAP)
        chunk, last, doc = _chunks(words, trigger)
        if len(chunk):
            yield pa.RecordBatch.from_arrays(
                [lang.take(pa.array(doc + at)), chunk, pa.array(last)], names=_PARSED.names)
        at = to


def parse(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
          trigger: int = TRIGGER) -> DataFrame:
    """The dictionary: (lang, chunk, last, freq), one row a distinct chunk of a language.
    ``last`` marks chunks that end their text and share no words with a next one. One
    window in ``trigger`` cuts; counts do not depend on it."""
    lang = F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit(UNDEFINED)).alias("lang")
    rows = docs.select(lang, F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))

    @tidied
    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _parse(batch, trigger)

    return (rows.mapInArrow(chunks, _PARSED).groupBy("lang", "chunk", "last")
            .agg(F.count("*").alias("freq")))


# --- counting inside chunks -------------------------------------------------------

def _seeds(langs: pa.Array) -> np.ndarray:
    """One 64-bit number a language, for each row."""
    coded = langs.dictionary_encode()
    seeds = [int.from_bytes(hashlib.blake2b((x or "").encode(), digest_size=8).digest(), "little")
             for x in coded.dictionary.to_pylist()]
    return np.array(seeds, np.uint64)[coded.indices.to_numpy(zero_copy_only=False)]


def _bit(h: np.ndarray, seed: np.ndarray, n: int) -> np.ndarray:
    """Position in the bit set of phrases of n words."""
    return (textkit.mix(h ^ seed ^ np.uint64(n)) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def _has(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _count(rows: pa.Table, sizes: tuple[int, ...], bits: np.ndarray | None) -> pa.Table:
    """(lang, phrase, n_words, f) of phrases with ``sizes`` words in these chunks. Of pairs,
    both words have to be in the bit set, of longer phrases all pairs. With size 1, a row
    without a phrase has the number of all words."""
    lang = rows["lang"].combine_chunks()
    buf, offsets = textkit._buffers(rows["chunk"])
    words = textkit._split(buf, offsets, _CHUNK_GAP)
    h, n = words.hashes(), len(words.starts)
    chunk = words.doc_of()
    seed = _seeds(lang)[chunk]
    left = np.repeat(words.first[1:], words.counts) - np.arange(n)       # words to the chunk's end
    open_end = ~rows["last"].combine_chunks().to_numpy(zero_copy_only=False)
    here = (left > SHARED) | ~open_end[chunk]                            # begins in this chunk
    joined = np.zeros(n, bool)                                           # with the word after it
    joined[:-1] = (words.buf[words.ends[:-1]] == SPACE) & (left[:-1] > 1)
    weight = rows["freq"].combine_chunks().to_numpy(zero_copy_only=False)
    out = []
    good = np.ones(n, bool)            # phrases that begin at a word and can be frequent
    if sizes != (1,):
        pair, _ = textkit.windows(words, h, 2)
        word_ok = _has(bits, _bit(h, seed, 1)) if sizes == (2,) else None
        nxt = np.zeros(n, bool)
        if word_ok is not None:
            nxt[:-1] = word_ok[1:]
            good = joined & word_ok & nxt
        else:
            pairs = joined & _has(bits, _bit(pair, seed, 2))
    for size in sizes:
        if size > 2:
            good = pairs.copy()
            for step in range(1, size - 1):
                good[:n - step] &= pairs[step:]
                good[n - step:] = False
        at = np.flatnonzero(good & here)
        phrase = _gather(words.buf, words.starts[at], words.ends[at + size - 1])
        found = pa.table({"lang": lang.take(pa.array(chunk[at])), "phrase": phrase,
                          "f": pa.array(weight[chunk[at]])})
        found = found.group_by(["lang", "phrase"]).aggregate([("f", "sum")])
        if size == 1:
            total = found.group_by("lang").aggregate([("f_sum", "sum")])
            nothing = pa.nulls(total.num_rows, found.schema.field("phrase").type)
            found = pa.concat_tables([found, pa.table({
                "lang": total["lang"], "phrase": nothing, "f_sum": total["f_sum_sum"]})])
        out.append(pa.table({"lang": found["lang"], "phrase": found["phrase"],
                             "n_words": pa.array(np.full(found.num_rows, size, np.int32)),
                             "f": found["f_sum"]}))
    return pa.concat_tables(out)


def _counts(chunks: DataFrame, sizes: tuple[int, ...], bits=None) -> DataFrame:
    """Occurrences of phrases in the whole dictionary: lang, phrase, n_words, f."""
    @tidied
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None if bits is None else np.frombuffer(bits.value, np.uint8)
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.get_total_buffer_size()
            if size >= HELD_BYTES:
                yield from _count(pa.Table.from_batches(held), sizes, known).to_batches()
                held, size = [], 0
        if size:
            yield from _count(pa.Table.from_batches(held), sizes, known).to_batches()

    found = chunks.mapInArrow(count, "lang string, phrase string, n_words int, f long")
    return found.groupBy("lang", "phrase", "n_words").agg(F.sum("f").alias("f"))


@F.arrow_udf(T.LongType())
def _position(lang: pa.Array, phrase: pa.Array) -> pa.Array:
    """The bit of each phrase; all phrases of a batch have one length."""
    words = textkit.split_words(phrase)
    out = np.zeros(len(phrase), np.int64)
    seeds, h = _seeds(lang), words.hashes()
    for n in np.unique(words.counts):
        of = np.flatnonzero(words.counts == n)
        if n:
            run, _ = textkit.windows(words, h, int(n)) if n > 1 else (h, None)
            out[of] = _bit(run[words.first[of]], seeds[of], int(n))
    return pa.array(out)


def _bit_set(frequent: DataFrame):
    """Broadcast bit set of the phrases; 8 MiB however many there are."""
    bit = F.col("at") + 1                       # Spark's buckets hold 32768 positions from 1 on
    rows = (frequent.select(_position("lang", "phrase").alias("at"))
            .groupBy(F.bitmap_bucket_number(bit).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits")).collect())
    whole = bytearray(1 << FILTER_BITS >> 3)
    for bucket, bits in rows:
        whole[(bucket - 1) * len(bits):bucket * len(bits)] = bits
    return frequent.sparkSession.sparkContext.broadcast(bytes(whole))


def phrase_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
                  least: int = 30, trigger: int = TRIGGER) -> DataFrame:
    """(lang, phrase, n_words, f) of all phrases of 1 to 4 words with f >= ``least``, and one
    row without a phrase a language, with the number of its words."""
    spark = docs.sparkSession
    path = fresh_dir(spark, "phrases")
    parse(docs, text_col, lang_col, trigger).write.parquet(f"{path}/chunks")
    chunks = spark.read.parquet(f"{path}/chunks")
    bits, enough = None, (F.col("f") >= least) | F.col("phrase").isNull()
    for at, sizes in enumerate(((1,), (2,), tuple(range(3, LONGEST + 1)))):
        _counts(chunks, sizes, bits).where(enough).write.parquet(f"{path}/counts/step={at}")
        found = spark.read.parquet(f"{path}/counts/step={at}")
        if at < 2:
            bits = _bit_set(found.where("phrase IS NOT NULL"))
    return spark.read.parquet(f"{path}/counts").drop("step")


# --- scores -----------------------------------------------------------------------

def _score(counts: DataFrame) -> DataFrame:
    """Each candidate's lowest cut: lang, phrase, a, l, r, score."""
    words = F.split("phrase", " ")
    pieces = (counts.where("n_words > 1").select("lang", "phrase", "n_words", F.col("f").alias("a"),
                                                 words.alias("w"))
              .select("*", F.explode(F.sequence(F.lit(1), F.col("n_words") - 1)).alias("k")))
    pieces = pieces.select("lang", "phrase", "a", "k", F.concat_ws(" ", F.slice("w", 1, F.col("k")))
                           .alias("head"),
                           F.concat_ws(" ", F.slice("w", F.col("k") + 1, F.col("n_words"))).alias("tail"))
    parts = counts.where("phrase IS NOT NULL AND n_words < 4").select("lang", "phrase", "f")
    heads = parts.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    tails = parts.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    cuts = pieces.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"])
    wide = "decimal(20,0)"             # l, r and 2000000 a may pass 64 bits
    score = F.expr(f"(2000000BD * CAST(a AS {wide})) div (CAST(l AS {wide}) + CAST(r AS {wide}))")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r"))
    return (cuts.groupBy("lang", "phrase", "a").agg(lowest.alias("cut"))
            .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"))


def _inside(counts: DataFrame) -> DataFrame:
    """Phrases of two or more words inside longer ones: lang, phrase, the longer one's most."""
    w = F.split("phrase", " ")
    size = F.explode(F.sequence(F.lit(2), F.col("n_words") - 1)).alias("size")
    longer = counts.where("n_words > 2").select("lang", "f", w.alias("w"), "n_words", size)
    start = F.explode(F.sequence(F.lit(1), F.col("n_words") - F.col("size") + 1)).alias("start")
    inner = longer.select("lang", "f", "w", "size", start)
    phrase = F.concat_ws(" ", F.slice("w", F.col("start"), F.col("size"))).alias("phrase")
    return inner.groupBy("lang", phrase).agg(F.max("f").alias("most"))


def mine(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 30,
         keep: int = 2000) -> DataFrame:
    """The ``keep`` best collocations a language: lang, rank, phrase, a, l, r, n, score.

    A-Z are folded. Pieces end at ``. , ; : ! ?`` and line feed to carriage return, words
    at space and TAB. n counts a language's words, a the phrase's occurrences inside
    pieces, overlaps included. Cut after k words, a phrase has parts l and r and the score
    floor(2000000 a / (l + r)); its lowest cut counts, of equal ones the first. A phrase
    inside a longer one that has at least 80 percent of its occurrences is left out.
    Ranks go by score and a, descending, then by phrase; so ties are settled.
    Null texts are empty; texts without a language are ``und``; other columns are not
    read. An empty table has no rows. Repeated rows count as often as they stand there.
    """
    counts = phrase_counts(docs, text_col, lang_col, least)
    part_of = _inside(counts)
    kept = _score(counts).join(part_of, ["lang", "phrase"], "left").where(
        "most IS NULL OR 100BD * CAST(most AS decimal(20,0)) < 80BD * CAST(a AS decimal(20,0))")
    total = counts.where("phrase IS NULL").select("lang", F.col("f").alias("n"))
    # ranks are places in sorted ranges: a language with most of the phrases is no single task
    down = kept.withColumn("_order", F.struct((-F.col("score")).alias("s"), (-F.col("a")).alias("a"), "phrase"))
    best = places(down, "lang", ["_order"]).drop("n").where(F.col("at") < keep)
    return best.join(total, "lang").select("lang", (F.col("at") + 1).alias("rank"), "phrase",
                                           "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
