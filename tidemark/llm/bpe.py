"""Byte-level BPE with a minimal acyclic transducer as lexicon.

The corpus' most frequent words are encoded once and compiled into a minimal
acyclic automaton: states with equal continuations are shared, and numbers on
the arcs add up to a word's place in the table of its token ids. The arrays
are written to one file, which Spark hands to every executor and the Python
workers memory-map. Words that the lexicon lacks are merged exactly, so the
lexicon's size bounds memory and never changes a result.

Word counts cover all documents; per slice they are summed before the shuffle.
"""

from __future__ import annotations

import heapq
import json
import os
import re
import tempfile
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.textkit import tidied
from tidemark.session import work_dir

LEXICON = 1 << 17        # frequent words in the automaton, a bound on its size
LEAST = 4                # rarer words are not worth a place in it
COUNTED = 1 << 18        # distinct words that a counting task holds at once
NEVER = 1 << 62          # rank of a pair that doesn't merge
NO_RANK = np.int32(2**31 - 1)
MERGED = 1 << 13         # words merged side by side
SLICE_CHARS = 1 << 20    # texts are worked on in slices of about so many characters
MEMO = 1 << 16           # merged words that a worker remembers

#: The white space of Unicode, and the split pattern of byte-level BPE.
SPACE = r"\t-\r \x85\xa0  -     　"
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?{letter}+| ?{number}+| ?{other}+"
           rf"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
#: Letters and numbers that Unicode got after version 16, which the
#: tokenizers library follows; it splits them as it does other symbols.
LATER = ("558 58B-58C 88F C5C CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D "
         "107BB-107BF 10940-10959 10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 11DF1 "
         "1246F 12475-1247F 12550-12686 16EA0-16EB8 16EBB-16ED3 16FF2-16FF6 187F8-187FF "
         "18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6 "
         "1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 "
         "1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479 "
         "3D000-3FC3F")
_later = "[" + "".join("-".join(rf"\U{int(c, 16):08x}" for c in r.split("-"))
                       for r in LATER.split()) + "]"
_OTHER = rf"[^{SPACE}\p{{L}}\p{{N}}]"
#: Bytes that end a word when words are counted, made spaces.
_BREAKS = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256))
_HAS_LATER = re.compile(_later)
_SPLIT = regex.compile(PATTERN.format(letter=r"\p{L}", number=r"\p{N}", other=_OTHER))
_SPLIT_LATER = regex.compile(PATTERN.format(
    letter=rf"(?:(?!{_later})\p{{L}})", number=rf"(?:(?!{_later})\p{{N}})",
    other=f"(?:{_later}|{_OTHER})"))


def split_words(text: str) -> list[str]:
    """The words that merge on their own, in order; joined, they are the text."""
    try:
        text.encode("latin-1")               # no character that late, found out fast
    except UnicodeEncodeError:
        if _HAS_LATER.search(text):
            return _SPLIT_LATER.findall(text)
    return _SPLIT.findall(text)


def _byte_chars() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Merges:
    """Exact BPE: pairs of token ids with their rank and the id they merge to."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.arrays = arrays
        pair, new = arrays["pair"].tolist(), arrays["new"].tolist()
        self.rank = {p: i for i, p in enumerate(pair)}
        self.new = new
        self.byte = arrays["byte"].tolist()
        order = np.argsort(arrays["pair"])
        self.pairs, self.ranks = np.asarray(arrays["pair"])[order], order.astype(np.int32)
        self.ends = np.cumsum(arrays["token_len"])
        self.special = {bytes(arrays["token_bytes"][self.ends[i] - n:self.ends[i]]).decode(): i
                        for i, n in zip(arrays["special"].tolist(),
                                        arrays["token_len"][arrays["special"]].tolist())}
        self.on_special = (regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
                           if self.special else None)

    def merge(self, word: bytes) -> list[int]:
        """Token ids of one word: always the leftmost pair of the lowest rank merges."""
        ids = [self.byte[b] for b in word]
        if len(ids) > 64:
            return self._merge_long(ids)
        get, new = self.rank.get, self.new
        ranks = [get(a << 32 | b, NEVER) for a, b in zip(ids, ids[1:])]
        while ranks and (best := min(ranks)) != NEVER:
            i = ranks.index(best)
            ids[i:i + 2] = [new[best]]
            del ranks[i]
            if i:
                ranks[i - 1] = get(ids[i - 1] << 32 | ids[i], NEVER)
            if i < len(ranks):
                ranks[i] = get(ids[i] << 32 | ids[i + 1], NEVER)
        return ids

    def pair_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids, or NO_RANK; ids below zero are no tokens."""
        key = a.astype(np.int64) << 32 | b
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where((self.pairs[at] == key) & (b >= 0), self.ranks[at], NO_RANK)

    def merge_many(self, words: list[bytes]) -> list[list[int]]:
        """The same for many words: one merge in each word that has any left, a step."""
        out: list = [None] * len(words)
        if not len(self.pairs):
            return [[self.byte[b] for b in w] for w in words]
        by_size = sorted(range(len(words)), key=lambda i: len(words[i]))
        byte = np.array(self.byte, np.int32)
        new = np.asarray(self.arrays["new"])
        while by_size and len(words[by_size[-1]]) > 64:
            out[by_size[-1]] = self.merge(words[by_size[-1]])
            by_size.pop()
        for lo in range(0, len(by_size), MERGED):
            part = np.array(by_size[lo:lo + MERGED])
            lens = np.array([len(words[i]) for i in part])
            ids = np.full((len(part), max(int(lens.max()), 1)), -1, np.int32)
            filled = np.arange(ids.shape[1])[None, :] < lens[:, None]
            ids[filled] = byte[np.frombuffer(b"".join(words[i] for i in part), np.uint8)]
            rank = self.pair_ranks(ids[:, :-1], ids[:, 1:])
            while len(part):
                at = rank.argmin(1) if rank.shape[1] else np.zeros(len(part), np.int64)
                best = rank[np.arange(len(part)), at] if rank.shape[1] else np.full(len(part), NO_RANK)
                done = best == NO_RANK
                for i, row in zip(part[done].tolist(), ids[done].tolist()):
                    out[i] = row[:row.index(-1)] if row and row[-1] < 0 else row
                part, ids, rank, at, best = (x[~done] for x in (part, ids, rank, at, best))
                if not len(part):
                    break
                row, width = np.arange(len(part)), ids.shape[1] - 1
                ids[row, at] = new[best]
                cols = np.arange(width)[None, :]
                ids = np.take_along_axis(ids, cols + (cols > at[:, None]), 1)
                if width > 1:
                    cols = cols[:, :-1]
                    rank = np.take_along_axis(rank, cols + (cols >= at[:, None]), 1)
                    left, right = at > 0, at < width - 1
                    rank[row[left], at[left] - 1] = self.pair_ranks(
                        ids[row[left], at[left] - 1], ids[row[left], at[left]])
                    rank[row[right], at[right]] = self.pair_ranks(
                        ids[row[right], at[right]], ids[row[right], at[right] + 1])
                else:
                    rank = np.zeros((len(part), 0), np.int32)
        return out

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap and a linked list: n log n in the word's length."""
        n = len(ids)
        nxt, prev = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def offer(i):
            if i >= 0 and nxt[i] < n:
                pair = ids[i] << 32 | ids[nxt[i]]
                if (r := self.rank.get(pair)) is not None:
                    heapq.heappush(heap, (r, i, pair))

        for i in range(n - 1):
            offer(i)
        while heap:
            r, i, pair = heapq.heappop(heap)
            j = nxt[i]
            if ids[i] < 0 or j >= n or ids[i] << 32 | ids[j] != pair:
                continue
            ids[i], ids[j] = self.new[r], -1
            nxt[i] = nxt[j]
            if nxt[i] < n:
                prev[nxt[i]] = i
            offer(i)
            offer(prev[i])
        return [t for t in ids if t >= 0]


def read_tokenizer(path: str) -> dict[str, np.ndarray]:
    """Arrays of a byte-level BPE file: merges, token bytes and special tokens.
    Its truncation and padding settings are not used."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    vocab, chars = dict(spec["model"]["vocab"]), _byte_chars()
    merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
    added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    token = {i: bytes(chars[c] for c in t) for t, i in vocab.items() if t not in added}
    token |= {i: t.encode() for t, i in added.items()}
    raw = [token.get(i, b"") for i in range(max(token) + 1)]
    return {
        "pair": np.array([vocab[a] << 32 | vocab[b] for a, b in merges], np.int64),
        "new": np.array([vocab[a + b] for a, b in merges], np.int32),
        "byte": np.array([vocab[c] for c, _ in sorted(chars.items(), key=lambda x: x[1])], np.int32),
        "token_len": np.array([len(t) for t in raw], np.int32),
        "token_bytes": np.frombuffer(b"".join(raw), np.uint8),
        "special": np.array(sorted(added.values()), np.int32)}


def compile_lexicon(words: Iterable[bytes], ids: Iterable[list[int]]) -> dict[str, np.ndarray]:
    """Minimal acyclic transducer of distinct words: arcs sorted by (state, byte),
    each with its target and the number of words that sort before it."""
    entries = sorted(zip(words, ids))
    register: dict[tuple, int] = {}
    states: list[tuple] = []                 # (final, ((byte, target), ...))

    def settle(node: list) -> int:
        key = (node[0], tuple(node[1]))
        if key not in register:
            register[key] = len(states)
            states.append(key)
        return register[key]

    stack: list[list] = [[False, [], b""]]   # path of the last word: final, arcs, byte into it
    last = b""
    for word, _ in entries:
        same = len(os.path.commonprefix([last, word]))
        while len(stack) > same + 1:
            node = stack.pop()
            stack[-1][1].append((node[2], settle(node)))
        for b in word[same:]:
            stack.append([False, [], b])
        stack[-1][0] = True
        last = word
    while len(stack) > 1:
        node = stack.pop()
        stack[-1][1].append((node[2], settle(node)))
    root = settle(stack[0])

    size = np.zeros(len(states), np.int64)   # words from each state on; targets come first
    key, target, skip = [], [], []
    for s, (final, arcs) in enumerate(states):
        n = int(final)
        for b, t in arcs:
            key.append(s << 8 | b)
            target.append(t)
            skip.append(n)
            n += int(size[t])
        size[s] = n
    lens = [len(i) for _, i in entries]
    return {"arc": np.array(key, np.int64), "target": np.array(target, np.int32),
            "skip": np.array(skip, np.int32), "final": np.array([s[0] for s in states], bool),
            "root": np.array([root], np.int32), "ids_end": np.cumsum(lens, dtype=np.int64),
            "ids": np.array([i for _, e in entries for i in e], np.int32)}


def write_arrays(path: str, arrays: dict[str, np.ndarray]) -> None:
    head, at = {}, 0
    for name, a in arrays.items():
        head[name] = [a.dtype.str, len(a), at]
        at += -(-a.nbytes // 64) * 64
    text = json.dumps(head).encode()
    with open(path, "wb") as f:
        f.write(len(text).to_bytes(8, "little") + text)
        start = -(-f.tell() // 64) * 64
        for name, a in arrays.items():
            f.seek(start + head[name][2])
            f.write(a.tobytes())
        f.truncate(start + at)


def map_arrays(path: str) -> dict[str, np.ndarray]:
    data = np.memmap(path, np.uint8, "r")
    n = int.from_bytes(data[:8].tobytes(), "little")
    start = -(-(8 + n) // 64) * 64
    return {name: data[start + at:start + at + np.dtype(kind).itemsize * size].view(kind)
            for name, (kind, size, at) in json.loads(data[8:8 + n].tobytes()).items()}


class Encoder:
    """Encodes and decodes with the memory-mapped arrays of a file."""

    _open: dict[str, "Encoder"] = {}

    def __init__(self, path: str):
        self.a = map_arrays(path)
        self.merges = Merges(self.a)
        self.memo: dict[str, list[int]] = {}

    @classmethod
    def of(cls, name: str) -> "Encoder":
        """One encoder a worker and file."""
        if name not in cls._open:
            cls._open.clear()
            cls._open[name] = cls(SparkFiles.get(name))
        return cls._open[name]

    def lookup(self, words: list[bytes]) -> np.ndarray:
        """Each word's place in the lexicon, or -1: all words walk the automaton at once."""
        a = self.a
        lens = np.array([len(w) for w in words], np.int64)
        if not len(lens) or not len(a["arc"]):
            return np.full(len(lens), -1, np.int64)
        buf = np.frombuffer(b"".join(words), np.uint8)
        start = np.cumsum(lens) - lens
        state = np.full(len(words), int(a["root"][0]), np.int64)
        place = np.zeros(len(words), np.int64)
        live, j = np.flatnonzero(lens > 0), 0
        while len(live):
            key = state[live] << 8 | buf[start[live] + j]
            arc = np.minimum(np.searchsorted(a["arc"], key), len(a["arc"]) - 1)
            ok = a["arc"][arc] == key
            state[live[~ok]] = -1
            live, arc = live[ok], arc[ok]
            state[live] = a["target"][arc]
            place[live] += a["skip"][arc]
            j += 1
            live = live[lens[live] > j]
        found = (state >= 0) & (lens > 0)
        found[found] = a["final"][state[found]]
        return np.where(found, place, -1)

    def word_ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of distinct words, one after the other, and how many each has."""
        raw = [w.encode() for w in words]
        place = self.lookup(raw)
        end = self.a["ids_end"]
        known = place >= 0
        lens = np.zeros(len(words), np.int64)
        lens[known] = end[place[known]] - np.where(place[known] > 0, end[place[known] - 1], 0)
        unseen = np.flatnonzero(~known).tolist()
        rare = {i: self.memo.get(words[i]) for i in unseen}
        missing = []
        for i in unseen:
            if rare[i] is None:
                if words[i] in self.merges.special:
                    rare[i] = [self.merges.special[words[i]]]
                else:
                    missing.append(i)
        merged = self.merges.merge_many([raw[i] for i in missing])
        rare.update(zip(missing, merged))
        if len(self.memo) + len(missing) > MEMO:
            self.memo.clear()
        self.memo.update((words[i], ids) for i, ids in zip(missing, merged))
        lens[unseen] = [len(rare[i]) for i in unseen]
        at = np.cumsum(lens) - lens
        flat = np.zeros(int(lens.sum()), np.int64)
        k = np.flatnonzero(known)
        flat[ragged(at[k], lens[k])] = self.a["ids"][ragged(end[place[k]] - lens[k], lens[k])]
        if unseen:
            flat[ragged(at[unseen], lens[unseen])] = [t for i in unseen for t in rare[i]]
        return flat, lens

    def split(self, text: str) -> list[str]:
        """Words of a text; special tokens stand alone."""
        special = self.merges.on_special
        if special is None or not special.search(text):
            return split_words(text)
        out = []
        for i, part in enumerate(special.split(text)):
            out += [part] if i % 2 else split_words(part)
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Token ids of each text."""
        words, counts = [], []
        for t in texts:
            w = self.split(t)
            words += w
            counts.append(len(w))
        if not words:
            return [np.zeros(0, "<u4") for _ in texts]
        place = {w: i for i, w in enumerate(dict.fromkeys(words))}
        code = np.fromiter(map(place.__getitem__, words), np.int64, len(words))
        del words
        flat, lens = self.word_ids(list(place))
        at = np.cumsum(lens) - lens
        ids = flat[ragged(at[code], lens[code])].astype("<u4")
        word_end = np.concatenate([[0], np.cumsum(lens[code])])
        edge = word_end[np.concatenate([[0], np.cumsum(counts)])]
        return [ids[a:b] for a, b in zip(edge[:-1], edge[1:])]

    def decode(self, ids: np.ndarray) -> str:
        """Text of token ids, special tokens included; broken UTF-8 is replaced."""
        ids = ids.astype(np.int64)
        lens = self.a["token_len"][ids].astype(np.int64)
        raw = self.a["token_bytes"][ragged(self.merges.ends[ids] - lens, lens)]
        return raw.tobytes().decode("utf-8", errors="replace")


def ragged(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The positions start .. start + len of each run, one run after the other."""
    ends = np.cumsum(lens)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lens), lens)


def _slices(texts: pa.Array) -> Iterator[list[str]]:
    part, size = [], 0
    for t in texts.to_pylist():
        part.append(t or "")
        size += len(part[-1])
        if size >= SLICE_CHARS:
            yield part
            part, size = [], 0
    if part:
        yield part


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n = Counter()

    def flush():
        return pa.record_batch([pa.array(n.keys(), pa.binary()),
                                pa.array(n.values(), pa.int64())], names=["word", "n"])

    for batch in batches:
        for text in batch.column(0).cast(pa.binary()).to_pylist():
            n.update((text or b"").translate(_BREAKS).split())
            if len(n) >= COUNTED:
                yield flush()
                n.clear()
    yield flush()


def frequent_words(docs: DataFrame, text_col: str = "text", size: int = LEXICON) -> DataFrame:
    """Words of all documents by frequency, as long as there is room for all of one
    frequency: at most ``size`` of them, chosen without sorting the words. A word
    here is a run of bytes other than ASCII signs and white space: what mostly
    follows a space and merges with it, found faster than by the split pattern."""
    work_dir(docs.sparkSession)
    counted = (docs.select(F.col(f"`{text_col}`").alias("text"))
               .mapInArrow(_count_words, "word binary, n bigint")
               .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST).checkpoint())
    by_count = counted.groupBy("n").agg(F.count("*").alias("words"))
    upto = Window.orderBy(F.desc("n"))
    least = (by_count.orderBy(F.desc("n")).limit(size)
             .withColumn("sum", F.sum("words").over(upto)).where(F.col("sum") <= size)
             .agg(F.min("n")).first()[0])
    return counted.where(F.col("n") >= F.lit(least if least is not None else NEVER))


def build_encoder(docs: DataFrame, path: str, text_col: str = "text", size: int = LEXICON) -> str:
    """Name of a file, known to all executors, that holds the tokenizer at ``path``
    and the lexicon of ``docs``."""
    arrays = read_tokenizer(path)
    merges = Merges(arrays)
    words = [b" " + r["word"] for r in frequent_words(docs, text_col, size).collect()]
    arrays |= compile_lexicon(words, merges.merge_many(words))
    name = f"bpe-{uuid.uuid4().hex}.bin"
    local = os.path.join(tempfile.mkdtemp(prefix="bpe-"), name)    # the driver's own copy
    write_arrays(local, arrays)
    docs.sparkSession.sparkContext.addFile(local)
    return name


def round_trip(name: str, text: Column) -> Column:
    """Struct column: token ids as little-endian 32-bit integers, and the text
    decoded from them. A null text is empty."""

    @tidied
    def run(texts: pa.Array) -> pa.Array:
        encoder = Encoder.of(name)
        ids, back = [], []
        for part in _slices(texts):
            for found in encoder.encode(part):
                ids.append(found.tobytes())
                back.append(encoder.decode(found))
        return pa.StructArray.from_arrays(
            [pa.array(ids, pa.binary()), pa.array(back, pa.string())], ["ids", "text"])

    return F.arrow_udf(run, "struct<ids:binary,text:string>")(text)


def encode(name: str, text: Column) -> Column:
    """Array column of a text's token ids; a null text has none."""

    def run(texts: pa.Array) -> pa.Array:
        encoder = Encoder.of(name)
        found = [x.astype(np.int32) for part in _slices(texts) for x in encoder.encode(part)]
        return pa.array(found, pa.list_(pa.int32()))

    return F.arrow_udf(run, "array<int>")(text)


def decode(name: str, ids: Column) -> Column:
    """Text column of arrays of token ids; null stays null."""

    def run(rows: pa.Array) -> pa.Array:
        encoder = Encoder.of(name)
        return pa.array([None if r is None else encoder.decode(np.array(r, np.int64))
                         for r in rows.to_pylist()], pa.string())

    return F.arrow_udf(run, "string")(ids)


def tokenized(docs: DataFrame, path: str, text_col: str = "text", size: int = LEXICON) -> DataFrame:
    """``docs`` with struct ``bpe``: n_tokens, ids_sha256 and decoded_sha256.

    A null or empty text has no tokens. Rows are independent, so repeated rows
    give repeated results and an empty table none. A column ``bpe`` of the input is
    replaced; all others stay, whatever their names.
    """
    name = build_encoder(docs, path, text_col, size)
    both = docs.withColumn("bpe", round_trip(name, F.col(f"`{text_col}`")))
    return both.withColumn("bpe", F.struct(
        (F.octet_length("bpe.ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("bpe.ids", 256).alias("ids_sha256"),
        F.sha2(F.col("bpe.text").cast("binary"), 256).alias("decoded_sha256")))
