"""Exact dedup, Merkle manifest and collocations against plain versions."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import collocations, content_sort, merkle

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- exact dedup -------------------------------------------------------------------

def _copies(seed=1, n=400):
    rng = random.Random(seed)
    long = "word " * 5000
    texts = [None, "", "hot", "hot", "hot", long, long + "x", "Hot"] + [f"t{i}" for i in range(40)]
    rows = [(i, rng.choice(texts), i % 3) for i in range(n)]
    return rows + [(None, "hot", 1), (None, "solo", 2), (7, "twice", 0), (7, "twice", 0)]


@pytest.fixture
def small_ranges(spark):
    """Ranges and batches so small that groups go on over several of them."""
    names = {"spark.sql.adaptive.coalescePartitions.enabled": "false",
             "spark.sql.execution.arrow.maxRecordsPerBatch": "7"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_copies_like_a_dictionary_of_texts(spark, small_ranges, keep):
    rows = _copies()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, keep_id int").repartition(6)
    groups = defaultdict(list)
    for i, text, _ in rows:
        groups[text or ""].append(i)
    pick = max if keep == "largest" else min
    best = {t: pick([i for i in ids if i is not None], default=None) for t, ids in groups.items()}
    got = content_sort.mark_copies(docs, keep=keep).collect()
    order = lambda r: tuple((x is None, x) for x in r)
    expected = [(i, best[t or ""], len(groups[t or ""]), sha(t or "")) for i, t, _ in rows]
    assert sorted(((r.row.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got),
                  key=order) == sorted(expected, key=order)
    assert sorted(r.text_sha256 for r in got if r.kept) == sorted(map(sha, groups))
    assert all(r.row.doc_id == r.keep_id for r in got if r.kept)
    kept = content_sort.keep_one(docs, keep=keep)
    assert kept.columns == docs.columns
    assert sorted((r.text or "", r.doc_id or -1) for r in kept.collect()) == sorted(
        (t, b or -1) for t, b in best.items())


def test_copies_after_normalising_and_of_nothing(spark):
    docs = spark.createDataFrame([(1, "A"), (2, "a"), (3, None), (4, "")], "doc_id int, text string")
    got = content_sort.mark_copies(docs, normalise=F.lower).collect()
    assert sorted((r.row.doc_id, r.keep_id, r.kept) for r in got) == [
        (1, 2, False), (2, 2, True), (3, 4, False), (4, 4, True)]
    assert content_sort.mark_copies(docs.limit(0)).count() == 0
    assert content_sort.keep_one(docs.limit(0)).columns == docs.columns


# --- Merkle manifest -----------------------------------------------------------------

def _field(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def _plain_manifest(rows):
    """{(source, leaf place): (leaf, subroot, root, proof digest)} level by level."""
    trees = defaultdict(list)
    for i, source, text in rows:
        trees[source].append((i is not None, i or 0, sha(_field(i) + _field(source) + _field(text))))
    def climb(nodes):
        paths = [[] for _ in nodes]
        below = [[k] for k in range(len(nodes))]
        while len(nodes) > 1:
            runs = [range(a, min(a + 16, len(nodes))) for a in range(0, len(nodes), 16)]
            for run in runs:
                for at in run:
                    for leaf in below[at]:
                        paths[leaf] += [nodes[o] for o in run if o != at]
            below = [[leaf for at in run for leaf in below[at]] for run in runs]
            nodes = [sha("".join(nodes[at] for at in run)) for run in runs]
        return nodes[0], paths
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    found = {s: climb([leaf for *_, leaf in sorted(trees[s])]) for s in names}
    root, above = climb([found[s][0] for s in names])
    return {(s, at): (leaf, found[s][0], root, sha("".join(found[s][1][at] + above[k])))
            for k, s in enumerate(names) for at, (*_, leaf) in enumerate(sorted(trees[s]))}


def _proved(manifest):
    folded = merkle.fold("digest", "witness")
    got = merkle.witnesses(manifest).select(
        "row.source", "at", *[F.lower(F.hex(c)).alias(c) for c in ("digest", "subroot", "root")],
        folded.alias("f")).collect()
    assert all(r.f.root == r.root for r in got)
    return {(r.source, r["at"]): (r.digest, r.subroot, r.root, r.f.proof_sha256) for r in got}


def _leaves(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string").repartition(5)
    return merkle.as_leaves(docs, ["doc_id", "source", "text"])


def _manifest_rows():
    rng = random.Random(3)
    sizes = {"one": 1, "two": 2, "run": 16, "more": 17, "b": 256, "ö": 257, "": 40, None: 5}
    rows = [(k, s, rng.choice([None, "", "text", "T" * 3000])) for s, n in sizes.items() for k in range(n)]
    rows += [(None, "two", "a"), (1, "two", "x"), (1, "two", "x")]
    return rows


def test_manifest_like_a_plain_tree(spark):
    rows = _manifest_rows()
    assert _proved(merkle.build(_leaves(spark, rows))) == _plain_manifest(rows)


@pytest.mark.parametrize("block_levels", [1, 2])
def test_manifest_over_many_rounds_and_appends(spark, block_levels):
    rows = [(k, s, f"{s}{k}") for s, n in (("a", 300), ("b", 40), ("c", 16), (None, 3)) for k in range(n)]
    assert _proved(merkle.build(_leaves(spark, rows), block_levels)) == _plain_manifest(rows)
    parts = [[r for r in rows if r[0] < 10], [r for r in rows if 10 <= r[0] < 33],
             [r for r in rows if r[0] >= 33] + [(0, "new", "n")]]
    grown = merkle.build(_leaves(spark, parts[0]), block_levels)
    for part in parts[1:]:
        grown = merkle.append(grown, _leaves(spark, part))
    assert _proved(grown) == _plain_manifest([r for p in parts for r in p])
    with pytest.raises(ValueError, match="must follow"):
        merkle.append(grown, _leaves(spark, [(5, "a", "late")]))


def test_manifest_of_nothing_and_of_one_leaf(spark):
    assert _proved(merkle.build(_leaves(spark, _manifest_rows()).limit(0))) == {}
    rows = [(1, "s", "x")]
    assert _proved(merkle.build(_leaves(spark, rows))) == _plain_manifest(rows)


def test_a_changed_leaf_does_not_verify(spark):
    rows = _manifest_rows()
    proved = merkle.witnesses(merkle.build(_leaves(spark, rows)))
    other = F.when(F.col("at") == 1, F.unhex(F.sha2(F.lit("other"), 256))).otherwise(F.col("digest"))
    got = proved.select("at", (merkle.fold(other, "witness")["root"] == F.lower(F.hex("root"))).alias("ok"))
    assert all(r.ok == (r["at"] != 1) for r in got.collect())


# --- collocations ---------------------------------------------------------------------

def _plain_phrases(rows, least):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            for size in range(1, 5):
                f[lang or "und"].update(tuple(words[i:i + size]) for i in range(len(words) - size + 1))
    return {k: Counter({g: c for g, c in v.items() if c >= least}) for k, v in f.items()}, n


def _plain_collocations(rows, least, keep):
    counts, n = _plain_phrases(rows, least)
    out = []
    for lang, f in counts.items():
        found = []
        for g, a in f.items():
            if len(g) == 1 or any(
                    100 * c >= 80 * a and len(o) > len(g)
                    and any(o[i:i + len(g)] == g for i in range(len(o) - len(g) + 1))
                    for o, c in f.items()):
                continue
            cuts = [(2000000 * a // (f[g[:k]] + f[g[k:]]), k) for k in range(1, len(g))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:keep], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def _texts(seed, n=150):
    rng = random.Random(seed)
    vocabulary = ["The", "the", "a", "of", "Übung", "x-y", "o'clock", "10", "é", "Ω b", "zz"]
    passage = "in the middle of nowhere, a long way from home; the end"
    rows = [(None, "en"), ("", None), (" \t ", "de"), (",;.", "en"), ("la la " * 3000, "fr"),
            ("one\x0btwo\x0cthree\rfour", "en")]
    for _ in range(n):
        words = [rng.choice(vocabulary) + rng.choice(["", "", "", ",", ".\n", "  ", "\t"])
                 for _ in range(rng.randint(0, 60))]
        text = " ".join(words) + (" " + passage if rng.random() < 0.5 else "")
        rows.append((text, rng.choice(["en", "en", "de", None, "und"])))
    return rows + rows[-20:]


@pytest.mark.parametrize("keep", [5, 2000])
def test_collocations_like_counting_everything(spark, keep):
    rows = _texts(keep)
    docs = spark.createDataFrame([(*r, 1) for r in rows], "text string, lang string, phrase int").repartition(4)
    got = [tuple(r) for r in collocations.mine(docs, least=8, keep=keep).collect()]
    assert sorted(got) == _plain_collocations(rows, 8, keep)


@pytest.mark.parametrize("trigger", [1, 2, 1 << 40])
def test_dictionary_counts_each_occurrence_once(spark, trigger):
    rows = _texts(9, 40)
    docs = spark.createDataFrame(rows, "text string, lang string")
    got = {(r.lang, r.phrase): r.f for r in collocations.phrase_counts(docs, least=2, trigger=trigger).collect()}
    counts, n = _plain_phrases(rows, 2)
    expected = {(lang, " ".join(g)): c for lang, f in counts.items() for g, c in f.items()}
    assert got == expected | {(lang, None): c for lang, c in n.items() if c}


def test_chunks_of_equal_passages_are_equal(spark):
    rng = random.Random(5)
    passage = " ".join(f"w{rng.randint(0, 500)}" for _ in range(2000))
    docs = spark.createDataFrame([(f"start{i} {passage} end{i}", "en") for i in range(20)],
                                 "text string, lang string")
    chunks = collocations.parse(docs).collect()
    # only chunks that reach into a text's own first or last word are its own; three windows do
    assert sum(r.freq == 20 for r in chunks) > 50 and sum(r.freq == 1 for r in chunks) <= 20 * 8


def test_collocations_of_nothing(spark):
    docs = spark.createDataFrame([], "text string, lang string")
    assert collocations.mine(docs).collect() == []
