"""Substring, SimHash and embedding dedup against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tidemark.llm import queries, simhash, substring_dedup
from tidemark.llm.embedding_dedup import near_duplicates
from tidemark.llm.graph import components, star_edges
from tidemark.operators import keyfilter

SF = "/root/testdata/sf0.01"


def some_docs(seed=1, n=60):
    """Texts that share passages, at random places; copies; odd ones."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeñé") for _ in range(rng.randint(1, 4)))
    passages = [[word() for _ in range(rng.randint(15, 45))] for _ in range(5)]
    out = []
    for i in range(n):
        w = [word() for _ in range(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 3)):
            p, at = rng.choice(passages), rng.randint(0, len(w))
            w[at:at] = p[rng.randint(0, 3):]
        out.append((i, rng.choice([" ", "\n", "\t \x0b"]).join(w)))
    out += [(n, out[3][1]), (n + 1, out[3][1]), (n + 2, ""), (n + 3, None), (n + 4, " \n\t"),
            (n + 5, "x " * 200), (n + 6, "y" * 5000 + " z" * 30), (n + 7, "A" * 100_000)]
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_substring_dedup_is_brute_force(spark, seed):
    rows = some_docs(seed)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = {r.row.doc_id: (r.n_words, r.n_removed, r.row.text or "")
           for r in substring_dedup.remove_repeats(docs).collect()}
    assert got == brute.substring_dedup(rows)


def test_substring_dedup_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = brute.substring_dedup([(r.doc_id, r.text) for r in docs.collect()])
    import hashlib
    want = {i: (n, g, hashlib.sha256(t.encode()).hexdigest()) for i, (n, g, t) in want.items()}
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256)
           for r in queries.op1_substring_dedup(spark, SF).collect()}
    assert got == want


def test_substring_dedup_other_window_and_columns(spark):
    text = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(1, text, 5, "a", [1]), (2, text, 6, None, None), (2, None, 7, "b", [2]),
                                  (None, text, 8, "c", [])],
                                 "doc_id int, text string, _chunk int, n_words string, row array<int>")
    out = substring_dedup.remove_repeats(docs, window=4)
    assert out.schema["row"].dataType.fieldNames() == docs.columns
    got = sorted((r.row._chunk, r.n_removed, r.row.text, r.row.row, [tuple(s) for s in r.removed])
                 for r in out.collect())
    assert got == [(5, 0, text, [1], []), (6, 30, "", None, [(0, 30)]), (7, 0, None, [2], []),
                   (8, 30, "", [], [(0, 30)])]


def test_substring_dedup_chunks_follow_the_bytes(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "CHUNK_BYTES", 2000)
    rows = some_docs(4)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = substring_dedup.remove_repeats(docs)
    assert {r.row.doc_id: (r.n_words, r.n_removed, r.row.text or "")
            for r in out.collect()} == brute.substring_dedup(rows)
    with pytest.raises(TypeError):
        substring_dedup.remove_repeats(docs.withColumn("doc_id", F.col("doc_id").cast("string")))


def test_windows_are_compared_by_all_bits():
    h, check = np.array([5, 5, 7, 9], np.uint64), np.array([1, 2, 3, 4], np.uint64)
    pairs = np.array([5, 5, 7, 8], np.uint64), np.array([2, 3, 4, 4], np.uint64)
    assert substring_dedup._among(h, check, pairs).tolist() == [False, True, False, False]
    none = np.zeros(0, np.uint64)
    assert not substring_dedup._among(h, check, (none, none)).any()


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string, source string")
    assert substring_dedup.remove_repeats(docs).count() == 0
    assert simhash.simhash_groups(docs).count() == 0
    assert simhash.keep_one(docs).count() == 0
    vectors = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert near_duplicates(vectors).count() == 0


def test_simhash_is_brute_force(spark):
    rng = random.Random(5)
    base = [" ".join(rng.choice("the of and a to in is on by it".split()) + rng.choice("xyz")
                     for _ in range(rng.randint(20, 60))) for _ in range(25)]
    rows = []
    for i, t in enumerate(base * 4):
        w = t.split()
        for _ in range(i // 25):
            w[rng.randrange(len(w))] = rng.choice(["Changed", "WORD", "ñ"])
        rows.append((i, "  ".join(w).upper() if i % 7 == 0 else "\n".join(w)))
    rows += [(200, None), (201, ""), (202, "one"), (203, "One two"), (204, "q " * 3000), (205, rows[0][1])]
    got = {r.row.doc_id: (r.fp % 2**64, r.component) for r in simhash.simhash_groups(
        spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    fps = [brute.simhash(t) for _, t in rows]
    root = brute.groups(len(rows), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 3)
    assert got == {r[0]: (fps[i], rows[root[i]][0]) for i, r in enumerate(rows)}


@pytest.mark.parametrize("distance", [1, 2, 3, 5])
def test_pigeonring_loses_no_pair(spark, distance):
    rng = np.random.default_rng(distance)
    seeds = rng.integers(0, 2**63, 30, dtype=np.uint64)
    fps = set(seeds.tolist())
    for s in seeds.tolist():
        for _ in range(6):
            for b in rng.choice(64, rng.integers(1, distance + 2), replace=False).tolist():
                s ^= 1 << b
            fps.add(s)
    fps = sorted(fps)
    signed = [f - 2**64 if f >= 2**63 else f for f in fps]
    edges = components(simhash.link_fingerprints(
        spark.createDataFrame([(f,) for f in signed], "fp bigint"), distance))
    got = {r.node: r.root for r in edges.collect()}
    root = brute.groups(len(fps), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= distance)
    same = {}
    for i, f in enumerate(signed):
        same.setdefault(root[i], []).append(f)
    for members in same.values():
        assert {got.get(f, f) for f in members} == {min(members)}


def test_hot_chain_keys_are_split(spark, monkeypatch):
    monkeypatch.setattr(simhash, "HOT", 8)
    monkeypatch.setattr(simhash, "BLOCK", 16)
    fps = spark.range(0, 300).select(F.col("id").alias("fp"))      # all within a few bits
    sizes = simhash.dealt_keys(fps, 3).groupBy("key", "cell").agg(
        F.count_if("probe").alias("probes"), F.count_if(~F.col("probe")).alias("rows"))
    most = sizes.agg(F.max("probes"), F.max("rows"), F.max("cell")).first()
    assert most[0] <= 2.5 * 16 and most[1] <= 2.5 * 8 and most[2] > 5
    got = components(simhash.link_fingerprints(fps, 3)).agg(
        F.countDistinct("root"), F.count("*"), F.min("root")).first()
    assert tuple(got) == (1, 300, 0)


@pytest.mark.parametrize("bits", [26, 3])          # 3: the bit set is full, all rows meet the survivors
def test_keep_one_leaves_one_of_each_group(spark, monkeypatch, bits):
    monkeypatch.setattr(keyfilter, "BITS", bits)
    a, b = "alpha beta gamma delta epsilon " * 9, "one two three four five six " * 9
    rows = [(3, a, "x"), (1, a, "y"), (1, a, "z"), (7, b, None), (None, b, "n"), (9, None, "e"), (8, "", "f")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, fp string")
    got = sorted((r.doc_id, r.text) for r in simhash.keep_one(docs).collect())
    assert got == [(1, a), (7, b), (8, "")]
    nameless = spark.createDataFrame([(None, a), (None, a), (None, b)], "doc_id bigint, text string")
    assert sorted(r.text for r in simhash.keep_one(nameless).collect()) == [a, b]


def test_components_of_paths_and_hubs(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(200, 260)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {i: 100 for i in range(100, 161)} | {5: 5} | {i: 5 for i in range(200, 260)}
    u, v = star_edges(np.array([9, 4, 2]), np.array([4, 2, 8]))
    assert dict(zip(u.tolist(), v.tolist())) == {4: 2, 8: 2, 9: 2}


def test_embedding_dedup_is_brute_force(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(40, 8))
    rows = [(int(i), (base[i % 40] + rng.normal(size=8) * 0.2).tolist()) for i in range(160)]
    rows += [(160, rows[0][1]), (161, rows[0][1]), (162, None), (163, [0.0] * 8), (164, [float("nan")] * 8),
             (165, [None, 1.0]), (166, [float("inf"), 1.0]), (167, [1.0, 2.0]), (168, [2.0, 4.0]), (169, []),
             (170, [1e-30] * 8), (171, [1e300] * 8)]
    want = brute.cosine_links([(i, v if i != 171 else [1.0] * 8) for i, v in rows])
    docs = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = {r.id: (r.n_links, r.component) for r in near_duplicates(docs).collect()}
    assert got == want
    assert all(r.kept == (r.id == r.component) for r in near_duplicates(docs).collect())


def test_embedding_dedup_over_strips(spark, monkeypatch):
    from tidemark.llm import embedding_dedup
    monkeypatch.setattr(embedding_dedup, "STRIP", 30)
    monkeypatch.setattr(embedding_dedup, "TILE", 7)
    rng = np.random.default_rng(4)
    base = rng.normal(size=(20, 6))
    rows = [(int(i), (base[i % 20] + rng.normal(size=6) * 0.15).tolist()) for i in range(140)]
    docs = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = {r.id: (r.n_links, r.component) for r in near_duplicates(docs).collect()}
    assert got == brute.cosine_links(rows)


def test_strips_far_apart_are_not_paired():
    from tidemark.llm import embedding_dedup as e
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(64, 32))
    x = e.unit(np.repeat(centres, 100, axis=0) + rng.normal(size=(6400, 32)) * 0.05)
    _, axes = np.linalg.eigh(x.T @ x)
    r = x @ axes[:, ::-1]
    lead, tail = r[:, :e.LEAD], np.sqrt((r[:, e.LEAD:] ** 2).sum(1))
    axis, cut = e.planes(lead[rng.permutation(len(lead))[:64 * e.SAMPLED]], 64)
    at = e.strip_of(lead, axis, cut)
    own = [at == s for s in range(64)]
    meet = e.may_link(np.array([lead[o].min(0) for o in own]), np.array([lead[o].max(0) for o in own]),
                      np.array([tail[o].max() for o in own]), 0.9)
    assert np.triu(meet).sum() < 0.1 * 64 * 65 / 2
    i, j = np.nonzero(x @ x.T >= 0.9)                        # and no link is lost
    assert meet[at[i], at[j]].all()


def test_strips_of_equal_coordinates_are_dealt_by_hash(spark, monkeypatch):
    from tidemark.llm import embedding_dedup as e
    monkeypatch.setattr(e, "STRIP", 10)
    rng = np.random.default_rng(9)
    rows = [(i, [1.0, 0.0, 1e-9 * i]) for i in range(60)]    # all but one point: no plane parts them
    rows += [(100 + i, rng.normal(size=3).tolist()) for i in range(60)]
    docs = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = {r.id: (r.n_links, r.component) for r in near_duplicates(docs).collect()}
    assert got == brute.cosine_links(rows)


def test_embedding_query_whole_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet")
            .orderBy("vec_id").collect()]
    got = {r.vec_id: (r.n_links, r.component_id)
           for r in queries.op2_embedding_near_dedup(spark, SF).collect()}
    assert got == brute.cosine_links(rows)
