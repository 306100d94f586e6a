"""Classifiers, mixing, chat, BPE, licenses and nearest neighbours."""

import difflib
import hashlib
import os
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
from scripts.oracle_check import TABLES, digest
from tests.llm import brute
from tidemark.llm import ann, bpe, chat, licences, mixing, quality, queries, toxicity

SF = "/root/testdata/sf0.01"
BPE = public_tokenizers.path("byte_bpe_50k.json")


def auc(score, truth):
    score, truth = np.asarray(score), np.asarray(truth)
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    p = truth.sum()
    return (rank[truth == 1].sum() - p * (p + 1) / 2) / (p * (len(truth) - p))


# classifiers

def test_toxicity_learns_from_positives_and_unlabelled_texts(spark):
    rng = random.Random(1)
    plain = [f"w{i}" for i in range(200)]
    rows, labels = [], []
    for i in range(1500):
        w = [rng.choice(plain) for _ in range(rng.randint(5, 60))]
        toxic = rng.random() < 0.2
        for _ in range(rng.randint(2, 6) if toxic else 0):
            w[rng.randrange(len(w))] = rng.choice(["Nasty", "vilest!", "ugh,ly"])
        rows.append((i, " ".join(w)))
        if rng.random() < 0.5:
            labels.append((i, int(toxic)))
        rows[-1] += (int(toxic),)
    rows += [(5000, None, 0), (5001, "", 0), (None, "w1 nasty", 0), (5002, "w2 " * 20000, 0)]
    labels += [(None, 1), (5000, None), (3, 0), (3, 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    learn = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) != 0
    model = toxicity.fit(docs.drop("toxic"), spark.createDataFrame(labels, "doc_id bigint, toxic int"), learn)
    got = docs.withColumn("score", toxicity.score(model, docs)).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert auc([r.score for r in held], [r.toxic for r in held]) > 0.95
    wrong = sum((r.score >= 0.5) != r.toxic for r in held)
    assert wrong <= 0.05 * len(held)


def test_toxicity_without_examples(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id bigint, text string")
    for labels in ([], [(1, 0)]):
        model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"), F.lit(True))
        assert [r[0] < 0.5 for r in docs.select(toxicity.score(model, docs)).collect()] == [True, True]
    empty = spark.createDataFrame([], docs.schema)
    model = toxicity.fit(empty, spark.createDataFrame([], "doc_id bigint, toxic int"), F.lit(True))
    assert empty.select(toxicity.score(model, empty)).count() == 0


def test_toxicity_bounds_and_prior_are_arguments(spark):
    texts = [("w%d w%d " % (i % 7, i % 5)) * 3 + ("vilest" if i % 4 == 0 else "") for i in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    only = spark.createDataFrame([(i, 1) for i in range(0, 200, 8)], "doc_id bigint, toxic int")
    model = toxicity.fit(docs, only, F.lit(True), prior=0.25, positives=20, unlabelled=100, features=3)
    assert 1 <= len(model.kept) <= 3
    got = docs.withColumn("score", toxicity.score(model, docs)).collect()
    assert all((r.score >= 0.5) == (r.doc_id % 4 == 0) for r in got)     # half of them never confirmed
    with pytest.raises(ValueError):
        toxicity.fit(docs, only, F.lit(True), prior=1.5)


def test_nnpu_corrects_for_the_positives_among_the_unlabelled():
    rng = np.random.default_rng(2)
    toxic = np.zeros((400, 4), np.float32)
    toxic[:, 0] = 1
    free = np.zeros((2000, 4), np.float32)
    free[:800, 0] = 1                     # two fifths of the unlabelled are positive
    free[:, 1] = rng.random(2000)
    w, b = toxicity.train_nnpu(toxic, free, prior=0.4)
    assert w[0] + b > 0 > b + w[1]        # plain learning against all unlabelled gives w[0] + b < 0


@pytest.mark.parametrize("name,table,column,mod,least", [
    ("op3_toxicity", toxicity, "toxic", (5, 0), 0.7), ("op6_quality_classifier", quality, "quality", (4, 2), 0.9)])
def test_classifiers_on_the_held_out_fold(spark, name, table, column, mod, least):
    got = {r.doc_id: r for r in queries.QUERIES[name](spark, SF).collect()}
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % mod[0] == mod[1])
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= {"toxic": 0.5, "quality": 0.7}[column])
    labels = [(got[r.doc_id], r[column]) for r in spark.read.parquet(f"{SF}/labels.parquet").collect()]
    held = [(r.score, y) for r, y in labels if r.held_out]
    assert auc(*zip(*held)) > least


def test_machine_scores_as_the_pairwise_sum():
    rng = np.random.default_rng(5)
    x, v = rng.normal(size=6), rng.normal(size=(6, 3))
    s = x @ v
    fast = 0.5 * ((s * s).sum() - ((x[:, None] * v) ** 2).sum())
    slow = sum(v[i] @ v[j] * x[i] * x[j] for i in range(6) for j in range(i))
    assert abs(fast - slow) < 1e-9


def test_quality_odd_rows_and_no_labels(spark):
    rows = [(1, None, None), (2, "", 0), (3, "x", 1), (None, "y z", 3), (5, "w " * 50000, 100000), (5, "w", -1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_chars bigint")
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (3, None), (None, 0), (5, 1)],
                                   "doc_id bigint, quality int")
    for known in (labels, labels.limit(0)):
        fm = quality.fit(docs, known, F.lit(True))
        scores = [r[0] for r in docs.select(quality.score(fm, docs)).collect()]
        assert len(scores) == 6 and all(0 <= s <= 1 for s in scores)
    assert all(s > 0.7 for s in scores)          # without labels nothing is rejected
    other = docs.drop("n_chars").withColumnRenamed("text", "at")
    assert other.select(quality.score(fm, other, "at")).count() == 6


def test_quality_sample_is_an_argument(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "w " * i) for i in range(50)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)], "doc_id bigint, quality int")
    seen = []
    plain = quality.train
    monkeypatch.setattr(quality, "train", lambda *a: seen.append(len(a[3])) or plain(*a))
    for n in (7, 60):
        quality.fit(docs, labels, F.lit(True), sample_rows=n)
    assert seen == [7, 50]


# mixing

def targets(sizes):
    """Weights 1, 2, 3 in turn, excess reshared by weight until none is above three times."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in full)
        free = sum(weight[s] for s in names if s not in full)
        over = {s for s in names if s not in full and left * weight[s] / free > 3 * sizes[s]}
        if not over:
            return {s: 3 * sizes[s] if s in full else left * weight[s] / free for s in names}
        full |= over


@pytest.mark.parametrize("seed", [1, 2])
def test_mixing(spark, seed):
    rng = random.Random(seed)
    rows = [(i, "w " * rng.randint(0, 12), rng.choice(["é", "a", "Z", None, "big", "big", "big", "ab"]))
            for i in range(1500)]
    rows += [(9000, None, "empty"), (9001, "", "empty"), (None, "w w", "a"), (None, "w w", "a"), (9002, "w " * 9, "tiny")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(4)
    sized = mixing.sizes(docs).checkpoint()
    out = mixing.copies(sized, mixing.cuts(sized), F.col("source"), F.col("key")).collect()
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(brute.words(t))
    want, taken = targets(sizes), {}
    assert len(out) == len(rows)
    for r in out:
        assert r.mix.source_size == sizes[r.source] and abs(r.mix.target - want[r.source]) < 1e-6
        assert 0 <= r.mix.copies <= 3
        taken[r.source] = taken.get(r.source, 0) + r.size * r.mix.copies
    for s, n in taken.items():
        assert abs(n - want[s]) <= 12              # a document's size at most
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r.mix.copies for r in out)
    assert sorted(map(str, mixed.collect())) == sorted(map(str, mixing.mix(docs).collect()))


def test_mixing_empty_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b", "s", 7, "k")],
                                 "doc_id int, text string, source string, target int, key string")
    assert [tuple(r) for r in mixing.mix(docs).collect()] == [(1, "a b", "s", 7, "k")]
    assert mixing.mix(docs.limit(0)).count() == 0
    nothing = spark.createDataFrame([(1, None, None)], "doc_id int, text string, source string")
    assert mixing.mix(nothing).count() == 0         # a source without words has no target


def test_mix_plan_beside_columns_of_its_own_names(spark):
    rows = [(i, "a b c" if i % 3 else None, "xyz"[i % 3], 1.5, i, 2, 3, "m") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, source string, target double, "
                                       "source_size int, base int, cut int, mix string")
    plan = mixing.cuts(mixing.sizes(docs))
    got = mixing.copies(docs, plan, F.col("source"), mixing._key("doc_id"))
    assert got.columns == docs.columns
    assert sorted((r.doc_id, r.target, r.source_size, r.base, r.cut) for r in got.collect()) == [
        (i, 1.5, i, 2, 3) for i in range(30)]
    sizes = {r.source: r.mix.source_size for r in got.collect()}
    assert sizes == {"x": 0, "y": 30, "z": 30}


def test_bpe_replaces_a_column_of_its_name(spark):
    docs = spark.createDataFrame([(1, "one two", "old"), (2, None, None)], "doc_id int, text string, bpe string")
    out = bpe.tokenized(docs, BPE)
    assert out.columns == docs.columns
    assert [r.bpe.n_tokens for r in out.orderBy("doc_id").collect()] == [2, 0]


def test_neighbours_of_repeated_ids(spark):
    rows = [(1, [1.0, 0.0]), (3, [1.0, 0.1]), (3, [1.0, 0.2]), (4, [0.0, 1.0])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    one = ann.nearest(table, table.where("vec_id = 1"), k=3)
    assert [(r["rank"], r.vec_id) for r in one.orderBy("rank").collect()] == [(1, 3), (2, 3), (3, 4)]
    two = ann.nearest(table, table.where("vec_id = 3"), k=2).orderBy("rank").collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in two] == [(3, 1, 1), (3, 2, 1)]


def test_mixing_oracle(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = entry.queries()["op4_mixing"](spark, SF)
    cur = con.execute(entry.oracle_sql()["op4_mixing"])
    names = [c[0] for c in cur.description]
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(names, cur.fetchall())[0]


# chat

def test_chat_query_reads_back(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, i, r, "</s>[INST] ok [/INST]") for i, r in enumerate(("user", "assistant"))]
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256)
           for r in queries.op5_chat_formatting(spark, SF).collect()}
    assert got == brute.turns(rows)


def test_template_is_reversible():
    rng = random.Random(6)
    parts = [*chat.CONTROLS, "\\", "\\\\", "<", "|", "[", "\n", "é", "\U0001F600", "", "text", "<\\|"]
    for _ in range(500):
        turns = [{"role": rng.choice(["user", "assistant", None, "".join(rng.choices(parts, k=2))]),
                  "text": rng.choice([None, "".join(rng.choices(parts, k=rng.randint(0, 6)))])}
                 for _ in range(rng.randint(0, 5))]
        made = chat.format_turns(turns)
        assert chat.read_turns(made["text"]) == [(t["role"] or "", t["text"] or "") for t in turns]
        assert chat.read_loss(made["text"], made["loss"]) == [
            t["text"] or "" for t in turns if t["role"] == "assistant"]


def test_reply_trees(spark):
    rng = random.Random(8)
    rows, parent = [], {}
    for tree in (1, 2, None):
        for node in range(40):
            parent[tree, node] = rng.randrange(node) if node else None
            rows.append((tree, node, parent[tree, node], "user" if node % 2 else "assistant",
                         f"t{node}", rng.choice([None, 0.5, 1.0])))
    rows += [(3, 0, 77, "user", "orphan", 1.0), (3, 0, 77, "user", "orphan", 1.0), (3, None, 0, "user", "lost", 1.0),
             (4, 1, 2, "a", "cycle", 1.0), (4, 2, 1, "a", "cycle", 1.0), (4, 3, 2, "a", "below", 9.0)]
    rows += [(5, i, i - 1 if i else None, "user", str(i), None) for i in range(100)]
    messages = spark.createDataFrame(
        rows, "tree bigint, node bigint, parent bigint, role string, text string, score double")
    got = {(r.tree, r.leaf): r for r in chat.format_trees(messages).collect()}
    inner = {(t, p) for (t, _), p in parent.items()}
    want = {}
    for (tree, node) in parent:
        if (tree, node) not in inner:
            path, at = [], node
            while at is not None:
                path.append(at)
                at = parent[tree, at]
            want[tree, node] = path[::-1]
    want[3, 0], want[5, 99] = [0], list(range(100))
    assert set(got) == set(want)
    score = {(r[0], r[1]): r[5] or 0.0 for r in rows}
    for (tree, leaf), path in want.items():
        r = got[tree, leaf]
        said = [t for _, t in chat.read_turns(r.conversation.text)]
        assert said == (["orphan"] if tree == 3 else [f"t{n}" if tree != 5 else str(n) for n in path])
        assert abs(r.score - sum(score[tree, n] for n in path)) < 1e-9
    for tree in (1, 2, None):
        ranked = sorted((-r.score, leaf, r.branch) for (t, leaf), r in got.items() if t == tree)
        assert [b for _, _, b in ranked] == list(range(1, len(ranked) + 1))
    best = {(r.tree, r.leaf) for r in chat.format_trees(messages, keep=1).collect()}
    assert best == {k for k, r in got.items() if r.branch == 1}
    assert chat.format_trees(messages.limit(0)).count() == 0


# BPE

@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(BPE)
    t.no_truncation()
    t.no_padding()
    return t


def odd_texts():
    rng = random.Random(3)
    texts = ["", " ", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "  x\n\n\ty  ", "x" * 3000, "ab" * 2000,
             "　\x85\x1c\x1d é", "日本語テキスト" * 50, "I'll we've 12³Ⅷ", "\U0001F600‍\U0001F468", "a\x00b\x00",
             "՘࢏ \U000323b0\U000323b1x", " don't  'S 's", "the the the"]
    for _ in range(300):
        texts.append("".join(chr(rng.choice(
            [rng.randrange(32, 127), rng.randrange(0, 0x250), rng.randrange(0x2000, 0x3100), 9, 10, 32, 32,
             0x4e00 + rng.randrange(500)])) for _ in range(rng.randrange(80))))
    return texts


@pytest.mark.parametrize("size", [0, 3, 1 << 17])
def test_bpe_equals_the_library(spark, tokenizer, size):
    texts = odd_texts()
    docs = spark.createDataFrame([*enumerate(texts * (4 if size else 1)), (-1, None)], "doc_id bigint, text string")
    name = bpe.build_encoder(docs, BPE, size=size)
    both = docs.select("text", bpe.encode(name, F.col("text")).alias("ids"),
                       bpe.round_trip(name, F.col("text")).alias("both"))
    for r in both.select("*", bpe.decode(name, F.col("ids")).alias("back")).collect():
        want = tokenizer.encode(r.text or "", add_special_tokens=False).ids
        assert r.ids == want and np.frombuffer(r.both.ids, "<u4").tolist() == want
        assert r.back == r.both.text == tokenizer.decode(want, skip_special_tokens=False)


def test_bpe_query_equals_the_library(spark, tokenizer):
    got = {r.doc_id: tuple(r)[1:] for r in queries.op7_bpe(spark, SF).collect()}
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for i, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        back = tokenizer.decode(ids, skip_special_tokens=False)
        assert got[i] == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                          hashlib.sha256(back.encode()).hexdigest())


def test_lexicon_is_a_shared_suffix_automaton():
    words = [w.encode() for w in ("tap taps top tops stop stops é és a".split())]
    lex = bpe.compile_lexicon(words, [[i, i + 1] for i in range(len(words))])
    assert len(lex["final"]) < sum(map(len, words))     # suffixes share states
    path = "/tmp/lexicon-test.bin"
    bpe.write_arrays(path, bpe.read_tokenizer(BPE) | lex)
    e = bpe.Encoder(path)
    os.unlink(path)
    order = sorted(words)
    assert e.lookup(words).tolist() == [order.index(w) for w in words]
    assert e.lookup([b"ta", b"tapss", b"", b"x", b"\xc3"]).tolist() == [-1] * 5
    flat, lens = e.word_ids([w.decode() for w in words])
    assert flat.reshape(-1, 2).tolist() == [[i, i + 1] for i in range(len(words))] and set(lens) == {2}


def test_bpe_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert bpe.tokenized(empty, BPE).count() == 0


# licenses

def test_license_scan(spark):
    mit, gpl = licences.TEMPLATES["MIT"], licences.TEMPLATES["GPL-3.0"]
    fill = " ".join(f"prose{i}" for i in range(300))
    rows = [(1, f"{fill} {mit} {fill}"), (2, f"{fill}\n{licences.TEMPLATES['CC-BY-NC-4.0 notice']}\n{fill}"),
            (3, mit.replace("free of charge", "gratis").replace("merge, ", "")), (4, f"{gpl} {mit}"),
            (5, "you need a license to drive, and a permission slip"), (6, None), (7, ""), (8, fill),
            (9, "All rights reserved. Released under the MIT License."), (10, "LICENSED UNDER CC BY 4.0"),
            (11, ("word " * 5000) + "Licensed under the Apache License, Version 2.0. " + "word " * 5000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("start", F.lit("clash"))
    got = {}
    for r in licences.scan(docs).collect():
        got.setdefault(r.row.doc_id, []).append((r.license, r.start, r.end, r.differences))
    names = {i: sorted(x[0] for x in v) for i, v in got.items()}
    assert names == {1: ["MIT"], 2: ["CC-BY-NC-4.0 notice"], 3: ["MIT"], 4: ["GPL-3.0", "MIT"],
                     9: ["All rights reserved", "MIT notice"], 10: ["CC-BY-4.0 notice"], 11: ["Apache-2.0 notice"]}
    assert got[1][0][1:] == (300, 300 + len(mit.split()), [])
    assert got[3][0][3] == ["replace: free of charge -> gratis", "delete: merge -> "]
    assert got[11][0][1:3] == (5000, 5007)
    assert licences.scan(docs.limit(0)).count() == 0


def test_license_query_finds_every_planted_notice(spark):
    got = {(r.doc_id, r.license) for r in queries.op9_license_scan(spark, SF).collect()}
    short = {n: t for n, t in licences.TEMPLATES.items() if len(t) < 80}
    want = {(r.doc_id, n) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()
            for n, t in short.items() if t in (r.text or "")}
    assert got == want and want


def test_licenses_that_are_alike_are_told_apart(spark):
    fill = " ".join(f"prose{i}" for i in range(60))
    rows = [(n, f"{fill} {t} {fill}") for n, t in licences.TEMPLATES.items()]
    bullets = licences.TEMPLATES["BSD-2-Clause"].replace("1. ", "* ").replace("2. ", "* ")
    gpl = licences.TEMPLATES["GPL-3.0"]
    unknown = {"x1": gpl.replace("version 3", "version 4"), "x2": "Licensed under CC BY-ND 4.0.",
               "x3": gpl.replace("General Public", "Free Documentation"),
               "x4": "This work is licensed under the GNU General Public License, version 5."}
    rows += [("BSD-2-Clause", bullets), ("LGPL-2.1", licences.TEMPLATES["LGPL-2.1"].upper())]
    docs = spark.createDataFrame(rows + list(unknown.items()), "name string, text string")
    got = [(r.row.name, r.license) for r in licences.scan(docs).collect()]
    assert sorted(got) == sorted((n, n) for n, _ in rows)


def test_custom_templates_are_found_in_their_own_text(spark):
    own = {"no vocabulary": "Do what you like with these files and tell nobody about it at all.",
           "only at its start": "Copyright holders agree: " + " ".join(f"clause{i}" for i in range(150)),
           "only at its end": " ".join(f"term{i}" for i in range(90)) + " is a warranty"}
    fill = " ".join(f"prose{i}" for i in range(700))
    docs = spark.createDataFrame([(n, f"{fill} {t} {fill}") for n, t in own.items()], "name string, text string")
    for some in (own, {n: t for n, t in own.items() if n != "no vocabulary"}):
        got = {(r.row.name, r.license, r.start, r.similarity) for r in licences.scan(docs, templates=some).collect()}
        assert got == {(n, n, 700, 1.0) for n in some}


def _brute_notice(words, template):
    """Best similarity of the template with any part of the text, at every start and length."""
    best = 0.0
    for lo in range(len(words)):
        for hi in range(lo + 1, min(len(words), lo + 2 * len(template)) + 1):
            common = sum(m.size for m in difflib.SequenceMatcher(
                None, words[lo:hi], template, autojunk=False).get_matching_blocks())
            best = max(best, 2 * common / (len(template) + hi - lo))
    return best


def test_notices_like_aligning_every_template_everywhere(spark):
    rng = random.Random(4)
    short = {n: t for n, t in licences.TEMPLATES.items() if len(t.split()) < 22}
    rows = []
    for i in range(60):
        words = rng.choice(list(short.values())).split()
        for _ in range(rng.randint(0, 4)):
            at = rng.randrange(len(words))
            words[at:at + 1] = rng.choice([[], ["other"], [words[at], "more"]])
        rows.append((i, " ".join(["some", "prose"] * 3 + words + ["and", "so"] * 3)))
    known = licences.load_templates(short)
    got = {r.row.i: r.similarity for r in licences.scan(spark.createDataFrame(rows, "i int, text string"),
                                                       templates=short).collect()}
    for i, text in rows:
        words = licences.plain(text.split())
        best = max(_brute_notice(words, t.words) for t in known.templates if t.may_be_in(Counter(words))) \
            if any(t.may_be_in(Counter(words)) for t in known.templates) else 0.0
        if best < licences.SIMILARITY:
            assert i not in got
        elif i in got:             # a telling word may rule out the most similar one, never add one
            assert licences.SIMILARITY <= got[i] <= best + 1e-9
    assert len(got) > 20


# nearest neighbours

def brute_nearest(rows, queries_, k=10):
    ok = [(i, np.array(v, float)) for i, v in rows
          if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, v in ok:
        if queries_(q):
            near = sorted((float(np.sqrt(((v - w) ** 2).sum())), i) for i, w in ok if i != q and len(w) == len(v))
            out[q] = near[:k]
    return out


def test_neighbours_exact_when_all_parts_are_asked(spark):
    rng = np.random.default_rng(1)
    rows = [(int(i), rng.integers(-2, 3, 5).astype(float).tolist()) for i in range(400)]
    rows += [(1000 + i, [1.0, 1.0, 1.0, 1.0, 1.0]) for i in range(60)]        # one common vector
    rows += [(2000, None), (2010, [0.0] * 5), (2020, [float("nan")] * 5), (2030, [None, 1.0]), (None, [1.0] * 5),
             (3000, [1.0, 2.0]), (3001, [1.0, 2.5])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("rank", F.lit("x"))
    got = {}
    for r in ann.nearest(df, df.where("vec_id % 10 = 0"), target=2.0).orderBy("rank").collect():
        got.setdefault(r.query_id, []).append((r.score, r.vec_id))
    want = brute_nearest(rows, lambda i: i % 10 == 0)
    assert set(got) == set(want)
    for q, near in want.items():
        assert [i for _, i in got[q]] == [i for _, i in near]
        assert np.allclose([s for s, _ in got[q]], [s for s, _ in near], atol=1e-12)
    assert ann.nearest(df.limit(0), df.limit(0)).count() == 0


def test_neighbours_recall_and_scores(spark, monkeypatch):
    rng = np.random.default_rng(2)
    centre = rng.normal(size=(30, 16))
    x = np.array([centre[i % 30] + rng.normal(size=16) * 0.4 for i in range(3000)])
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    monkeypatch.setattr(ann, "CELL", 100)
    monkeypatch.setattr(ann, "QUERIES", 10)
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = {}
    for r in ann.nearest(df, df.where("vec_id % 50 = 0")).collect():
        got.setdefault(r.query_id, {})[r.vec_id] = r.score
    want = brute_nearest(rows, lambda i: i % 50 == 0)
    hits = sum(i in got[q] for q, near in want.items() for _, i in near)
    assert hits >= 0.9 * 10 * len(want)
    for q, found in got.items():
        assert len(found) == 10
        for i, s in found.items():
            assert abs(s - np.sqrt(((x[q] - x[i]) ** 2).sum())) < 1e-12


@pytest.mark.parametrize("target", [0.95, 2.0])
def test_neighbours_of_parts_that_are_cut_again(spark, monkeypatch, target):
    rng = np.random.default_rng(4)
    centre = rng.normal(size=(60, 16))
    x = np.array([centre[i % 60] + rng.normal(size=16) * 0.3 for i in range(4000)])
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    monkeypatch.setattr(ann, "PARTS", 4)
    monkeypatch.setattr(ann, "LEAF", 100)
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    own = df.select(F.col("embedding").alias("vector"), F.array("vec_id").alias("ids"))
    index, placed = ann.fit_index(own, 16, 10, target)
    sizes = dict(placed.groupBy("leaf").count().collect())
    leaves = int(index.first[-1])
    assert len(index.below) == 4 and leaves >= 16            # both levels are in use
    assert sum(sizes.values()) == 4000 and set(sizes) <= set(range(leaves))
    order = index.order(x)
    assert np.array_equal(np.sort(order, axis=1), np.tile(np.arange(leaves), (4000, 1)))
    got = {}
    for r in ann.nearest(df, df.where("vec_id % 40 = 0"), target=target).collect():
        got.setdefault(r.query_id, {})[r.rank] = r.vec_id
    want = brute_nearest(rows, lambda i: i % 40 == 0)
    if target > 1:
        assert index.probes == leaves
        assert got == {q: {n + 1: i for n, (_, i) in enumerate(near)} for q, near in want.items()}
    else:
        read = np.mean([sum(sizes.get(int(a), 0) for a in o[:index.probes]) for o in order[::40]])
        assert read < 0.5 * len(x)
        hits = sum(i in got[q].values() for q, near in want.items() for _, i in near)
        assert hits >= 0.9 * 10 * len(want)


def test_parts_are_balanced():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(512, 8))
    label = ann.balanced_parts(ann.neighbour_graph(x, 10), 8, rng)
    assert np.bincount(label).tolist() == [64] * 8


def test_neighbour_query_recall(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    want = brute_nearest(rows, lambda i: i % 100 == 0)
    got = {}
    for r in queries.op10_nearest_neighbours(spark, SF).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert set(got) == set(want)
    assert sum(i in got[q] for q, near in want.items() for _, i in near) >= 0.9 * 10 * len(want)
