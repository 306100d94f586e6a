"""Each stage of the pipeline against plain versions on its own input."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm import brute
from tests.llm.test_text_operators import targets
from tidemark.llm import queries
from tidemark.session import fresh_dir

SF = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def outputs(spark):
    """Rows before the first and after every stage, written and read as the pipeline does."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        path = fresh_dir(spark, "stage")
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs.collect())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == COLUMNS
    return out


def test_stage_names_and_registration():
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None
    assert queries.QUERIES["pipeline"]


def test_quality_stage(spark, outputs):
    good = {r.doc_id for r in queries.op6_quality_classifier(spark, SF).collect() if r.predicted}
    assert sorted(outputs[1]) == sorted(r for r in outputs[0] if r.doc_id in good)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in outputs[1]}
    clean = [i for i, q in labels.items() if q == 1]
    assert sum(i in kept for i in clean) >= 0.98 * len(clean)


def test_simhash_stage(outputs):
    rows = sorted(outputs[1], key=lambda r: r.doc_id)
    fps = [brute.simhash(r.text) for r in rows]
    root = brute.groups(len(rows), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 3)
    assert sorted(outputs[2]) == sorted(r for i, r in enumerate(rows) if root[i] == i)


def test_substring_stage(outputs):
    want = brute.substring_dedup([(r.doc_id, r.text) for r in outputs[2]])
    assert {r.doc_id: r.text for r in outputs[3]} == {i: t for i, (_, _, t) in want.items()}
    assert all(r.n_chars == len(r.text) for r in outputs[3])
    assert len(outputs[3]) == len(outputs[2])


def test_mixing_stage(outputs):
    size = {r.doc_id: len(brute.words(r.text)) for r in outputs[3]}
    source = {r.doc_id: r.source for r in outputs[3]}
    sizes = Counter()
    for i, n in size.items():
        sizes[source[i]] += n
    taken, copies = Counter(), Counter(r.doc_id for r in outputs[4])
    assert max(copies.values()) <= 3 and set(outputs[4]) <= set(outputs[3])
    for i, n in copies.items():
        taken[source[i]] += n * size[i]
    biggest = Counter()
    for i, n in size.items():
        biggest[source[i]] = max(biggest[source[i]], n)
    for s, want in targets(dict(sizes)).items():
        assert abs(taken[s] - want) <= biggest[s]


def test_bpe_stage_and_run(spark, outputs):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.no_truncation()
    t.no_padding()
    texts = {r.doc_id: r.text for r in outputs[4]}
    want = {}
    for i, text in texts.items():
        ids = t.encode(text, add_special_tokens=False).ids
        want[i] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                   hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest())
    assert Counter(r.doc_id for r in outputs[5]) == Counter(r.doc_id for r in outputs[4])
    assert all((r.n_tokens, r.ids_sha256, r.decoded_sha256) == want[r.doc_id] for r in outputs[5])
    assert sorted(corpus_pipeline.run(spark, SF).collect()) == sorted(outputs[5])


def test_odd_and_empty_documents_pass_every_stage(spark):
    rng = random.Random(4)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, " ".join(rng.choice("the of and to a in").strip() + str(rng.randrange(50))
                         for _ in range(rng.randint(0, 80))), "en", rng.choice(["s", None, "t"]), 5)
            for i in range(40)]
    rows += [(100, None, None, None, None), (101, "", "en", "s", 0), (None, "lost id", "en", "s", 7),
             (102, passage, "en", "s", 1), (103, "before " + passage + " after", "en", "t", 1),
             (103, "before " + passage + " after", "en", "t", 1), (104, "x" * 50_000, "en", "t", 1)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    for given in (rows, []):
        docs = spark.createDataFrame(given, schema)
        for _, stage in corpus_pipeline.STAGES:
            path = fresh_dir(spark, "odd")
            stage(spark, docs, SF).write.parquet(path)
            docs = spark.read.parquet(path)
        assert (docs.count() > 0) == bool(given)
