"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

import hashlib
import string
from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import (ann, bpe, chat, collocations, content_sort, licences, merkle, mixing,
                          quality, ship, toxicity)
from tidemark.llm.embedding_dedup import near_duplicates
from tidemark.llm.simhash import fingerprint, fingerprint_groups
from tidemark.llm.substring_dedup import remove_repeats
from tidemark.session import work_dir


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = F.sha2(F.coalesce(F.col("row.text"), F.lit("")), 256)
    return remove_repeats(docs).select(
        "row.doc_id", "n_words", "n_removed", kept.alias("kept_sha256"))


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "embeddings"), threshold=0.9).select(
        F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), "kept")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5))
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"), fold != 0)
    scored = docs.select("doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"),
                         toxicity.score(model, docs).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    work_dir(spark)
    sized = mixing.sizes(_table(spark, sf_dir, "documents")).checkpoint()
    out = mixing.copies(sized, mixing.cuts(sized), F.col("source"), F.col("key"))
    return out.select(F.col("id").alias("doc_id"), "size", "mix.source_size", "mix.target",
                      (F.col("size") * F.col("mix.copies")).alias("taken"))


OP4_SQL = """
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS size,
         ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 9))::BIGINT AS key
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM sized GROUP BY source),
room AS (
  SELECT *, CAST(3 * source_size AS DOUBLE) AS cap, CAST(3 * source_size AS DOUBLE) / weight AS room,
         sum(source_size) OVER () AS total, sum(weight) OVER () AS weights FROM sources),
filled AS (
  SELECT *, coalesce(sum(3 * source_size) OVER before, 0) AS capped,
         coalesce(sum(weight) OVER before, 0) AS gone FROM room
  WINDOW before AS (ORDER BY room, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
levels AS (
  SELECT *, CAST(total - capped AS DOUBLE) / CAST(weights - gone AS DOUBLE) AS level FROM filled),
targets AS (
  SELECT source, source_size, least(cap, weight * max(level) OVER ()) AS target FROM levels),
plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS base FROM targets),
sums AS (
  SELECT source, key, sum(size) AS tokens FROM sized GROUP BY source, key),
upto AS (
  SELECT *, sum(tokens) OVER (PARTITION BY source ORDER BY key) AS upto FROM sums),
edge AS (
  SELECT p.source, min(u.key) AS key FROM upto u JOIN plan p ON u.source IS NOT DISTINCT FROM p.source
  WHERE u.upto > p.target - p.base * p.source_size GROUP BY p.source),
cut AS (
  SELECT p.*, coalesce(e.key + CASE WHEN u.upto - (p.target - p.base * p.source_size)
      < (p.target - p.base * p.source_size) - (u.upto - u.tokens) THEN 1 ELSE 0 END, 0) AS cut
  FROM plan p LEFT JOIN edge e ON p.source IS NOT DISTINCT FROM e.source
  LEFT JOIN upto u ON u.source IS NOT DISTINCT FROM e.source AND u.key = e.key)
SELECT s.doc_id, s.size, c.source_size, c.target,
       CAST(s.size * least(c.base + CASE WHEN s.key < c.cut THEN 1 ELSE 0 END, 3) AS BIGINT) AS taken
FROM sized s JOIN cut c ON s.source IS NOT DISTINCT FROM c.source
"""


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)],
                                "conv_id bigint, turn bigint, role string, text string")
    rows = _table(spark, sf_dir, "conversations").select(*own.columns).unionByName(own)
    # a conversation is a tree of one branch: each row answers the one before it
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_last(), "role", "text")
    at = F.row_number().over(order).cast("long")
    messages = rows.select(F.col("conv_id").alias("tree"), at.alias("node"), (at - 1).alias("parent"),
                           "role", "text", F.lit(0.0).alias("score"))
    back = _read_back("conversation")
    return chat.format_trees(messages, keep=1).select(
        F.col("tree").alias("conv_id"), back.alias("back"),
        F.length("conversation.text").cast("long").alias("formatted_chars")).select(
        "conv_id", "back.*", "formatted_chars")


@F.arrow_udf(T.StructType([
    T.StructField("n_turns", T.LongType()), T.StructField("turns_sha256", T.StringType()),
    T.StructField("loss_chars", T.LongType()), T.StructField("loss_sha256", T.StringType())]))
def _read_back(conversations: pa.Array) -> pa.Array:
    rows = []
    for c in conversations.to_pylist():
        turns = chat.read_turns(c["text"])
        said = "".join(f"{role}\n{text}\n" for role, text in turns)
        loss = "".join(chat.read_loss(c["text"], c["loss"]))
        rows.append({"n_turns": len(turns), "turns_sha256": hashlib.sha256(said.encode()).hexdigest(),
                     "loss_chars": len(loss), "loss_sha256": hashlib.sha256(loss.encode()).hexdigest()})
    return pa.array(rows, pa.struct([("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                                     ("loss_chars", pa.int64()), ("loss_sha256", pa.string())]))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4))
    model = quality.fit(docs, _table(spark, sf_dir, "labels"), fold != 2)
    scored = docs.select("doc_id", F.coalesce(fold == 2, F.lit(False)).alias("held_out"),
                         quality.score(model, docs).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path("byte_bpe_50k.json")
    return bpe.tokenized(docs, path).select("doc_id", "bpe.*")


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    work_dir(spark)
    docs = _table(spark, sf_dir, "documents")
    # only ids and fingerprints go on: each text is read and shingled once
    fps = docs.select(F.col("doc_id").alias("id"), fingerprint("text", 3).alias("fp")).checkpoint()
    return fps.join(fingerprint_groups(fps, 3), "fp").select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return licences.scan(docs).select(
        "row.doc_id", "license", "start", "end", "saved_bytes",
        F.round("similarity", 4).alias("similarity"), F.size("differences").alias("n_differences"))


def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    return ann.nearest(rows, rows.where("vec_id % 100 = 0"), k=10)


def op11_content_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return content_sort.mark_copies(docs, keep="largest").select(
        "row.doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP11_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(text) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)
WINDOW same AS (PARTITION BY text)
"""


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    fields = ["doc_id", "source", "lang", "n_chars"]
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0,
                      merkle.leaf_digest([*fields, lower]))
    leaves = merkle.as_leaves(docs, [*fields, "text"], extra={"tampered": tampered})
    proved = merkle.witnesses(merkle.build(leaves))
    folded = merkle.fold(F.coalesce("row.tampered", "digest"), "witness")
    hexed = [F.lower(F.hex(c)).alias(name) for c, name in
             (("digest", "leaf"), ("subroot", "subroot"), ("root", "root"))]
    return (proved.select(F.col("row.id").alias("doc_id"), *hexed, folded.alias("folded"))
            .select("doc_id", "leaf", "subroot", "root", "folded.proof_sha256",
                    F.col("folded.root").alias("folded_root"),
                    (F.col("folded.root") == F.col("root")).alias("verified")))


def _merkle_sql(levels: int) -> str:
    """One WITH term a level: ``levels`` of a source, then as many of the sources. Folding
    needs the siblings left and right of each node, for the true and the tampered leaf."""
    def field(c: str) -> str:
        return f"coalesce(octet_length(encode(CAST({c} AS VARCHAR))) || ':' || CAST({c} AS VARCHAR), '-')"

    upper, lower = string.ascii_uppercase, string.ascii_lowercase
    head = " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars"))
    # CRC-32 bit by bit: a digit is mixed in, then eight steps marked -1 follow
    digits = "CAST(doc_id AS VARCHAR)"
    crc = (f"list_reduce(flatten(list_transform(range(1, len({digits}) + 1), lambda i: "
           f"list_value(ascii({digits}[i])::BIGINT, {', '.join(['-1::BIGINT'] * 8)}))), "
           "lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END, "
           "4294967295::BIGINT)")
    terms = [f"""leaves AS (
      SELECT doc_id, source, xor({crc}, 4294967295) % 5 = 0 AS hit,
             sha256({head} || {field('text')}) AS leaf,
             sha256({head} || {field(f"translate(text, '{upper}', '{lower}')")}) AS tampered
      FROM documents)""",
             """t0 AS (SELECT source AS tree, row_number() OVER (
        PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, leaf AS d FROM leaves)"""]
    for tree in ("t", "s"):
        if tree == "s":
            terms.append(f"""s0 AS (SELECT 0 AS tree, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS pos,
                d, tree AS source FROM t{levels})""")
        for k in range(levels):
            terms.append(f"""{tree}{k + 1} AS (
              SELECT tree, pos // 16 AS pos, CASE WHEN any_value(more) THEN sha256(string_agg(d, '' ORDER BY pos))
                     ELSE any_value(d) END AS d
              FROM (SELECT *, count(*) OVER (PARTITION BY tree) > 1 AS more FROM {tree}{k})
              GROUP BY tree, pos // 16)""")
            terms.append(f"""{tree}w{k} AS (
              SELECT tree, pos, coalesce(string_agg(d, '' ORDER BY pos) OVER (run ROWS BETWEEN
                       UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
                     coalesce(string_agg(d, '' ORDER BY pos) OVER (run ROWS BETWEEN
                       1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r,
                     count(*) OVER (PARTITION BY tree) > 1 AS more
              FROM {tree}{k} WINDOW run AS (PARTITION BY tree, pos // 16 ORDER BY pos))""")
    terms.append(f"""f0 AS (
      SELECT l.*, p.pos AS a, z.pos AS b, CASE WHEN hit THEN tampered ELSE leaf END AS f, '' AS proof
      FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rn
            FROM leaves) l
      JOIN t0 p ON p.tree IS NOT DISTINCT FROM l.source AND p.pos = l.rn
      JOIN s0 z ON z.source IS NOT DISTINCT FROM l.source)""")
    step = 0
    for tree, place in (("t", "a"), ("s", "b")):
        for k in range(levels):
            same = "w.tree IS NOT DISTINCT FROM f.source" if tree == "t" else "w.tree = 0"
            terms.append(f"""f{step + 1} AS (
              SELECT f.* REPLACE (f.{place} // 16 AS {place},
                       CASE WHEN w.more THEN sha256(w.l || f.f || w.r) ELSE f.f END AS f,
                       f.proof || w.l || w.r AS proof)
              FROM f{step} f JOIN {tree}w{k} w ON {same} AND w.pos = f.{place})""")
            step += 1
    return f"""WITH {', '.join(terms)}
    SELECT f.doc_id, f.leaf, t.d AS subroot, s.d AS root, sha256(f.proof) AS proof_sha256,
           f.f AS folded_root, f.f = s.d AS verified
    FROM f{step} f JOIN t{levels} t ON t.tree IS NOT DISTINCT FROM f.source JOIN s{levels} s ON s.tree = 0"""


#: Five levels: 16^5 leaves of a source, and as many sources.
OP12_SQL = _merkle_sql(5)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("text", "lang")
    return collocations.mine(docs, least=30, keep=2000)


OP13_SQL = f"""
WITH pieces AS (
  SELECT lang, regexp_extract_all(p, '[^\\x20\\x09]+') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
      translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'),
      '[.,;:!?\\x0A-\\x0D]')) AS p FROM documents)),
grams AS (
  SELECT lang, w[i:i + n - 1] AS g FROM (
    SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM (
      SELECT *, unnest(range(1, least(len(w), 4) + 1)) AS n FROM pieces))),
f AS (SELECT lang, g, count(*) AS a FROM grams GROUP BY lang, g HAVING count(*) >= 30),
cuts AS (
  SELECT c.lang, c.g, c.a, k, l.a AS l, r.a AS r, (2000000 * c.a::HUGEINT) // (l.a + r.a) AS score
  FROM (SELECT *, unnest(range(1, len(g))) AS k FROM f WHERE len(g) > 1) c
  JOIN f l ON l.lang = c.lang AND l.g = c.g[1:k] JOIN f r ON r.lang = c.lang AND r.g = c.g[k + 1:]),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
inner_parts AS (
  SELECT lang, a, g[s:s + n - 1] AS g FROM (
    SELECT *, unnest(range(1, len(g) - n + 2)) AS s FROM (
      SELECT *, unnest(range(2, len(g))) AS n FROM f WHERE len(g) > 2))),
longer AS (SELECT lang, g, max(a) AS most FROM inner_parts GROUP BY lang, g),
total AS (SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang),
ranked AS (
  SELECT c.lang, row_number() OVER (PARTITION BY c.lang
           ORDER BY score DESC, a DESC, array_to_string(c.g, ' ')) AS rank,
         array_to_string(c.g, ' ') AS phrase, a, l, r, score
  FROM lowest c LEFT JOIN longer o ON o.lang = c.lang AND o.g = c.g
  WHERE o.most IS NULL OR 100 * o.most::HUGEINT < 80 * a::HUGEINT)
SELECT lang, rank::BIGINT AS rank, phrase, a, l, r, n, score::BIGINT AS score
FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_substring_dedup, op2_embedding_near_dedup, op3_toxicity, op4_mixing, op5_chat_formatting,
        op6_quality_classifier, op7_bpe,
        op8_simhash_near_dedup,
        op9_license_scan, op10_nearest_neighbours, op11_content_sort, op12_merkle_manifest,
        op13_collocations, pipeline)}

SQL: dict[str, str] = {"op4_mixing": OP4_SQL, "op11_content_sort": OP11_SQL,
                       "op12_merkle_manifest": OP12_SQL, "op13_collocations": OP13_SQL}
