"""Mixing sources to target weights with hash-threshold histograms.

Each document has a fixed 36-bit hash key. A source takes every document
``base`` times and once more those whose key lies below the source's cut. Cuts
come from histograms, not from sorting documents: tokens are summed by source
and the key's first 12 bits, the bucket where the budget runs out is found, and
only that bucket is summed again by the next 12 bits, three levels deep. Cuts
are nested: a larger budget only adds documents. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import work_dir

WORD = r"[^\x20\x09-\x0D]+"
MOST = 3                 # a document is taken at most so often, a source filled so far
LEVELS, DIGITS = 3, 3    # hash levels of 3 hexadecimal digits: 4096 buckets each


def _key(id_col: str) -> Column:
    digest = F.md5(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")))
    return F.conv(F.substring(digest, 1, LEVELS * DIGITS), 16, 10).cast("long")


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          source_col: str = "source") -> DataFrame:
    """(id, source, size, key) of each document; size counts the text's words."""
    words = F.regexp_count(F.col(f"`{text_col}`"), F.lit(WORD))
    return docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{source_col}`").alias("source"),
                       F.coalesce(words, F.lit(0)).cast("long").alias("size"),
                       _key(id_col).alias("key"))


def _targets(sized: DataFrame) -> DataFrame:
    """Per source: its size and target. One row a source is all that is ranked."""
    source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    name = Window.orderBy(F.col("source").asc_nulls_last())
    source = source.withColumn("weight", (F.row_number().over(name) - 1) % 3 + 1)
    # Water level: sources fill up by weight; those with the least room for their weight
    # stop first, at MOST times their size, and the others share what is left.
    cap = (MOST * F.col("source_size")).cast("double")
    filled = Window.orderBy("room", F.col("source").asc_nulls_last())
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    source = (source.withColumn("cap", cap).withColumn("room", cap / F.col("weight"))
              .withColumn("total", F.sum("source_size").over(every))
              .withColumn("weights", F.sum("weight").over(every))
              .withColumn("capped", F.coalesce(F.sum(MOST * F.col("source_size")).over(before),
                                               F.lit(0)))
              .withColumn("gone", F.coalesce(F.sum("weight").over(before), F.lit(0)))
              .withColumn("level", (F.col("total") - F.col("capped")).cast("double")
                          / (F.col("weights") - F.col("gone"))))
    # the level rises as long as the next source is below it, and falls from there on
    level = F.max("level").over(every)
    return source.select("source", "source_size",
                         F.least("cap", F.col("weight") * level).alias("target"))


def cuts(sized: DataFrame) -> DataFrame:
    """Per source: source_size, target, base copies of every document, and the key
    below which documents are taken once more. ``sized`` is read once a level."""
    share = F.try_divide("target", "source_size")
    plan = (_targets(sized)
            .withColumn("base", F.coalesce(F.floor(share), F.lit(0)))
            .withColumn("budget", F.col("target") - F.col("base") * F.col("source_size"))
            .withColumn("cut", F.lit(0).cast("long")).checkpoint())
    bits = 4 * DIGITS
    for level in range(LEVELS):
        low = bits * (LEVELS - 1 - level)                 # bits of the key below this level's
        bucket = F.shiftright("key", low)
        inside = sized.alias("d").join(
            plan.select("source", "cut").alias("p"),
            F.col("d.source").eqNullSafe(F.col("p.source"))
            & (F.shiftright(F.col("key"), low + bits) == F.shiftright(F.col("cut"), low + bits)))
        sums = (inside.groupBy("d.source", bucket.alias("bucket"))
                .agg(F.sum("size").alias("tokens")))
        upto = Window.partitionBy("source").orderBy("bucket")
        sums = sums.withColumn("sum", F.sum("tokens").over(upto))
        # the bucket in which the budget runs out: the first whose sum exceeds it
        edge = (sums.alias("s").join(plan.alias("p"),
                                     F.col("s.source").eqNullSafe(F.col("p.source")))
                .where("s.sum > p.budget").groupBy("p.source")
                .agg(F.min(F.struct("bucket", "sum", "tokens")).alias("edge")))
        start = F.shiftleft(F.col("edge.bucket"), low)
        spent = F.col("edge.sum") - F.col("edge.tokens")
        if level == LEVELS - 1:                           # the last bucket goes in if that is nearer
            over = F.col("edge.sum") - F.col("budget")
            start += F.shiftleft((over < F.col("budget") - spent).cast("long"), low)
        plan = (plan.alias("p").join(edge.alias("e"),
                                     F.col("p.source").eqNullSafe(F.col("e.source")), "left")
                .select("p.source", "source_size", "target", "base",
                        F.coalesce(F.col("budget") - spent, F.col("budget")).alias("budget"),
                        F.coalesce(start, F.col("cut")).alias("cut")).checkpoint())
    return plan.select("source", "source_size", "target", "base", "cut")


def copies(docs: DataFrame, plan: DataFrame, source: Column, key: Column) -> DataFrame:
    """``docs`` with struct ``mix``: source_size, target and copies of each row. A column
    ``mix`` of the input is replaced; other columns may have any names but those of
    the join, ``_mix_plan`` and ``_mix_source``."""
    small = plan.select(F.struct("source_size", "target", "base", "cut").alias("_mix_plan"),
                        F.col("source").alias("_mix_source"))
    more = (key < F.col("_mix_plan.cut")).cast("long")
    taken = F.least(F.col("_mix_plan.base") + more, F.lit(MOST)).cast("int")
    found = F.struct(F.col("_mix_plan.source_size"), F.col("_mix_plan.target"), taken.alias("copies"))
    return docs.join(small, source.eqNullSafe(F.col("_mix_source"))).select(
        *[F.col(f"`{c}`") for c in docs.columns if c != "mix"], found.alias("mix"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source") -> DataFrame:
    """The documents as the mix takes them: each row as often as it is taken.

    Sources in code point order, null last, weigh 1, 2, 3 and so on again, and
    share the size of all documents by weight. A source stops at three times its
    size; what it leaves goes to the others. Null texts count no word. Rows with
    one id fall together, as do all rows with a null id. Reruns agree.
    """
    work_dir(docs.sparkSession)
    sized = sizes(docs, id_col, text_col, source_col).checkpoint()
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    keyed = docs.select(row.alias("row"), F.col(f"`{source_col}`").alias("by"),
                        _key(id_col).alias("key"))
    out = copies(keyed, cuts(sized), F.col("by"), F.col("key")).where("mix.copies > 0")
    return out.select("row", F.explode(F.sequence(F.lit(1), F.col("mix.copies")))).select("row.*")
