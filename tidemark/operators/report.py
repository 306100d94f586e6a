"""Schema and sample reports over a whole input."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.variant import misfit


def leaf_columns(schema: T.StructType, prefix: str = "") -> list[tuple[str, T.DataType, bool]]:
    """(dotted path, type, nullable) of every leaf; arrays and maps are leaves."""
    out = []
    for f in schema.fields:
        path = f"{prefix}{f.name}"
        if isinstance(f.dataType, T.StructType):
            out += leaf_columns(f.dataType, path + ".")
        else:
            out.append((path, f.dataType, f.nullable))
    return out


def schema_report(df: DataFrame) -> DataFrame:
    """One row per leaf column: ``column, data_type, nullable, non_null``.

    ``non_null`` is counted over the whole input in one aggregate job
    (partial counts per task), then turned into rows with ``stack``.
    """
    leaves = leaf_columns(df.schema)
    counts = df.agg(*[F.count(F.col(p)).cast("long").alias(f"c{i}")
                      for i, (p, _, _) in enumerate(leaves)])
    args = ", ".join(
        f"'{p}', '{t.simpleString()}', {str(n).lower()}, c{i}"
        for i, (p, t, n) in enumerate(leaves))
    return counts.selectExpr(
        f"stack({len(leaves)}, {args}) AS (column, data_type, nullable, non_null)")


def sample(df: DataFrame, order: list[str], n: int = 5) -> DataFrame:
    """First ``n`` rows in key order (deterministic, unlike a bare limit)."""
    return df.orderBy(*order).limit(n)


DEPTH = 4                # struct levels whose fields are told apart; deeper ones count as one field


def drift_report(records: DataFrame, schema: T.StructType | None, record: str = "record") -> DataFrame:
    """What the records hold against what is declared, in one pass over VARIANT records.

    One row a field path and kind of value: ``column, kind, records, declared, state``.
    Kinds are those of the data (BIGINT, DECIMAL(3,1), STRING, ...; ARRAY for any array, VOID
    for null). ``state`` is ``as declared``, ``retyped`` (some value does not convert to the
    declared type), ``extra`` (not declared) or ``absent`` (declared, but in no record). An
    object counts through its fields, an empty one as OBJECT. Names with a dot in them stay
    one step of the path. Without a schema, every field is ``extra``.
    """
    declared = leaf_columns(schema) if schema is not None else []
    kinds = {p: t.simpleString() for p, t, _ in declared}
    empty = F.create_map().cast("map<string,string>")
    lookup = F.create_map(*[F.lit(x) for kv in kinds.items() for x in kv]) if kinds else empty

    def kind(v: str) -> F.Column:
        k = F.schema_of_variant(v)
        return (F.when(k.startswith("OBJECT"), "OBJECT").when(k.startswith("ARRAY"), "ARRAY")
                .otherwise(k))

    # A record unfolds level by level in one generator chain: leaves go out, objects go on.
    level = records.select(F.col(record).alias("_v"), F.lit("").alias("_path"),
                           F.lit("OBJECT").alias("_kind")).where(F.schema_of_variant("_v").startswith("OBJECT"))
    for _ in range(DEPTH):
        fields = F.try_variant_get("_v", "$", "map<string,variant>")
        inner = F.when((F.col("_kind") == "OBJECT") & F.col("_v").isNotNull(), fields)
        step = level.select("_v", "_path", "_kind", F.explode_outer(inner).alias("_name", "_field"))
        named = F.when(F.col("_path") == "", F.col("_name")).otherwise(F.concat_ws(".", "_path", "_name"))
        level = step.select(
            F.when(F.col("_name").isNull(), F.col("_v")).otherwise(F.col("_field")).alias("_v"),
            F.when(F.col("_name").isNull(), F.col("_path")).otherwise(named).alias("_path"),
            F.when(F.col("_name").isNull(), F.col("_kind")).otherwise(kind("_field")).alias("_kind"))
    leaf = level.where(F.col("_path") != "").select(
        F.col("_path").alias("column"), F.col("_kind").alias("kind"), F.col("_v"),
        F.element_at(lookup, F.col("_path")).alias("declared"))
    odd = F.lit(False)
    for t in {t.simpleString(): t for _, t, _ in declared}.values():
        odd = odd | ((F.col("declared") == t.simpleString()) & misfit(
            F.col("_v"), t, F.try_variant_get("_v", "$", t.simpleString())))
    counted = leaf.groupBy("column", "kind", "declared").agg(
        F.count(F.lit(1)).alias("records"), F.count_if(odd).alias("_odd"))
    state = (F.when(F.col("declared").isNull(), "extra").when(F.col("_odd") > 0, "retyped")
             .otherwise("as declared"))
    seen = counted.select("column", "kind", "records", "declared", state.alias("state"))
    if not kinds:
        return seen
    spark = records.sparkSession
    wanted = spark.createDataFrame(list(kinds.items()), "column string, declared string")
    full = wanted.join(seen.drop("declared"), "column", "full_outer")
    return full.select("column", "kind", F.coalesce("records", F.lit(0)).alias("records"), "declared",
                       F.coalesce("state", F.lit("absent")).alias("state"))


def by_field(drift: DataFrame) -> DataFrame:
    """A drift report with one row a field: its kinds together, its gravest state."""
    kind = F.when(F.col("kind").startswith("DECIMAL"), "double").otherwise(F.lower("kind"))
    found = F.collect_set(F.when(F.col("kind") != "VOID", kind))
    weight = {"absent": 0, "as declared": 1, "extra": 2, "retyped": 3}
    grave = F.create_map(*[F.lit(x) for kv in weight.items() for x in kv])
    return drift.groupBy("column").agg(
        F.max("declared").alias("data_type"),
        F.max("declared").isNotNull().alias("declared"),
        F.nullif(F.array_join(F.array_sort(found), "|"), F.lit("")).alias("inferred_type"),
        F.sum(F.when(F.col("kind") != "VOID", F.col("records")).otherwise(0)).alias("non_null"),
        F.max_by("state", F.element_at(grave, F.col("state"))).alias("state"))
