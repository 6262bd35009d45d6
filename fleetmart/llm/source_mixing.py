"""Mixing sources to target weights by repeating documents.

Words are summed per source, every source gets a target, and target over size is its repetition rate. A document is
emitted floor(rate) times, and once more if a value hashed from a seed and its id is below the fraction of the rate.
A few seeds are tried at once and every source keeps the one whose total comes nearest to its target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fleetmart.llm.store import Workspace, every
from fleetmart.llm.words import WORD

WEIGHTS = (5, 2, 1)
#: No source takes more than so many times its size.
MOST = 3
#: Seeds tried; each md5 of (group, id) gives four.
SEED_GROUPS = 4


def word_count(text: Column | str) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _draws(doc_id: Column) -> Column:
    """One value in [0, 1) per seed."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    out = []
    for group in range(SEED_GROUPS):
        digest = F.md5(F.concat(F.lit(f"{group}:"), text))
        out += [F.conv(F.substring(digest, 1 + 8 * part, 8), 16, 10).cast("long") / F.lit(4294967296.0) for part in range(4)]
    return F.array(*out)


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, target, rate) from rows with source and size.

    Sources in code point order, null last, take the weights in turn. All targets add up to all words; what a source
    cannot take within ``most`` times its size is shared again by weight among the others. With the sources in the order
    of cap over weight, filling the first k to their caps leaves a level for the others; the level that holds is the
    largest of these. The table has one row per source.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weighed = totals.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (turn % len(weights) + 1).cast("int")).cast("long"))
    before = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    left = F.sum("source_size").over(whole) - most * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    rest = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    level = weighed.withColumn("level", left.cast("double") / rest.cast("double"))
    level = level.withColumn("level", F.max("level").over(whole))
    target = F.least((F.col("source_size") * most).cast("double"), F.col("level") * F.col("weight"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return level.withColumn("target", target).select("source", "source_size", "target", rate.alias("rate"))


def _copies(seed: Column) -> Column:
    whole = F.floor("rate")
    return (whole + (seed < F.col("rate") - whole).cast("long")).cast("long")


def mixing_plan(sizes: DataFrame, work: Workspace) -> DataFrame:
    """(source, source_size, target, rate, seed): the targets, and the seed that comes nearest, ties to the smaller."""
    targets = work.save(source_targets(sizes), "targets")
    drawn = sizes.join(targets.select(F.col("source").alias("_s"), "rate"), F.col("source").eqNullSafe(F.col("_s"))).withColumn("draws", _draws(F.col("doc_id")))
    n = SEED_GROUPS * 4
    taken = drawn.groupBy("source").agg(*[F.sum(F.col("size") * _copies(F.col("draws")[k])).alias(f"t{k}") for k in range(n)])
    off = F.array_min(F.array(*[F.struct(F.abs(F.col(f"t{k}") - F.col("target")).alias("off"), F.lit(k).alias("seed")) for k in range(n)]))["seed"]
    both = targets.join(taken.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")))
    return work.save(both.select("source", "source_size", "target", "rate", off.alias("seed")), "plan")


def sized(docs: DataFrame, source_col: str = "source", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, source, size) per row."""
    return docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(text_col).alias("size"))


def with_copies(docs: DataFrame, plan: DataFrame, source_col: str = "source", id_col: str = "doc_id") -> DataFrame:
    """``docs`` with source_size, target and copies, the number of times the mix takes the row. The plan is one small row per source."""
    named = plan.select(F.col("source").alias("_s"), "source_size", "target", "rate", "seed")
    joined = docs.join(named, F.col(source_col).eqNullSafe(F.col("_s")), "left")
    drawn = joined.withColumn("copies", _copies(_draws(F.col(id_col))[F.col("seed")]))
    return drawn.drop("_s", "rate", "seed")


def mix_sources(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken), one row per row of ``docs``.

    A null text has size 0, a null source is a source of its own, a null id draws as the empty text. Repeated rows draw
    alike. Sources without words have target 0. An empty table gives an empty result; further columns are not read.
    """
    work = Workspace(docs.sparkSession, "mixing")
    sizes = work.save(sized(docs), "sizes")
    mixed = with_copies(sizes, mixing_plan(sizes, work))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def mixed_documents(docs: DataFrame, source_col: str = "source") -> DataFrame:
    """The documents of the mix: every row as often as the plan takes it, with the columns of ``docs``."""
    work = Workspace(docs.sparkSession, "mixing")
    plan = mixing_plan(work.save(sized(docs, source_col), "sizes"), work)
    taken = with_copies(docs.select(F.struct(*every(docs)).alias("_row"), F.col(source_col).alias("_src"), F.col("doc_id").alias("_id")), plan, "_src", "_id")
    return taken.where("copies > 0").select("_row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("_copy")).select("_row.*")


def _sql_draw(k: str) -> str:
    return f"(('0x' || substr(md5(({k} // 4)::VARCHAR || ':' || coalesce(doc_id::VARCHAR, '')), 1 + 8 * ({k} % 4)::INT, 8))::BIGINT / 4294967296.0::DOUBLE)"


#: The same mix in the checking database.
SQL = f"""
WITH s AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size FROM documents),
t AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS turn FROM s GROUP BY source),
w AS (SELECT *, CASE turn % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END::BIGINT AS weight FROM t),
l AS (SELECT *,
    (sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER b, 0))::DOUBLE / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0))::DOUBLE AS level
    FROM w WINDOW b AS (ORDER BY source_size::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g AS (SELECT *, least((source_size * 3)::DOUBLE, (SELECT max(level) FROM l) * weight) AS target FROM l),
r AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM g),
k AS (SELECT unnest(range(16)) AS seed),
c AS (SELECT r.source, k.seed, any_value(r.target) AS target, sum(s.size * (floor(rate)::BIGINT + ({_sql_draw('k.seed')} < rate - floor(rate))::BIGINT))::BIGINT AS taken
    FROM s JOIN r ON s.source IS NOT DISTINCT FROM r.source CROSS JOIN k GROUP BY r.source, k.seed),
p AS (SELECT source, arg_min(seed, (abs(taken - target), seed)) AS seed FROM c GROUP BY source)
SELECT s.doc_id, s.size, r.source_size, r.target, (s.size * (floor(rate)::BIGINT + ({_sql_draw('p.seed')} < rate - floor(rate))::BIGINT))::BIGINT AS taken
FROM s JOIN r ON s.source IS NOT DISTINCT FROM r.source JOIN p ON s.source IS NOT DISTINCT FROM p.source
"""
