"""Operator 2: mix sources to target weights.

Word counts are summed per source, the targets give each source a repetition
rate, and every document is emitted ``floor(rate)`` times plus one more copy
with probability ``rate - floor(rate)``, drawn from a hash of its id and a
seed, so that reruns agree.

Defined cases: a null or empty text has size 0; a null source is a source of
its own, after all others; a null id draws as the empty text; repeated rows
are documents of their own (rows with one id share their draw); an empty table
gives no rows. Only ``id_col``, ``text_col`` and ``source_col`` are read, so
other columns may have any names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import group_row_number
from .common import WORD, by_place, hinted, stored

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2
SEED = "mix"
#: Sources that a join may broadcast.
BROADCAST_SOURCES = 50_000


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, source, size) of every row, stored, so that the texts are read once."""
    size = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD)).cast("bigint")
    return stored(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), size.alias("size")),
                  "mix-sizes")


def source_rates(sized: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """(source, source_size, target, rate), one row per source.

    Sources in code-point order (null last) weigh ``weights``, repeating. They
    share ``share`` times all sizes by weight; a target stops at ``cap`` times
    its source's size and the excess is shared again until no target is above.
    Each round is one aggregate of two numbers and caps one source or more.
    """
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size")) \
        .withColumn("last", F.col("source").isNull())
    ranked = group_row_number(per_source, [], ["last", "source"], out="rank")
    pick = F.element_at(F.array(*[F.lit(int(w)) for w in weights]),
                        ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    ranked = stored(ranked.select("source", "source_size", pick.cast("bigint").alias("weight")), "mix-sources")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    budget, level, capped_before = share * total, 0.0, -1
    while True:
        above = F.col("weight") * F.lit(level) > cap * F.col("source_size")
        n, held, free = ranked.agg(F.count_if(above), F.sum(F.when(above, cap * F.col("source_size")).otherwise(0)),
                                   F.sum(F.when(above, 0).otherwise(F.col("weight")))).first()
        if not free or n == capped_before:
            break
        level, capped_before = (budget - held) / free, n
    above = F.col("weight") * F.lit(level) > cap * F.col("source_size")
    target = F.when(above, (cap * F.col("source_size")).cast("double")).otherwise(F.col("weight") * F.lit(level))
    return ranked.select("source", "source_size", target.alias("target")) \
        .withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))


def _draw(id_col: str, seed: str):
    """Uniform in [0, 1) from 32 bits of a hash of the seed and the id."""
    text = F.concat(F.lit(seed + ":"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") / F.lit(float(1 << 32))


def _copies(id_col: str, seed: str):
    whole = F.floor("__rate")
    return (whole + F.when(_draw(id_col, seed) < F.col("__rate") - whole, 1).otherwise(0)).cast("int")


def repetitions(sized: DataFrame, rates: DataFrame, seed: str = SEED) -> DataFrame:
    """(doc_id, size, source_size, target, copies): how often the mix takes each document."""
    right = hinted(rates.select(F.col("source").alias("__source"), "source_size", "target",
                                F.col("rate").alias("__rate")), BROADCAST_SOURCES)
    return sized.join(right, sized["source"].eqNullSafe(right["__source"]), "left") \
        .select("doc_id", "size", "source_size", "target", _copies("doc_id", seed).alias("copies"))


def mix_sources(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, cap: int = CAP,
                seed: str = SEED, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source") -> DataFrame:
    """The mixed corpus: every row of ``docs`` as often as its source's rate says, same columns."""
    own = by_place(docs)
    doc_id, text, source = (f"c{docs.columns.index(c)}" for c in (id_col, text_col, source_col))
    rates = source_rates(sizes(own, doc_id, text, source), weights, share, cap)
    right = hinted(rates.select(F.col("source").alias("__source"), F.col("rate").alias("__rate")), BROADCAST_SOURCES)
    copies = F.array_repeat(F.lit(True), _copies(doc_id, seed))
    return own.join(right, own[source].eqNullSafe(right["__source"]), "left") \
        .withColumn("__copy", F.explode(copies)).select(*own.columns).toDF(*docs.columns)


def op2_mix_sources(spark, sf_dir: str) -> DataFrame:
    """Contract columns for all ``documents``."""
    sized = sizes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return repetitions(sized, source_rates(sized)) \
        .select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


OP2_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS s FROM sized GROUP BY source),
ranked AS (SELECT source, s, [3, 1, 2][((row_number() OVER (ORDER BY source COLLATE "binary" NULLS LAST) - 1) % 3 + 1)::INT] AS w FROM per),
sorted AS (
  SELECT *, row_number() OVER o AS k, 1.5 * sum(s) OVER () AS budget, sum(w) OVER () AS all_w,
         coalesce(sum(2 * s) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held,
         coalesce(sum(w) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used_w
  FROM ranked WINDOW o AS (ORDER BY s::DOUBLE / w, source)),
lev AS (
  SELECT (budget - held)::DOUBLE / (all_w - used_w)::DOUBLE AS level FROM sorted
  WHERE w * ((budget - held)::DOUBLE / (all_w - used_w)::DOUBLE) <= 2 * s ORDER BY k LIMIT 1),
targets AS (
  SELECT source, s, CASE WHEN w * level > 2 * s THEN (2 * s)::DOUBLE ELSE w * level END AS target
  FROM ranked, (SELECT coalesce((SELECT level FROM lev), 0.0) AS level)),
rated AS (
  SELECT d.doc_id, d.size, t.s AS source_size, t.target, CASE WHEN t.s > 0 THEN t.target / t.s ELSE 0 END AS rate,
         ('0x' || substr(md5('mix:' || coalesce(d.doc_id::VARCHAR, '')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       ((floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM rated
"""
