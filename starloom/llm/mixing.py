"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.support import FILE, PLACE, located
from starloom.operators.keys import dense_ids
from starloom.session import materialize

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
SEED = 17


def word_count(text: Column) -> Column:
    """Words between ASCII white space; NULL holds none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def source_targets(
    sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = SEED
) -> DataFrame:
    """One row per source of ``sizes`` (``source``, ``size``): its words, target, rate, offset and first rank.

    ``share`` times all words are dealt to the sources by weight; the weights repeat
    over the sources in code-point order, NULL last. A source takes at most ``most``
    times its own words; what it leaves is dealt to the others by weight again.
    In closed form: all targets are ``min(most * words, level * weight)`` with one
    ``level``, found along the sources in the order in which they fill up. The
    windows run over one row per source.
    """
    own = sizes.groupBy("source").agg(F.count(F.lit(1)).alias("docs"), F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    before = Window.orderBy(F.col("source").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    weighed = own.select(
        "*",
        weight.alias("weight"),
        F.coalesce(F.sum("docs").over(before), F.lit(0)).alias("first_rank"),
        (F.lit(most) * F.col("source_size")).alias("cap"),
        (F.lit(share) * F.sum("source_size").over(Window.partitionBy())).alias("total"),
    ).withColumn("full_at", F.col("cap") / F.col("weight"))
    filling = Window.orderBy("full_at", "first_rank")
    capped = F.coalesce(F.sum("cap").over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    open_weight = F.sum("weight").over(filling.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    levels = weighed.withColumn("level", (F.col("total") - capped) / open_weight)
    reached = F.max(F.when(F.col("level") <= F.col("full_at"), F.col("level"))).over(Window.partitionBy())
    target = F.least(F.col("cap"), F.coalesce(reached, F.lit(float("inf"))) * F.col("weight"))
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce("source", F.lit("")))), 1, 4), 16, 10)
    return (
        levels.withColumn("target", target)
        .withColumn("rate", F.least(F.lit(most), F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0))))
        .withColumn("offset", offset.cast("double") / 65536)
        .select("source", "source_size", "target", "rate", "offset", "first_rank")
    )


def mixed(
    docs: DataFrame,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weights: tuple = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    seed: int = SEED,
) -> DataFrame:
    """One row per document: ``key``, ``size``, ``source_size``, ``target``, ``copies``, ``taken`` and its place.

    Systematic sampling. Every document of a source expects ``target / source_size``
    copies. Along the source, in the order of size and key, the expected copies are
    summed up, one random offset per source is added, and a document is emitted
    once for each whole number that the sum passes at it. Because neighbours in
    that order have nearly the same size, the words taken come close to the target.

    The sum needs no task that holds a whole source: documents are ranked over
    range partitions, and the rank times the rate is the sum. ``taken`` is
    ``size * copies``, at most ``most`` times the size. NULL text has no
    words; NULL sources are one source; a source without words takes none. Rows that
    repeat a key are ranked one by one. Reruns agree. An empty table gives no rows.
    """
    lean = located(docs).select(
        F.col(key).alias("key"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"), FILE, PLACE
    )
    ranked = dense_ids(lean, ["source", "size", "key", FILE, PLACE], "rank", start=0)
    targets = materialize(source_targets(ranked, weights, share, most, seed), "targets")
    joined = ranked.withColumnRenamed("source", "own_source").join(
        targets, F.col("own_source").eqNullSafe(F.col("source"))
    )
    inside = F.col("rank") - F.col("first_rank")
    passed = lambda n: F.floor(n * F.col("rate") + F.col("offset"))
    copies = passed(inside + 1) - passed(inside)
    return joined.withColumn("copies", copies.cast("bigint")).select(
        F.col("key").alias(key),
        "size",
        "source_size",
        "target",
        "copies",
        (F.col("size") * F.col("copies")).alias("taken"),
        FILE,
        PLACE,
    )


def mix(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` with each row as often as ``mixed`` takes it; the columns stay as they are."""
    placed = located(docs)
    copies = mixed(placed, **settings)
    taken = copies.where("copies > 0").select(F.col("copies").alias("__located_copies"), FILE, PLACE)
    repeated = placed.join(taken, [FILE, PLACE]).withColumn("__located_copy", F.explode(F.expr("sequence(1L, __located_copies)")))
    return repeated.select(*[c for c in docs.columns if c not in (FILE, PLACE)])


SQL = r"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents
), own AS (
    SELECT source, sum(size)::BIGINT AS source_size,
           [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS weight
    FROM sized GROUP BY source
), weighed AS (
    SELECT *, 2.0::DOUBLE * source_size AS cap, 1.5::DOUBLE * sum(source_size) OVER () AS total,
           2.0::DOUBLE * source_size / weight AS full_at
    FROM own
), levels AS (
    SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY full_at, source NULLS FIRST
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
              / sum(weight) OVER (ORDER BY full_at, source NULLS FIRST
                                  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM weighed
), targets AS (
    SELECT source, source_size,
           least(cap, max(CASE WHEN level <= full_at THEN level END) OVER () * weight) AS target,
           ('0x' || substr(md5('17|' || coalesce(source, '')), 1, 4))::INTEGER / 65536.0::DOUBLE AS shift
    FROM levels
), ranked AS (
    SELECT doc_id, size, source_size, target, shift,
           least(2.0::DOUBLE, coalesce(target / nullif(source_size, 0), 0)) AS rate,
           row_number() OVER (PARTITION BY s.source ORDER BY size, doc_id NULLS FIRST) - 1 AS place
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       (size * (floor((place + 1) * rate + shift) - floor(place * rate + shift)))::BIGINT AS taken
FROM ranked
"""
