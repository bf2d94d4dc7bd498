"""Mixing sources to target weights by systematic sampling, in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.llm.common import brought_back, set_aside

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Runs of characters other than ASCII white space; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """Never null, so that it can be joined; the null source has a key of its own."""
    return F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), source))


def source_targets(sizes: DataFrame, weights: Sequence[int], share: float, most: float) -> DataFrame:
    """Target words of each source from (source, source_size), one row per source.

    Weights repeat over the sources by code point, null last. Together the sources
    should give ``share`` of all words. A target stops at ``most`` times its source,
    and the excess goes to the others by weight: that is one water level, found by
    ordering the sources by the level at which they are full. The windows run over
    one row per source.
    """
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("nr", F.row_number().over(by_name)).select(
        "source",
        "source_size",
        "nr",
        F.element_at(F.array(*map(F.lit, weights)), ((F.col("nr") - 1) % len(weights) + 1).cast("int")).alias("weight"),
        (F.lit(float(most)) * F.col("source_size")).alias("top"),
    )
    filled = Window.orderBy(F.col("top") / F.col("weight"), "nr")
    total = F.lit(float(share)) * F.sum("source_size").over(everything)
    above = F.coalesce(F.sum("top").over(filled.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    open_weight = F.sum("weight").over(filled.rowsBetween(0, Window.unboundedFollowing))
    levels = ranked.withColumn("place", F.row_number().over(filled)).withColumn("level", (total - above) / open_weight)
    holds = F.when(F.col("level") <= F.col("top") / F.col("weight"), F.struct("place", "level"))
    levels = levels.withColumn("water", F.min(holds).over(everything)["level"])
    return levels.select(
        "source",
        "source_size",
        F.when(F.col("water").isNull(), F.col("top")).otherwise(F.least("top", F.col("water") * F.col("weight"))).alias("target"),
    )


def systematic_copies(
    docs: DataFrame,
    weights: Sequence[int] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    seed: str = "mix",
    chunks: int = 64,
) -> DataFrame:
    """Documents with how often the mix takes each.

    Needs ``doc_id``, ``text`` and ``source``; adds ``size`` (words), ``source_size``,
    ``target`` (of its source), ``copies`` and ``taken`` = copies x size.

    Every document of a source is expected target / source_size times. In a fixed
    order of the source the expected copies are summed, one offset per source (from a
    hash of its name, so reruns agree) is added, and a document is emitted once per
    whole number its stretch crosses. The order goes by size class first: documents of
    like length are neighbours, so the words taken come near the target. As the
    expectation is one number per source, the prefix sum is the rank times that number
    and needs no sum of fractions. Ranks come from counts per (source, size class,
    chunk of ids) and a window inside such a chunk, so a source with a third of all
    rows is spread over its chunks.

    Null texts have size 0 and are taken 0 words; a null source is a source; rows with
    the same id and text are separate rows that may differ in copies only among
    themselves; an empty table gives no rows. ``chunks`` is the number of slices per
    size class; raise it with the largest source.
    """
    bits = F.bin("size")
    mark = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    new = ["size", "source_size", "target", "copies", "taken"]
    rows = docs.drop(*new).withColumn("size", word_count(F.col("text")))
    rows = rows.withColumns(
        {
            "__key": source_key(F.col("source")),
            "__class": F.concat(F.lpad(F.length(bits).cast("string"), 2, "0"), F.substring(bits, 1, 3)),
            "__mark": mark,
            "__tie": F.xxhash64("text"),  # taken here, so that texts move only if the caller keeps them
            "__chunk": (F.conv(F.substring(mark, 1, 4), 16, 10).cast("int") % chunks),
        }
    )
    group = ["__key", "__class", "__chunk"]
    groups = rows.groupBy("source", *group).agg(F.count("*").alias("__n"), F.sum("size").alias("__words"))
    sizes = groups.groupBy("source").agg(F.sum("__words").alias("source_size"))
    targets = source_targets(sizes, weights, share, most).select(
        source_key(F.col("source")).alias("__key"),
        "source_size",
        "target",
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)).alias("__rate"),
        (F.conv(F.substring(F.md5(F.concat(F.lit(seed), source_key(F.col("source")))), 1, 8), 16, 10).cast("double") / 4294967296.0).alias("__offset"),
    )
    before = Window.partitionBy("__key").orderBy("__class", "__chunk").rowsBetween(Window.unboundedPreceding, -1)
    placed = groups.select(*group, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before")).join(targets, "__key")
    inside = Window.partitionBy(*group).orderBy("__mark", "size", "__tie")
    rank = F.col("__before") + F.row_number().over(inside)
    out = rows.join(placed, group).withColumn("__rank", rank)
    crossed = lambda k: F.floor(k * F.col("__rate") + F.col("__offset"))
    out = out.withColumn("copies", crossed(F.col("__rank")) - crossed(F.col("__rank") - 1))
    out = out.withColumn("taken", F.col("copies") * F.col("size"))
    return out.select(*[c for c in docs.columns if c not in new], *new)


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every document as often as it is taken, in the columns of ``docs``."""
    core = ("doc_id", "text", "source")
    out = systematic_copies(set_aside(docs, *core), **options).where(F.col("copies") > 0)
    return brought_back(out.withColumn("__i", F.explode(F.sequence(F.lit(1), F.col("copies")))), docs.columns, *core)


SQL = r"""
WITH rows AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS mark FROM documents),
ordered AS (
  SELECT *, lpad(CAST(length(bin(size)) AS VARCHAR), 2, '0') || substr(bin(size), 1, 3) AS class,
         CAST('0x' || substr(mark, 1, 4) AS INTEGER) % 64 AS chunk FROM rows),
sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM rows GROUP BY source),
ranked AS (
  SELECT *, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight,
         row_number() OVER (ORDER BY source NULLS LAST) AS nr FROM sizes),
levels AS (
  SELECT a.*, 2.0::DOUBLE * a.source_size AS top,
         ((SELECT 1.5::DOUBLE * sum(source_size) FROM sizes)
           - coalesce((SELECT sum(2.0::DOUBLE * b.source_size) FROM ranked b
                       WHERE (2.0::DOUBLE * b.source_size / b.weight, b.nr) < (2.0::DOUBLE * a.source_size / a.weight, a.nr)), 0))
         / (SELECT sum(b.weight) FROM ranked b
            WHERE (2.0::DOUBLE * b.source_size / b.weight, b.nr) >= (2.0::DOUBLE * a.source_size / a.weight, a.nr)) AS level
  FROM ranked a),
water AS (SELECT arg_min(level, top / weight) AS w FROM levels WHERE level <= top / weight),
goals AS (
  SELECT source, source_size, least(top, coalesce((SELECT w FROM water), 1e300) * weight) AS target,
         CAST('0x' || substr(md5('mix' || coalesce('s' || source, 'n')), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS shift
  FROM levels),
placed AS (
  SELECT o.doc_id, o.size, g.source_size, g.target, g.shift,
         CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0 END AS rate,
         row_number() OVER (PARTITION BY o.source ORDER BY class, chunk, mark, size) AS rank
  FROM ordered o JOIN goals g ON o.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (floor(rank * rate + shift) - floor((rank - 1) * rate + shift)) AS BIGINT) AS taken
FROM placed
"""
