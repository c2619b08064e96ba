"""Mixing sources to target weights by Sainte-Laguë apportionment; built-in expressions only.

Every source's words form one line, its documents in seeded order (md5 of the
key), read again from its start when it ends.  The mix is a number of blocks
of equal word counts.  They go to the sources by highest quotients
``target / (2 seats + 1)``, once for the blocks up to each shard's end, so each
shard has an integer quota of every source.  A source's quota takes the next
blocks of its line; a document is taken as often as blocks cover it.

Nothing is laid out block by block: a document's words before it on the line
and its source's quotas give all its pieces.  The rows cross one exchange, by
(source, slice of the seeded order), so a source with a third of all rows is
spread over ``16 ** DIGITS`` slices.  Texts do not travel.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prismtab.session import cut_lineage

#: words of a document
WORD = r"[^\x20\x09-\x0D]+"
#: hex digits of the seeded order that name a slice of a source
DIGITS = 3
#: the largest block, and blocks that the smallest target has at least
MOST_BLOCK, LEAST_BLOCKS = 1024, 256


def word_count(text: Column) -> Column:
    """Words of a text; a null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[int] = (5, 2, 1), most: int = 3) -> DataFrame:
    """``sizes`` (source, source_size: a row each) with place, weight and target.

    The weights repeat over the sources in code point order, a null source
    last.  Targets share the sum of all sizes by weight; none is above ``most`` x
    its source's size, and what that frees goes to the others by weight until
    no target is above (the level is the highest of the levels at which the
    first k sources, by size for their weight, are full).  One row per source: the windows are as
    large as the list of sources."""
    places = Window.orderBy(F.isnull("source"), "source")
    rows = sizes.withColumn("place", F.row_number().over(places))
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    rows = rows.withColumn("weight", F.get(cycle, (F.col("place") - 1) % len(weights)))
    rows = rows.withColumn("most", F.col("source_size") * most)
    everything = Window.partitionBy()
    before = Window.orderBy(F.col("most") / F.col("weight"), "place").rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0))
    share = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    rows = rows.withColumn("level", left / share)
    level = F.max("level").over(everything)
    return rows.withColumn("target", F.least(F.col("most").cast("double"), F.col("weight") * level)).drop("level")


def quotas(aims: DataFrame, shards: int, block: int | None = None) -> DataFrame:
    """``aims`` (the result of ``targets``) with block and ends: blocks of the source up to the end of each shard.

    Highest quotients without a loop: with n sources and h blocks every quota
    lies within n blocks of its share (the divisor that gives h is that close), so
    all quotients above that range win, none below does, and the few in
    between (about 2 n + 2 per source in all) are ranked.  Equal quotients go
    by the sources' order.  A source never gets blocks beyond ``most``; blocks
    that no source may take stay out."""
    everything = Window.partitionBy()
    least = F.min(F.when(F.col("target") > 0, F.col("target"))).over(everything)
    own = F.greatest(F.lit(1), F.least(F.lit(MOST_BLOCK), F.coalesce(F.floor(least / LEAST_BLOCKS), F.lit(1)))).cast("long")
    rows = aims.withColumn("block", F.lit(block).cast("long") if block else own)
    rows = rows.withColumn("total", F.sum("source_size").over(everything)).withColumn("n", F.count(F.lit(1)).over(everything))
    at = rows.withColumn("shard", F.explode(F.sequence(F.lit(1), F.lit(shards))))
    at = at.withColumn("h", F.expr(f"((total div block) * shard) div {shards}"))
    at = at.withColumn("room", F.expr("most div block"))
    at = at.withColumn("high", F.expr("if(total = 0, 0, least(room, cast(floor(target * (h + n) / total) as long) + 2))"))
    at = at.withColumn("low", F.expr("if(total = 0, 0, least(high, greatest(0, cast(floor(target * (h - n) / total) as long) - 2)))"))
    open_ = at.withColumn("open", F.col("h") - F.sum("low").over(Window.partitionBy("shard")))
    asked = open_.where("high > low").select("place", "shard", "open", "target", F.explode(F.expr("sequence(low, high - 1)")).alias("seat"))
    best = Window.partitionBy("shard").orderBy(F.desc(F.col("target") / (2 * F.col("seat") + 1)), "place", "seat")
    won = asked.withColumn("rank", F.row_number().over(best)).where("rank <= open")
    won = won.groupBy("place", "shard").agg(F.count(F.lit(1)).alias("won"))
    ends = at.join(won, ["place", "shard"], "left").withColumn("end", F.col("low") + F.coalesce("won", F.lit(0)))
    ends = ends.groupBy("place").agg(F.sort_array(F.collect_list(F.struct("shard", "end"))).alias("ends"))
    return rows.join(ends.select("place", F.col("ends.end").alias("ends")), "place").drop("total", "n")


def mix(docs: DataFrame, size: Column, key: str = "doc_id", source: str = "source", weights: Sequence[int] = (5, 2, 1), most: int = 3,
        shards: int = 40, seed: int = 13, block: int | None = None) -> DataFrame:
    """One row per row of ``docs``: key, source, size, source_size, target, taken, pieces.

    ``taken`` counts the words that the mix takes of the document, repeats
    included, at most ``most`` x its size.  ``pieces`` lists them: shard, copy (from 0),
    first word in the document (from 0) and number of words.  Rows without
    words and null sizes take 0.  A null key is one more key and a null source
    a source of its own, the last.  Rows of equal key and size are told apart by
    nothing else and may swap their places.  An empty input gives an empty result.  Further
    columns of ``docs`` are not read.  A third of all rows under one source is spread by key; only rows of one same
    key share a slice."""
    rows = docs.select(F.col(key).alias("key"), F.col(source).alias("source"), F.coalesce(size.cast("long"), F.lit(0)).alias("size"))
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("key").cast("string"), F.lit(""))).cast("binary"))
    rows = cut_lineage(rows.withColumn("order", order))
    rows = rows.withColumn("slice", F.substring("order", 1, DIGITS))
    slices = rows.groupBy("source", "slice").agg(F.sum("size").alias("words"))
    sizes = slices.groupBy("source").agg(F.sum("words").alias("source_size"))
    aims = quotas(targets(sizes, weights, most), shards, block).select("source", "source_size", "target", "block", "ends")
    earlier = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("before", F.coalesce(F.sum("words").over(earlier), F.lit(0))).drop("words")
    slices = slices.join(aims, slices["source"].eqNullSafe(aims["source"])).drop(aims["source"])
    inside = Window.partitionBy("source", "slice").orderBy("order", "key", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("own", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    placed = placed.join(slices, placed["source"].eqNullSafe(slices["source"]) & (placed["slice"] == slices["slice"])).drop(slices["source"], slices["slice"])
    placed = placed.withColumn("at", F.col("before") + F.col("own")).withColumn("stop", F.element_at("ends", -1) * F.col("block"))
    taken = " + ".join(f"greatest(0, least(at + size + {c} * source_size, stop) - (at + {c} * source_size))" for c in range(most))
    pieces = f"""filter(flatten(transform(sequence(0, {most - 1}), c -> transform(ends, (e, j) -> named_struct('shard', j, 'copy', c,
        'first', greatest(0, if(j = 0, 0, ends[j - 1]) * block - at - c * source_size),
        'words', least(at + size + c * source_size, e * block) - greatest(at + c * source_size, if(j = 0, 0, ends[j - 1]) * block))))), p -> p.words > 0)"""
    return placed.select(
        F.col("key").alias(key), F.col("source").alias(source), "size", "source_size", "target",
        F.expr(f"cast({taken} as long)").alias("taken"), F.expr(pieces).alias("pieces"),
    )
