"""Mixing sources to target weights: water-filled targets, weighted sampling by exponential keys.

Each document gets the key ``-ln(u) / quality`` with a ``u`` fixed by its id; the
smallest keys of a source are a weighted sample without replacement. A source first
gives every document as often as its target holds the whole source, then the documents
of the smallest keys up to the words that are left. The running sum over a source is
taken in two steps, sums of key ranges and then within each range, so that a source
that holds most documents is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattfolio.llm.common import cut, free

WORD = r"[^\x20\x09-\x0D]+"
# Documents in one key range, on average.
RANGE_ROWS = 10_000


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def uniform(doc_id: Column, mark: Column) -> Column:
    """A number within (0, 1) that depends on the id only, or without one on the mark: 52 bits of the md5."""
    digits = F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.concat(F.lit("-"), mark.cast("string"))).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(2.0**52)


def targets(sources: DataFrame, weights: tuple[int, ...], share: float, repeat: int) -> DataFrame:
    """Adds sid and target to one row per source (source, source_size).

    Sources by code point, null last, get the weights in turn. In the order of size per
    weight those that would exceed ``repeat`` times their size are full; the rest share
    what is left by weight. That is what repeated resharing ends in. There is one row a
    source here, so one task holds them all.
    """
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    turn = F.array(*map(F.lit, weights))
    ranked = sources.withColumn("sid", F.row_number().over(by_name) - 1)
    ranked = ranked.withColumn("weight", F.get(turn, F.col("sid") % len(weights)))
    ranked = ranked.withColumn("cap", F.col("source_size") * repeat)
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "sid")
    before = F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    total = F.sum("source_size").over(Window.partitionBy()) * share
    ranked = ranked.withColumn("unit", (total - before) / rest)
    ranked = ranked.withColumn("full", F.col("unit") > F.col("cap") / F.col("weight"))
    # the first source that is not full sets the unit of all later ones, the smallest of theirs
    every = Window.partitionBy()
    first = F.min_by("unit", F.when(~F.col("full"), F.struct(F.col("cap") / F.col("weight"), "sid"))).over(every)
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(first * F.col("weight"))
    return ranked.select("source", "sid", "source_size", "n", target.alias("target"))


def mix(
    docs: DataFrame,
    qualities: DataFrame | None = None,
    weights: tuple[int, ...] = (5, 2, 1),
    share: float = 1.0,
    repeat: int = 3,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """(doc_id, mark, size, source_size, target, taken, copies) for each row of (doc_id, text, source).

    ``size`` is the number of words, 0 for a null or empty text; ``target`` the words
    its source is to give; ``taken`` the words the mix takes of the document, repeats
    counted: whole epochs, then the sample, whose last document is taken in part;
    ``copies`` the same in whole documents, the last one rounded; ``mark`` a hash of
    text and source. ``qualities`` (doc_id, quality), one row an id, has positive
    weights; without one the weight is 1. A null source is a source, rows without an
    id have keys by text and source; rows that repeat are documents of their own, ties of a key go by id,
    size and text. An empty table gives no rows. Further columns are ignored.
    """
    mark = F.xxhash64("text", "source").alias("mark")
    rows = cut(docs.select("doc_id", "source", words(F.col("text")).alias("size"), mark))
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    planned = targets(sources, weights, share, repeat).withColumnRenamed("source", "name")
    if qualities is None:
        rows = rows.withColumn("quality", F.lit(1.0))
    else:
        rows = rows.join(qualities.select("doc_id", F.col("quality").cast("double")), "doc_id", "left")
    key = -F.ln(uniform(F.col("doc_id"), F.col("mark"))) / F.coalesce("quality", F.lit(1.0))
    placed = rows.withColumn("key", key).join(planned, F.col("source").eqNullSafe(F.col("name")))
    # 1 - exp(-key) grows with the key from 0 to 1; so do the key ranges
    ranges = F.ceil(F.col("n") / range_rows)
    placed = placed.withColumn("range", F.floor((1 - F.exp(-F.col("key"))) * ranges))
    at_range = Window.partitionBy("sid").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = placed.groupBy("sid", "range").agg(F.sum("size").alias("held"))
    sums = sums.select("sid", "range", F.coalesce(F.sum("held").over(at_range), F.lit(0)).alias("before"))
    within = (
        Window.partitionBy("sid", "range")
        .orderBy("key", "doc_id", "size", "mark")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    summed = placed.join(sums, ["sid", "range"])
    before = F.col("before") + F.sum("size").over(within) - F.col("size")
    epochs = F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0))
    summed = summed.withColumn("before", before).withColumn("epochs", epochs)
    left = F.round(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long")
    summed = summed.withColumn("part", F.least(F.col("size"), F.greatest(F.lit(0), left - F.col("before"))))
    whole = F.col("epochs") + F.when((F.col("part") > 0) & (F.col("part") * 2 >= F.col("size")), 1).otherwise(0)
    taken = F.col("epochs") * F.col("size") + F.col("part")
    return summed.select(
        "doc_id", "mark", "size", "source_size", "target", taken.alias("taken"), whole.cast("int").alias("copies")
    )


def sampled(docs: DataFrame, qualities: DataFrame | None = None, **options: object) -> DataFrame:
    """The rows of the mix itself: each input row as often as it is taken whole.

    Columns and their order stay. Texts move once, to meet their number of copies; rows
    with the same id, text and source share their copies out.
    """
    mixed = mix(docs, qualities, **options)
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    id_, mark, least, more, copies, copy = free(docs, "id", "mark", "least", "more", "copies", "copy")
    counts = mixed.groupBy(name.alias(id_), F.col("mark").alias(mark)).agg(
        F.min("copies").alias(least), (F.sum("copies") - F.count("copies") * F.min("copies")).alias(more)
    )
    rows = docs.withColumns({id_: name, mark: F.xxhash64("text", "source")}).join(counts, [id_, mark])
    nth = F.row_number().over(Window.partitionBy(id_, mark).orderBy(id_, mark))
    rows = rows.withColumn(copies, F.col(least) + (nth <= F.col(more)).cast("int")).where(F.col(copies) > 0)
    each = rows.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies).cast("int"))))
    return each.select(*(F.col(f"`{c}`") for c in docs.columns))
