"""Exact duplicates of texts, by recipes of content-defined chunks; SQL functions only.

A text is cut where its content says so: behind the end of a sentence or line, after
``least`` code points at least and ``most`` at most. Equal stretches of different texts are
cut alike, so a chunk that many texts share is moved once a task and kept once. A chunk
is known by a hash, and that hash is verified: all different chunks come together by
their whole content, and where several have one hash each gets a number beside it. A
text's recipe is the ordered list of its chunks' identifiers, and two texts are equal if
their recipes are. Only recipes are grouped and joined, some hundredths of the texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wattfolio.llm.common import ascii_lower, stored

LEAST = 256
MOST = 4096
# A hot group of equal texts is spread over so many parts.
PARTS = 64


def chunks(text: Column, least: int = LEAST, most: int = MOST) -> Column:
    """The text in pieces that make it up in their order; an empty text has none."""
    # a cut lies behind the end of a sentence or line; the rest is the last chunk
    pattern = rf"(?s).{{{least},{most}}}?(?<=[.!?\n])|.{{1,{most}}}"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def hashed(chunk: Column, bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(chunk), 64 - bits)


def duplicates(docs: DataFrame, least: int = LEAST, most: int = MOST, bits: int = 64) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for each row of (doc_id, text).

    Texts are equal if they are after lower-casing A-Z; a null text counts as empty, and
    empty texts equal each other. Of a group the row with the largest ``doc_id`` stays; a
    null id is the least of all, and of several rows with that id one stays. Rows that
    repeat count as often as they occur. Further columns are ignored. ``bits`` is the width
    of the hash that chunks are first known by; results are the same for any.
    """
    text = ascii_lower(F.coalesce("text", F.lit("")))
    rows = docs.select("doc_id", text.alias("text")).select(
        F.monotonically_increasing_id().alias("row"), "doc_id",
        F.sha2("text", 256).alias("sha"), chunks(F.col("text"), least, most).alias("chunks"),
    )
    rows = stored(rows, "chunks").withColumn("hashes", F.transform("chunks", lambda c: hashed(c, bits)))

    different = rows.select(F.explode("chunks").alias("chunk")).distinct()
    different = different.withColumn("h", hashed(F.col("chunk"), bits))
    # of the chunks brought together once, only hashes go on; those of several chunks are rare
    shared = stored(different.groupBy("h").agg(F.count("h").alias("n")).where("n > 1").select("h"), "shared")
    if shared.isEmpty():
        rows = rows.select("row", "doc_id", "sha", "hashes", F.lit(None).cast("array<int>").alias("numbers"))
    else:
        number = F.row_number().over(W.partitionBy("h").orderBy("chunk"))
        rows = numbered(rows, different.join(shared, "h").withColumn("number", number))

    key = ["hashes", "numbers"]
    part = F.pmod("row", F.lit(PARTS))
    last = F.max(F.struct("doc_id", "row"))
    partial = rows.groupBy(*key, part.alias("part")).agg(last.alias("last"), F.count("row").alias("n"))
    whole = partial.groupBy(*key).agg(F.max("last").alias("last"), F.sum("n").alias("n"), F.collect_list("part").alias("parts"))
    spread = whole.select(*(F.col(k).alias(f"of_{k}") for k in key), "last", "n", F.explode("parts").alias("of_part"))
    same = [F.col(k).eqNullSafe(F.col(f"of_{k}")) for k in key]
    joined = rows.withColumn("part", part).join(spread, [*same, F.col("part") == F.col("of_part")])
    return joined.select(
        "doc_id", F.col("last.doc_id").alias("keep_id"), F.col("n").alias("group_size"),
        (F.col("row") == F.col("last.row")).alias("kept"), F.col("sha").alias("text_sha256"),
    )


def numbered(rows: DataFrame, numbers: DataFrame) -> DataFrame:
    """The rows with the numbers of their chunks whose hash others have as well, in the order of the text."""
    spots = rows.select("row", F.posexplode("chunks").alias("spot", "chunk"))
    found = spots.join(numbers, "chunk").groupBy("row").agg(F.sort_array(F.collect_list(F.struct("spot", "number"))).alias("found"))
    return rows.join(found, "row", "left").select("row", "doc_id", "sha", "hashes", F.col("found.number").alias("numbers"))
