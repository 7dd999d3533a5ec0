"""License scans by diagonal voting.

Every rolling hash of three words of a text is joined to the places of the templates
that have it, and a hit is one if its three words are the template's. It votes for its
diagonal, the text place less the template place. A diagonal that has all places of a
phrase is a verbatim place of it. Neighbouring diagonals are merged, as a word more or
less moves a passage to the next one.

Each merged passage is verified as a span of the text: its words that are the template's
must cover enough of the template and be enough of the span's own words, nearly all of
them for a short template. A span that follows a negation ("not under the ...") is found
and returned, but gives no label.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattfolio.llm.common import ascii_lower

BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GRAM = 3
# Diagonals that far apart are merged, and one more for every 20 words of a template.
NEAR = 3
# The share of a template's words that a span holds, and their share of the span; a short
# template must stand nearly verbatim, as one word more is another license there.
COVERED = 0.7
DENSE = 0.5
SHORT = 16
SHORT_COVERED = 0.8
SHORT_DENSE = 0.9
# Words that negate a span when one of the three words before it is one.
NEGATIONS = ("not", "no", "never", "neither", "nor")
# Bits of the filter that most grams fail before they leave their row; 64 to a long.
FILTER_BITS = 1 << 14


class Template(NamedTuple):
    label: str
    text: str
    base: bool = False


# Phrases with their labels, and notices as their licenses word them.
TEMPLATES = (
    Template("mit", "under the mit license", True),
    Template("apache-2", "apache license version 2", True),
    Template("cc-by-nc", "cc by nc", True),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and "
        "associated documentation files the software to deal in the software without restriction",
    ),
    Template(
        "apache-2",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at",
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted "
        "provided that the following conditions are met",
    ),
    Template(
        "gpl",
        "you can redistribute it and or modify it under the terms of the gnu general public license as "
        "published by the free software foundation",
    ),
    Template("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    Template("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license"),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation the "
        "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
        "persons to whom the software is furnished to do so subject to the following conditions the above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the software the "
        "software is provided as is without warranty of any kind express or implied including but not limited to the "
        "warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the "
        "authors or copyright holders be liable for any claim damages or other liability whether in an action of "
        "contract tort or otherwise arising from out of or in connection with the software or the use or other dealings "
        "in the software",
    ),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies the software "
        "is provided as is and the author disclaims all warranties with regard to this software including all implied "
        "warranties of merchantability and fitness in no event shall the author be liable for any special direct "
        "indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether "
        "in an action of contract negligence or other tortious action arising out of or in connection with the use or "
        "performance of this software",
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met 1 redistributions of source code must retain the above copyright notice this list "
        "of conditions and the following disclaimer 2 redistributions in binary form must reproduce the above copyright "
        "notice this list of conditions and the following disclaimer in the documentation and or other materials "
        "provided with the distribution 3 neither the name of the copyright holder nor the names of its contributors may "
        "be used to endorse or promote products derived from this software without specific prior written permission "
        "this software is provided by the copyright holders and contributors as is and any express or implied warranties "
        "including but not limited to the implied warranties of merchantability and fitness for a particular purpose are "
        "disclaimed in no event shall the copyright holder or contributors be liable for any direct indirect incidental "
        "special exemplary or consequential damages including but not limited to procurement of substitute goods or "
        "services loss of use data or profits or business interruption however caused and on any theory of liability "
        "whether in contract strict liability or tort including negligence or otherwise arising in any way out of the "
        "use of this software even if advised of the possibility of such damage",
    ),
    Template(
        "apache-2",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with "
        "the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by "
        "applicable law or agreed to in writing software distributed under the license is distributed on an as is basis "
        "without warranties or conditions of any kind either express or implied see the license for the specific "
        "language governing permissions and limitations under the license",
    ),
    Template(
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
        "public license as published by the free software foundation either version 3 of the license or at your option "
        "any later version this program is distributed in the hope that it will be useful but without any warranty "
        "without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general "
        "public license for more details you should have received a copy of the gnu general public license along with "
        "this program",
    ),
    Template(
        "mpl-2",
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not "
        "distributed with this file you can obtain one at http mozilla org mpl 2 0",
    ),
    Template(
        "epl-2",
        "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 "
        "which is available at https www eclipse org legal epl 2 0",
    ),
    Template(
        "cc0",
        "to the extent possible under law the author has dedicated all copyright and related and neighboring rights to "
        "this software to the public domain worldwide this software is distributed without any warranty",
    ),
    # Short notices. They are chosen so that one is not met by another license: a lesser or affero license is no
    # gpl, a creative commons license with more conditions is none with fewer, and public licenses of equal
    # version are told apart.
    Template("isc", "under the isc license"),
    Template("isc", "license identifier isc"),
    Template("epl-2", "the eclipse public license 2 0"),
    Template("epl-2", "eclipse public license v 2 0"),
    Template("epl-2", "epl 2 0"),
    Template("cc0", "cc0 1 0 universal"),
    Template("cc0", "license identifier cc0 1 0"),
    Template("cc-by", "cc by 4 0"),
    Template("cc-by", "cc by 3 0"),
    Template("cc-by", "creative commons attribution 4 0 international"),
    Template("cc-by", "creative commons attribution license"),
    Template("cc-by-sa", "cc by sa"),
    Template("cc-by-sa", "creative commons attribution sharealike"),
    Template("cc-by-sa", "creative commons attribution share alike"),
    Template("gpl", "the gnu general public license"),
    Template("gpl", "under the gpl"),
    Template("gpl", "gpl 2 0"),
    Template("gpl", "gpl 3 0"),
    Template("lgpl", "the gnu lesser general public license"),
    Template("agpl", "the gnu affero general public license"),
    Template("bsd", "the bsd license"),
    Template("bsd", "2 clause bsd license"),
    Template("bsd", "3 clause bsd license"),
    Template("bsd", "bsd 2 clause"),
    Template("bsd", "bsd 3 clause"),
    Template("mpl", "mozilla public license"),
    Template("mpl-2", "the mozilla public license 2 0"),
    Template("mpl-2", "mpl 2 0"),
    Template("apache-2", "the apache license 2 0"),
    Template("apache-2", "license identifier apache 2 0"),
    Template("mit", "license identifier mit"),
)


def grams(templates: tuple[Template, ...]) -> list[tuple[int, str, bool, int, int, list[str]]]:
    """(template, label, base, words, place, three words) of each template."""
    out = []
    for number, (label, text, base) in enumerate(templates):
        words = text.split()
        if len(words) < GRAM:
            raise ValueError(f"a template has {GRAM} words at least: {text}")
        out += [(number, label, base, len(words), i, words[i : i + GRAM]) for i in range(len(words) - GRAM + 1)]
    return out


def template_table(spark: SparkSession, templates: tuple[Template, ...]) -> DataFrame:
    """A row per place of a template by its hash and words, and one that heads each text (hash and place null)."""
    schema = "template int, label string, base boolean, n int, place int, words array<string>"
    rows = spark.createDataFrame(grams(templates), schema)
    rows = rows.withColumn("h", F.xxhash64(*(F.col("words")[i] for i in range(GRAM))))
    head = spark.range(1).selectExpr("-1 template", "null label", "false base", "0 n", "0 place", "array() words", "0L h")
    return rows.unionByName(head)


def filter_longs(table: DataFrame) -> list[int]:
    """Bits that are set for the hashes of the table, which the templates bound."""
    longs = [0] * (FILTER_BITS // 64)
    for (h,) in table.select("h").collect():
        longs[(h >> 6) % len(longs)] |= 1 << (h & 63)
    return [x - (1 << 64) if x >> 63 else x for x in longs]


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans) of each row of (doc_id, text).

    ``spans`` are the verified spans (label, first_word, last_word, covered, negated) by first
    word, last word and label; words count from 0, both ends included. ``labels`` are those of
    base phrases and of spans that are not negated; the score is the largest ``covered`` of a
    span. A null text counts as empty; a text without words has no places, empty labels and
    score 0. Rows that repeat are returned as often. Further columns are ignored.
    """
    spark = docs.sparkSession
    table = template_table(spark, templates)
    words = F.filter(F.split(ascii_lower(F.coalesce("text", F.lit(""))), BETWEEN_WORDS, -1), lambda w: w != "")
    texts = docs.select("doc_id", F.xxhash64("text").alias("mark"), words.alias("w"))
    # most grams fail this filter inside their row; the others take their words and those before along
    longs = ", ".join(f"{x}L" if x != -(1 << 63) else "shiftleft(1L, 63)" for x in filter_longs(table))
    passes = f"shiftright(get(array({longs}), cast(shiftright(g.h, 6) & {FILTER_BITS // 64 - 1} AS INT)), cast(g.h & 63 AS INT)) & 1 = 1"
    rolling = "transform(sequence(0, size(w) - 3), i -> struct(i AS at, xxhash64(w[i], w[i + 1], w[i + 2]) AS h))"
    taken = (
        f"transform(filter({rolling}, g -> {passes}), g -> struct(g.at AS at, g.h AS h, slice(w, g.at + 1, 3) AS words, "
        "slice(w, greatest(g.at - 2, 1), least(g.at, 3)) AS before))"
    )
    head = "array(struct(size(w) AS at, 0L AS h, array() AS words, array() AS before))"
    each = texts.selectExpr("doc_id", "mark", f"inline(CASE WHEN size(w) < 3 THEN {head} ELSE concat({head}, {taken}) END)")
    # a fixed number of rows: one for each place of the templates
    hits = each.join(F.broadcast(table), ["h", "words"])
    text = ["doc_id", "mark"]
    diagonal = (F.col("at") - F.col("place")).alias("diagonal")
    votes = hits.groupBy(*text, "template", "label", "base", "n", diagonal).agg(
        F.collect_set("place").alias("places"), F.min_by("before", "at").alias("before"), F.count(F.lit(1)).alias("rows")
    )
    along = Window.partitionBy(*text, "template").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(along) > NEAR + F.floor(F.col("n") / 20)
    votes = votes.withColumn("passage", F.sum(F.coalesce(apart.cast("int"), F.lit(0))).over(along))
    whole = F.col("base") & (F.size("places") == F.col("n") - (GRAM - 1))
    first, last = F.col("diagonal") + F.array_min("places"), F.col("diagonal") + F.array_max("places") + (GRAM - 1)
    merged = votes.groupBy(*text, "template", "label", "n", "passage").agg(
        F.array_distinct(F.flatten(F.collect_list("places"))).alias("places"),
        F.min(first).alias("first"),
        F.max(last).alias("last"),
        F.min_by("before", F.struct(first, "diagonal")).alias("before"),
        F.count_if(whole).alias("n_base"),
        F.min(F.when(whole, F.col("diagonal"))).alias("first_word"),
        F.max(F.when(whole, F.col("diagonal"))).alias("last_word"),
        F.max("diagonal").alias("n_words"),
        F.max("rows").alias("rows"),
    )
    held = F.size(F.array_distinct(F.flatten(F.transform("places", lambda p: F.array(*(p + i for i in range(GRAM)))))))
    merged = merged.withColumn("held", F.when(F.col("template") >= 0, held).otherwise(0))
    dense = F.when(F.col("n") < SHORT, F.lit(SHORT_DENSE)).otherwise(F.lit(DENSE))
    close = F.col("held") >= dense * (F.col("last") - F.col("first") + 1)
    covered = F.when((F.col("template") >= 0) & close, F.col("held") / F.col("n")).otherwise(0.0)
    negated = F.exists("before", lambda w: w.isin(*NEGATIONS))
    merged = merged.withColumns({"covered": covered, "negated": negated})
    found = F.col("covered") >= F.when(F.col("n") < SHORT, F.lit(SHORT_COVERED)).otherwise(F.lit(COVERED))
    based, licensed = F.when(F.col("n_base") > 0, F.col("label")), F.when(found & ~F.col("negated"), F.col("label"))
    header = F.col("template") == -1
    span = F.struct(
        F.col("first").cast("long").alias("first_word"), F.col("last").cast("long").alias("last_word"), "label", "covered", "negated"
    )
    joined = lambda labels: F.concat_ws(",", F.array_sort(F.collect_set(labels)))
    out = merged.groupBy(*text).agg(
        F.max(F.when(header, F.col("n_words"))).cast("long").alias("n_words"),
        F.max(F.when(header, F.col("rows"))).alias("rows"),
        F.sum(F.when(header, 0).otherwise(F.col("n_base"))).alias("n_base"),
        F.min("first_word").cast("long").alias("first_word"),
        F.max("last_word").cast("long").alias("last_word"),
        joined(based).alias("base_labels"),
        joined(F.coalesce(licensed, based)).alias("labels"),
        F.max("covered").alias("score"),
        F.array_sort(F.collect_list(F.when(found, span))).alias("spans"),
    )
    return out.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans",
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))).alias("copy"),
    ).drop("copy")
