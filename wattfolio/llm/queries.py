"""Queries of the operators with production parameters over whole tables, and SQL to compare."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattfolio.llm import (
    embedding_dedup,
    exact_dedup,
    language,
    licenses,
    mixing,
    packing,
    periodic_runs,
    phrases,
    secret_scan,
    simhash,
    suffix_dedup,
    topk,
    toxicity,
)
from wattfolio.llm.common import fold, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


@query
def op1_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Three-word shingles, links at 3 bits."""
    found = simhash.near_duplicates(table(spark, folder, "documents"), shingle=3, max_bits=3)
    return found.select("doc_id", "fingerprint", "component_id")


@query
def op5_exact_topk(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 best of each vector whose id is divisible by 20."""
    return topk.top_k(table(spark, folder, "embeddings"), every=20, k=20, scale=64)


ORACLE["op5_exact_topk"] = """
WITH v AS (
  SELECT vec_id, [floor(64 * x::DOUBLE) FOR x IN embedding] AS x
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.x, c.x)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.x) = len(c.x)
  WHERE q.vec_id % 20 = 0
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 20
"""


@query
def op8_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Links at a cosine of 0.93 within a label."""
    return embedding_dedup.near_duplicates(table(spark, folder, "embeddings"), threshold=0.93)


ORACLE["op8_embedding_near_dedup"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, [x::DOUBLE FOR x IN embedding] AS x FROM embeddings
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.x, b.x) >= 0.93
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM v
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), least AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT vec_id, (SELECT count(*) FROM links WHERE links.a = least.vec_id) AS n_links,
       component_id, vec_id = component_id AS kept
FROM least
"""


def qualities(labels: DataFrame, docs: DataFrame) -> DataFrame:
    """(doc_id, quality): 1 for good documents, 0.5 for bad ones, 0.75 without a label."""
    rated = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("mark"))
    quality = F.expr("CASE mark WHEN 1 THEN 1.0D WHEN 0 THEN 0.5D ELSE 0.75D END").alias("quality")
    ids = docs.select("doc_id").where("doc_id is not null").distinct()
    return ids.join(rated, "doc_id", "left").select("doc_id", quality)


@query
def op4_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents, weights 5, 2, 1 in turn, at most three times each."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    mixed = mixing.mix(docs, qualities(labels, docs), weights=(5, 2, 1), share=1.0, repeat=3)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


ORACLE["op4_source_mixing"] = r"""
WITH rated AS (
  SELECT doc_id, CASE max(quality) WHEN 1 THEN 1.0 WHEN 0 THEN 0.5 END AS weight
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), d AS (
  SELECT d.doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    -ln((('0x' || left(md5(coalesce(d.doc_id::VARCHAR, '')), 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE)
      / CASE WHEN d.doc_id IS NULL THEN 1.0 ELSE coalesce(weight, 0.75) END::DOUBLE AS key
  FROM documents d LEFT JOIN rated r ON d.doc_id = r.doc_id
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS sid
  FROM d GROUP BY source
), w AS (SELECT *, [5, 2, 1][sid % 3 + 1] AS weight, 3 * source_size AS cap FROM s
), u AS (
  SELECT *, cap / weight AS ratio,
    ((sum(source_size) OVER ())::DOUBLE
       - coalesce(sum(cap) OVER (ORDER BY cap / weight, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
      / (sum(weight) OVER (ORDER BY cap / weight, sid ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS unit
  FROM w
), t AS (
  SELECT source, source_size, CASE WHEN unit > ratio THEN cap::DOUBLE
    ELSE weight * (SELECT unit FROM u WHERE unit <= ratio ORDER BY ratio, sid LIMIT 1) END AS target
  FROM u
), e AS (
  SELECT d.*, source_size, target,
    coalesce(floor(target / nullif(source_size, 0)), 0)::BIGINT AS epochs,
    sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size::BIGINT AS size, source_size, target,
  (epochs * size + least(size, greatest(0, round(target - epochs * source_size)::BIGINT - before)))::BIGINT AS taken
FROM e
"""


@query
def op6_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """All rules over all texts, with nothing scanned before."""
    docs = table(spark, folder, "documents")
    return secret_scan.by_document(docs, secret_scan.scan(docs))


def secret_sql() -> str:
    """The same places from lists: a text split at its matches, beside the matches."""
    parts = []
    for rank, rule in enumerate(secret_scan.RULES):
        pattern = rule.pattern.replace("'", "''")
        parts.append(
            f"SELECT doc_id, {rank} AS rank, '{rule.kind}' AS kind, {rule.least} AS least, {rule.base} AS base, "
            f"string_split_regex(t, '{pattern}') AS gaps, regexp_extract_all(t, '{pattern}', 0) AS hits, "
            f"regexp_extract_all(t, '{pattern}', {rule.group}) AS vals FROM d"
        )
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS ({" UNION ALL ".join(parts)}),
p AS (
  SELECT doc_id, rank, kind, least, base, hits[i] AS hit, vals[i] AS val,
    list_sum([length(g) FOR g IN gaps[:i]]) + coalesce(list_sum([length(h) FOR h IN hits[:i - 1]]), 0) AS start
  FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM m)
),
f AS (SELECT *, kind || ':' || start::BIGINT || ':' || (start + length(hit))::BIGINT AS shown
      FROM p WHERE length(val) >= least)
SELECT d.doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
  count(*) FILTER (kind = 'hex') AS n_hex,
  sha256(coalesce(string_agg(shown, ',' ORDER BY start, rank) FILTER (base), '')) AS base_sha256,
  coalesce(string_agg(shown, ',' ORDER BY start, rank), '') AS spans
FROM d LEFT JOIN f ON d.doc_id = f.doc_id GROUP BY d.doc_id
"""


ORACLE["op6_secret_scan"] = secret_sql()


@query
def op10_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """All templates over all texts."""
    found = licenses.scan(table(spark, folder, "documents"))
    shown = F.transform("spans", lambda s: F.concat_ws(":", s["label"], s["first_word"], s["last_word"], s["negated"].cast("int")))
    return found.withColumn("spans", F.array_join(shown, ","))


def license_sql() -> str:
    """The same votes from three words joined as text; the templates are split in SQL."""
    rows = ", ".join(f"({i}, '{t.label}', '{t.text}', {t.base})" for i, t in enumerate(licenses.TEMPLATES))
    negations = ", ".join(f"'{w}'" for w in licenses.NEGATIONS)
    return rf"""
WITH t(template, label, phrase, base) AS (VALUES {rows}),
k AS (
  SELECT template, label, base, len(p) AS n, i - 1 AS place, p[i] AS a, p[i + 1] AS b, p[i + 2] AS c
  FROM (SELECT *, unnest(range(1, len(p) - 1)) AS i FROM (SELECT *, string_split(phrase, ' ') AS p FROM t))
),
d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
),
g AS (SELECT doc_id, i - 1 AS spot, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c, w[greatest(i - 3, 1):i - 1] AS before
      FROM (SELECT *, unnest(range(1, len(w) - 1)) AS i FROM d)),
h AS (SELECT DISTINCT doc_id, template, label, base, n, spot, place, spot - place AS diagonal, before FROM g JOIN k USING (a, b, c)),
v AS (SELECT doc_id, template, diagonal, base AND count(*) = n - 2 AS whole FROM h GROUP BY doc_id, template, diagonal, base, n),
l AS (
  SELECT v.*, n, coalesce((diagonal - lag(diagonal) OVER (PARTITION BY doc_id, v.template ORDER BY diagonal)
                          > {licenses.NEAR} + n // 20)::INT, 0) AS apart
  FROM v JOIN (SELECT DISTINCT template, n FROM k) USING (template)
),
p AS (SELECT *, sum(apart) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS passage FROM l),
b AS (
  SELECT doc_id, template, count(*) AS n_base, min(diagonal) AS first_word, max(diagonal) AS last_word
  FROM v WHERE whole GROUP BY doc_id, template
),
s AS (
  SELECT h.doc_id, h.template, h.label, h.n, passage, len(list_distinct(flatten(list([place, place + 1, place + 2])))) AS held,
    min(spot) AS f, max(spot) + 2 AS z, arg_min(before, (spot, h.diagonal)) AS before
  FROM h JOIN p ON p.doc_id = h.doc_id AND p.template = h.template AND p.diagonal = h.diagonal
  GROUP BY h.doc_id, h.template, h.label, h.n, passage
),
c AS (
  SELECT *, CASE WHEN held >= CASE WHEN n < {licenses.SHORT} THEN {licenses.SHORT_DENSE} ELSE {licenses.DENSE} END::DOUBLE * (z - f + 1)
                 THEN held / n ELSE 0.0 END AS covered, list_has_any(before, [{negations}]) AS negated FROM s
),
x AS (
  SELECT doc_id, max(covered) AS score, list(label) FILTER (fits AND NOT negated) AS ls,
    string_agg(label || ':' || f || ':' || z || ':' || negated::INT, ',' ORDER BY f, z, label, covered, negated) FILTER (fits) AS spans
  FROM (SELECT *, covered >= CASE WHEN n < {licenses.SHORT} THEN {licenses.SHORT_COVERED} ELSE {licenses.COVERED} END::DOUBLE AS fits FROM c)
  GROUP BY doc_id
),
y AS (
  SELECT doc_id, sum(n_base) AS n_base, min(first_word) AS first_word, max(last_word) AS last_word, list(label) AS bs
  FROM b JOIN t USING (template) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base,
  first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  coalesce(array_to_string(list_sort(list_distinct(bs)), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(bs, []), coalesce(ls, [])))), ','), '') AS labels,
  coalesce(score, 0)::DOUBLE AS score, coalesce(spans, '') AS spans
FROM d LEFT JOIN x USING (doc_id) LEFT JOIN y USING (doc_id)
"""


ORACLE["op10_license_scan"] = license_sql()


@query
def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Trained on about 1000 documents a language of folds 1 to 4."""
    docs = table(spark, folder, "documents")
    found = language.identify(docs, language.fit(docs, per_label=1000))
    held_out = F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out")
    return found.select("doc_id", held_out, F.col("lang_best").alias("lang_pred"), "score", "rejected")


@query
def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Trained on about 1500 documents a class of folds 1 to 4."""
    docs = table(spark, folder, "documents")
    found = toxicity.score(docs, toxicity.fit(docs, table(spark, folder, "labels"), per_label=1500))
    held_out = F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out")
    return found.select("doc_id", held_out, "score", F.col("toxic").cast("int").alias("predicted"))


@query
def op2_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents into sequences of 1024 words, near copies (three-word shingles, links at 3 bits) apart."""
    docs = table(spark, folder, "documents")
    copies = simhash.near_duplicates(docs, shingle=3, max_bits=3).withColumnRenamed("root", "cluster")
    return packing.pack(docs, capacity=1024, clusters=copies)


@query
def op3_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Strings of 400 bytes."""
    found = suffix_dedup.without_repeats(table(spark, folder, "documents"), length=400)
    return found.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


def with_repeats(docs: DataFrame) -> DataFrame:
    """The documents; those with crc32(doc_id) % 10 = 0 repeat a part of their words from a place on, both given by that number."""
    parts = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    parts = parts.withColumn("w", F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))))
    parts = parts.withColumns({"n": F.size("w"), "g": F.floor(F.col("h") / 10)})
    parts = parts.withColumn("a", F.expr("CASE WHEN n > 0 THEN g % n END"))
    parts = parts.withColumn("p", F.expr("1 + (n - a) DIV (3 + g % 8)"))
    again = "flatten(array_repeat(slice(w, cast(a AS INT) + 1, cast(p AS INT)), cast(1 + (n - a) DIV p AS INT)))"
    made = F.expr(f"array_join(slice(concat(slice(w, 1, cast(a AS INT)), {again}), 1, n), ' ')")
    return parts.select("doc_id", F.when(F.col("a").isNotNull(), made).otherwise(F.col("text")).alias("text"))


@query
def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of six words and four periods at least, of all documents with the repeats put in."""
    found = periodic_runs.collapse(with_repeats(table(spark, folder, "documents")), least=6, times=4)
    best = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), -r.start, -r.period)))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period))
    rows = found.select("doc_id", "runs", "kept", best.alias("best"), lines.alias("lines"))
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.col2")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.col3")).alias("period"), F.expr("1000 * best.length DIV -best.col3").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("lines", lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("kept", 256).alias("collapsed_sha256"),
    )


@query
def op12_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """Phrases of 2 to 5 words with 100 occurrences, the 2000 best of each language."""
    return phrases.collocations(table(spark, folder, "documents"), least=100, longest=5, top=2000)


ORACLE["op12_phrase_collocations"] = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
t AS (SELECT lang, sum(len(w))::HUGEINT AS n FROM w GROUP BY lang),
g AS (
  SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase, w[i:i + size - 1] AS words
  FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM w, (SELECT unnest(range(1, 6)) AS size))
),
f AS (SELECT lang, size, phrase, any_value(words) AS words, count(*)::HUGEINT AS a FROM g GROUP BY lang, size, phrase HAVING count(*) >= 100),
c AS (SELECT *, unnest(range(1, size)) AS k FROM f WHERE size >= 2),
s AS (
  SELECT c.lang, c.phrase, c.a, c.k, l.a AS l, r.a AS r, t.n, 1000 * c.a * t.n // (l.a * r.a) AS score
  FROM c JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.words[:c.k], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.words[c.k + 1:], ' ') JOIN t ON t.lang = c.lang
),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
o AS (
  SELECT b.* FROM b WHERE NOT EXISTS (
    SELECT 1 FROM f x WHERE x.lang = b.lang AND x.a >= b.a AND x.phrase <> b.phrase
      AND contains(' ' || x.phrase || ' ', ' ' || b.phrase || ' '))
)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM o)
WHERE rank <= 2000
"""


@query
def op13_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Texts equal after lower-casing A-Z; of equal ones the largest id stays."""
    return exact_dedup.duplicates(table(spark, folder, "documents"))


ORACLE["op13_exact_dedup"] = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
  coalesce(doc_id = max(doc_id) OVER (PARTITION BY t), false) AS kept, sha256(t) AS text_sha256
FROM d
"""
