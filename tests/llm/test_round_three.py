"""Runs of words, phrases and exact duplicates against plain versions; operators on hostile tables."""

from __future__ import annotations

import hashlib
import random
import re
import time
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from wattfolio.llm import (
    embedding_dedup,
    exact_dedup,
    licenses,
    mixing,
    packing,
    periodic_runs,
    phrases,
    queries,
    secret_scan,
    simhash,
    suffix_dedup,
    topk,
    toxicity,
)

RNG = random.Random(8)
# Columns beside the needed ones, named as operators might name their own.
CLASHES = ["row", "runs", "kept", "chunks", "hashes", "part", "shard", "phrase", "n", "a", "_id", "_mark", "_blob", "spots", "_n", "id", "mark", "nth"]
DOCS = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHES)


@pytest.fixture(scope="module")
def hostile(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, clashing names."""
    words = ["al", "ben", "cor", "dun", "éli"]
    long = " ".join(RNG.choice(words) for _ in range(4000)) + ". " + "x y " * 300
    base = " ".join(RNG.choice(words) for _ in range(60))
    texts = [None, "", " \t\n", "one", long, long, long + "!", base, base.upper(), base + "\n" + base, "a b c d " * 12, "é" * 900, "É" * 900]
    rows = [(i, t, "en" if i % 3 else None, f"s{i % 3}" if i % 4 else None, None, *["z"] * len(CLASHES)) for i, t in enumerate(texts)]
    rows += [rows[7], rows[7], (None, base, None, None, 3, *[None] * len(CLASHES)), (None,) * (5 + len(CLASHES))]
    return spark.createDataFrame(rows, DOCS)


# --- runs


def words_of(text):
    return [w.decode() for w in (text or "").encode().split()]


def plain_runs(w, least, times):
    out = []
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(least, times * q) and not any(w[i : j + q - p] == w[i + p : j + q] for p in range(1, q)):
                out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_kept(w, found):
    gone = {k for a, n, q in found for k in range(a + q, a + n)}
    return " ".join(x for k, x in enumerate(w) if k not in gone)


@pytest.mark.parametrize("least, times", [(6, 4), (3, 2)])
def test_runs_of_random_texts(spark, least, times):
    rng = random.Random(least)
    texts = []
    for _ in range(300):
        w = [rng.choice("abcde"[: rng.choice([1, 2, 3, 5])]) for _ in range(rng.randrange(70))]
        if rng.random() < 0.5 and w:
            a = rng.randrange(len(w))
            p = 1 + (len(w) - a) // rng.randrange(3, 9)
            w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
        texts.append(rng.choice([" ", "\n", "  \t"]).join(w))
    got = periodic_runs.collapse(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), least, times)
    for r in got.collect():
        w = words_of(texts[r.doc_id])
        assert [tuple(x) for x in r.runs] == plain_runs(w, least, times)
        assert (r.n_words, r.kept) == (len(w), plain_kept(w, plain_runs(w, least, times)))


def test_runs_on_a_hostile_table(hostile):
    got = periodic_runs.collapse(hostile)
    want = Counter()
    for r in hostile.select("doc_id", "text").collect():
        w = words_of(r.text)
        found = plain_runs(w, 6, 4) if len(w) < 2000 else None
        want[(r.doc_id, len(w), tuple(found) if found is not None else "long")] += 1
    assert Counter((r.doc_id, r.n_words, tuple(map(tuple, r.runs)) if r.n_words < 2000 else "long") for r in got.collect()) == want
    assert periodic_runs.collapse(hostile.limit(0)).count() == 0


def test_query_of_runs(spark):
    """Every document of the small tables, the repeats put in by the contract's words."""
    folder = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in queries.op11_periodic_runs(spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    assert len(docs) == len(got)
    some = 0
    for d in docs:
        w, h = words_of(d.text), zlib.crc32(str(d.doc_id).encode())
        n, g = len(w), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
        if n > 1500:
            continue
        found, r = plain_runs(w, 6, 4), got[d.doc_id]
        some += bool(found)
        best = min(found, key=lambda x: (-x[1], x[0], x[2]), default=(None,) * 3)
        assert (r.n_runs, r.start, r.length, r.period) == (len(found), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if found else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{k},{q}\n" for s, k, q in found).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(plain_kept(w, found).encode()).hexdigest()
    assert some > 3


# --- phrases


def plain_collocations(rows, least, longest, top, inside):
    count, total = Counter(), Counter()
    for lang, text in rows:
        lang = lang if lang is not None else "und"
        lower = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            w = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(w)
            count.update((lang, *w[i : i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    out = defaultdict(list)
    held = {c: a for c, a in count.items() if len(c) > 2 and a >= least}
    for c, a in held.items():
        lang, w = c[0], c[1:]
        cuts = [(1000 * a * total[lang] // (count[(lang, *w[:k])] * count[(lang, *w[k:])]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        longer = [b for x, b in held.items() if x[0] == lang and len(x) > len(c) and any(x[i : i + len(w)] == w for i in range(1, len(x)))]
        if not any(100 * b >= inside * a for b in longer):
            out[lang].append((-score, -a, " ".join(w).encode(), count[(lang, *w[:k])], count[(lang, *w[k:])], total[lang]))
    return {
        (lang, i, p.decode(), -a, left, r, n, -s)
        for lang, found in out.items()
        for i, (s, a, p, left, r, n) in enumerate(sorted(found)[:top], 1)
    }


@pytest.mark.parametrize("shards, cells, inside", [(4, 1 << 16, 100), (3, 2, 60), (1, 1 << 16, 100)])
def test_collocations_of_random_texts(spark, shards, cells, inside):
    """Whatever the cells: with two of them nearly every phrase is active before its time."""
    rng = random.Random(shards)
    words = ["A", "b", "Cé", "d d", "e\x1ff"]
    rows = []
    for i in range(200):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", " ", "\t", ", ", ". ", "\n", "!"]) for _ in range(rng.randrange(40)))
        rows.append((rng.choice(["x", "y", None]), text if i % 20 else None, i))
    rows += [rows[1]] * 30
    docs = spark.createDataFrame(rows, "lang string, text string, n long")
    got = phrases.collocations(docs, least=12, longest=4, top=25, inside=inside, shards=shards, cells=cells).collect()
    want = plain_collocations([r[:2] for r in rows], 12, 4, 25, inside)
    assert len(want) > 30 and {tuple(r) for r in got} == want and len(got) == len(want)


@pytest.mark.parametrize("cells", [16, 64, 256])
def test_phrases_that_share_cells_are_counted_whole(spark, cells):
    """A part's cell may be set by another phrase before the part itself is active."""
    rng = random.Random(5)
    rows = [("x", " ".join(f"w{rng.randrange(1 + int(rng.random() ** 2 * 12))}" for _ in range(rng.randrange(30)))) for _ in range(400)]
    got = phrases.collocations(spark.createDataFrame(rows, "lang string, text string"), least=14, shards=4, cells=cells).collect()
    want = plain_collocations(rows, 14, 5, 2000, 100)
    assert len(want) > 100 and {tuple(r) for r in got} == want


def test_collocations_on_a_hostile_table(hostile):
    rows = [(r.lang, r.text) for r in hostile.select("lang", "text").collect()]
    got = phrases.collocations(hostile, least=3, cells=1 << 16)
    assert {tuple(r) for r in got.collect()} == plain_collocations(rows, 3, 5, 2000, 100)
    assert phrases.collocations(hostile.limit(0), least=3, cells=1 << 16).count() == 0


def test_scores_pass_64_bits(spark, monkeypatch):
    big = 3 * 10**15
    counts = [("x", 0, "", big), ("x", 1, "a", 10**14), ("x", 1, "b", 10**14 - 1), ("x", 2, "a b", 10**14 - 1)]
    frame = spark.createDataFrame(counts, "lang string, length int, phrase string, n long")
    monkeypatch.setattr(phrases, "frequent", lambda *a: frame)
    (row,) = phrases.collocations(frame.selectExpr("lang", "phrase text")).collect()
    assert row.score == int(Fraction(1000 * (10**14 - 1) * big, 10**14 * (10**14 - 1)))


# --- exact duplicates


def plain_duplicates(rows):
    lower = lambda t: (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    groups = defaultdict(list)
    for i, t in rows:
        groups[lower(t)].append(i)
    out = Counter()
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        left = True
        for i in ids:
            kept = left and i == keep
            left = left and not kept
            out[(i, keep, len(ids), kept, hashlib.sha256(text.encode()).hexdigest())] += 1
    return out


@pytest.mark.parametrize("bits", [64, 3, 1])
def test_recipes_with_colliding_hashes(spark, hostile, bits):
    """With a hash of few bits nearly all chunks collide, and only their content tells them apart."""
    rng = random.Random(bits)
    parts = [" ".join(rng.choice(["ab", "cd", "Ef"]) for _ in range(40)) + rng.choice([".", "\n", " "]) for _ in range(6)]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(4))) for _ in range(150)] + [None, "x" * 20_000, "X" * 20_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for frame in (docs, hostile):
        rows = [tuple(r) for r in frame.select("doc_id", "text").collect()]
        got = exact_dedup.duplicates(frame, least=20, most=100, bits=bits)
        assert Counter(map(tuple, got.collect())) == plain_duplicates(rows)
    assert exact_dedup.duplicates(docs.limit(0)).count() == 0


def test_chunks_follow_the_content(spark):
    rng = random.Random(3)
    tail = "".join("".join(rng.choice("abcdefg ") for _ in range(rng.randrange(20, 300))) + ". " for _ in range(200))
    docs = spark.createDataFrame([(0, tail), (1, "something else put before it. " * 3 + tail), (2, "")], "doc_id long, text string")
    got = {r.doc_id: r.c for r in docs.select("doc_id", exact_dedup.chunks(F.col("text")).alias("c")).collect()}
    assert ["".join(got[i]) for i in range(3)] == [r.text for r in docs.collect()]
    assert len(set(got[0]) & set(got[1])) > 0.9 * len(got[0])
    assert all(len(c) <= exact_dedup.MOST for c in got[1])


# --- operators on hostile tables and extreme values


def test_stages_keep_foreign_columns(spark, hostile):
    """Columns that operators might name their own come back as they were."""
    shown = lambda df: {(r.doc_id, *(r[c] for c in CLASHES)) for r in df.collect()}
    want = shown(hostile)
    for name, frame in {
        "simhash": simhash.one_of_each(hostile),
        "mixing": mixing.sampled(hostile),
        "secrets": secret_scan.redacted(hostile, secret_scan.scan(hostile)),
        "stage": corpus_pipeline.secrets(spark, hostile, ""),
        "toxicity": toxicity.without_toxic(hostile, None),
    }.items():
        assert frame.columns == hostile.columns, name
        assert shown(frame) <= want, name
    for frame in (packing.pack(hostile), suffix_dedup.without_repeats(hostile), licenses.scan(hostile), simhash.near_duplicates(hostile)):
        assert frame.count() >= hostile.count()


def test_scores_beyond_a_long(spark):
    rows = [(0, [1e9, 1e9]), (1, [1e9, 1e9]), (2, [-1e9, 1.0]), (3, [1e300, 0.0]), (4, [0.5, 0.5]), (20, [-1e300, -1e300])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    top, least = (1 << 63) - 1, -(1 << 63)
    whole = {i: [max(least, min(top, int(64 * x // 1) if abs(x) < 1e17 else (top if x > 0 else least))) for x in v] for i, v in rows}
    want = set()
    for q in (0, 20):
        scores = sorted((-max(-top, min(top, sum(a * b for a, b in zip(whole[q], whole[i], strict=True)))), i) for i in whole if i != q)
        want |= {(q, k, i, -s) for k, (s, i) in enumerate(scores[:3], 1)}
    assert {tuple(r) for r in topk.top_k(frame, every=20, k=3).collect()} == want


def test_cosines_of_extreme_vectors(spark):
    rows = [(0, [1e200, 2e200], 1), (1, [1e200, 2.01e200], 1), (2, [1e-200, 2e-200], 1), (3, [1e-320, 2e-320], 1), (4, [2.0, -1.0], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.near_duplicates(frame, miss=1e-9).collect()}
    assert got == {0: (3, 0), 1: (3, 0), 2: (3, 0), 3: (3, 0), 4: (0, 4)}


def test_recall_of_sign_hashing_at_many_bits(spark):
    """Parameters of the query, buckets as small as for 8 bits, the vectors of sf0.1 and near ones against all pairs of a label."""
    rng = np.random.default_rng(4)
    found = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").where("label is not null").select("vec_id", "embedding", "label").collect()
    size = np.mean([np.linalg.norm(r.embedding) for r in found]) / np.sqrt(len(found[0].embedding))
    near = [(10**6 + r.vec_id, [float(np.float32(x + rng.normal() * size * 0.3)) for x in r.embedding], r.label) for r in found]
    frame = spark.createDataFrame([*map(tuple, found), *near], "vec_id long, embedding array<float>, label int")
    rows = frame.collect()
    most = max(Counter(r.label for r in rows).values())
    bucket = max(1, most // 200)
    assert embedding_dedup.tables_for(most, 0.93, bucket, 0.0005)[0] == 8
    want = Counter()
    for label in {r.label for r in rows}:
        own = [r for r in rows if r.label == label and r.embedding is not None]
        x = np.array([r.embedding for r in own], dtype=float)
        x /= np.sqrt((x * x).sum(axis=1))[:, None]
        for r, n in zip(own, (x @ x.T >= 0.93).sum(axis=1) - 1, strict=True):
            want[r.vec_id] = int(n)
    got = {r.vec_id: r.n_links for r in embedding_dedup.near_duplicates(frame, 0.93, bucket_rows=bucket).collect()}
    assert all(got[i] <= n for i, n in want.items())
    assert sum(got[i] for i in want) >= 0.999 * sum(want.values()) > 500


def test_equal_rows_cost_what_other_rows_cost(spark):
    rng = random.Random(5)
    text = "".join(rng.choice("abcdefgh ") for _ in range(8000))
    seconds = {}
    for name, ids in (("warm", range(50)), ("ids", range(800)), ("rows", [7] * 800)):
        docs = spark.createDataFrame([(i, text) for i in ids], "doc_id long, text string").repartition(8)
        start = time.perf_counter()
        got = suffix_dedup.without_repeats(docs).selectExpr("doc_id", "length(kept) k", "size(spans) n").distinct().collect()
        seconds[name] = time.perf_counter() - start
        assert {(r.k, r.n) for r in got} == {(0, 1)} and len(got) == len(set(ids))
    assert seconds["rows"] < 2 * seconds["ids"] + 2


def test_equal_rows_beside_other_texts(spark):
    rng = random.Random(6)
    shared = "".join(rng.choice("abcd") for _ in range(150))
    texts = [shared, shared, shared, "x" + shared[:90], "".join(rng.choice("ab") for _ in range(100)), shared[20:] + "yz"]
    ids = [1, 1, 2, 3, 4, 5]
    docs = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string")
    from tests.llm.test_llm import plain_removal

    for contexts in (20_000, 1):
        got = suffix_dedup.without_repeats(docs, length=30, gram=9, contexts=contexts).collect()
        want = Counter(zip(ids, plain_removal(texts, 30), strict=True))
        assert Counter((r.doc_id, bytes(r.kept)) for r in got) == want


def test_rows_of_a_frequent_anchor_are_split(spark, monkeypatch):
    """A passage of all texts: its rows, kinds and strings meet their counts in several tasks, with the same result."""
    from tests.llm.test_llm import plain_removal

    rng = random.Random(7)
    passage = "".join(rng.choice("abcdefgh") for _ in range(32))
    texts = ["".join(rng.choice("abcdefgh") for _ in range(24)) + passage + "".join(rng.choice("abcdefgh") for _ in range(24)) for _ in range(600)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    plans, sizes, cut = [], [], suffix_dedup.cut

    def seen(df):
        out = cut(df)
        plans.append(df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0])
        if set(df.columns) >= {"place", "differ"}:
            sizes.extend(r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect())
        return out

    options = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "0",
    }
    before = {k: spark.conf.get(k, None) for k in options}
    monkeypatch.setattr(suffix_dedup, "cut", seen)
    want = dict(enumerate(plain_removal(texts, 30)))
    try:
        for k, v in options.items():
            spark.conf.set(k, v)
        # few contexts a task, so that strings are counted too
        found = suffix_dedup.without_repeats(docs, length=30, gram=9, contexts=10)
        assert {r.doc_id: bytes(r.kept) for r in found.collect()} == want
        plans.append(found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0])
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert sum(sizes) >= 600 and max(sizes) < sum(sizes) / 2
    # rows and counts, kinds and counts, strings and counts
    assert sum(p.count("SortMergeJoin(skew=true)") for p in plans) >= 3


def test_components_of_a_hot_node(spark):
    from wattfolio.llm.components import components

    star = [(0, i) for i in range(1, 3000)] + [(i, i + 10_000) for i in range(1, 500)] + [(20_000 + i, 20_001 + i) for i in range(60)]
    rng = random.Random(1)
    edges = [(a, b) if rng.random() < 0.5 else (b, a) for a, b in star] + [(5, 5), (None, 3)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {n: 20_000 if n >= 20_000 else 0 for e in star for n in e}


# --- packing


def test_every_rest_takes_the_tightest_compatible_bin():
    """Bins of one room may be taken in any order, so each step is judged by the bins that the shard itself has made."""
    rng = np.random.default_rng(3)
    for _ in range(60):
        n, capacity = int(rng.integers(1, 120)), int(rng.integers(5, 60))
        size = np.sort(rng.integers(1, capacity + 1, n))[::-1]
        source, cluster = rng.integers(0, 6, n), rng.integers(0, 40, n)
        bins, at = packing.pack_shard(size, source, cluster, capacity)
        held: dict[int, list[int]] = {}
        for i in range(n):
            room = {b: capacity - sum(size[k] for k in ks) for b, ks in held.items()}
            fits = [
                b for b, ks in held.items()
                if room[b] >= size[i] and source[i] not in source[ks] and cluster[i] not in cluster[ks]
            ]
            if fits:
                assert bins[i] in fits and room[bins[i]] == min(room[b] for b in fits)
                assert at[i] == capacity - room[bins[i]]
            else:
                assert bins[i] not in held and at[i] == 0
            held.setdefault(int(bins[i]), []).append(i)


def test_bins_do_not_depend_on_partitions(spark, hostile):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").unionByName(hostile.select("doc_id", "text", "lang", "source", "n_chars"))
    shown = lambda df: Counter(map(tuple, packing.pack(df, shard_rows=50).collect()))
    assert shown(docs.repartition(3, "text")) == shown(docs.repartition(7))


# --- licenses and secrets

MIT = next(t.text for t in licenses.TEMPLATES if t.label == "mit" and len(t.text.split()) > 100)
EXPECTED = {
    "Some file. " + MIT.upper() + " The end.": "mit",
    MIT.replace("without restriction", "without any kind of restriction"): "mit",
    " ".join(MIT.split()[:40]): "mit",
    " ".join(MIT.split()[60:90]): "",
    "This is not under the GNU General Public License": "",
    "It was never released under the ISC license.": "",
    "Not this one. It is under the ISC license.": "isc",
    "available under the Eclipse Public License 2.0": "epl-2",
    "CC0 1.0 Universal": "cc0",
    "SPDX-License-Identifier: CC0-1.0": "cc0",
    "CC BY 4.0": "cc-by",
    "CC BY-SA 4.0": "cc-by-sa",
    "Creative Commons Attribution 4.0 International": "cc-by",
    "Creative Commons Attribution-ShareAlike 4.0 International": "cc-by-sa",
    "not under the MIT license": "mit",
}


def test_license_spans(spark):
    docs = spark.createDataFrame(list(enumerate(EXPECTED)), "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.scan(docs).collect()}
    assert {t: got[i].labels for i, t in enumerate(EXPECTED)} == EXPECTED
    texts = list(EXPECTED)
    span = max(got[0].spans, key=lambda s: s.last_word - s.first_word)
    words = re.findall("[A-Za-z0-9]+", texts[0])
    assert (words[span.first_word], words[span.last_word], span.covered, span.negated) == ("PERMISSION", "SOFTWARE", 1.0, False)
    # three words put in at one place: one span with all of the template's words but for those of the broken grams
    span = max(got[1].spans, key=lambda s: s.last_word - s.first_word)
    assert span.last_word - span.first_word + 1 == len(MIT.split()) + 3 and span.covered == 1.0
    # a negated mention is found but gives no label of its own; base places stay
    assert [(s.label, s.negated) for s in got[4].spans] == [("gpl", True)]
    assert got[14].base_labels == "mit" and [s.negated for s in got[14].spans] == [True]


def test_long_templates_and_repeats(spark):
    template = licenses.Template("own", " ".join(f"w{i}" for i in range(500)))
    text = template.text + " other words between them " + template.text
    docs = spark.createDataFrame([(1, text), (1, text), (2, template.text[:900])], "doc_id long, text string")
    got = licenses.scan(docs, (template,)).collect()
    assert sorted((r.doc_id, len(r.spans), r.labels) for r in got) == [(1, 2, "own"), (1, 2, "own"), (2, 0, "")]
    with pytest.raises(ValueError, match="3 words"):
        licenses.scan(docs, (licenses.Template("x", "two words"),))


def test_a_ledger_that_outlives_its_runs(spark, tmp_path, monkeypatch):
    ledger, key = str(tmp_path / "ledger"), "token=abcdefgh1"
    history = [("a.txt", 1, key), ("a.txt", 2, "none"), ("b.txt", 1, key), ("c.txt", 1, None)]
    schema = "path string, version int, text string"
    frame = lambda rows: spark.createDataFrame(rows, schema)
    first = secret_scan.scan_into(frame(history), ledger)
    assert first.ledger.count() == 3 * len(secret_scan.RULES)
    shown = lambda f, s: sorted((r.path, r.version, r.kind, r.rule_version, r.start, r.end) for r in secret_scan.by_path(f, s).collect())
    assert shown(frame(history), first) == [("a.txt", 1, "assign", 1, 0, 15), ("b.txt", 1, "assign", 1, 0, 15)]
    # a later run scans the one new text alone, and finds the old ones without scanning them
    seen = []
    real = secret_scan.found
    monkeypatch.setattr(secret_scan, "found", lambda texts, rules: seen.append(texts) or real(texts, rules))
    later = [*history, ("a.txt", 3, "password: 12345678 x"), ("d.txt", 1, key)]
    second = secret_scan.scan_into(frame(later), ledger)
    assert [r.text for r in seen[-1].collect()] == ["password: 12345678 x"]
    assert len(shown(frame(later), second)) == 4
    folders = sorted((tmp_path / "ledger" / "versions").iterdir())
    assert spark.read.parquet(f"{folders[1]}/pairs").count() == len(secret_scan.RULES)
    # a run that is killed before its pointer leaves the ledger as it was
    with monkeypatch.context() as m:
        m.setattr(secret_scan.versions, "point", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            secret_scan.scan_into(frame([("e", 1, "secret = zzzzzzzzz")]), ledger)
    assert secret_scan.earlier_scan(spark, ledger).ledger.count() == 4 * len(secret_scan.RULES)
    # a rule of a new version is looked for in every text again, and only that rule
    newer = tuple(r if r.kind != "assign" else secret_scan.Rule("assign", r.pattern, 2, 9, version=2, base=True) for r in secret_scan.RULES)
    third = secret_scan.scan_into(frame(later), ledger, newer)
    assert third.ledger.where("kind = 'assign' and version = 2").count() == 4
    assert {r.rule_version for r in secret_scan.by_path(frame(later), third).collect()} == {1, 2}
    got = secret_scan.by_document(frame(later).withColumnRenamed("version", "doc_id"), secret_scan.Scan(third.findings.where("version = 2"), third.ledger), newer)
    assert sorted(r.n_assign for r in got.collect()) == [0, 0, 0, 1, 1, 1]


# --- the kernel and the pipeline against plain versions


def plain_kernel(a, b):
    """Subsequences of three letters, steps of up to three, weighted by the letters they skip, enumerated."""

    def profile(w):
        out, norm = Counter(), 0.0
        for i in range(len(w)):
            for j in range(i + 1, min(i + 4, len(w))):
                for k in range(j + 1, min(j + 4, len(w))):
                    weight = toxicity.DECAY ** (k - i - 2)
                    out[w[i] + w[j] + w[k]] += weight
                    norm += weight**2
        return out, max(norm, 1.0) ** 0.5

    (p, p_norm), (q, q_norm) = profile(a), profile(b)
    return sum(p[k] * q[k] for k in p) / (p_norm * q_norm)


def plain_pipeline(docs, qualities, model):
    """Documents kept by each stage and words taken, one document after the other."""
    from tests.llm.test_llm import plain_components, plain_fingerprint, plain_spans

    kept = [d for d in docs if not (model.probabilities([d["text"]]) >= 0.5)[0]] if model else list(docs)
    stages = {"toxicity": {d["doc_id"] for d in kept}}
    prints = [plain_fingerprint(d["text"]) for d in kept]
    root = plain_components(prints, lambda a, b: (a ^ b).bit_count() <= 3)
    first = {}
    for d, r in zip(kept, root, strict=True):
        if r not in first or d["doc_id"] < first[r]["doc_id"]:
            first[r] = d
    kept = list(first.values())
    stages["simhash"] = {d["doc_id"] for d in kept}
    masked = []
    for d in kept:
        spans = [tuple(map(int, s.split(":")[1:])) for s in plain_spans(d["text"]).split(",") if s]
        text, at = "", 0
        for a, b in sorted(spans):
            if a >= at:
                text += (d["text"] or "")[at:a] + "[secret]"
            at = max(at, b)
        masked.append(d | {"text": text + d["text"][at:] if spans else d["text"]})
    stages["secrets"] = {d["doc_id"]: d["text"] for d in masked}
    # mixing: targets by repeated resharing, then the smallest exponential keys
    for d in masked:
        d["size"] = len(words_of(d["text"]))
        u = (int(hashlib.md5(str(d["doc_id"]).encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        d["key"] = -np.log(u) / qualities.get(d["doc_id"], 0.75)
    sources = sorted({d["source"] for d in masked}, key=lambda s: (s is None, (s or "").encode("utf-32-be")))
    size = {s: sum(d["size"] for d in masked if d["source"] == s) for s in sources}
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sources)}
    full: set = set()
    while True:
        unit = (sum(size.values()) - sum(3 * size[s] for s in full)) / max(sum(weight[s] for s in sources if s not in full), 1e-9)
        above = {s for s in sources if s not in full and unit * weight[s] > 3 * size[s]}
        if not above:
            break
        full |= above
    copies = {}
    for s in sources:
        target = 3 * size[s] if s in full else unit * weight[s]
        epochs = int(target // size[s]) if size[s] else 0
        left = round(target - epochs * size[s])
        for d in sorted((d for d in masked if d["source"] == s), key=lambda d: (d["key"], d["doc_id"])):
            part = min(d["size"], max(0, left))
            left -= d["size"]
            copies[d["doc_id"]] = epochs + (part > 0 and 2 * part >= d["size"])
    stages["mixing"] = {i: n for i, n in copies.items() if n}
    stages["words"] = {d["doc_id"]: copies[d["doc_id"]] * d["size"] for d in masked if copies[d["doc_id"]]}
    return stages


def test_kernel_against_counted_subsequences():
    words = ["skwoxle", "vyjakk", "skwxole", "abcabc", "xyz", "skwoxle"]
    got = toxicity.kernel(words, words)
    for i, a in enumerate(words):
        for j, b in enumerate(words):
            # a word's start counts as a letter of its own
            assert got[i, j] == pytest.approx(plain_kernel("^" + a, "^" + b), abs=1e-5)


def test_pipeline_against_plain_stages(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    model = toxicity.fit(docs, labels)
    rated = {r.doc_id: {1: 1.0, 0: 0.5}.get(r.q, 0.75) for r in labels.groupBy("doc_id").agg(F.max("quality").alias("q")).collect()}
    want = plain_pipeline([r.asDict() for r in docs.collect()], rated, model)
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    kept = corpus_pipeline.toxic(spark, docs, folder)
    assert ids(kept) == want["toxicity"]
    unique = corpus_pipeline.near_duplicates(spark, kept, folder)
    assert ids(unique) == want["simhash"]
    masked = corpus_pipeline.secrets(spark, unique, folder)
    assert {r.doc_id: r.text for r in masked.collect()} == want["secrets"]
    mixed = corpus_pipeline.mixture(spark, masked, folder)
    assert Counter(r.doc_id for r in mixed.select("doc_id").collect()) == want["mixing"]
    out = corpus_pipeline.run(spark, folder).collect()
    words = Counter()
    for r in out:
        words[r.doc_id] += r.n_words
    assert dict(words) == want["words"]
    bins = defaultdict(list)
    for r in out:
        if r.bin_id is not None:
            bins[r.bin_id].append(r)
    for held in bins.values():
        assert sum(r.n_words for r in held) <= 1024
        assert len(held) == 1 or len({r.source for r in held}) == len({r.doc_id for r in held}) == len(held)
