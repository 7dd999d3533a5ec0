"""Secret scans over an incremental ledger of blobs.

Each text is addressed by its SHA-256. The ledger holds the (blob, rule, version) pairs
that were scanned; only pairs it lacks are scanned, each distinct text once, and the
findings are joined back to every row that holds the text. All of it is built from SQL
functions: a text split at its matches, beside the matches, gives their places.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattfolio.llm.common import free
from wattfolio.sinks import versions


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` whose group ``group`` has at least ``least`` characters."""

    kind: str
    pattern: str
    group: int
    least: int
    version: int = 1
    base: bool = False


RULES = (
    Rule(
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        8,
        base=True,
    ),
    Rule("access", "AKIA[A-Z0-9]+", 0, 16, base=True),
    Rule("hex", "[0-9a-f]+", 0, 32, base=True),
    Rule("github", "gh[opusr]_[A-Za-z0-9]+", 0, 40),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 30),
    Rule("pem", r"-----BEGIN\x20[A-Z\x20]*PRIVATE\x20KEY-----", 0, 1),
)


class Scan(NamedTuple):
    """findings: (blob, kind, version, start, end); ledger: (blob, kind, version) pairs scanned so far."""

    findings: DataFrame
    ledger: DataFrame


def blob(text: Column) -> Column:
    """The address of a text; null counts as empty."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def searched(rule: Rule) -> str:
    """A pattern for the same kept matches, without the short ones where they can be left out.

    Runs of one class of characters match whole, so a least length in the pattern drops
    the short runs alone. The assignment keeps its pattern: a short match there may hold
    the start of another.
    """
    if rule.kind == "hex":
        return f"[0-9a-f]{{{rule.least},}}"
    if rule.kind == "access":
        return f"AKIA[A-Z0-9]{{{rule.least - 4},}}"
    return rule.pattern


def found(texts: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(blob, kind, version, start, end) in (blob, text, due); due holds the kinds to look for.

    Places count code points; the end is exclusive.
    """
    text = F.col("text")
    looks = [F.array_contains("due", r.kind) & text.rlike(searched(r)) for r in rules]
    hits = []
    for rule, look in zip(rules, looks, strict=True):
        pattern = F.lit(searched(rule))
        between = F.split(text, searched(rule), -1)
        whole = F.regexp_extract_all(text, pattern, F.lit(0))
        value = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else whole
        sizes = [F.transform(x, F.length) for x in (between, whole, value)]
        match = F.struct(
            F.lit(rule.kind).alias("kind"), F.lit(rule.version).alias("version"), F.lit(rule.least).alias("least"),
            F.arrays_zip(*(s.alias(n) for s, n in zip(sizes, ("gap", "size", "value"), strict=True))).alias("parts"),
        )
        hits.append(F.when(look, match))
    held = texts.where(F.expr("size(due) > 0")).select("blob", F.filter(F.array(*hits), lambda h: h.isNotNull()).alias("hits"))
    each = held.select("blob", F.explode("hits").alias("hit"))
    each = each.select("blob", "hit.kind", "hit.version", "hit.least", F.posexplode("hit.parts").alias("at", "part"))
    order = Window.partitionBy("blob", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    size = F.coalesce("part.size", F.lit(0))
    end = F.sum((F.col("part.gap") + size).cast("long")).over(order)
    each = each.withColumn("end", end).where("part.value >= least")
    return each.select("blob", "kind", "version", (F.col("end") - F.col("part.size")).alias("start"), "end")


def scan(
    docs: DataFrame, earlier: Scan | None = None, rules: tuple[Rule, ...] = RULES, keep_earlier: bool = True
) -> Scan:
    """Scans the texts of (text) that the ledger of the earlier scan lacks, under each rule's version.

    The result holds what the earlier scan found under the same versions as well, or only
    what is new. Rows of all historical versions of a path may be given at once.
    """
    seen = docs.select(blob(F.col("text")).alias("blob"), F.coalesce("text", F.lit("")).alias("text"))
    every = F.array(*(F.lit(r.kind) for r in rules))
    current = F.array(*(F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules))
    if earlier is None:
        texts = seen.groupBy("blob").agg(F.first("text").alias("text")).withColumn("due", every)
    else:
        valid = F.array_contains(current, F.struct("kind", "version"))
        done = earlier.ledger.where(valid).groupBy("blob").agg(F.collect_set("kind").alias("done"))
        due = F.array_except(every, F.coalesce("done", F.array().cast("array<string>")))
        fresh = seen.join(done, "blob", "left").withColumn("due", due).where(F.size("due") > 0)
        texts = fresh.groupBy("blob").agg(F.first("text").alias("text"), F.first("due").alias("due"))
    findings = found(texts, rules)
    ledger = texts.select("blob", F.explode(F.filter(current, lambda r: F.array_contains(F.col("due"), r["kind"]))).alias("r"))
    ledger = ledger.select("blob", "r.kind", "r.version")
    if earlier is not None and keep_earlier:
        findings = earlier.findings.where(valid).unionByName(findings)
        ledger = earlier.ledger.unionByName(ledger)
    return Scan(findings, ledger)


def blob_versions(history: DataFrame, paths: str = "path", version: str = "version") -> DataFrame:
    """(blob, path, version): which text each historical version of a path held."""
    return history.select(blob(F.col("text")).alias("blob"), F.col(paths).alias("path"), F.col(version).alias("version"))


def by_path(history: DataFrame, scanned: Scan, paths: str = "path", version: str = "version") -> DataFrame:
    """(path, version, kind, rule_version, start, end): the findings of every version of every path."""
    found = scanned.findings.withColumnRenamed("version", "rule_version")
    return blob_versions(history, paths, version).join(found, "blob").drop("blob")


def earlier_scan(spark: SparkSession, ledger: str) -> Scan | None:
    """What the runs before have left in a ledger's folder; None before the first one."""

    runs = [r[0] for r in versions.pointers(spark, ledger).select(versions.VERSION).orderBy(versions.VERSION).collect()]
    if not runs:
        return None
    folders = [f"{ledger}/versions/{versions.VERSION}={run}" for run in runs]
    return Scan(*(spark.read.parquet(*(f"{f}/{part}" for f in folders)) for part in ("findings", "pairs")))


def scan_into(docs: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES) -> Scan:
    """Scan what the ledger in a shared folder lacks, add it there, and return all findings.

    A run adds its findings and its pairs at once (``sinks.versions``): one that fails leaves
    the ledger as it was, and its texts are scanned again by the next.
    """
    spark = docs.sparkSession
    earlier = earlier_scan(spark, ledger)
    new = scan(docs, earlier, rules, keep_earlier=False)
    number, name = versions.new_version(spark, ledger)
    folder = f"{ledger}/versions/{versions.VERSION}={name}"
    new.findings.write.parquet(f"{folder}/findings")
    new.ledger.write.parquet(f"{folder}/pairs")
    # each run is a part of its own, so all stay current
    versions.point(spark.range(1).select(F.lit(name).alias("part")), ledger, number, name)
    return earlier_scan(spark, ledger)


def by_document(docs: DataFrame, scanned: Scan, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, n_<kind> of each base rule, base_sha256, spans) for each row of (doc_id, text).

    A null text counts as empty, and an empty text has no findings; rows that repeat get
    the findings each. A table without rows gives none. Further columns are ignored.
    Places are sorted by start, then in the order of the rules.
    """
    base = [r.kind for r in rules if r.base]
    ranks = F.create_map(*(F.lit(x) for i, r in enumerate(rules) for x in (r.kind, i)))
    place = F.struct("start", F.element_at(ranks, F.col("kind")).alias("rank"), "kind", "end")
    shown = lambda p: F.concat_ws(":", p["kind"], p["start"], p["end"])
    all_ = F.sort_array(F.collect_list(place))
    lists = scanned.findings.groupBy("blob").agg(
        all_.alias("all"), *(F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in base)
    )
    kept = F.filter("all", lambda p: p["kind"].isin(base))
    lists = lists.select(
        "blob", *(f"n_{k}" for k in base),
        F.concat_ws(",", F.transform(kept, shown)).alias("base"),
        F.concat_ws(",", F.transform("all", shown)).alias("spans"),
    )
    rows = docs.select("doc_id", blob(F.col("text")).alias("blob")).join(lists, "blob", "left")
    none = F.lit("")
    return rows.select(
        "doc_id", *(F.coalesce(f"n_{k}", F.lit(0).cast("long")).alias(f"n_{k}") for k in base),
        F.sha2(F.coalesce("base", none), 256).alias("base_sha256"), F.coalesce("spans", none).alias("spans"),
    )


def redacted(docs: DataFrame, scanned: Scan, mask: str = "[secret]") -> DataFrame:
    """The rows of (doc_id, text, ...) with every found place replaced by ``mask``.

    Columns and their order stay. Overlapping places are replaced as one. A row without
    findings keeps its text, a null one too.
    """
    blob_, spots_ = free(docs, "blob", "spots")
    spot = F.sort_array(F.collect_list(F.struct("start", "end")))
    spots = scanned.findings.groupBy(F.col("blob").alias(blob_)).agg(spot.alias(spots_))
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))

    def step(state: Column, p: Column) -> Column:
        gap = F.substr(F.col("text"), (state["at"] + 1).cast("int"), (p["start"] - state["at"]).cast("int"))
        new = F.struct(F.concat(state["out"], gap, F.lit(mask)).alias("out"), p["end"].alias("at"))
        inside = F.struct(state["out"].alias("out"), F.greatest(state["at"], p["end"]).alias("at"))
        return F.when(p["start"] >= state["at"], new).otherwise(inside)

    def end(state: Column) -> Column:
        return F.concat(state["out"], F.substr(F.col("text"), (state["at"] + 1).cast("int")))

    joined = docs.withColumn(blob_, blob(F.col("text"))).join(spots, blob_, "left")
    text = F.when(F.col(spots_).isNull(), F.col("text")).otherwise(F.aggregate(spots_, start, step, end))
    return joined.select(*(text.alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns))
