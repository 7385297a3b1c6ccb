"""Secret scans over an incremental ledger of blobs, in DataFrame functions only.

Every version of every path is addressed by the SHA-256 of its content.  The
ledger holds, for each blob, the rule versions it has been scanned with and the
spans found; a run scans the pairs of blob and rule version that the ledger
lacks, appends them, and joins the spans of each blob back to all its paths.

A scan cuts the text at a rule's matches: the lengths of the parts and of the
matches in turn give all positions as running sums, in code points.

A null text counts as empty and has no spans.  Copies are scanned once.  Tied
spans are ordered by start, then by the order of the rules.  Extra columns are
kept by ``redact`` and left out by ``findings``; columns named ``_blob`` and
``_spans`` are taken for the ledger's.  An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from graphloom.llm.store import cut, parted, shared_folder


@dataclass(frozen=True)
class Rule:
    """``group`` must have at least ``least`` characters for a match to count."""

    kind: str
    pattern: str
    group: int
    least: int
    version: int = 1

    @property
    def id(self) -> str:
        return f"{self.kind}@{self.version}"


#: The kinds in the order in which ties are listed.  Runs of one
#: class of characters carry their least length in the pattern, which finds the
#: same runs.
RULES = (
    Rule("assign", r"""((?i)password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]{14,}", 0, 18),
    Rule("hex", r"[0-9a-f]{16,}", 0, 16),
)

LEDGER = "_blob binary, _rules array<string>, _spans array<struct<kind:string,start:bigint,end:bigint,rule:string>>"


def blob_id(text: str) -> Column:
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256))


def _cuts(text: Column, rule: Rule) -> Column:
    """For each match: code points before it since the last one, its own, and whether it counts."""
    pattern = F.lit(rule.pattern)
    parts = F.transform(F.split(text, rule.pattern, -1), F.length)
    whole = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.length)
    if rule.group:
        good = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), lambda x: F.length(x) >= rule.least)
    else:
        good = F.transform(whole, lambda n: n >= rule.least)
    return F.arrays_zip(F.slice(parts, F.lit(1), F.size(whole)).alias("gap"), whole.alias("own"), good.alias("good"))


def scan(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Ledger rows of ``_blob, _text, _todo`` (ids of the rules to apply)."""
    text = F.coalesce(F.col("_text"), F.lit(""))
    tried = blobs.select(
        "_blob",
        "_todo",
        *(F.when(F.array_contains("_todo", r.id) & text.rlike(r.pattern), _cuts(text, r)).alias(f"_cut{i}") for i, r in enumerate(rules)),
    )
    rows = F.array(*(F.struct(F.lit(r.kind).alias("kind"), F.lit(r.id).alias("rule"), F.col(f"_cut{i}").alias("cuts")) for i, r in enumerate(rules)))
    each = tried.select("_blob", "_todo", F.explode(rows).alias("r"))
    each = each.select("_blob", "_todo", "r.kind", "r.rule", F.posexplode_outer("r.cuts").alias("n", "cut"))
    upto = W.partitionBy("_blob", "kind").orderBy("n")
    end = F.sum(F.col("cut.gap").cast("bigint") + F.col("cut.own")).over(upto)
    placed = each.withColumn("end", end).withColumn("start", F.col("end") - F.col("cut.own"))
    span = F.when(F.col("cut.good"), F.struct("kind", "start", "end", "rule"))
    return placed.groupBy("_blob").agg(F.first("_todo").alias("_rules"), F.collect_list(span).alias("_spans"))


def update(docs: DataFrame, ledger: str, text: str = "text", rules: tuple[Rule, ...] = RULES, fresh: bool = False) -> None:
    """Scan what the ledger at path ``ledger`` lacks and append it.

    ``fresh`` says that there is no ledger yet."""
    spark = docs.sparkSession
    wanted = F.array(*(F.lit(r.id) for r in rules))
    blobs = docs.select(blob_id(text).alias("_blob"), F.col(text).alias("_text")).groupBy("_blob").agg(F.first("_text").alias("_text"))
    if fresh:
        todo = blobs.withColumn("_todo", wanted)
    else:
        seen = spark.read.schema(LEDGER).parquet(ledger).select("_blob", F.explode("_rules").alias("r")).groupBy("_blob").agg(F.collect_set("r").alias("_seen"))
        left = F.array_except(wanted, F.coalesce("_seen", F.array().cast("array<string>")))
        todo = blobs.join(seen, "_blob", "left").withColumn("_todo", left).where(F.size("_todo") > 0).drop("_seen")
    scan(todo, rules).write.mode("append").option("compression", "zstd").parquet(ledger)


def spans_by_blob(spark, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``_blob, _spans`` of the given rule versions, for blobs that have any;
    spans are in order and rows appended twice count once."""
    rank = F.element_at(F.create_map(*(F.lit(x) for i, r in enumerate(rules) for x in (r.id, i))), F.col("s.rule"))
    rows = spark.read.schema(LEDGER).parquet(ledger).where(F.size("_spans") > 0).select("_blob", F.explode("_spans").alias("s"))
    rows = rows.where(F.col("s.rule").isin([r.id for r in rules]))
    grouped = rows.groupBy("_blob").agg(F.array_sort(F.collect_set(F.struct(F.col("s.start").alias("start"), rank.alias("rank"), F.col("s.end").alias("end"), F.col("s.kind").alias("kind")))).alias("_spans"))
    return grouped


def findings(docs: DataFrame, key: str = "doc_id", text: str = "text", ledger: str | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per path: key, number of spans of each kind, all spans and their SHA-256."""
    folder = shared_folder(docs.sparkSession)
    path = ledger or f"{folder}/ledger"
    update(docs, path, text, rules, fresh=ledger is None)
    found = spans_by_blob(docs.sparkSession, path, rules)
    listed = F.array_join(F.transform("_spans", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def of(kind: str) -> Column:
        return F.size(F.filter("_spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    counts = [of(kind) for kind in dict.fromkeys(r.kind for r in rules)]
    digest = cut(found.select("_blob", *counts, listed.alias("spans")), "found", folder)
    paths = docs.select(F.col(key).alias(key), blob_id(text).alias("_blob"))
    joined = paths.join(digest, "_blob", "left")
    spans = F.coalesce("spans", F.lit(""))
    return joined.select(key, *(F.coalesce(f"n_{kind}", F.lit(0)).cast("bigint").alias(f"n_{kind}") for kind in dict.fromkeys(r.kind for r in rules)), F.sha2(spans.cast("binary"), 256).alias("base_sha256"), spans.alias("spans"))


def redact(docs: DataFrame, text: str = "text", mark: str = "[SECRET]", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with each maximal run of found spans in ``text`` replaced by ``mark``; columns as before."""
    folder = shared_folder(docs.sparkSession)
    update(docs, f"{folder}/ledger", text, rules, fresh=True)
    found = cut(spans_by_blob(docs.sparkSession, f"{folder}/ledger", rules), "found", folder)
    inner = [f"c{i}" for i in range(len(docs.columns))]
    own = inner[docs.columns.index(text)]
    named = docs.toDF(*inner).withColumn("_blob", blob_id(own))
    # only texts that may hold a secret are sent to the join
    holding, others = parted(named, "_blob", found)
    joined = holding.join(found, "_blob", "left")
    whole = F.col(own)

    def step(acc: Column, s: Column) -> Column:
        part = F.concat(acc["out"], F.substr(whole, acc["at"] + 1, s["start"].cast("int") - acc["at"]), F.lit(mark))
        return F.struct(F.when(s["start"] >= acc["at"], part).otherwise(acc["out"]).alias("out"), F.greatest(acc["at"], s["end"].cast("int")).alias("at"))

    begin = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    clean = F.aggregate("_spans", begin, step, lambda acc: F.concat(acc["out"], F.substr(whole, acc["at"] + 1, F.length(whole))))
    masked = joined.withColumn(own, F.when(F.col("_spans").isNull(), whole).otherwise(clean))
    return masked.select(*inner).unionByName(others.select(*inner)).toDF(*docs.columns)
