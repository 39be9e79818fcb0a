"""Secret scanning with an incremental blob ledger.

Every version of every path is addressed by the SHA-256 of its content. Each rule has a version of its own, and the
ledger holds one row per (blob, rule version) that has been scanned, with what was found. A run scans one copy of each
blob with those of its rules that the ledger lacks for it, adds those rows, and joins the findings back to all paths and
versions that hold the blob. So a new or changed rule alone goes over the old blobs, and the others over new ones only.

Texts are hardly shuffled: only blobs that occur more than once or that the ledger knows decide which rows are scanned;
that list is broadcast where a count proves it small, and otherwise only texts that a filter says may be listed are
shuffled (listed.py). The ledger is as large as it is: only its addresses are compared with a run's.

Defined cases: a null text counts as the empty text; null paths and repeated rows are paths like others; a blob
without secrets has a ledger row with no spans; empty tables give empty results. Texts are scanned whole, whatever
their length. Only the named columns are read. No rules, or the same rule twice, are an error.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import bounded_batches
from daybook.llm.listed import joined
from daybook.scratch import Scratch, small

#: Rows of a list of blobs that may be broadcast (about 100 bytes each).
BROADCAST_ROWS = 200_000


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches are leftmost and do not overlap; those whose group is too short are dropped."""

    kind: str
    pattern: str
    group: int
    shortest: int
    #: Lower-case strings of which a text with a match holds one in any case; none: always search.
    needles: tuple[str, ...] = ()

    def spans(self, text: str, lowered: str) -> Iterator[tuple[int, int]]:
        if self.needles and not any(n in lowered for n in self.needles):
            return
        for m in re.compile(self.pattern, re.ASCII).finditer(text):
            if m.end(self.group) - m.start(self.group) >= self.shortest:
                yield m.span()


#: The fixed kinds, in the order of the report.
RULES = (
    Rule(
        "assign",
        "(?i:(password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        2,
        12,
        ("passw", "secret", "token", "key"),
    ),
    Rule("access", "AKIA[A-Z0-9]+", 0, 18, ("akia",)),
    # A run of 16 or more is what a greedy run of any length is, less the short ones, and is found faster.
    Rule("hex", "[0-9a-f]{16,}", 0, 16),
)


def rule_version(rule: Rule) -> str:
    """Changes with the kind, pattern or bound, so that a changed rule scans everything anew."""
    said = f"{rule.kind}\t{rule.pattern}\t{rule.group}\t{rule.shortest}"
    return hashlib.sha256(said.encode()).hexdigest()[:16]


def find(text: str, rules: tuple[Rule, ...] = RULES) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all secrets of a text in code points, by start and then in the rules' order."""
    lowered = text.lower()
    found = sorted((s, k, e) for k, r in enumerate(rules) for s, e in r.spans(text, lowered))
    return [(rules[k].kind, s, e) for s, k, e in found]


LEDGER_SCHEMA = "blob string, rule_version string, spans array<struct<kind:string,start:int,end:int>>"


def _scan(rules: tuple[Rule, ...], versions: list[str]):
    """An Arrow step from (blob, text, places of the rules that the ledger has) to a ledger row for each other rule."""
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
    schema = pa.schema([("blob", pa.string()), ("rule_version", pa.string()), ("spans", pa.list_(span))])

    def run(batches):
        for batch in batches:
            blobs, of, spans = [], [], []
            for blob, text, known in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                lowered = text.lower()
                for k, rule in enumerate(rules):
                    if k not in (known or ()):
                        blobs.append(blob)
                        of.append(versions[k])
                        spans.append([{"kind": rule.kind, "start": s, "end": e} for s, e in rule.spans(text, lowered)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(blobs, pa.string()), pa.array(of, pa.string()), pa.array(spans, pa.list_(span))], schema=schema
            )

    return run


def scan(
    history: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES, path_col: str = "path",
    text_col: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """(findings, new ledger rows) of a history of versions, one row each.

    findings: path, blob, spans for every row of history. The new rows are what this run scanned; a caller appends
    them to the ledger that it passes next time.
    """
    versions = [rule_version(r) for r in rules]
    if not rules or len(set(versions)) < len(rules):
        raise ValueError("rules must be there and differ")
    spark = history.sparkSession
    scratch = Scratch(spark, "secret-ledger")
    place = F.array_position(F.array(*map(F.lit, versions)), F.col("rule_version")).cast("int") - 1
    rows = history.select(F.col(path_col).alias("path"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("blob", F.sha2(F.encode("text", "UTF-8"), 256))
    paths = scratch.save(rows.select("path", "blob"), "paths")
    blobs = paths.groupBy("blob").agg(F.min("path").alias("scanned_at"), F.count(F.lit(1)).alias("n"))
    if ledger is None:
        seen = spark.createDataFrame([], LEDGER_SCHEMA)
        listed = blobs.where("n > 1").withColumn("known", F.expr("cast(null as array<int>)"))
    else:
        seen = ledger.where(F.col("rule_version").isin(versions)).select("blob", "rule_version", "spans")
        # Places of the rules that each blob has been scanned with.
        known = seen.groupBy("blob").agg(F.collect_set(place).alias("known"))
        listed = blobs.join(known, "blob", "left").where("n > 1 or known is not null")
    listed = scratch.save(listed.select("blob", "scanned_at", "known", F.lit(True).alias("listed")), "listed")
    lacking = F.coalesce(F.size("known"), F.lit(0)) < len(rules)
    with bounded_batches(spark):
        unseen = (
            joined(rows, listed, ["blob"], "left", BROADCAST_ROWS)
            .where(F.col("listed").isNull() | (lacking & F.col("path").eqNullSafe(F.col("scanned_at"))))
            .select("blob", "text", "known")
        )
        scanned = scratch.save(unseen.mapInArrow(_scan(rules, versions), LEDGER_SCHEMA), "scanned")
    # The same path may be there twice with the same content.
    fresh = scratch.save(scanned.groupBy("blob", "rule_version").agg(F.first("spans").alias("spans")), "fresh")
    # At most one row a rule for each blob; all spans by start, then in the rules' order.
    found = seen.unionByName(fresh).where(F.size("spans") > 0)
    placed = F.transform("spans", lambda s: F.struct(s.start.alias("start"), place.alias("place"), s.kind.alias("kind"), s.end.alias("end")))
    in_order = F.array_sort(F.flatten(F.collect_list(placed)))
    hits = found.groupBy("blob").agg(
        F.transform(in_order, lambda s: F.struct(s.kind.alias("kind"), s.start.alias("start"), s.end.alias("end"))).alias("spans")
    )
    hits = scratch.save(hits, "hits")
    none = F.expr("cast(array() as array<struct<kind:string,start:int,end:int>>)")
    findings = paths.join(small(hits, BROADCAST_ROWS), "blob", "left").select("path", "blob", F.coalesce("spans", none).alias("spans"))
    findings = scratch.save(findings, "findings")
    scratch.drop("paths", "listed", "scanned", "hits")
    return findings, fresh


def scan_in_runs(
    history: DataFrame, runs: int = 2, rules: tuple[Rule, ...] = RULES, path_col: str = "path", text_col: str = "text"
) -> DataFrame:
    """The findings of a history that arrives in so many runs, dealt by hash of the path: each adds to the ledger, and the
    next one scans only what it lacks."""
    run_of = F.pmod(F.xxhash64(path_col), F.lit(runs))
    ledger, found = None, None
    for k in range(runs):
        findings, fresh = scan(history.where(run_of == k), ledger, rules, path_col, text_col)
        ledger = fresh if ledger is None else ledger.unionByName(fresh)
        found = findings if found is None else found.unionByName(findings)
    return found


def digest_columns(findings: DataFrame) -> DataFrame:
    """doc_id, counts by kind, and all spans as kind:start:end text with its SHA-256."""
    said = F.array_join(
        F.transform("spans", lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ","
    )
    kinds = [F.expr(f"cast(size(filter(spans, s -> s.kind = '{r.kind}')) AS long)").alias(f"n_{r.kind}") for r in RULES]
    return findings.select(
        F.col("path").alias("doc_id"), *kinds, F.sha2(F.encode(said, "UTF-8"), 256).alias("base_sha256"), said.alias("spans")
    )
