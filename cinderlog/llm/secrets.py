"""Secret scans over a ledger of contents.

Every text is named by its SHA-256. The ledger holds, for each content and version of the rules, the spans found
in it; a run scans only contents that the ledger lacks for its version, however many documents or earlier
versions share them, and the findings are joined back to all of them. All of it is SQL expressions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, functions as F

from cinderlog.functions import quoted
from cinderlog.llm.common import unused
from cinderlog.session import freeze


@dataclass(frozen=True)
class Rule:
    """Matches of `pattern` whose group `group` has `least` characters or more."""

    name: str
    pattern: str
    group: int = 0
    least: int = 0


#: Names and patterns are fixed values; the first three are the base rules. Spans are listed in this order. None of the
#: patterns starts again within a run it has read in vain, or repeats a group without a bound, which long texts would punish.
RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("web_token", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ ){0,8}PRIVATE KEY-----"),
)
BASE = 3
#: Change this with any rule: contents are then scanned again.
RULE_VERSION = "1.1"

SPANS = "array<struct<start:int,kind:int,end:int>>"
LEDGER = f"blob string, rule_version string, spans {SPANS}"
MASK = "[SECRET]"


def blob_of(text: str) -> str:
    """SQL: the name of a content; a null text has that of the empty one."""
    return f"sha2(encode(coalesce({text}, ''), 'UTF-8'), 256)"


def spans_of(text: str, rule: Rule, kind: int) -> str:
    """SQL: spans of a rule's matches, leftmost and not overlapping, in code points.

    The texts between the matches and the matches themselves alternate, so their lengths give the places.
    """
    pattern = quoted(rule.pattern)
    zipped = (
        f"arrays_zip(split({text}, {pattern}, -1) AS p, regexp_extract_all({text}, {pattern}, 0) AS m, "
        f"regexp_extract_all({text}, {pattern}, {rule.group}) AS g)"
    ).replace(" AS p", "").replace(" AS m", "").replace(" AS g", "")
    start = "a.pos + length(x.`0`)"
    end = f"{start} + length(x.`1`)"
    found = f"array_append(a.found, named_struct('start', {start}, 'kind', {kind}, 'end', {end}))"
    return (
        f"CASE WHEN {text} RLIKE {pattern} THEN aggregate({zipped}, "
        f"CAST(named_struct('pos', 0, 'found', array()) AS struct<pos:int,found:{SPANS}>), (a, x) -> "
        f"CASE WHEN x.`1` IS NULL THEN a ELSE CAST(named_struct('pos', {end}, 'found', "
        f"CASE WHEN length(x.`2`) >= {rule.least} THEN {found} ELSE a.found END) AS struct<pos:int,found:{SPANS}>) END, "
        f"a -> a.found) ELSE CAST(array() AS {SPANS}) END"
    )


def scan(blobs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Add `spans`: what all rules find in a text, by start and then by rule."""
    found = [spans_of(f"`{text}`", rule, kind) for kind, rule in enumerate(rules)]
    return blobs.withColumn("spans", F.expr(f"array_sort(concat({', '.join(found)}))"))


def read_ledger(spark, path: str) -> DataFrame:
    """The ledger at `path`; one that was not written yet is empty."""
    try:
        return spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def update_ledger(docs: DataFrame, path: str, text: str = "text", rules=RULES, version: str = RULE_VERSION) -> DataFrame:
    """Scan the contents of `docs` that the ledger lacks for this version, add them, and return the ledger.

    Contents are collected before texts move, so that a content which many rows share moves once for each task.
    """
    spark = docs.sparkSession
    known = read_ledger(spark, path).where(F.col("rule_version") == version).select("blob")
    contents = docs.select(F.expr(blob_of(f"`{text}`")).alias("blob"), F.coalesce(text, F.lit("")).alias("text"))
    unseen = contents.groupBy("blob").agg(F.first("text").alias("text")).join(known, "blob", "left_anti")
    scan(unseen, rules=rules).select("blob", F.lit(version).alias("rule_version"), "spans").write.mode("append").parquet(path)
    return read_ledger(spark, path)


def of_version(ledger: DataFrame, version: str = RULE_VERSION) -> DataFrame:
    """One row per content, blob and spans, of one version; runs that overlapped may have added a content twice.

    Written once, so that a join by blob shuffles both of its sides and adaptive execution can split a content that very
    many documents share; right above an aggregation by the same key it could not.
    """
    rows = ledger.where(F.col("rule_version") == version).groupBy("blob").agg(F.first("spans").alias("spans"))
    return freeze(rows, "ledger")


def named_spans(spans: str, rules: tuple[Rule, ...] = RULES) -> str:
    """SQL: spans as kind:start:end, joined by commas."""
    names = ", ".join(quoted(r.name) for r in rules)
    return f"array_join(transform({spans}, s -> concat(array({names})[s.kind], ':', s.start, ':', s.end)), ',')"


def findings(
    docs: DataFrame, ledger: DataFrame, key: str = "doc_id", text: str = "text", rules=RULES, version: str = RULE_VERSION
) -> DataFrame:
    """One row per document: key, blob and the spans that the ledger has for its content.

    Repeated rows each get their row; a null text is empty. A content that the ledger lacks has null spans.
    """
    paths = docs.select(key, F.expr(blob_of(f"`{text}`")).alias("blob"))
    return paths.join(of_version(ledger, version), "blob", "left")


def report(found: DataFrame, key: str = "doc_id", rules=RULES) -> DataFrame:
    """Counts of the base rules, the digest of their spans, and all spans, for each row of `findings`."""
    counts = [f"CAST(size(filter(spans, s -> s.kind = {k})) AS BIGINT) AS n_{rules[k].name}" for k in range(BASE)]
    base = named_spans(f"filter(spans, s -> s.kind < {BASE})", rules)
    return found.selectExpr(
        f"`{key}`", *counts, f"sha2({base}, 256) AS base_sha256", f"{named_spans('spans', rules)} AS spans"
    )


def masked(text: str, spans: str) -> str:
    """SQL: the text with every stretch that spans cover, alone or together, put as one mask."""
    state = "struct<upto:int,out:string>"
    return (
        f"aggregate({spans}, CAST(named_struct('upto', 0, 'out', '') AS {state}), (a, s) -> "
        "CASE WHEN s.end <= a.upto THEN a WHEN a.upto > s.start THEN "
        f"CAST(named_struct('upto', s.end, 'out', a.out) AS {state}) ELSE CAST(named_struct('upto', s.end, 'out', "
        f"concat(a.out, substring({text}, a.upto + 1, s.start - a.upto), {quoted(MASK)})) AS {state}) END, "
        f"a -> concat(a.out, substring({text}, a.upto + 1)))"
    )


def redact(docs: DataFrame, ledger: DataFrame, text: str = "text", n_chars: str = "n_chars", version: str = RULE_VERSION) -> DataFrame:
    """The documents with their secrets masked, and n_chars, if there is one, counted anew where text changed."""
    blob, spans = unused(docs, "blob"), unused(docs, "spans")
    found = of_version(ledger.where(F.size("spans") > 0), version).select(F.col("blob").alias(blob), F.col("spans").alias(spans))
    joined = docs.join(found, F.expr(blob_of(f"`{text}`")) == found[blob], "left")
    changed = found[blob].isNotNull()
    new = F.expr(masked(f"`{text}`", f"`{spans}`"))
    columns = {text: F.when(changed, new).otherwise(docs[text])}
    if n_chars in docs.columns:
        kind = docs.schema[n_chars].dataType
        columns[n_chars] = F.when(changed, F.length(new).cast(kind)).otherwise(docs[n_chars])
    return joined.select(*[columns.get(c, docs[c]).alias(c) for c in docs.columns])
