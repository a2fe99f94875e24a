"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cinderlog.llm import (
    decontaminate, extraction, fixity, language, licenses, manifest, packing, quality, secrets,
    simhash, substrings, tokens, toxicity,
)
from cinderlog.llm.common import table
from cinderlog.session import work_path


def op1_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The article of every page."""
    pages = table(spark, sf_dir, "pages")
    return extraction.extract(pages, extraction.train(pages))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    forest = quality.train(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))
    return quality.assess(docs, forest)


#: The chain: junk first, then toxic documents, then those that are both.
_CATEGORIES = {"junk": "quality = 0", "toxic": "toxic = 1", "toxic_junk": "toxic = 1 AND quality = 0"}


def op4_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probabilities of every document, and whether it is toxic."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    chain = toxicity.train(docs, table(spark, sf_dir, "labels"), _CATEGORIES)
    return toxicity.score(docs, chain).withColumn("toxic", F.col("p_toxic") >= 0.5)


def op5_license_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence sentences and licences of every document."""
    return licenses.scan(table(spark, sf_dir, "documents", "doc_id", "text"))


def op6_packed_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every piece of every document."""
    return packing.pack(table(spark, sf_dir, "documents", "doc_id", "text"))


def op7_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, by way of a new ledger of their contents."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    ledger = secrets.update_ledger(docs, work_path(spark, "secret-ledger"))
    return secrets.report(secrets.findings(docs, ledger))


def op8_language_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from those that are not held out."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    return language.identify(docs, language.train(docs, language.held_out()))


def op9_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark hits and verdict of every document."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return decontaminate.contamination(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


#: The damage done to the second replica, on a column `record`: every fiftieth page has its middle character replaced,
#: every hundredth or so is lost.
_CHANGED, _LOST = "record_id % 50 = 7", "record_id % 101 = 13"
_DAMAGED = (
    "concat(substring(record, 1, length(record) DIV 2), "
    "CASE WHEN substring(record, length(record) DIV 2 + 1, 1) = '~' THEN '-' ELSE '~' END, "
    "substring(record, length(record) DIV 2 + 2))"
)


def op10_merkle_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as WARC records, against a replica in which some are changed or lost: the records that the audit finds."""
    pages = table(spark, sf_dir, "pages")
    stored = fixity.archive(pages, "page_id", F.expr(fixity.warc_record("url", "html")))
    replica = stored.where(f"coalesce(NOT ({_LOST}), true)").withColumn(
        "record", F.expr(f"CASE WHEN {_CHANGED} THEN {_DAMAGED} ELSE record END")
    )
    found = fixity.audit(fixity.build_tree(stored), fixity.build_tree(replica))
    return found.select(
        F.col("record_id").alias("page_id"), "status", F.col("length_a").alias("length"),
        F.col("digest_a").alias("stored_sha256"), F.col("digest_b").alias("found_sha256"),
    )


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How two vocabularies' tokens of every document go together, by counts over all documents."""
    return tokens.alignment(table(spark, sf_dir, "documents", "doc_id", "text")).documents


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, proof and folded root of every document, half of them tampered with."""
    return manifest.audit(table(spark, sf_dir, "documents", *manifest.FIELDS))


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of windows that are found elsewhere too."""
    cut = substrings.remove_repeats(table(spark, sf_dir, "documents", "doc_id", "text"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


REGISTERED = (
    op1_simhash_groups, op2_main_text, op3_quality_rules, op4_toxicity_chain, op5_license_sentences,
    op6_packed_sequences, op7_secret_ledger, op8_language_bayes, op9_contamination, op10_merkle_fixity,
    op11_token_alignment, op12_merkle_manifest, op13_substring_dedup,
)



def _sql_text(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _rule_pattern(sentences: tuple[str, ...]) -> str:
    """A pattern over identifiers that each stand between commas; its groups hold what stands between the sentences."""
    return "((?:,[^,]+,)*?)".join(f",{s}," for s in sentences)


def _license_sql() -> str:
    """The licence scan with the functions of the oracle's own engine."""
    known = licenses.known_sentences()
    keys, values = (f"[{', '.join(map(_sql_text, x))}]" for x in (known, known.values()))
    normal = "trim(regexp_replace(lower({}), '[^a-z0-9]+', ' ', 'g'))"
    state = "list_aggregate(list_transform(ids, lambda i: ',' || i || ','), 'string_agg', '')"
    for name, sentences in licenses.RULES:
        put = f",<{name}>," + "".join(f"\\{i}" for i in range(1, len(sentences)))
        state = f"regexp_replace({state}, {_sql_text(_rule_pattern(sentences))}, {_sql_text(put)}, 'g')"
    return f"""
WITH known AS (SELECT map({keys}, {values}) AS m),
parts AS (
  SELECT doc_id, unnest(regexp_split_to_array(text, {_sql_text(licenses.SENTENCE_END)})) AS s,
         generate_subscripts(regexp_split_to_array(text, {_sql_text(licenses.SENTENCE_END)}), 1) AS i
  FROM documents
), lines AS (
  SELECT doc_id, i, CASE WHEN m[{normal.format('s')}] IS NOT NULL THEN [m[{normal.format('s')}]]
    ELSE list_filter(list_transform(string_split(s, chr(10)), lambda l: m[{normal.format('l')}]), lambda x: x IS NOT NULL)
    END AS found
  FROM parts, known
), named AS (
  SELECT doc_id, flatten(list(found ORDER BY i)) AS ids FROM lines GROUP BY doc_id
), judged AS (
  SELECT doc_id, coalesce(ids, []) AS ids, coalesce(CASE WHEN len(ids) > 0 THEN {state} END, '') AS state
  FROM documents LEFT JOIN named USING (doc_id)
)
SELECT doc_id, coalesce(list_aggregate(ids, 'string_agg', ','), '') AS sentence_ids,
  coalesce(list_aggregate(list_sort(list_distinct(regexp_extract_all(state, '<([^>]+)>', 1))), 'string_agg', ','), '') AS licenses,
  CAST(len(regexp_extract_all(state, ',([a-z0-9_]+),', 1)) AS BIGINT) AS n_unmatched
FROM judged"""


_FIXITY_SQL = """
WITH records AS (
  SELECT page_id, concat('WARC/1.1', chr(13), chr(10), 'WARC-Type: resource', chr(13), chr(10), 'WARC-Target-URI: ',
    coalesce(url, ''), chr(13), chr(10), 'Content-Type: text/html', chr(13), chr(10), 'Content-Length: ',
    octet_length(encode(coalesce(html, ''))), chr(13), chr(10), chr(13), chr(10), coalesce(html, ''), chr(13), chr(10),
    chr(13), chr(10)) AS r
  FROM pages WHERE page_id % 50 = 7 OR page_id % 101 = 13
)
SELECT page_id, CASE WHEN page_id % 101 = 13 THEN 'missing' ELSE 'changed' END AS status,
  octet_length(encode(r)) AS length, sha256(r) AS stored_sha256,
  CASE WHEN page_id % 101 <> 13 THEN sha256(concat(substring(r, 1, length(r) // 2),
    CASE WHEN substring(r, length(r) // 2 + 1, 1) = '~' THEN '-' ELSE '~' END, substring(r, length(r) // 2 + 2))) END AS found_sha256
FROM records"""


def _manifest_sql() -> str:
    """Trees level by level, and each document's way up them, by recursion."""
    def leaf(text: str) -> str:
        values = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
        return "sha256(concat(" + ", ".join(f"coalesce(concat(strlen({v}), ':', {v}), '-')" for v in values) + "))"

    # DuckDB has no CRC-32: its polynomial, bit by bit, over the digits of the number
    crc = """list_reduce([4294967295::BIGINT] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT)),
      lambda a, d: list_reduce([xor(a, d)] || [0::BIGINT, 0, 0, 0, 0, 0, 0, 0],
        lambda b, z: CASE WHEN b % 2 = 1 THEN xor(b >> 1, 3988292384::BIGINT) ELSE b >> 1 END))"""
    def tree(name: str, leaves: str) -> str:
        return f"""{name} AS (
  SELECT g, 0 AS level, i, n, h FROM {leaves}
  UNION ALL
  SELECT g, level + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM {name} WHERE n > 1
  GROUP BY g, level, i // 3, n
)"""

    def fold(name: str, start: str, nodes: str) -> str:
        return f"""{name} AS (
  SELECT doc_id, g, 0 AS level, i, n, cur, proof FROM {start}
  UNION ALL
  SELECT f.doc_id, f.g, f.level + 1, f.i // 3, (f.n + 2) // 3,
    sha256(string_agg(CASE WHEN t.i = f.i THEN f.cur ELSE t.h END, '' ORDER BY t.i)),
    concat(f.proof, coalesce(string_agg(t.h, '' ORDER BY t.i) FILTER (t.i <> f.i), ''))
  FROM {name} f JOIN {nodes} t ON t.g IS NOT DISTINCT FROM f.g AND t.level = f.level AND t.i // 3 = f.i // 3
  WHERE f.n > 1 GROUP BY f.doc_id, f.g, f.level, f.i, f.n, f.cur, f.proof
)"""

    return f"""WITH RECURSIVE leaves AS (
  SELECT doc_id, source AS g, {leaf('text')} AS h, CASE WHEN xor({crc}, 4294967295::BIGINT) % 2 = 0
    THEN {leaf("replace(text, chr(10), '')")} ELSE {leaf('text')} END AS cur, '' AS proof,
    row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS i, count(*) OVER (PARTITION BY source) AS n
  FROM documents
), {tree('own', 'leaves')}, tops AS (
  SELECT 0 AS g, g AS name, h, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM own WHERE n = 1
), {tree('top', 'tops')}, {fold('up', 'leaves', 'own')}, ends AS (
  SELECT doc_id, 0 AS g, tops.i, tops.n, cur, proof FROM up JOIN tops ON name IS NOT DISTINCT FROM up.g WHERE up.n = 1
), {fold('over', 'ends', 'top')}
SELECT l.doc_id, l.h AS leaf, t.h AS subroot, r.h AS root, sha256(o.proof) AS proof_sha256, o.cur AS folded_root, o.cur = r.h AS verified
FROM leaves l JOIN tops t ON t.name IS NOT DISTINCT FROM l.g JOIN over o ON o.doc_id = l.doc_id AND o.n = 1 CROSS JOIN (SELECT h FROM top WHERE n = 1) r"""


ORACLES = {"op12_merkle_manifest": _manifest_sql(), "op5_license_sentences": _license_sql(), "op10_merkle_fixity": _FIXITY_SQL}
