"""An inverted index beside the log index: for each word, and each attribute, the files that hold it.

A search reads the postings of its words, meets their file lists from the shortest on, and opens only the files that are
left. Files that no run has covered yet are opened too, so a search always gives what a scan of the whole index gives.

Below its folder are `postings`, in buckets by term, and `files`, which gives each run's file numbers a name. A run's
files are written last: postings of a run that did not finish are not used.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from cinderlog.functions import quoted, text as txt
from cinderlog.operators.search import has_attribute, search, search_phrase
from cinderlog.sinks.index import FOLDER, read_index, read_parts

#: Folders of the postings; a search reads only those of its words.
BUCKETS = 64
_FILES = "run string, number int, file string"
_POSTINGS = f"term string, {FOLDER} date, n_files int, files array<int>, run string, bucket int"
_BUCKET = f"CAST(pmod(xxhash64(term), {BUCKETS}) AS INT)"

#: A word is without signs, so an attribute's term can't be taken for one.
_ATTRIBUTE_TERMS = (
    "transform(filter(attributes, a -> a.key IS NOT NULL AND a.value IS NOT NULL), a -> concat(a.key, '=', a.value))"
)


def attribute_term(key: str, value: str) -> str:
    return f"{key}={value}"


def index_files(spark: SparkSession, path: str) -> list[str]:
    """The index's files now, named from the date folder on: the list that Spark makes itself before it reads a table."""
    found = read_index(spark, path).inputFiles()
    return sorted(f[f.rindex(f"/{FOLDER}=") + 1:] for f in found)


def _table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def covered_files(spark: SparkSession, terms_path: str) -> DataFrame:
    return _table(spark, f"{terms_path}/files", _FILES)


def update_terms(spark: SparkSession, path: str, terms_path: str) -> int:
    """Cover the index's files that no run has covered, and return how many these were.

    Each task gives a word once for each of its files, so a frequent word moves no more often than there are files.
    """
    done = {r["file"] for r in covered_files(spark, terms_path).select("file").distinct().toLocalIterator()}
    new = [f for f in index_files(spark, path) if f not in done]
    if not new:
        return 0
    run = uuid.uuid4().hex
    files = spark.createDataFrame(list(enumerate(new)), "number int, file string")
    name = F.concat(F.lit(f"{FOLDER}="), F.substring_index("_metadata.file_path", f"/{FOLDER}=", -1))
    words = f"explode(array_distinct(concat(coalesce({txt.tokens('message')}, array()), coalesce({_ATTRIBUTE_TERMS}, array())))) AS term"
    terms = read_parts(spark, path, new).withColumn("file", name).selectExpr(FOLDER, "file", words).distinct()
    postings = terms.join(files, "file").groupBy("term", FOLDER).agg(
        F.count("*").cast("int").alias("n_files"), F.sort_array(F.collect_list("number")).alias("files")
    )
    (
        postings.withColumn("run", F.lit(run)).withColumn("bucket", F.expr(_BUCKET)).hint("rebalance", "bucket")
        .sortWithinPartitions("bucket", "term").write.partitionBy("run", "bucket").mode("append").parquet(f"{terms_path}/postings")
    )
    files.withColumn("run", F.lit(run)).write.partitionBy("run").mode("append").parquet(f"{terms_path}/files")
    return len(new)


def files_with(
    spark: SparkSession, terms_path: str, terms: Sequence[str], every: bool = True, since: str | None = None, until: str | None = None
) -> DataFrame:
    """The covered files (file) that hold all of the terms, or any; `since` and `until` are dates, both included."""
    wanted = sorted(set(terms))
    files = covered_files(spark, terms_path)
    lists = _table(spark, f"{terms_path}/postings", _POSTINGS).where(F.col("term").isin(*wanted)).where(
        "bucket IN ({})".format(", ".join(_BUCKET.replace("term", quoted(t)) for t in wanted))
    )
    if since is not None:
        lists = lists.where(F.col(FOLDER) >= F.lit(since).cast("date"))
    if until is not None:
        lists = lists.where(F.col(FOLDER) <= F.lit(until).cast("date"))
    # a row for each term, date and run; the shortest list comes first
    held = lists.groupBy("run", FOLDER).agg(F.array_sort(F.collect_list(F.struct("n_files", "files"))).alias("lists"))
    if every:
        met = "aggregate(slice(lists, 2, size(lists)), lists[0].files, (kept, l) -> array_intersect(kept, l.files))"
        held = held.where(F.size("lists") == len(wanted))
    else:
        met = "array_distinct(flatten(transform(lists, l -> l.files)))"
    return held.selectExpr("run", f"explode({met}) AS number").join(files, ["run", "number"]).select("file")


def opened_files(spark: SparkSession, path: str, terms_path: str, terms: Sequence[str], every: bool = True, **dates) -> list[str]:
    """The files a search has to open: those with the terms, and those that are not covered; files that are gone are not."""
    now = set(index_files(spark, path))
    done = {r["file"] for r in covered_files(spark, terms_path).select("file").distinct().toLocalIterator()}
    found = {r["file"] for r in files_with(spark, terms_path, terms, every, **dates).toLocalIterator()}
    return sorted(now - done | now & found)


def search_index(spark: SparkSession, path: str, terms_path: str, terms: Sequence[str], mode: str = "all", **dates) -> DataFrame:
    """What `search` finds in the index, opening only the files that hold the words."""
    files = opened_files(spark, path, terms_path, txt.term_words(terms), mode == "all", **dates)
    return search(read_parts(spark, path, files), terms, "message", mode)


def phrase_in_index(spark: SparkSession, path: str, terms_path: str, phrase: str, **dates) -> DataFrame:
    """What `search_phrase` finds in the index, opening only the files that hold all of its words."""
    files = opened_files(spark, path, terms_path, txt.words_of(phrase), **dates)
    return search_phrase(read_parts(spark, path, files), phrase)


def attribute_in_index(spark: SparkSession, path: str, terms_path: str, key: str, value: str, **dates) -> DataFrame:
    """The events with an attribute, opening only the files that hold it."""
    files = opened_files(spark, path, terms_path, [attribute_term(key, value)], **dates)
    return read_parts(spark, path, files).where(has_attribute(key, value))
