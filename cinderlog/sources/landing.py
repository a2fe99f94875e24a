"""Landing folder: uploads below `<base>`, one level of client folders."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from cinderlog.functions import quoted
from cinderlog.operators.collector import route
from cinderlog.schema import PARSER_BY_EXTENSION

# Fixed value: a landed file name starts with its upload id and an underscore.
UPLOAD_RE = r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}_"
UPLOAD_LENGTH = 36
# Names of the folders and files that a partitioned write makes.
CLIENT_FOLDER, NAME_FOLDER = "client_id=", "file_name="
PART_RE = r"^part-\d+-([0-9a-f-]{36})"
# A name is one step of a path: no separator, no pattern, and neither `.`, `..` nor hidden.
NAME_RE = r"[^/\\{}\[\]*?,._\x00-\x1f][^/\\{}\[\]*?,\x00-\x1f]*"
LINES_PER_FILE = 100_000
FILES_PER_TRIGGER = 1_000


def path_columns(path: str) -> dict[str, str]:
    """SQL of client_id, upload_id, file_name and ext for the path column of that name.

    Two layouts are read: `<client>/<upload id>_<file name>`, as other tools put files there, and folders that Spark
    writes, `client_id=<client>/file_name=<file name>/part-<n>-<upload id>...`. A file without an upload id keeps
    its whole name, and upload_id is NULL.
    """
    last, folder, above = (f"substring_index(substring_index({path}, '/', -{n}), '/', 1)" for n in (1, 2, 3))
    written = f"startswith({folder}, {quoted(NAME_FOLDER)}) AND startswith({above}, {quoted(CLIENT_FOLDER)})"
    landed = f"{last} RLIKE {quoted(UPLOAD_RE)}"
    own_name = f"CASE WHEN {landed} THEN substr({last}, {UPLOAD_LENGTH + 2}) ELSE {last} END"
    name = f"CASE WHEN {written} THEN {_unescaped(f'substr({folder}, {len(NAME_FOLDER) + 1})')} ELSE {own_name} END"
    client = f"CASE WHEN {written} THEN {_unescaped(f'substr({above}, {len(CLIENT_FOLDER) + 1})')} ELSE nullif({folder}, '') END"
    part_id = f"nullif(regexp_extract({last}, {quoted(PART_RE)}, 1), '')"
    return {
        "client_id": client,
        "upload_id": f"CASE WHEN {written} THEN {part_id} WHEN {landed} THEN left({last}, {UPLOAD_LENGTH}) END",
        "file_name": name,
        "ext": f"CASE WHEN contains({name}, '.') THEN nullif(lower(substring_index({name}, '.', -1)), '') END",
    }


def _unescaped(name: str) -> str:
    """SQL: a folder value without the escapes that Spark writes; a plus sign stands for itself."""
    return f"CASE WHEN contains({name}, '%') THEN url_decode(replace({name}, '+', '%2B')) ELSE {name} END"


def with_path_columns(df: DataFrame, path: str) -> DataFrame:
    return df.selectExpr("*", *[f"{sql} AS {name}" for name, sql in path_columns(path).items()])


def _glob(base: str, extensions: list[str] | None, client: str | None = None) -> str:
    names = f"*.{{{','.join(extensions or PARSER_BY_EXTENSION)}}}"
    folders = "*" if client is None else f"{{{_name(client)},{CLIENT_FOLDER}{client}}}"
    return f"{base.rstrip('/')}/{folders}/{names}"


def _name(value: str) -> str:
    """A client or file name that cannot lead out of its folder, nor stand for others in a pattern."""
    if not re.fullmatch(NAME_RE, value):
        raise ValueError(f"not a name: {value!r}")
    return value


def _described(text: DataFrame) -> DataFrame:
    # the path arrives URL-encoded, where a plus sign stands for itself
    path = "_metadata.file_path"
    decoded = f"CASE WHEN contains({path}, '%') THEN url_decode(replace({path}, '+', '%2B')) ELSE {path} END"
    line = "CASE WHEN endswith(value, '\\r') THEN left(value, length(value) - 1) ELSE value END"
    lines = text.selectExpr(f"{line} AS value", f"{decoded} AS file_path", "_metadata.file_modification_time AS landed_at")
    return route(with_path_columns(lines, "file_path"))


def read_landing(
    spark: SparkSession, base: str, extensions: list[str] | None = None, client: str | None = None
) -> DataFrame:
    """All lines below `base` with path columns, parser and tag; with `client` only its folder is listed."""
    return _described(spark.read.option("lineSep", "\n").text(_glob(base, extensions, client)))


def stream_landing(
    spark: SparkSession, base: str, extensions: list[str] | None = None, max_files_per_trigger: int | None = FILES_PER_TRIGGER
) -> DataFrame:
    """The same as a stream. Files already there come first, a bounded number at a time; files must appear whole."""
    reader = spark.readStream.option("lineSep", "\n")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return _described(reader.text(_glob(base, extensions)))


def land_lines(lines: DataFrame, base: str, lines_per_file: int = LINES_PER_FILE) -> None:
    """Write rows of (client_id, file_name, line), in folders by client and file name.

    Spark's commit makes the files appear whole, and only those of one attempt of each task. A part is one upload:
    its name carries the id of the write. Lines of a file are gathered first, so that there are about as many parts as
    files and not one for each task; adaptive execution splits a large file over several tasks. A name that could lead
    out of its folder fails the write.
    """
    wrong = F.lit(False)
    for column in ("client_id", "file_name"):
        wrong = wrong | ~F.coalesce(F.col(column).rlike(f"^{NAME_RE}$"), F.lit(False))
    message = F.concat(F.lit("not a client and file name: "), F.to_json(F.struct("client_id", "file_name")))
    client = F.when(wrong, F.raise_error(message).cast("string")).otherwise(F.col("client_id"))
    (
        lines.select(client.alias("client_id"), "file_name", F.col("line").alias("value"))
        .hint("rebalance", "client_id", "file_name")
        .write.partitionBy("client_id", "file_name").mode("append").option("maxRecordsPerFile", lines_per_file).text(base)
    )


def land_files(files: DataFrame, base: str) -> None:
    """Write rows of (client_id, file_name, content); the lines of a content stay together and in order."""
    content = F.regexp_replace("content", r"\n$", "")
    land_lines(files.where("content <> ''").select("client_id", "file_name", content.alias("line")), base)
