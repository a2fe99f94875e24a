"""Landing folder: writing, reading and path columns."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from cinderlog.operators.binding import bind, quarantine, valid_events
from cinderlog.sources import landing

UPLOAD = "0f8fad5b-d9cb-469f-a165-70867728950e"


def test_path_columns(spark):
    paths = [f"file:/up/logs/acme/{UPLOAD}_a_b.tar.LOG", "/up/logs/acme/plain.json", "/up/logs/acme/noext"]
    frame = landing.with_path_columns(spark.createDataFrame([(p,) for p in paths], "p string"), "p")
    assert [tuple(r)[1:] for r in frame.collect()] == [
        ("acme", UPLOAD, "a_b.tar.LOG", "log"), ("acme", None, "plain.json", "json"), ("acme", None, "noext", None),
    ]


def test_uploaded_files_are_read_back(spark, tmp_path):
    base = str(tmp_path / "logs")
    files = spark.createDataFrame([
        ("acme", "my app+1%.json", '{"logId":"1"}\n{"logId":"2"}\n'),
        ("acme", "my app+1%.json", '{"logId":"1"}\n{"logId":"2"}\n'),
        ("zeta", "x.csv", "1,h,2026-07-17T10:25:30Z,svc,i,n,p,t,INFO,windows line\r\n"),
        ("zeta", "x.yaml", "a: 1\nb: 2"),
        ("zeta", "skip.png", "??"),
    ], "client_id string, file_name string, content string")
    landing.land_files(files, base)
    uploads = landing.read_landing(spark, base).select("upload_id").distinct().collect()
    assert all(re.fullmatch(landing.UPLOAD_RE, f"{r[0]}_") for r in uploads)

    lines = landing.read_landing(spark, base)
    counts = {(r["client_id"], r["file_name"], r["tag"], r["parser"]): r["count"] for r in
              lines.groupBy("client_id", "file_name", "tag", "parser").count().collect()}
    assert counts == {
        ("acme", "my app+1%.json", "logs.json", "json"): 4, ("zeta", "x.csv", "logs.csv", "csv"): 1,
        ("zeta", "x.yaml", "logs.yaml", "raw"): 2,
    }
    bound = bind(lines, F.col("parser"), arrival=F.col("landed_at"))
    assert sorted(r["message"] or r["log_id"] for r in valid_events(bound).collect()) == ["1", "1", "2", "2", "windows line"]
    assert [r["reason"] for r in quarantine(bound).collect()] == ["unstructured"] * 2


def test_both_layouts_and_one_client(spark, tmp_path):
    base = tmp_path / "logs"
    (base / "acme").mkdir(parents=True)
    (base / "acme" / f"{UPLOAD}_x.log").write_text("put there\n")
    files = spark.createDataFrame([("acme", "x.log", "a\n"), ("zeta", "x.log", "b\n")], "client_id string, file_name string, content string")
    landing.land_files(files, str(base))
    assert sorted(r["value"] for r in landing.read_landing(spark, str(base)).collect()) == ["a", "b", "put there"]
    own = landing.read_landing(spark, str(base), client="acme")
    assert sorted((r["value"], r["client_id"], r["file_name"]) for r in own.collect()) == [("a", "acme", "x.log"), ("put there", "acme", "x.log")]
    assert all("/acme/" in f or "client_id=acme/" in f for f in own.inputFiles())


@pytest.mark.parametrize("client, name", [("../x", "a.log"), ("/abs", "a.log"), ("c", "../a.log"), ("..", "a.log"), ("c", ""), (None, "a.log")])
def test_names_cannot_leave_their_folder(spark, tmp_path, client, name):
    files = spark.createDataFrame([(client, name, "1\n")], "client_id string, file_name string, content string")
    with pytest.raises(Exception, match="not a client and file name"):
        landing.land_files(files, str(tmp_path / "logs"))
    assert not list(tmp_path.rglob("*.log"))


def test_lines_roll_over_to_new_files(spark, tmp_path):
    base = str(tmp_path / "logs")
    rows = spark.range(1000).repartition(3).select(
        F.when(F.col("id") % 3 == 0, "big").otherwise(F.concat(F.lit("c"), F.col("id") % 4)).alias("client_id"),
        F.lit("app.log").alias("file_name"), F.concat(F.lit("line "), "id").alias("line"),
    )
    landing.land_lines(rows, base, lines_per_file=50)
    back = landing.read_landing(spark, base)
    assert max(r["count"] for r in back.groupBy("file_path").count().collect()) <= 50
    assert sorted(r["value"] for r in back.collect()) == sorted(f"line {i}" for i in range(1000))


def test_parts_follow_files_and_not_tasks(spark, tmp_path):
    base = str(tmp_path / "logs")
    rows = spark.range(400).repartition(8).select(
        F.concat(F.lit("c"), F.col("id") % 5).alias("client_id"), F.lit("app.log").alias("file_name"), F.col("id").cast("string").alias("line"),
    )
    landing.land_lines(rows, base)
    assert landing.read_landing(spark, base).select("file_path").distinct().count() == 5
