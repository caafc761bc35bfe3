"""Row-wise operators accept a streaming table of files."""

from __future__ import annotations

from pyspark.sql import functions as F

from lintlake.functions import text as tx
from lintlake.operators import analysers, paths

RULE = analysers.Rule("lint", "digit", "digit", "[0-9]", "Info", "CodeStyle", "A digit")


def test_filter_detect_scan_on_a_stream(spark, table, tmp_path):
    schema = "project string, tool string, filename string, text string"
    rows = [("p", "lint", "a.py", "x\ny = 2\n"), ("p", "lint", "vendor/b.py", "3"), ("p", "lint", "c.unknown", "4")]
    table(rows, schema).write.parquet(str(tmp_path / "in"))
    rules = table([("p", "global", None, "glob", "vendor/**")], "project string, scope string, tool string, kind string, value string")
    extensions = table([], "project string, language string, suffix string")
    files = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    kept = paths.detect_languages(paths.filter_global(files, rules), extensions)
    issues = analysers.scan_issues(kept, [RULE])
    measured = kept.select("filename", tx.count_loc(F.col("text")).alias("loc"))
    for name, frame in (("stream_issues", issues), ("stream_loc", measured)):
        running = frame.writeStream.format("memory").queryName(name).outputMode("append").start()
        running.processAllAvailable()
        running.stop()
    assert [(r.filename, r.line) for r in spark.table("stream_issues").collect()] == [("a.py", 2)]
    assert [tuple(r) for r in spark.table("stream_loc").collect()] == [("a.py", 1)]
