"""Many files written by tasks."""

import os

import pytest
from pyspark.sql import functions as F

from stemma.sources import sinks, text_files


def found(root):
    return {os.path.relpath(f"{d}/{n}", root): open(f"{d}/{n}", encoding="utf-8").read() for d, _, names in os.walk(root) for n in names}


def test_every_row_is_a_file(spark, tmp_path):
    rows = spark.range(500).repartition(7).select(F.format_string("d%d/e %d/f%d.ini", F.col("id") % 5, F.col("id") % 3, "id").alias("path"), F.when(F.col("id") % 50 != 0, F.concat(F.lit("é\n"), "id")).alias("value"), F.lit(1).alias("other"))
    root = tmp_path / "root"
    sinks.write_files(rows, f"file://{root}")
    want = {f"d{k % 5}/e {k % 3}/f{k}.ini": f"é\n{k}" if k % 50 else "" for k in range(500)}
    assert found(root) == want
    sinks.write_files(rows.where("id = 7").withColumn("value", F.lit("new")), str(root))
    assert found(root) == want | {"d2/e 1/f7.ini": "new"} and os.listdir(tmp_path) == ["root"]
    sinks.write_files(rows.limit(0), str(root))
    assert len(found(root)) == 500


def test_a_broken_job_leaves_no_half_files(spark, tmp_path):
    """A task that fails after some files: those at their places are whole, and nothing else is left."""
    rows = spark.createDataFrame([(f"a/{k}", "x" * 10) for k in range(20)] + [("../out", "x")], "path string, value string").coalesce(1)
    with pytest.raises(Exception, match="no place"):
        text_files.write(rows, f"file://{tmp_path}/root")
    assert set(found(tmp_path).values()) <= {"x" * 10} and os.listdir(tmp_path) == ["root"]
    with pytest.raises(Exception, match="append"):
        rows.write.format("text_files").mode("overwrite").save(f"file://{tmp_path}/root")
