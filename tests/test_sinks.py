from __future__ import annotations

import tempfile

from pyspark.sql import functions as F

from shipwise.sources.sinks import save_reports, top_rows
from shipwise.plans.context import Ctx
from shipwise.plans.source_queries import write_raw_csv


def test_save_reports_skips_empty_but_writes_first(spark):
    out = tempfile.mkdtemp(prefix="shipwise-reports-")
    results = spark.createDataFrame([("m", 0.123456)], "model string, average_precision double")
    empty = results.where(F.lit(False))
    written = save_reports(out, {"training_summary": empty, "feature_importance": empty, "error_analysis": results})
    assert [w.rsplit("/", 1)[1] for w in written] == ["training_summary", "error_analysis"]
    back = spark.read.option("header", True).csv(f"{out}/error_analysis").first()
    assert back["model"] == "m"
    assert top_rows(results).first()["average_precision"] == 0.1235


def test_round_trip_csv_is_compressed(spark, tmp_path):
    write_raw_csv(Ctx(spark, "/root/testdata/sf0.001"), str(tmp_path))
    parts = [p.name for p in tmp_path.glob("*/part-*")]
    assert len(parts) >= 6 and all(p.endswith(".csv.gz") for p in parts)
