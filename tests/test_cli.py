import os

from parcelflow.__main__ import main
from parcelflow.sinks.warehouse import Warehouse

from inputs import SF_SMALL


def test_reports_job_writes_every_report(spark, scratch):
    out = os.path.join(scratch, "reports")
    assert main(["reports", "--source", f"testdata:{SF_SMALL}", "--as-of", "2001-09-01", "--out", out], spark) == 0
    written = sorted(os.listdir(out))
    assert len([w for w in written if w.startswith("q")]) == 12 and "data_quality" in written
    assert spark.read.parquet(os.path.join(out, "q04_deliveries_by_city")).count() > 0


def test_etl_job_loads_a_batch(spark, scratch, capsys):
    wh = os.path.join(scratch, "wh")
    args = ["etl", "--source", f"testdata:{SF_SMALL}", "--warehouse", wh, "--as-of", "2001-09-01", "--batch-id", "5"]
    assert main(args, spark) == 0
    assert '"records_loaded"' in capsys.readouterr().out
    assert Warehouse(spark, wh).read("fact_deliveries").count() > 0
