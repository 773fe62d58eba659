from pathlib import Path

from pyspark.sql import functions as F

from millrace import session
from millrace.session import Scratch, append_row, appended_rows, drop_scratch


def test_scratch_is_removed_on_request(spark, monkeypatch):
    monkeypatch.setattr(session, "_kept", set())
    first, second = Scratch(spark), Scratch(spark)
    df, _ = first.write(spark.range(5))
    second.write(spark.range(3))
    assert df.count() == 5
    second.drop()
    assert not Path(second.path).exists() and Path(first.path).exists()
    assert drop_scratch(spark) == 1 and not Path(first.path).exists()
    assert drop_scratch(spark) == 0


def test_appended_rows_come_back(spark, tmp_path):
    for i in range(3):
        append_row(spark, [F.lit(i).alias("n")], str(tmp_path / "log"))
    assert sorted(r["n"] for r in appended_rows(spark, "n int", str(tmp_path / "log")).collect()) == [0, 1, 2]
