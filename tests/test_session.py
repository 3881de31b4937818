import pytest
from pyspark.sql import functions as F

from clientele.session import freeze


def test_freeze_runs_one_job(spark):
    sc = spark.sparkContext
    df = spark.range(5).select("id", F.lit("x").alias("name"), F.array("id").alias("list"), F.struct("id").alias("one"))
    sc.setJobGroup("test_freeze", "freeze")
    try:
        out = freeze(df)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert len(sc.statusTracker().getJobIdsForGroup("test_freeze")) == 1
    assert out.dtypes == df.dtypes and all(f.nullable for f in out.schema)
    assert sorted(out.collect()) == sorted(df.collect())


@pytest.mark.parametrize("rows", [[], [(None, None), (1, "a"), (1, "a")]])
def test_freeze_keeps_rows(spark, rows):
    df = spark.createDataFrame(rows, "a int, b string")
    assert sorted(freeze(df).collect(), key=str) == sorted(df.collect(), key=str)
