"""CSV source with delimiter detection, sinks, preview, model round trip."""
import os
import tempfile

import pandas as pd
from pyspark.sql import functions as F

from clientele.sources import csv as CSV
from clientele.sources import sinks


ROWS = pd.DataFrame({"ID": [1, 2, 3], "Year_Birth": [1970, 1985, 1990], "Income": [50000.5, None, 72000.0],
                     "Dt_Customer": ["2012-09-04", "2013-03-08", "xx"], "Response": [1, 0, 0]})


def _write(sep: str) -> str:
    d = tempfile.mkdtemp(prefix="clientele-csv-")
    p = os.path.join(d, "customers.csv")
    ROWS.to_csv(p, sep=sep, index=False)
    return p


def test_csv_variants_detected(spark):
    for sep in [";", ",", "\t", "|"]:
        p = _write(sep)
        assert CSV.detect_delimiter(spark, p) == sep
        df = CSV.read_customers_csv(spark, p, sep=";")
        assert df.columns == list(ROWS.columns)
        assert df.count() == 3
        assert df.where(F.col("Income").isNull()).count() == 1


def test_write_and_read_back(spark):
    out = tempfile.mkdtemp(prefix="clientele-out-")
    df = spark.createDataFrame(ROWS.drop(columns=["Income"]))
    sinks.write_table(df, os.path.join(out, "t"), "csv")
    back = spark.read.option("header", True).csv(os.path.join(out, "t"))
    assert back.count() == 3
    sinks.write_table(df, os.path.join(out, "p"))
    assert spark.read.parquet(os.path.join(out, "p")).count() == 3
    sinks.save_feature_list(spark, ["b", "a", "c"], os.path.join(out, "f"))
    assert sinks.load_feature_list(spark, os.path.join(out, "f")) == ["b", "a", "c"]


def test_preview_is_top_k(spark):
    df = spark.range(0, 1000).select((999 - F.col("id")).alias("ID"))
    rows = sinks.preview(df, 5).collect()
    assert [r.ID for r in rows] == [0, 1, 2, 3, 4]
    plan = sinks.preview(df, 5)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_model_round_trip_and_scoring(spark):
    from clientele.operators import modeling as ML
    from clientele.plans import catalog
    f = catalog.feat(spark, "/root/testdata/sf0.001")
    spec = ML.FeatureSpec.from_frame(f)
    model = ML.pipeline(spec, ML.random_forest(10)).fit(ML.prepared(f, spec))
    out = tempfile.mkdtemp(prefix="clientele-model-")
    sinks.save_model(model, os.path.join(out, "m"))
    loaded = sinks.load_model(os.path.join(out, "m"))
    a = ML.score_customers(model, f, spec).orderBy("ID").collect()
    b = ML.score_customers(loaded, f, spec).orderBy("ID").collect()
    assert a == b and len(a) == f.count()
    assert all(0.0 <= r.Response_Probability <= 1.0 for r in a)


def test_required_columns_and_types(spark):
    from clientele.operators import quality as QA
    df = spark.createDataFrame([(1, "1970", 1)], "ID long, Year_Birth string, Response int")
    assert [r.column for r in QA.missing_required(df).collect()] == ["Income", "Dt_Customer"]
    assert [r.column for r in QA.missing_required(df, QA.REQUIRED_APP).collect()] == ["Income"]
    assert not QA.type_check(df, "Year_Birth")


def test_csv_columns_go_by_name_and_bad_rows_are_counted(spark, tmp_path):
    from clientele.sources.csv import CUSTOMER_SCHEMA, bad_rows, read_customers_csv
    names = [f.name for f in CUSTOMER_SCHEMA.fields][::-1] + ["Extra"]
    line = lambda **own: ";".join(str(own.get(n, 0)) for n in names)
    lines = [";".join(names), line(ID=1, AcceptedCmp1=1, Education="PhD", Extra="e"), line(ID=2, AcceptedCmp3=1), "1;2;3", line(ID="x")]
    path = tmp_path / "customers.csv"
    path.write_text("\n".join(lines) + "\n")
    got = {r.ID: r for r in read_customers_csv(spark, str(path), schema=CUSTOMER_SCHEMA).collect()}
    assert set(got) == {1, 2} and got[1].Education == "PhD" and got[1].Extra == "e"
    assert (got[1].AcceptedCmp1, got[1].AcceptedCmp3, got[2].AcceptedCmp1, got[2].AcceptedCmp3) == (1, 0, 0, 1)
    assert bad_rows(spark, str(path)).first()[0] == 2
