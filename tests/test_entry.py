"""Driver contract and oracle parity on the smallest scale."""
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle_check import compare  # noqa: E402

SF001 = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) >= 1
    assert df.columns[:3] == ["RFM_Segment", "Age", "Income"]


def test_every_query_has_a_callable(spark):
    import __spark_entry__ as E
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 60


def test_oracle_parity_sf0001(spark):
    from clientele.plans import catalog
    res = compare(spark, SF001, list(catalog.ORACLE))
    bad = {k: v for k, v in res.items() if not v.startswith("ok") or "TYPES" in v}
    assert not bad, bad


def test_changed_input_is_read_again(spark, tmp_path):
    """The cached customer table follows the state of the input files."""
    import shutil
    from clientele.plans import catalog
    for name in os.listdir(SF001):
        shutil.copyfile(os.path.join(SF001, name), tmp_path / name)
    before = catalog.base(spark, str(tmp_path)).count()
    fewer = spark.read.parquet(f"{SF001}/customer.parquet").limit(10).toPandas()
    fewer.to_parquet(tmp_path / "customer.parquet")
    assert catalog.base(spark, str(tmp_path)).count() == 10 < before
