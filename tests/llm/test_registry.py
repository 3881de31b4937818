import os
import sys

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))

from oracle_check import compare  # noqa: E402

from clientele.llm import registry


def test_one_query_for_each_operator():
    assert [int(n[2:].split("_")[0]) for n in registry.QUERIES] == list(range(1, 14))


def test_parity_with_sql(spark):
    res = compare(spark, "/root/testdata/sf0.001", list(registry.ORACLE))
    assert all(v.startswith("ok") for v in res.values()), res
