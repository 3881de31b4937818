"""Forests fitted in parts, attributions shared out by tree, cuts and sums of boosted trees."""
import numpy as np
import pandas as pd
import pytest

from clientele.operators import leafwise as LW
from clientele.operators import modeling as ML
from clientele.operators import trees as TR
from clientele.sources import sinks


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(5)
    n = 600
    p = pd.DataFrame({"ID": np.arange(n), "x": rng.normal(size=n), "z": rng.integers(0, 4, n).astype(float), "c": rng.choice(["a", "b", "d"], n)})
    p["Response"] = ((p.x + (p.c == "b") + rng.normal(0, 0.4, n)) > 0.5).astype(int)
    p.loc[::9, "x"] = np.nan
    return spark.createDataFrame(p).repartition(3)


SPEC = ML.FeatureSpec(["x", "z"], {"c": ["a", "b", "d"]})


def test_forest_in_parts(spark, table, monkeypatch, tmp_path):
    monkeypatch.setattr(ML, "TREE_ROWS", 600 * 4)  # the driver holds 4 trees at a time
    model = ML.fit_forest(table, SPEC, ML.random_forest(10, max_depth=6))
    assert isinstance(model, ML.ForestInParts) and [n for _, n in model.parts] == [4, 4, 2]
    got = {r.ID: r for r in ML.score_customers(model, table, SPEC).collect()}
    assert len(got) == 600
    points, total = model.inputs.transform(ML.prepared(table, SPEC)), {}
    for path, n in model.parts:
        part = ML.RandomForestClassificationModel.load(path)
        for r in part.transform(points).select("ID", "probability").collect():
            total[r.ID] = total.get(r.ID, 0.0) + n * r.probability[1] / 10
    assert all(abs(got[i].Response_Probability - v) < 1e-9 and got[i].Predicted_Response == (v > 0.5) for i, v in total.items())
    hits = {r.ID: r.Response for r in table.collect()}
    assert np.mean([got[i].Predicted_Response == v for i, v in hits.items()]) > 0.8
    importance = {r.feature: r.importance for r in ML.feature_importance(model, SPEC).collect()}
    assert set(importance) == {"x", "z", "c_b", "c_d"} and sum(importance.values()) == pytest.approx(1.0)
    assert len(ML.permutation_importance(model, table, SPEC).collect()) == 2
    assert ML.evaluation_frame(model, table, SPEC).columns == ["label", "prediction", "score"]
    sinks.save_model(model, str(tmp_path / "m"))
    again = ML.ForestInParts.load(str(tmp_path / "m"))
    assert {r.ID: r.Response_Probability for r in ML.score_customers(again, table, SPEC).collect()} == pytest.approx(
        {i: r.Response_Probability for i, r in got.items()})
    sums = ML.tree_attributions(model, table, SPEC, 20).groupBy("ID").sum("attribution").collect()
    assert len(sums) == 20
    for r in sums:
        assert r[1] == pytest.approx(got[r.ID].Response_Probability, abs=1e-9)


def test_few_trees_stay_one_pipeline(table):
    assert isinstance(ML.fit_forest(table, SPEC, ML.random_forest(3, max_depth=3)), ML.PipelineModel)


@pytest.mark.parametrize("boosted", [False, True])
def test_attributions_by_tree_equal_those_by_row(table, boosted):
    classifier = ML.boosted_trees(4, 3) if boosted else ML.random_forest(6, max_depth=5)
    model = ML.pipeline(SPEC, classifier).fit(ML.prepared(table, SPEC))
    by_tree = ML.tree_attributions(model, table, SPEC, 30)
    assert by_tree.columns == ["ID", "feature", "attribution", "value"] and "FlatMapGroupsInArrow" in by_tree._jdf.queryExecution().toString()
    rows = {(r.ID, r.feature): r for r in ML.tree_attributions(model, table, SPEC, None).collect()}
    found = by_tree.collect()
    assert len(found) == 30 * 5
    for r in found:
        want = rows[r.ID, r.feature]
        assert r.attribution == pytest.approx(want.attribution, abs=1e-12) and r.value == want.value


def test_cuts_of_dummies_follow_from_counts(spark):
    rng = np.random.default_rng(2)
    n = 4000
    p = pd.DataFrame({"dummy": (rng.random(n) < 0.05) * 1.0, "rare_zero": (rng.random(n) < 0.999) * 1.0, "zeros": 0.0, "ones": 1.0,
                      "none": np.nan, "gaps": np.where(rng.random(n) < 0.3, np.nan, rng.integers(0, 2, n)), "wide": rng.normal(size=n), "three": rng.integers(0, 3, n)})
    cuts = LW.feature_cuts(spark.createDataFrame(p).repartition(3), list(p), 16)
    for c, found in zip(p, cuts):
        x = np.sort(p[c].dropna())
        want = np.unique([x[int(np.ceil(i / 15 * len(x))) - 1] for i in range(1, 15)]) if len(x) else np.array([])
        want = want[want < x[-1]] if len(x) else want
        assert found.tolist() == want.tolist(), c


def test_sums_over_uncommon_bins_are_exact():
    rng = np.random.default_rng(8)
    cell, v = rng.integers(0, 5, 9000), rng.integers(-2 ** 45, 2 ** 45, (2, 9000))
    total = np.zeros((5, 3), dtype=np.int64)
    LW._add_whole(total, cell, v[0], v[1])
    for i in range(5):
        assert total[i].tolist() == [int(v[0][cell == i].sum()), int(v[1][cell == i].sum()), int((cell == i).sum())]
