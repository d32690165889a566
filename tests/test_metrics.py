"""Metrics (E1, E3-E6) against the fixture and MLlib."""
import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator

from bagwise.operators import metrics as met

# (prediction, label) rows of FIXTURES.md section 3
ROWS = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (2.0, 1.0), (3.0, 1.0), (0.0, 2.0)]


@pytest.fixture
def pred(spark):
    return spark.createDataFrame(ROWS, "prediction double, label double")


def test_per_class_fixture(pred):
    pc = {r["label"]: r for r in met.per_class(pred).collect()}
    assert sorted(pc) == [0.0, 1.0, 2.0]
    assert abs(pc[0.0]["f1"] - 0.5) < 1e-12
    assert abs(pc[1.0]["f1"] - 0.4) < 1e-12
    assert pc[2.0]["f1"] == 0.0
    assert (pc[1.0]["tp"], pc[1.0]["fp"], pc[1.0]["fn"], pc[1.0]["support"]) == (1, 1, 2, 3)


def test_summary_fixture(pred):
    s = met.summary(pred).first()
    assert abs(s["macro_f1"] - 0.3) < 1e-12
    assert abs(s["weighted_f1"] - 0.366667) < 1e-6
    assert abs(s["accuracy"] - 1 / 3) < 1e-12
    assert s["n_rows"] == 6
    assert abs(met.accuracy(pred).first()["accuracy"] - 1 / 3) < 1e-12


def test_against_mllib(spark, pred):
    from pyspark.mllib.evaluation import MulticlassMetrics
    m = MulticlassMetrics(pred.rdd.map(lambda r: (r[0], r[1])))
    pc = {r["label"]: r["f1"] for r in met.per_class(pred).collect()}
    for lab in m.call("labels"):
        assert abs(pc[lab] - m.fMeasure(lab, 1.0)) < 1e-12
    assert abs(met.weighted_f1(pred).first()[0] - m.weightedFMeasure()) < 1e-12
    ev = MulticlassClassificationEvaluator(metricName="f1")
    assert abs(met.weighted_f1(pred).first()[0] - ev.evaluate(pred)) < 1e-12
    ev = MulticlassClassificationEvaluator(metricName="accuracy")
    assert abs(met.accuracy(pred).first()[0] - ev.evaluate(pred)) < 1e-12


def test_confusion_keeps_every_row(pred):
    cm = met.confusion_matrix(pred)
    assert cm.columns == ["label", "p_0", "p_1", "p_2", "p_3"]
    rows = {r["label"]: (r["p_0"], r["p_1"], r["p_2"], r["p_3"]) for r in cm.collect()}
    assert rows == {0.0: (1, 1, 0, 0), 1.0: (0, 1, 1, 1), 2.0: (1, 0, 0, 0)}
    assert sum(sum(v) for v in rows.values()) == 6


def test_rule_prediction_cells(spark):
    from bagwise.plans import catalog
    p = catalog.rule_predictions(spark, "/root/testdata/sf0.01")
    cells = {(r["label"], r["prediction"]): r["n"] for r in met.confusion_cells(p).collect()}
    assert cells == {(0.0, 0.0): 12, (0.0, 1.0): 46, (1.0, 0.0): 103, (1.0, 1.0): 238}
    s = met.summary(p).first()
    assert abs(s["macro_f1"] - 0.450164) < 1e-6
    assert abs(s["weighted_f1"] - 0.671057) < 1e-6
    assert abs(s["accuracy"] - 0.626566) < 1e-6
