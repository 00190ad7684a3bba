import pytest

from simpairs.operators import metrics as me

TIED = [(1, .9), (0, .8), (1, .8), (1, .6), (0, .5), (0, .5), (1, .4), (0, .1)]


def _scored(spark, rows, model="m"):
    data = [(model, i, y, float(p), int(p >= 0.5)) for i, (y, p) in enumerate(rows)]
    return spark.createDataFrame(data, "model string, pair_id long, label int, probability double, predicted int")


def test_auc_and_ap_with_ties(spark):
    s = _scored(spark, TIED)
    assert me.roc_auc(s).first().roc_auc == pytest.approx(0.71875)
    assert me.average_precision(s).first().pr_auc == pytest.approx(0.747024, abs=1e-6)


def test_one_class_gives_zero(spark):
    for y in (0, 1):
        s = _scored(spark, [(y, 0.3), (y, 0.7)])
        r = me.evaluate(s).first()
        assert r.roc_auc == 0.0
        if y == 0:
            assert (r.precision, r.recall, r.f1_score, r.pr_auc) == (0.0, 0.0, 0.0, 0.0)


def test_confusion_and_report(spark):
    s = _scored(spark, TIED)
    cm = {(r.label, r.predicted): r.n for r in me.confusion_matrix(s).collect()}
    assert cm == {(1, 1): 3, (1, 0): 1, (0, 1): 3, (0, 0): 1}
    rep = {r["class"]: r for r in me.class_report(s).collect()}
    assert rep["1"].precision == pytest.approx(0.5) and rep["1"].recall == pytest.approx(0.75)
    assert rep["accuracy"].f1 == pytest.approx(0.5) and rep["weighted avg"].support == 8


def test_curve_reads_the_scored_rows_once(spark):
    s = _scored(spark, TIED)
    c = me.score_curve(s)
    # ranges, offsets and windows are made of the counts, not of the scored rows again
    assert "label" not in c._jdf.queryExecution().optimizedPlan().toString()
    assert [(r.probability, r.tp, r.fp, r.ctp, r.cfp) for r in c.orderBy(c.probability.desc()).collect()] == [
        (.9, 1, 0, 1, 0), (.8, 1, 1, 2, 1), (.6, 1, 0, 3, 1), (.5, 0, 2, 3, 3), (.4, 1, 0, 4, 3), (.1, 0, 1, 4, 4)]
