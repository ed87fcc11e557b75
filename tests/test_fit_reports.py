"""Reports of the fits, recomputed by hand from the fitted coefficients."""

import os

import numpy as np
import pytest

import __spark_entry__ as driver
from labelops.operators import learn
from labelops.operators.threshold import Sweep
from labelops.plans import queries
from labelops.plans import standins as s

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def f1s(tn, fp, fn, tp):
    f = lambda hit, wrong, missed: 2 * hit / (2 * hit + wrong + missed) if hit else 0.0
    return f(tp, fp, fn), f(tn, fn, fp)


def cells(y, score, t):
    p = score >= t
    return [int(x) for x in ((~y & ~p).sum(), (~y & p).sum(), (y & ~p).sum(), (y & p).sum())]


def test_gate_report(spark):
    data = queries._features(spark, SF)
    gate = learn.fit_gate(data)
    rows = data.select("split", "truth", "features").collect()
    x, y, part = np.array([r["features"] for r in rows], float), np.array([r["truth"] == 1 for r in rows]), np.array([r["split"] for r in rows])
    score = 1 / (1 + np.exp(-(x @ gate.model.coefficients.toArray() + gate.model.intercept)))
    cfg, best = Sweep(), None
    for t in cfg.grid:
        tn, fp, fn, tp = cells(y[part == "val"], score[part == "val"], t)
        fruit, other = tp / max(1, tp + fn), tn / max(1, tn + fp)
        ok = fruit >= cfg.min_fruit_recall and other >= cfg.min_other_recall
        rank = (ok, sum(f1s(tn, fp, fn, tp)) / 2, min(fruit, other), (fruit + other) / 2, fruit, other, -abs(t - 0.5), -t)
        if best is None or tuple(np.round(rank, 9)) > tuple(np.round(best[0], 9)):
            best = (rank, t)
    got = driver.queries()["fit_gate_report"](spark, SF).first()
    assert got["threshold"] == pytest.approx(best[1]) == pytest.approx(gate.threshold)
    tn, fp, fn, tp = cells(y[part == "test"], score[part == "test"], best[1])
    assert (got["tn"], got["fp"], got["fn"], got["tp"]) == (tn, fp, fn, tp)
    assert got["macro_f1"] == pytest.approx(sum(f1s(tn, fp, fn, tp)) / 2, abs=1e-6) and got["accuracy"] == pytest.approx((tn + tp) / (tn + fp + fn + tp), abs=1e-6)


def test_classes_report(spark):
    data = queries._features(spark, SF)
    model = learn.fit_classes(data, s.K).model
    rows = data.where("split = 'test'").select("label", "features").collect()
    x, y = np.array([r["features"] for r in rows], float), np.array([r["label"] for r in rows])
    found = (x @ model.coefficientMatrix.toArray().T + model.interceptVector.toArray()).argmax(1)
    for r in driver.queries()["fit_classes_report"](spark, SF).collect():
        c = r["class_idx"]
        assert [int(n) for n in r["predicted"].split(",")] == [int(((y == c) & (found == p)).sum()) for p in range(s.K)]
        hit, said, there = ((y == c) & (found == c)).sum(), (found == c).sum(), (y == c).sum()
        assert (r["precision"], r["recall"], r["support"]) == (pytest.approx(hit / said if said else 0, abs=1e-6), pytest.approx(hit / there if there else 0, abs=1e-6), there)
