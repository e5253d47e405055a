"""Model files: checks, fits and predictions against whole matrices."""

import json

import numpy as np
import pytest

from stridelake.sources import models as M

FEATURES = ["b", "a", "flat"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(0)
    rows = [(i, float(a), float(b), 7.0, 3 * float(a) - 2 * float(b) + 5, float(rng.normal()), "k") for i, (a, b) in enumerate(rng.normal(3, 2, (500, 2)))]
    rows += [(500, None, 1.0, 7.0, 1.0, 1.0, "k"), (501, 1.0, float("nan"), 7.0, 1.0, 1.0, "k")]
    return spark.createDataFrame(rows, "id int, a double, b double, flat double, y double, noise double, weights string")


def test_fit_save_and_apply(spark, data, tmp_path):
    clean = data.where("id < 500")
    scaler, model = M.fit(data, FEATURES, {"force": "y", "other": "noise"})
    x = np.array([[r[f] for f in FEATURES] for r in clean.collect()])
    assert np.allclose(scaler.mean, x.mean(0)) and np.allclose(scaler.scale, [*x.std(0)[:2], 1.0])
    targets = np.array([[r["y"], r["noise"]] for r in clean.collect()])
    whole = np.concatenate((x, np.ones((500, 1))), 1)
    assert np.allclose(model.apply(scaler.apply(x)), whole @ np.linalg.lstsq(whole, targets, rcond=None)[0], atol=1e-6)
    M.save(spark, scaler, f"{tmp_path}/s.json")
    M.save(spark, model, f"{tmp_path}/m.json")
    out = M.apply_model(clean, f"{tmp_path}/s.json", f"{tmp_path}/m.json", FEATURES, ["force", "other"]).orderBy("id").collect()
    assert np.allclose([r["force"] for r in out], [r["y"] for r in out], atol=1e-6) and {r["weights"] for r in out} == {"k"}
    assert M.loads(open(f"{tmp_path}/m.json").read(), M.Model) == model


def test_wrong_order_scaler_and_version_are_refused(spark, data, tmp_path):
    scaler, model = M.fit(data, FEATURES, {"force": "y"})
    other, _ = M.fit(data.where("id > 100"), FEATURES, {"force": "y"})
    M.save(spark, scaler, f"{tmp_path}/s1.json")
    M.save(spark, other, f"{tmp_path}/s2.json")
    M.save(spark, model, f"{tmp_path}/m1.json")
    for s, features, outputs in (("s1", sorted(FEATURES), ["force"]), ("s2", FEATURES, ["force"]), ("s1", FEATURES, ["weight"])):
        with pytest.raises(Exception, match="ModelError"):
            M.apply_model(data.where("id < 9"), f"{tmp_path}/{s}.json", f"{tmp_path}/m1.json", features, outputs).collect()
    text = M.dumps(model)
    for bad in ("{", "[]", text.replace('"version": 1', '"version": 2'), text.replace("linear-force", "scaler"), json.dumps(json.loads(text) | {"features": ["a"]}), json.dumps(json.loads(text) | {"more": 1})):
        with pytest.raises(M.ModelError):
            M.loads(bad, M.Model)
    with pytest.raises(M.ModelError):
        M.loads(text, M.Scaler)
