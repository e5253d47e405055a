"""Every recording is ranked, as by plain ranks and correlations."""

import numpy as np


def ranks(x):
    return np.array([(x < v).sum() + ((x == v).sum() + 1) / 2 for v in x])


def test_every_recording_is_ranked(spark, tmp_path):
    from stridelake.plans.aggregate_queries import spearman_rank_all

    rng = np.random.default_rng(5)
    rows = [(k, int(rng.integers(0, 3)), np.round(rng.normal(size=64), 1).tolist()) for k in range(1, 42)]
    spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    vectors = {k: np.array(v, np.float32).astype(float) for k, _, v in rows}
    means = {c: ranks(np.round(np.mean([vectors[k] for k, label, _ in rows if label == c], axis=0), 9)) for c in {r[1] for r in rows}}
    wanted = {(k, c): np.corrcoef(ranks(vectors[k]), m)[0, 1] for k in vectors for c, m in means.items()}
    found = spearman_rank_all(spark, str(tmp_path)).collect()
    assert {(r["vec_id"], r["label"]) for r in found} == set(wanted) and len(found) == len(wanted)
    assert all(abs(r["rho"] - wanted[r["vec_id"], r["label"]]) < 0.01 for r in found)
    for k in vectors:
        own = sorted((r for r in found if r["vec_id"] == k), key=lambda r: r["place"])
        assert [r["place"] for r in own] == [1, 2, 3] and [r["rho"] for r in own] == sorted((r["rho"] for r in own), reverse=True)
