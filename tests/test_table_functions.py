"""Table functions from SQL against the operators."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stridelake.functions import table_functions as T
from stridelake.operators import ranges as R
from stridelake.operators.signal import detect_peaks, filter_data


@pytest.fixture(scope="module")
def view(spark):
    rng = np.random.default_rng(0)
    rows = [(s, q, bool(rng.random() < 0.6) if rng.random() < 0.95 else None, float(rng.normal())) for s, n in ((1, 400), (2, 12), (3, 1), (None, 30)) for q in range(n)]
    order = rng.permutation(len(rows))
    spark.createDataFrame([rows[i] for i in order], "s long, q long, f boolean, x double").repartition(5).createOrReplaceTempView("udtf_samples")
    T.register(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    yield rows
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_ranges(spark, view):
    got = spark.sql("SELECT * FROM session_ranges(TABLE(SELECT s, q, f FROM udtf_samples) PARTITION BY s ORDER BY q)").collect()
    want = R.ranges(spark.table("udtf_samples"), F.col("f"), key="s", seq="q").collect()
    assert sorted(map(str, ((r["session_id"], r["start"], r["end"], r["length"]) for r in got))) == sorted(map(str, ((None if r["s"] is None else str(r["s"]), r["start"], r["end"], r["length"]) for r in want)))


def test_filter_and_peaks(spark, view):
    low = spark.sql("SELECT * FROM session_lowpass(TABLE(SELECT s, q, x FROM udtf_samples) PARTITION BY s ORDER BY (q), 6.0D)").collect()
    peaks = spark.sql("SELECT * FROM session_peaks(TABLE(SELECT s, q, x FROM udtf_samples) PARTITION BY s ORDER BY (q), 0.5D, 4)").collect()
    assert len(low) == len(view)
    for s in (1, 2, 3, None):
        x = np.array([r[3] for r in view if r[0] == s])
        name = None if s is None else str(s)
        mine = sorted((r["seq"], r["filtered"]) for r in low if r["session_id"] == name)
        assert [q for q, _ in mine] == list(range(len(x)))
        if len(x) > 15:
            assert np.allclose([v for _, v in mine], filter_data(x, "low", high=6.0))
        else:
            assert all(v is None for _, v in mine)
        at = detect_peaks(x, 0.5, 4)
        assert sorted((r["seq"], r["height"]) for r in peaks if r["session_id"] == name) == [(int(i), x[i]) for i in at]


def test_empty_table(spark, view):
    assert spark.sql("SELECT * FROM session_peaks(TABLE(SELECT s, q, x FROM udtf_samples WHERE false) PARTITION BY s ORDER BY (q), 0.5D, 4)").collect() == []
