"""Queries against their SQL on small tables that hold what the test tables lack."""

import datetime as dt

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq

from stridelake.plans import catalog
from tests.test_oracle import as_rows


def same(spark, folder, name: str, **tables: pa.Table) -> list:
    """Rows of the query on the tables, after a comparison with its SQL."""
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for t, rows in tables.items():
        pq.write_table(rows, f"{folder}/{t}.parquet")
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    df = catalog.QUERIES[name](spark, str(folder))
    rows, found = df.collect(), con.sql(catalog.ORACLE_SQL[name])
    assert as_rows(df.columns, rows) == as_rows(found.columns, found.fetchall())
    return rows


def events(*sessions: list[float], kind: str = "click") -> pa.Table:
    """Sessions of the values, a second apart."""
    begin = dt.datetime(2024, 1, 1)
    rows = [(u, k, v) for u, values in enumerate(sessions) for k, v in enumerate(values)]
    return pa.table({
        "event_id": pa.array(range(len(rows)), pa.int64()), "ts": pa.array([begin + dt.timedelta(seconds=k) for _, k, _ in rows], pa.timestamp("us")), "user_id": pa.array([u for u, _, _ in rows], pa.int64()),
        "event_type": pa.array([kind] * len(rows)), "value": pa.array([v for _, _, v in rows], pa.float64()), "props": pa.array([None] * len(rows), pa.string()),
    })


def test_decay_of_zeros(spark, tmp_path):
    """A session that begins with zero, one with a zero later, one with both, and plain ones."""
    plain = [5.0, 4, 3, 2, 1, 2, 3]
    rows = same(spark, tmp_path, "decay_outliers", events=events([0.0, 1, 2, 3, 4, 5, 6], plain, [9.0, 8, 7, 6, 5, 4, 3]))
    assert {r["session_id"]: r["decay"] for r in rows}[0] == float("inf")
    rows = same(spark, tmp_path, "decay_outliers", events=events([1.0, 2, 3, 4, 5, 0, 6], plain))
    assert {r["session_id"]: r["decay"] for r in rows}[0] == float("-inf")
    same(spark, tmp_path, "decay_outliers", events=events([0.0, 1, 2, 3, 4, 0, 6], plain))
    # Without spread across sessions.
    same(spark, tmp_path, "decay_outliers", events=events(plain, plain))
    same(spark, tmp_path, "decay_outliers", events=events(plain))


def test_session_without_steps(spark, tmp_path):
    """A session whose samples are all of the phase between contacts has no step, and the others keep theirs."""
    pq.write_table(events([float(k % 40) for k in range(30)]), tmp_path / "events.parquet")
    (step,) = catalog.QUERIES["step_cmes"](spark, str(tmp_path)).collect()
    assert (step["start"], step["end"]) == (0, 29)
    pq.write_table(events([float(k % 40) for k in range(30)], kind="error"), tmp_path / "events.parquet")
    assert catalog.QUERIES["step_cmes"](spark, str(tmp_path)).collect() == []


def test_payload_of_broken_ties(spark, tmp_path):
    """Medians that end in 5 at the third digit are rounded as doubles, up or down by what they hold."""
    pairs = [(64_210.0, 64_240.0), (1_000.0, 1_010.0), (64_220.0, 64_230.0), (2_670.0, 2_680.0), (8_030.0, 8_040.0)]
    rows = [(50 * k + o, 1 + line, "AR"[o % 2], 10.0 + o, p[line], 0.01 * (o % 5), 0.07) for k, p in enumerate(pairs) for o in range(50) for line in range(2)]
    names = ("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    kinds = (pa.int64(), pa.int32(), pa.string(), *[pa.float64()] * 4)
    table = pa.table({n: pa.array(v, k) for n, k, v in zip(names, kinds, zip(*rows))} | {"l_linestatus": pa.array(["F"] * len(rows)), "l_shipdate": pa.array([dt.datetime(2024, 1, 1)] * len(rows), pa.timestamp("us"))})
    bodies = same(spark, tmp_path, "payload_bodies", lineitem=table)
    assert len(bodies) == len(pairs)


def test_payload_steps_move_once(spark, tmp_path):
    """Steps reach their session by two exchanges (blocks, regressions); no later grouping or join moves them."""
    from tests.conftest import DATA

    plan = catalog.QUERIES["payload_records"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(") <= 3 and "REPARTITION_BY_COL" in plan
