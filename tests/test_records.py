"""Binary recordings, ids, merges and streams."""

import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from stridelake.functions import metadata as M
from stridelake.functions import quaternion as Q
from stridelake.sources import recordings as R
from stridelake.sources import records
from stridelake.streaming import sessions as ST


def record(ms, sensors):
    """Inverse of the decoding: sensors are (flag, acc fields, quaternion fields), signed 13-bit."""
    pack = lambda fields: sum((f & 8191) << s for f, s in zip(fields, (26, 13, 0))).to_bytes(5, "big")
    return ms.to_bytes(5, "big") + b"\0\0" + b"".join(bytes([flag]) + pack(acc) + pack(quat) for flag, acc, quat in sensors)


def test_decode_split_and_repeated_parts(spark):
    rng = np.random.default_rng(0)
    rows = [(1000 + 10 * i, [(8 if k == 0 else 0, rng.integers(-4096, 4096, 3).tolist(), rng.integers(-2000, 2000, 3).tolist()) for k in range(3)]) for i in range(25)]
    data = b"".join(record(*r) for r in rows)
    parts = [("s", "a_1", data[:130]), ("s", "a_2", data[130:410]), ("s", "a_3", data[130:410]), ("s", "a_4", data[410:]), ("t", "b_1", b"short"), ("u", "c_1", None)]
    df = spark.createDataFrame(parts, "session_id string, part string, content binary")
    out = records.decode(records.distinct_parts(df)).orderBy("seq").collect()
    assert [r["seq"] for r in out] == list(range(25)) and {r["session_id"] for r in out} == {"s"}
    for r, (ms, sensors) in zip(out, rows):
        assert r["epoch_ms"] == ms + records.EPOCH_MS and r["timestamp_error"] is None
        for k, (flag, acc, quat) in enumerate(sensors):
            assert r[f"static_{k}"] == flag // 8
            assert [r[f"acc_{k}_{c}"] for c in "xyz"] == [a * 8.0 for a in acc]
            q = [r[f"quat_{k}_{c}"] for c in "wxyz"]
            assert abs(sum(x * x for x in q) - 1) < 1e-9 and abs(q[1] - np.clip(quat[0] * 8 / 32767, -1, 1)) < 1e-9


def recording(n, seed=0, start=1000):
    rng = np.random.default_rng(seed)
    return b"".join(record(start + 10 * i, [(int(rng.integers(0, 256)), rng.integers(-4096, 4096, 3).tolist(), rng.integers(-3000, 3000, 3).tolist()) for _ in range(3)]) for i in range(n))


def upload(folder, session, data, sizes, millis=1_700_000_000_000):
    """Files of the given sizes; the rest goes into the last one."""
    at = 0
    for k, size in enumerate([*sizes, len(data) - sum(sizes)]):
        with open(f"{folder}/{session}_{millis + k}", "wb") as f:
            f.write(data[at : at + size])
        at += size


def test_places_move_no_contents(spark):
    data = recording(12)
    parts = [("s", f"p{k:02d}", data[a:b]) for k, (a, b) in enumerate([(0, 70), (70, 71), (71, 71), (71, 75), (75, 76), (76, 300), (300, 480)])] + [(None, "x", data[:45]), ("s", "p99", None)]
    df = spark.createDataFrame(parts, "session_id string, part string, content binary")
    got = {(r["session_id"], r["part"]): (r["begin"], bytes(r["tail"])) for r in records.places(df).collect()}
    for session, part, content in parts:
        if content:
            begin = sum(len(c or b"") for s, p, c in parts if s == session and p < part)
            whole = b"".join(c or b"" for s, p, c in parts if s == session)
            assert got.pop((session, part)) == (begin, whole[begin + len(content) :][:39])
    assert not got
    out = records.decode(df)
    assert sorted((r["session_id"] or "", r["seq"]) for r in out.collect()) == [("", 0)] + [("s", k) for k in range(12)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_named_format_equals_decode(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    upload(folder, "a_b", recording(700), [130, 1, 0, 39, 40, 8000, 3])
    upload(folder, "c", recording(5, 1)[:-7], [], millis=5)
    (folder / "notes.txt").write_bytes(b"x" * 100)
    (folder / "empty_1").write_bytes(b"")
    spark.dataSource.register(R.Recordings)
    own = spark.read.format("recordings").option("recordsPerPartition", 64).load(str(folder))
    parts = records.read_parts(spark, str(folder)).where("part != 'notes.txt'")
    other = records.decode(parts)
    columns = ["session_id", "seq", *R.COLUMNS]
    rows = lambda df: sorted(map(tuple, df.select(*columns).collect()))
    mine, theirs = rows(records.repair_times(own)), rows(other)
    assert len(mine) == 704 and [r[:2] for r in mine] == [r[:2] for r in theirs]
    assert np.allclose(np.array([r[2:] for r in mine], float), np.array([r[2:] for r in theirs], float), atol=1e-12)
    assert own.rdd.getNumPartitions() == 12
    none = tmp_path / "none"
    none.mkdir()
    assert spark.read.format("recordings").load(str(none)).collect() == []


def test_stream_completes_records(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    spark.dataSource.register(R.Recordings)
    data, other = recording(50), recording(20, 2)

    def run():
        stream = spark.readStream.format("recordings").load(f"file://{folder}")
        q = stream.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start()
        q.awaitTermination(120)
        return sorted((r["session_id"], r["seq"]) for r in spark.read.parquet(f"{tmp_path}/out").collect())

    upload(folder, "s", data[:170], [100], millis=1000)
    assert run() == [("s", k) for k in range(4)]
    upload(folder, "s", data[170:1000], [25, 5], millis=2000)
    upload(folder, "t", other[:90], [], millis=2500)
    assert run() == [("s", k) for k in range(25)] + [("t", k) for k in range(2)]
    upload(folder, "t", other[90:], [], millis=3000)
    upload(folder, "s", data[1000:], [], millis=3001)
    assert run() == [("s", k) for k in range(50)] + [("t", k) for k in range(20)]
    out = spark.read.parquet(f"{tmp_path}/out").where("session_id = 's'").orderBy("seq").collect()
    whole = R.columns_of(np.frombuffer(data, np.uint8).reshape(-1, 40))
    assert np.allclose([[r[c] for c in R.COLUMNS] for r in out], np.stack([c.to_numpy() for c in whole], 1))


def test_stages_are_deleted_by_any_name(spark, tmp_path):
    names = ["A B", "C:D", "50%", "x=y", "é/ü", "%41", "plain", None, "keep"]
    df = spark.createDataFrame([(n, k) for k, n in enumerate(names)], "session_id string, x int")
    records.write_stage(df, f"{tmp_path}/t")
    for name in names[:-1]:
        assert records.delete_stage(spark, f"{tmp_path}/t", F.col("session_id").eqNullSafe(name)) == 1
        left = {r["session_id"] for r in spark.read.parquet(f"{tmp_path}/t").collect()}
        assert left == set(names[names.index(name) + 1 :])
    assert records.delete_stage(spark, f"{tmp_path}/t", F.col("session_id") == "nobody") == 0


def test_time_repair(spark):
    df = spark.createDataFrame([("a", i, t) for i, t in enumerate([0, 10, 5, 30, 40])] + [("b", i, t) for i, t in enumerate([0, 10, 400_000, 400_010])], "session_id string, seq long, epoch_ms long")
    out = records.repair_times(df).orderBy("session_id", "seq").collect()
    assert [r["epoch_ms"] for r in out if r["session_id"] == "a"] == [0, 10, 20, 30, 40]
    assert [r["seq"] for r in out if r["session_id"] == "b"] == [0, 1]
    assert {r["timestamp_error"] for r in out} == {"SMALL_NEGATIVE_JUMP", "LARGE_JUMP_DATA_TRUNCATED"}


def test_session_id_is_a_name_based_uuid(spark):
    rows = [("00:00:00:00:00", ["11:11:11:11:11"], None, "2001-01-01T01:23:45Z"), ("x", ["b", "a"], "u", "d")]
    df = spark.createDataFrame(rows, "accessory string, sensors array<string>, user string, date string")
    got = [r[0] for r in df.select(M.session_id(*(F.col(c) for c in df.columns))).collect()]
    names = ["00:00:00:00:00_11:11:11:11:11_None_2001-01-01T01:23:45Z", "x_a,b_u_d"]
    assert got == [str(uuid.uuid5(uuid.NAMESPACE_URL, f"http://session.example.com/{n}")) for n in names]


def test_metadata_functions(spark):
    row = spark.range(1).select(
        M.parse_time(F.lit("2019-02-03T04:05:06Z")).cast("string"), M.parse_time(F.lit("2019-02-03T04:05:06.789Z")).cast("string"), M.parse_time(F.lit("nothing")),
        M.changed(F.create_map(F.lit("a"), F.lit("1"), F.lit("b"), F.lit("2")), F.create_map(F.lit("a"), F.lit("1"))),
        M.decoded_attribute(F.from_json(F.lit('{"SS": ["x", "y"]}'), "S string, N string, SS array<string>, L array<string>, NULL boolean")), M.may_change(F.lit("UPLOAD_COMPLETE"), F.lit("CREATE_COMPLETE")),
    ).first()
    assert list(row) == ["2019-02-03 04:05:06", "2019-02-03 04:05:06.789", None, {"b": "2"}, "x,y", False]


def test_quaternion_properties(spark):
    rng = np.random.default_rng(4)
    df = spark.createDataFrame([tuple(map(float, rng.normal(size=7))) for _ in range(20)], "w double, x double, y double, z double, a double, b double, c double")
    q, v = Q.normalize(tuple(map(F.col, "wxyz"))), tuple(map(F.col, "abc"))
    turned = Q.rotate(Q.rotate(v, q), Q.conjugate(q))
    euler = Q.from_euler(*Q.to_euler(q))
    dot = F.abs(sum((s * t for s, t in zip(q[1:], euler[1:])), q[0] * euler[0]))
    rows = df.select(Q.norm(Q.rotate(v, q)) - Q.norm(v), turned[0] - v[0], turned[2] - v[2], Q.norm(Q.rotation_between(q, q)) - 1, Q.rotation_between(q, q)[0] - 1, dot - 1).collect()
    assert np.abs(np.array(rows)).max() < 1e-9
    with pytest.raises(ValueError):
        Q.product()


def test_stages_and_upsert(spark, tmp_path):
    one = spark.createDataFrame([("a", 1), ("b", 2)], "session_id string, x int")
    records.write_stage(one, f"{tmp_path}/t")
    records.write_stage(spark.createDataFrame([("b", 5)], "session_id string, x int"), f"{tmp_path}/t")
    assert sorted(map(tuple, records.read_stage(spark, f"{tmp_path}/t", ["session_id", "x"]).collect())) == [("a", 1), ("b", 5)]
    assert records.read_stage(spark, f"{tmp_path}/t", ["x"], "a").collect()[0][0] == 1
    now = spark.createDataFrame([("a", "CREATE_COMPLETE", 1), ("b", "UPLOAD_COMPLETE", 1)], "session_id string, session_status string, updated int")
    batch = spark.createDataFrame([("a", "UPLOAD_IN_PROGRESS", 3), ("a", "UPLOAD_COMPLETE", 4), ("b", "CREATE_COMPLETE", 9), ("c", "CREATE_COMPLETE", 2)], now.schema)
    got = {r[0]: r[1] for r in ST.apply_changes(now, batch).collect()}
    assert got == {"a": "UPLOAD_COMPLETE", "b": "UPLOAD_COMPLETE", "c": "CREATE_COMPLETE"}


def test_streams(spark, tmp_path):
    rows = [("a", f"2024-01-01 00:00:{s:02d}", float(s), s, f) for s, f in [(0, True), (10, True), (21, True), (22, False), (23, True)]] + [("z", "2024-01-02 00:00:00", 1.0, 0, False)]
    df = spark.createDataFrame(rows, "session_id string, t string, signal double, seq long, flag boolean").withColumn("t", F.to_timestamp("t"))
    df.coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = ST.uploads(spark, f"{tmp_path}/in", df.schema.simpleString()[7:-1].replace(":", " "))

    def run(out, name, mode="append"):
        q = out.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", f"{tmp_path}/{name}").trigger(availableNow=True).start()
        q.awaitTermination(120)
        return spark.table(name).collect()

    blocks = run(ST.active_blocks(stream, "t", "10 seconds", "0 seconds"), "blocks")
    assert sorted((r["session_id"], r["n"]) for r in blocks if r["session_id"] == "a") == [("a", 2), ("a", 3)]
    once = run(ST.distinct_uploads(stream.withColumn("digest", F.lit("same")), "t", "digest", "2 days"), "once")
    assert len(once) == 1
