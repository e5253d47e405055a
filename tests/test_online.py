"""Streams in any split of batches give what the batch operators give."""

import random

import pytest
from pyspark.sql import functions as F

from stridelake.operators import ranges as R
from stridelake.streaming import online as O
from stridelake.streaming import sessions as ST

GAP, WIDTH, SILENCE = 4, 7, 60_000
SCHEMA = "session_id long, at timestamp, seq long, flag boolean, signal double"


def rows_of(seed, n=160):
    rng = random.Random(seed)
    out = []
    for key in (1, 2):
        at = 1_700_000_000_000
        for seq in range(n):
            at += 100 if rng.random() > 0.02 else 200_000
            out.append((key, at, seq, rng.random() < 0.6, float(rng.randrange(10))))
    return out


@pytest.fixture(scope="module")
def store(spark):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", O.PROVIDER)
    yield
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


def frame(spark, rows):
    return spark.createDataFrame(rows, "session_id long, ms long, seq long, flag boolean, signal double").select("session_id", F.timestamp_millis("ms").alias("at"), "seq", "flag", "signal")


def batch(spark, rows):
    """The same by the batch operators; a silence starts a new session of the key."""
    df = R.sessionize(frame(spark, rows).withColumn("ms", F.unix_millis("at")), "ms", SILENCE).withColumn("own", F.concat_ws("-", "session_id", "block")).drop("block")
    found = R.ranges(df, F.col("flag"), key="own")
    blocks = R.merge_ranges(found, GAP, key="own")
    met = df.where("flag").join(blocks.select("own", F.col("start").alias("b"), F.col("end").alias("e")), "own").where("seq >= b AND seq < e")
    bucket = F.col("b") + F.floor((F.col("seq") - F.col("b")) / WIDTH) * WIDTH
    out = [("bucket", r["own"], r["b"], r["s"], min(r["s"] + WIDTH, r["e"]), r["n"], r["t"]) for r in met.groupBy("own", "b", "e", bucket.alias("s")).agg(F.count("*").alias("n"), F.sum("signal").alias("t")).collect()]
    out += [("block", r["own"], r["b"], r["b"], r["e"], r["k"], r["t"]) for r in met.groupBy("own", "b", "e").agg(F.sum("signal").alias("t")).join(blocks.select("own", F.col("start").alias("b"), F.col("n_ranges").alias("k")), ["own", "b"]).collect()]
    runs = met.join(found.select("own", F.col("start").alias("s"), F.col("end").alias("x")), "own").where("seq >= s AND seq < x")
    out += [("range", r["own"], r["b"], r["s"], r["x"], r["x"] - r["s"], r["t"]) for r in runs.groupBy("own", "b", "s", "x").agg(F.sum("signal").alias("t")).collect()]
    return sorted((kind, int(own.split("-")[0]), *rest) for kind, own, *rest in out)


def test_fold_equals_batch(spark):
    for seed in range(3):
        rows, got = rows_of(seed), []
        for key in (1, 2):
            fold = O.Fold(GAP, WIDTH, SILENCE)
            for _, at, seq, flag, signal in (r for r in rows if r[0] == key):
                fold.row(seq, at, flag, signal)
            fold.close()
            got += [(kind, key, *rest) for kind, *rest in fold.out]
        assert sorted(got) == batch(spark, rows)


@pytest.mark.parametrize("split", ["one", "in order", "shuffled"])
def test_any_split_gives_the_batch_result(spark, tmp_path, store, split):
    rows = rows_of(7, 60)
    end = max(r[1] for r in rows)
    rng = random.Random(1)
    order = list(rows) if split != "shuffled" else rng.sample(rows, len(rows))
    order = sorted(order, key=lambda r: r[1]) if split == "in order" else order
    size = {"one": len(rows), "in order": 23, "shuffled": 40}[split]
    parts = [order[i : i + size] for i in range(0, len(order), size)] + [[(99, end + 10 * 3_600_000, 0, False, 0.0)]]
    delay = "5 hours" if split == "shuffled" else "0 seconds"
    for k, part in enumerate(parts):
        frame(spark, part).coalesce(1).write.parquet(f"{tmp_path}/in/{k:03d}")

    def run(name, upto):
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/{upto}")
        found = O.online_blocks(stream, "at", delay, GAP, WIDTH, SILENCE)
        q = found.writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", f"{tmp_path}/{name}").trigger(availableNow=True).start()
        q.awaitTermination(240)
        return spark.table(name).collect()

    got = run(f"online_{split.replace(' ', '_')}", "*")
    assert sorted((r["kind"], r["session_id"], r["block"], r["start"], r["end"], r["n"], r["total"]) for r in got if r["session_id"] != 99) == batch(spark, rows)


def test_ranges_of_a_stream(spark, tmp_path, store):
    rows = [(1, 1_000_000 + s * 1000, s, f, 1.0) for s, f in [(0, True), (10, True), (21, True), (22, False), (23, True)]] + [(9, 86_400_000, 0, False, 0.0)]
    frame(spark, rows).coalesce(1).write.parquet(f"{tmp_path}/in")
    found = ST.online_ranges(spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in"), "at", "0 seconds")
    q = found.writeStream.format("memory").queryName("online_ranges").outputMode("append").option("checkpointLocation", f"{tmp_path}/s").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert sorted((r["start"], r["end"]) for r in spark.table("online_ranges").collect()) == [(0, 22), (23, 24)]


def test_other_state_stores_are_refused(spark, tmp_path, store):
    name = "spark.sql.streaming.stateStore.providerClass"
    frame(spark, rows_of(1, 3)).write.parquet(f"{tmp_path}/in")
    spark.conf.set(name, "other")
    with pytest.raises(ValueError):
        O.online_blocks(spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in"), "at", "0 seconds", 1, 1, 1)
    spark.conf.set(name, O.PROVIDER)
