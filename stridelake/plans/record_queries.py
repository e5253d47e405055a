"""Parts, metadata, states, change events and nested documents."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from stridelake.functions import metadata as M
from stridelake.plans.register import S, T, query, samples, steps, table
from stridelake.sources import records


@query("SELECT min(doc_id) AS doc_id, sha256(text) AS digest FROM documents GROUP BY sha256(text)")
def content_dedupe(spark, sf_dir):
    """Of equal parts the first."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("digest"))
    return d.groupBy("digest").agg(F.min("doc_id").alias("doc_id"))


#: Times and fields of the records that are built from samples: every 13th time runs back, every 211th sample jumps by 400 s.
_MS = "1700000000000 + seq * 10 - CASE WHEN event_id % 13 = 0 THEN 25 ELSE 0 END + CASE WHEN event_id % 211 = 0 THEN 400000 ELSE 0 END"
_ACC = ("event_id", "event_id * 7", "seq * 31")
_TURN = ("event_id * 3 % 2000", "8191 - seq", "event_id * 11 % 3000")
_FLAG = "event_id % 16 * 8"


def _hex_record() -> Column:
    """A record of a sample as hex digits; the three sensors are alike but for the first field of their acceleration."""

    def packed(values, shift=0):
        one, two, three = (F.expr(v) for v in values)
        return F.lpad(F.hex(F.shiftleft((one + shift) % 8192, 26) + F.shiftleft(two % 8192, 13) + three % 8192), 10, "0")

    sensors = [F.concat(F.lpad(F.hex(F.expr(_FLAG)), 2, "0"), packed(_ACC, k * 1000), packed(_TURN)) for k in range(3)]
    return F.concat(F.lpad(F.hex(F.expr(_MS) - records.EPOCH_MS), 10, "0"), F.lit("0000"), *sensors)


def recording_parts(spark, sf_dir):
    """Samples as uploads: the bytes of a session's records in parts of 130 bytes, one of them twice."""
    rows = samples(spark, sf_dir).groupBy("session_id").agg(F.sort_array(F.collect_list(F.struct("seq", _hex_record().alias("r")))).alias("r"))
    whole = rows.select("session_id", F.unhex(F.array_join(F.transform("r", lambda x: x["r"]), "")).alias("content"))
    parts = records.chunk_by_bytes(whole, "content", 130).select("session_id", F.format_string("%09d", "part").alias("part"), F.col("chunk").alias("content"))
    again = parts.where("part = '000000001'").withColumn("part", F.lit("000000001b"))
    return parts.unionByName(again)


def _decoded_sql() -> str:
    signed = lambda e: f"((({e}) % 8192) - CASE WHEN ({e}) % 8192 >= 4096 THEN 8192 ELSE 0 END) * 8"
    acc = ", ".join(f"CAST({signed(a if i else f'{a} + {k * 1000}')} * CASE WHEN event_id % 16 & 10 = 2 THEN 4 ELSE 1 END AS DOUBLE) AS acc_{k}_{c}" for k in range(3) for i, (a, c) in enumerate(zip(_ACC, "xyz")))
    turn = ", ".join(f"{signed(e)} / 32767.0 AS q{c}" for e, c in zip(_TURN, "xyz"))
    quat = ", ".join(f"round(CASE WHEN n > 1 THEN {'0.0' if c == 'w' else f'q{c} / sqrt(n)'} ELSE {'sqrt(greatest(1 - n, 0))' if c == 'w' else f'q{c}'} END, 9) AS quat_{k}_{c}" for k in range(3) for c in "wxyz")
    still = ", ".join(f"CAST(event_id % 2 AS INTEGER) AS static_{k}" for k in range(3))
    return S + f""", r AS (SELECT session_id, seq, event_id, {_MS} AS ms, {acc}, {turn}, {still} FROM s),
t AS (SELECT *, qx * qx + qy * qy + qz * qz AS n, ms - lag(ms) OVER w AS d, lag(ms) OVER w AS a, lead(ms) OVER w AS b FROM r WINDOW w AS (PARTITION BY session_id ORDER BY seq)),
j AS (SELECT *, min(CASE WHEN abs(d) > 300000 THEN seq END) OVER (PARTITION BY session_id) AS jump, max(CASE WHEN d < 0 THEN 1 ELSE 0 END) OVER (PARTITION BY session_id) AS back FROM t)
SELECT session_id, seq, CASE WHEN d < 0 AND b IS NOT NULL THEN (a + b) // 2 ELSE ms END AS epoch_ms, CASE WHEN jump IS NOT NULL THEN 'LARGE_JUMP_DATA_TRUNCATED' WHEN back = 1 THEN 'SMALL_NEGATIVE_JUMP' END AS timestamp_error,
{", ".join(f"acc_{k}_{c}" for k in range(3) for c in "xyz")}, {", ".join(f"static_{k}" for k in range(3))}, {quat} FROM j WHERE jump IS NULL OR seq < jump"""


@query(_decoded_sql())
def decoded_records(spark, sf_dir):
    """Samples as 40-byte records in parts that split them, read back with repaired times."""
    out = records.decode(records.distinct_parts(recording_parts(spark, sf_dir)))
    return out.select(*(F.round(c, 9).alias(c) if c.startswith("quat") else c for c in out.columns))


_UUID = "sha1('\\x6b\\xa7\\xb8\\x11\\x9d\\xad\\x11\\xd1\\x80\\xb4\\x00\\xc0\\x4f\\xd4\\x30\\xc8'::BLOB || CAST(name AS BLOB))"


@query(f"""WITH n AS (SELECT o_orderkey, 'http://session.example.com/acc' || o_custkey || '_' || array_to_string(list_sort([o_orderpriority, o_orderstatus]), ',') || '_' || CASE WHEN o_custkey % 2 = 0 THEN CAST(o_custkey AS VARCHAR) ELSE 'None' END || '_' || strftime(o_orderdate, '%Y-%m-%d') AS name FROM orders),
h AS (SELECT o_orderkey, {_UUID} AS h FROM n)
SELECT o_orderkey, h[1:8] || '-' || h[9:12] || '-5' || h[14:16] || '-' || substr('89ab', (strpos('0123456789abcdef', h[17]) - 1) % 4 + 1, 1) || h[18:20] || '-' || h[21:32] AS session_id FROM h""")
def session_ids(spark, sf_dir):
    """Name-based ids."""
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", M.session_id(F.concat(F.lit("acc"), F.col("o_custkey")), F.array(F.col("o_orderpriority"), F.col("o_orderstatus")), F.when(F.col("o_custkey") % 2 == 0, F.col("o_custkey").cast("string")), F.date_format("o_orderdate", "yyyy-MM-dd")).alias("session_id"))


@query("""SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'complete' WHEN 'O' THEN CASE WHEN o_totalprice >= 60000 THEN 'paused' ELSE 'in progress' END ELSE 'failed' END AS display,
CASE WHEN o_orderstatus NOT IN ('F', 'O') THEN split_part(o_orderpriority, '-', 1) END AS cause, o_orderstatus || '>' || left(o_orderpriority, 1) IN ('F>1', 'O>2', 'P>3') AS allowed FROM orders""")
def status_display(spark, sf_dir):
    """Display states, causes and allowed changes."""
    s = F.col("o_orderstatus")
    display = F.when(s == "F", "complete").when(s == "O", F.when(F.col("o_totalprice") >= 60000, "paused").otherwise("in progress")).otherwise("failed")
    allowed = F.concat_ws(">", s, F.substring("o_orderpriority", 1, 1)).isin("F>1", "O>2", "P>3")
    return table(spark, sf_dir, "orders").select("o_orderkey", display.alias("display"), F.when(~s.isin("F", "O"), F.split("o_orderpriority", "-")[0]).alias("cause"), allowed.alias("allowed"))


@query("""SELECT o_custkey, o_orderkey, epoch_us(o_orderdate) AS at_us, coalesce(CASE WHEN o_orderstatus = 'F' THEN epoch_us(o_orderdate) END, epoch_us(o_orderdate) + 14400000000) AS end_us
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS k FROM orders WHERE o_orderstatus IN ('F', 'O')) WHERE k = 1""")
def latest_session(spark, sf_dir):
    """Each user's latest session in two states; a missing end is four hours later."""
    at = F.unix_micros(F.col("o_orderdate").cast("timestamp"))
    o = table(spark, sf_dir, "orders").where(F.col("o_orderstatus").isin("F", "O"))
    top = o.groupBy("o_custkey").agg(F.max(F.struct(at.alias("at_us"), "o_orderkey", "o_orderstatus")).alias("t")).select("o_custkey", "t.*")
    return top.select("o_custkey", "o_orderkey", "at_us", F.when(F.col("o_orderstatus") == "F", F.col("at_us")).otherwise(F.col("at_us") + 14_400_000_000).alias("end_us"))


@query("""SELECT o_orderkey, o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1998-01-02' + INTERVAL 30 DAY AND extract(hour FROM o_orderdate + INTERVAL 330 MINUTE) >= 3 AND o_orderstatus <> 'P'""")
def sessions_of_day(spark, sf_dir):
    """Sessions of a time range and local hour; the range reaches the scan."""
    o = table(spark, sf_dir, "orders").where("o_orderdate >= TIMESTAMP_NTZ'1998-01-01 00:00:00' AND o_orderdate < TIMESTAMP_NTZ'1998-02-01 00:00:00' AND o_orderstatus <> 'P'")
    return o.where(F.hour(M.local_time(F.col("o_orderdate").cast("timestamp"), F.lit("+05:30"))) >= 3).select("o_orderkey", "o_custkey")


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' OR epoch_us(o_orderdate) > epoch_us(TIMESTAMP '1997-06-01') + 300000000 THEN epoch_us(TIMESTAMP '1997-06-01') ELSE epoch_us(o_orderdate) + CASE WHEN o_custkey % 2 = 0 THEN 5000000 ELSE 0 END END AS event_us FROM orders""")
def event_date_correction(spark, sf_dir):
    """Event dates corrected at creation."""
    said = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate").cast("timestamp"))
    fixed = M.corrected_event_date(said, F.to_timestamp(F.lit("1997-06-01 00:00:00")), F.col("o_custkey") % 2 == 0)
    return table(spark, sf_dir, "orders").select("o_orderkey", F.unix_micros(fixed).alias("event_us"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso, epoch_us(ts) // 1000 AS epoch_ms, json_extract_string(props, '$.k') AS k FROM events")
def time_formats(spark, sf_dir):
    """Formats of times, and JSON fields."""
    ts = F.col("ts").cast("timestamp")
    return table(spark, sf_dir, "events").select("event_id", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss").alias("iso"), F.unix_millis(ts).alias("epoch_ms"), F.get_json_object("props", "$.k").alias("k"))


@query(S + """, c AS (SELECT session_id, seq, lag(event_type) OVER w AS old_type, event_type AS new_type, lag(phase) OVER w AS old_phase, phase AS new_phase FROM s WINDOW w AS (PARTITION BY session_id ORDER BY seq))
SELECT session_id, seq, CAST(CASE WHEN new_type IS DISTINCT FROM old_type THEN 1 ELSE 0 END + CASE WHEN new_phase IS DISTINCT FROM old_phase THEN 1 ELSE 0 END AS INTEGER) AS n_changes, new_type = 'purchase' AND old_type IS DISTINCT FROM 'purchase' AS triggers FROM c""")
def cdc_changes(spark, sf_dir):
    """Changed attributes of each new image, and the changes that trigger the pipeline."""
    w = Window.partitionBy("session_id").orderBy("seq")
    image = F.create_map(F.lit("type"), F.col("event_type"), F.lit("phase"), F.col("phase").cast("string"))
    s = samples(spark, sf_dir).withColumn("image", image).withColumn("old", F.coalesce(F.lag("image").over(w), F.create_map().cast("map<string,string>")))
    diff = M.changed(F.col("image"), F.col("old"))
    return s.select("session_id", "seq", F.size(diff).alias("n_changes"), F.coalesce(F.element_at(diff, "type") == "purchase", F.lit(False)).alias("triggers"))


@query("""WITH k AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id % 2 DESC, ts DESC, event_id DESC) AS r FROM events WHERE event_id % 2 = 0 OR user_id % 3 > 0)
SELECT user_id, event_id, value FROM k WHERE r = 1""")
def merged_state(spark, sf_dir):
    """Rows replaced by key; changes replace what is there, the last of them counts, and keys without one stay."""
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "value", F.struct("ts", "event_id").alias("updated"))
    change = F.col("event_id") % 2 == 1
    return records.upsert(e.where(~change), e.where(change & (F.col("user_id") % 3 > 0)), "user_id").select("user_id", "event_id", "value")


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def replayed_sessions(spark, sf_dir):
    """Rows that the target does not have yet."""
    return table(spark, sf_dir, "customer").select("c_custkey").join(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti")


@query("""SELECT (SELECT count(*) FROM (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' UNION SELECT o_custkey FROM orders WHERE o_orderstatus = 'O')) AS n_union,
(SELECT count(*) FROM (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'O')) AS n_both,
(SELECT count(*) FROM (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'O')) AS n_only""")
def set_operations(spark, sf_dir):
    """Set algebra of two states' users by one grouping."""
    o = table(spark, sf_dir, "orders").where(F.col("o_orderstatus").isin("F", "O"))
    u = o.groupBy("o_custkey").agg(F.max((F.col("o_orderstatus") == "F").cast("int")).alias("f"), F.max((F.col("o_orderstatus") == "O").cast("int")).alias("o"))
    return u.agg(F.count("*").alias("n_union"), F.sum(F.col("f") * F.col("o")).alias("n_both"), F.sum(F.col("f") * (1 - F.col("o"))).alias("n_only"))


@query(S + " SELECT event_id, signal FROM s ORDER BY md5(CAST(event_id AS VARCHAR) || ':77'), event_id LIMIT 1000")
def hash_sample(spark, sf_dir):
    """A repeatable sample without replacement, ordered by hash; the size is the feature."""
    return samples(spark, sf_dir).select("event_id", "signal").orderBy(F.md5(F.concat(F.col("event_id").cast("string"), F.lit(":77"))), "event_id").limit(1000)


@query(T + """, u AS (SELECT block_id, coalesce(side, 'none') AS side, count(*) AS n, sum(force) AS total FROM t GROUP BY ALL)
SELECT CAST(o_orderkey AS BIGINT) AS block_id, count(*) AS n_units, CAST(sum(n) AS BIGINT) AS n_steps, sum(total) AS total FROM orders JOIN u ON o_orderkey = block_id GROUP BY o_orderkey""")
def nested_blocks(spark, sf_dir):
    """Blocks of unit blocks of steps as nested arrays, measured on the nested form."""
    t = steps(spark, sf_dir).withColumn("side", F.coalesce("side", F.lit("none")))
    # One grouping: a block's steps sorted by side and step, split where the side changes.
    ordered = t.groupBy("block_id").agg(F.sort_array(F.collect_list(F.struct("side", "step", "force", "accel"))).alias("all"))
    own = lambda s: F.transform(F.filter("all", lambda x: x["side"] == s), lambda x: F.struct(x["step"].alias("step"), x["force"].alias("force"), x["accel"].alias("accel")))
    units = F.transform(F.array_distinct(F.transform("all", lambda x: x["side"])), lambda s: F.struct(s.alias("side"), own(s).alias("steps")))
    nested = ordered.select("block_id", units.alias("units"))
    blocks = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("block_id")).join(nested, "block_id")
    flat = F.flatten(F.transform("units", lambda u: u["steps"]))
    return blocks.select("block_id", F.size("units").cast("long").alias("n_units"), F.size(flat).cast("long").alias("n_steps"), F.aggregate(flat, F.lit(0.0), lambda a, s: a + s["force"]).alias("total"))


@query(T + """, a AS (SELECT side, quantile_cont(force, 0.5) AS m, count(*) AS n FROM t WHERE side IS NOT NULL GROUP BY side)
SELECT 'v' || v AS version, max(CASE WHEN side = 'LF' THEN m END) AS left_median, max(CASE WHEN side = 'RF' THEN m END) AS right_median, CAST(sum(n) AS BIGINT) AS n FROM a, (VALUES (1), (2), (3)) x(v) GROUP BY v""")
def plan_payloads(spark, sf_dir):
    """Versioned payloads, encoded as JSON and read back."""
    t = steps(spark, sf_dir).where("side IS NOT NULL")
    a = t.agg(F.median(F.when(F.col("side") == "LF", F.col("force"))).alias("l"), F.median(F.when(F.col("side") == "RF", F.col("force"))).alias("r"), F.count("*").alias("n"))
    body = F.to_json(F.struct(F.struct(F.col("l").alias("left"), F.col("r").alias("right")).alias("summary"), "n"))
    sent = a.select(F.explode(F.array(*(F.lit(f"v{v}") for v in (1, 2, 3)))).alias("version"), body.alias("body"))
    read = F.from_json("body", "summary struct<left: double, right: double>, n long")
    return sent.select("version", read["summary"]["left"].alias("left_median"), read["summary"]["right"].alias("right_median"), read["n"].alias("n"))
