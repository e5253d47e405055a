"""Quaternion operators over the embeddings view: p, q and a vector v."""

from __future__ import annotations

from pyspark.sql import functions as F

from stridelake.functions import quaternion as Q
from stridelake.plans.register import query, samples, S, table  # noqa: F401


def _view(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    raw = e.select("vec_id", "label", *(F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(11)))
    p, q = Q.normalize(tuple(F.col(f"e{i}") for i in range(4))), Q.normalize(tuple(F.col(f"e{i}") for i in range(4, 8)))
    return raw.select("vec_id", "label", *(c.alias(n) for n, c in zip(("pw", "px", "py", "pz", "qw", "qx", "qy", "qz"), (*p, *q))), *(F.col(f"e{8 + i}").alias(f"v{'xyz'[i]}") for i in range(3)))


def _columns():
    """p, q and v as columns; made by each query, since columns need a session."""
    return tuple(tuple(F.col(n) for n in names) for names in (("pw", "px", "py", "pz"), ("qw", "qx", "qy", "qz"), ("vx", "vy", "vz")))


E = """WITH r AS (SELECT vec_id, label, """ + ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS e{i}" for i in range(11)) + """ FROM embeddings),
n AS (SELECT *, sqrt(e0*e0+e1*e1+e2*e2+e3*e3) AS np, sqrt(e4*e4+e5*e5+e6*e6+e7*e7) AS nq FROM r),
e AS (SELECT vec_id, label, e0/np AS pw, e1/np AS px, e2/np AS py, e3/np AS pz, e4/nq AS qw, e5/nq AS qx, e6/nq AS qy, e7/nq AS qz, e8 AS vx, e9 AS vy, e10 AS vz FROM n)
"""


def _out(columns, names):
    return [(F.round(c, 6) + F.lit(0.0)).alias(n) for c, n in zip(columns, names)]


def _sql(**columns) -> str:
    return E + "SELECT vec_id, " + ", ".join(f"round({c}, 6) + 0.0 AS {n}" for n, c in columns.items()) + " FROM e"


WXYZ = ("w", "x", "y", "z")
PROD = {"w": "pw*qw-px*qx-py*qy-pz*qz", "x": "pw*qx+px*qw+py*qz-pz*qy", "y": "pw*qy-px*qz+py*qw+pz*qx", "z": "pw*qz+px*qy-py*qx+pz*qw"}


@query(_sql(**PROD))
def quat_product(spark, sf_dir):
    """Q1, Q2, Q5."""
    P, QQ, VV = _columns()
    return _view(spark, sf_dir).select("vec_id", *_out(Q.product(P, QQ), WXYZ))


@query(_sql(w="pw", x="-px", y="-py", z="-pz"))
def quat_conjugate(spark, sf_dir):
    """Q4."""
    P, QQ, VV = _columns()
    return _view(spark, sf_dir).select("vec_id", *_out(Q.inverse(P), WXYZ))


@query(_sql(quat="sqrt(pw*pw+px*px+py*py+pz*pz)", vector="sqrt(vx*vx+vy*vy+vz*vz)", metres="sqrt(vx*vx+vy*vy+vz*vz)*9.80665/1000"))
def quat_norm(spark, sf_dir):
    """Q3, Q14, Q17."""
    P, QQ, VV = _columns()
    return _view(spark, sf_dir).select("vec_id", *_out((Q.norm(P), Q.norm(VV), Q.milli_g(Q.norm(VV))), ("quat", "vector", "metres")))


@query(_sql(
    x="(1-2*(qy*qy+qz*qz))*vx+2*(qx*qy+qw*qz)*vy+2*(qx*qz-qw*qy)*vz",
    y="2*(qx*qy-qw*qz)*vx+(1-2*(qx*qx+qz*qz))*vy+2*(qy*qz+qw*qx)*vz",
    z="2*(qx*qz+qw*qy)*vx+2*(qy*qz-qw*qx)*vy+(1-2*(qx*qx+qy*qy))*vz"))
def quat_rotation(spark, sf_dir):
    """Q6: conj(q) v q, against the rotation matrix."""
    P, QQ, VV = _columns()
    return _view(spark, sf_dir).select("vec_id", *_out(Q.rotate(VV, QQ), "xyz"))


@query(_sql(w="pw*qw+px*qx+py*qy+pz*qz", x="pw*qx-px*qw-py*qz+pz*qy", y="pw*qy+px*qz-py*qw-pz*qx", z="pw*qz-px*qy+py*qx-pz*qw"))
def quat_find_rotation(spark, sf_dir):
    """Q7."""
    P, QQ, VV = _columns()
    return _view(spark, sf_dir).select("vec_id", *_out(Q.rotation_between(P, QQ), WXYZ))


@query(E + """, d AS (SELECT *, pw*qw+px*qx+py*qy+pz*qz AS dot FROM e), k AS (SELECT *, CASE WHEN dot < 0 THEN -1.0 ELSE 1.0 END AS sg, acos(least(abs(dot), 1.0)) AS th FROM d),
u AS (SELECT *, CASE WHEN abs(dot) >= 1 THEN 0.7 ELSE sin(0.7*th)/sin(th) END AS a, CASE WHEN abs(dot) >= 1 THEN 0.3 ELSE sin(0.3*th)/sin(th) END AS b FROM k)
SELECT vec_id, """ + ", ".join(f"round(a*p{c}+b*sg*q{c}, 6) + 0.0 AS {c}" for c in WXYZ) + " FROM u")
def quat_slerp(spark, sf_dir):
    """Q8."""
    P, QQ, VV = _columns()
    return _view(spark, sf_dir).select("vec_id", *_out(Q.slerp(P, QQ, F.lit(0.3)), WXYZ))


@query(_sql(roll="atan2(2*(pw*px+py*pz), 1-2*(px*px+py*py))", pitch="asin(2*least(greatest(pw*py-px*pz, -0.5), 0.5))", yaw="atan2(2*(pw*pz+px*py), 1-2*(py*py+pz*pz))"))
def quat_euler(spark, sf_dir):
    """Q9, Q20."""
    P, QQ, VV = _columns()
    return _view(spark, sf_dir).select("vec_id", *_out(Q.to_euler(P), ("roll", "pitch", "yaw")))


HALF = {a: (f"cos(v{a}/2)", f"sin(v{a}/2)") for a in "xyz"}
(_cx, _sx), (_cy, _sy), (_cz, _sz) = HALF["x"], HALF["y"], HALF["z"]


@query(_sql(w=f"{_cx}*{_cy}*{_cz}+{_sx}*{_sy}*{_sz}", x=f"{_sx}*{_cy}*{_cz}-{_cx}*{_sy}*{_sz}", y=f"{_cx}*{_sy}*{_cz}+{_sx}*{_cy}*{_sz}", z=f"{_cx}*{_cy}*{_sz}-{_sx}*{_sy}*{_cz}"))
def quat_from_euler(spark, sf_dir):
    """Q10."""
    P, QQ, VV = _columns()
    return _view(spark, sf_dir).select("vec_id", *_out(Q.from_euler(*VV), WXYZ))


@query(_sql(adduction="atan2(2*(py*pz+pw*px), sqrt(pow(2*(px*py-pw*pz),2)+pow(1-2*(px*px+pz*pz),2)))", flexion="-atan2(2*(px*pz-pw*py), sqrt(pow(1-2*(py*py+pz*pz),2)+pow(2*(px*py+pw*pz),2)))", mirrored="CASE WHEN 1-2*(px*px+py*py) < 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"))
def geometry_angles(spark, sf_dir):
    """Q15."""
    P, QQ, VV = _columns()
    return _view(spark, sf_dir).select("vec_id", *_out((Q.adduction(P), Q.flexion(P), Q.upside_down(P).cast("int").cast("double")), ("adduction", "flexion", "mirrored")))


@query(_sql(
    w="pw*qw+px*qx+py*qy+pz*qz", x="-pw*qx+px*qw-py*qz+pz*qy", y="-pw*qy+px*qz+py*qw-pz*qx", z="-pw*qz-px*qy+py*qx+pz*qw",
    ax="(1-2*(qy*qy+qz*qz))*vx+2*(qx*qy-qw*qz)*vy+2*(qx*qz+qw*qy)*vz", az_free="2*(px*pz-pw*py)*vx+2*(py*pz+pw*px)*vy+(1-2*(px*px+py*py))*vz-1"))
def body_frame(spark, sf_dir):
    """Q11, Q13, Q18: orientation and acceleration against a reference, and gravity removed."""
    P, QQ, VV = _columns()
    q, a = Q.to_body_frame(P, VV, QQ)
    return _view(spark, sf_dir).select("vec_id", *_out((*q, a[0], Q.correct_acceleration(VV, P, 1.0)[2]), (*WXYZ, "ax", "az_free")))


@query(E + """, m AS (SELECT label, avg(pw) AS w, avg(px) AS x, avg(py) AS y, avg(pz) AS z FROM e GROUP BY label), k AS (SELECT *, sqrt(w*w+x*x+y*y+z*z) AS n FROM m)
SELECT label, """ + ", ".join(f"round({c}/n, 6) + 0.0 AS {c}" for c in WXYZ) + " FROM k")
def quat_mean(spark, sf_dir):
    """Mean of a group's quaternions, normalized."""
    P, QQ, VV = _columns()
    return _view(spark, sf_dir).groupBy("label").agg(*_out(Q.mean(P), WXYZ))


@query(E + """, c AS (SELECT vec_id, label, vx - avg(CASE WHEN vec_id % 100 < 50 THEN vx END) OVER (PARTITION BY label) AS x FROM e) SELECT vec_id, label, round(x, 6) + 0.0 AS x FROM c""")
def centred_acceleration(spark, sf_dir):
    """Q19: centred on the mean of the first samples of the session."""
    from pyspark.sql import Window

    first = F.avg(F.when(F.col("vec_id") % 100 < 50, F.col("vx"))).over(Window.partitionBy("label"))
    return _view(spark, sf_dir).select("vec_id", "label", *_out([F.col("vx") - first], ["x"]))
