"""Versioned documents of a session's asymmetry and movement patterns, as JSON columns.

A version is an entry of a registry: which head fields, measures and patterns it sends, and
whether they are nested.  From it three documents are built as columns: the body that is
sent, the asymmetry record that is kept with its time blocks, and the record of the
patterns' statistics.

Null rules: a value that is missing is sent as null.  Nested versions leave a whole section
out where a session has none; flat versions have no sections, so their fields are null.  A
pattern without a significant regression has an elasticity of 0, and one without a unit root
test that exceeds its critical value a y_adf of 0.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Names of measures and of pattern pairs, in their order.
MEASURES = ("apt", "ankle_pitch", "hip_drop", "knee_valgus", "hip_rotation")
PATTERNS = ("apt_ankle_pitch", "hip_drop_apt", "hip_drop_pva", "knee_valgus_hip_drop", "knee_valgus_pva", "knee_valgus_apt", "hip_rotation_ankle_pitch", "hip_rotation_apt")
#: Names of the patterns' statistics where they differ from the pattern's.
STATS = tuple(f"{p}_stats" for p in PATTERNS)
#: Least t and least number of observations of a regression that counts.
LEAST_T, LEAST_OBS = 2.0, 100


@dataclass(frozen=True)
class Version:
    """What a version sends and keeps."""

    head: tuple[str, ...]
    measures: tuple[str, ...]
    patterns: tuple[str, ...] = ()
    nested: bool = True
    #: Measures of the kept record; those that are sent, if not given.
    kept: tuple[str, ...] | None = None


_HEAD = ("event_date", "session_id", "seconds_duration")
VERSIONS = {
    "4_3": Version((*_HEAD, "user_id"), MEASURES[:1], nested=False),
    "4_4": Version(_HEAD, MEASURES[:1], nested=False),
    "4_5": Version((*_HEAD, "end_date"), MEASURES[:3]),
    "4_6": Version((*_HEAD, "end_date"), MEASURES[:3], PATTERNS[:6], kept=MEASURES),
    "4_7": Version((*_HEAD, "end_date"), MEASURES, PATTERNS),
}
#: Versions that are not known are sent as the first one; sessions without one as the default.
OLDEST, DEFAULT, LATEST = "4_3", "4_4", "4_7"
SUMMARY = ("left", "right", "asymmetric_events", "symmetric_events", "percent_events_asymmetric")


def summaries(blocks: DataFrame, key: str = "session_id") -> DataFrame:
    """``key, asymmetry``: a map from measure to its summary, from time blocks.

    ``blocks`` has ``measure, left, right, significant``: medians of both sides in a time
    block.  Blocks where both are zero (or missing) are no events.
    """
    event = (F.coalesce("left", F.lit(0.0)) > 0) | (F.coalesce("right", F.lit(0.0)) > 0)
    n, bad = F.count_if(event), F.count_if(event & F.col("significant"))
    one = blocks.groupBy(key, "measure").agg(F.median("left").alias("left"), F.median("right").alias("right"), bad.alias("asymmetric_events"), (n - bad).alias("symmetric_events"), F.coalesce(F.bround(bad * 100 / F.nullif(n, F.lit(0)), 0), F.lit(0.0)).cast("long").alias("percent_events_asymmetric"))
    return one.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("measure", F.struct(*SUMMARY)))).alias("asymmetry"))


def time_blocks(blocks: DataFrame, key: str = "session_id") -> DataFrame:
    """``key, time_blocks``: the blocks in order, each with a map from measure to its sides."""
    one = blocks.groupBy(key, "time_block", "start_time", "end_time").agg(F.collect_list(F.struct("measure", F.struct("left", "right", "significant"))).alias("sides"))
    ordered = F.sort_array(F.collect_list(F.struct("time_block", "start_time", "end_time", "sides")))
    said = F.transform(ordered, lambda b: F.struct(*(b[n].alias(n) for n in ("time_block", "start_time", "end_time")), F.map_from_entries(b["sides"]).alias("sides")))
    return one.groupBy(key).agg(said.alias("time_blocks"))


def pattern_stats(stats: DataFrame, key: str = "session_id") -> DataFrame:
    """``key, patterns``: a map from pattern to its regressions, ordered by side and cadence.

    ``stats`` has ``pattern, side`` (1 left, 2 right) ``, cadence, elasticity, elasticity_t,
    elasticity_se, obs, adf, adf_critical``.
    """
    fields = ("side", "cadence", "elasticity", "elasticity_t", "elasticity_se", "obs", "adf", "adf_critical")
    one = stats.groupBy(key, "pattern").agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("stats"))
    return one.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("pattern", "stats"))).alias("patterns"))


def _most_observed(stats: Column, holds, name: str) -> Column:
    """``name`` of the regression with most observations among those that count; 0 without one."""
    fit = F.filter(stats, lambda s: holds(s) & (s["obs"] >= LEAST_OBS))
    # Of equal numbers of observations the first in order counts.
    first = F.aggregate(fit, F.get(fit, 0), lambda best, s: F.when(s["obs"] > best["obs"], s).otherwise(best))
    return F.coalesce(first[name], F.lit(0.0))


def _sides(stats: Column) -> Column:
    def side(k: int) -> Column:
        own = F.filter(F.coalesce(stats, F.array()), lambda s: s["side"] == k)
        return F.struct(_most_observed(own, lambda s: F.abs(s["elasticity_t"]) >= LEAST_T, "elasticity").alias("elasticity"), _most_observed(own, lambda s: s["adf"] > s["adf_critical"], "adf").alias("y_adf"))

    return F.struct(side(1).alias("left"), side(2).alias("right"))


def _inner(fields: Column) -> Column:
    """A struct's JSON without its braces; nulls stay."""
    said = F.to_json(fields, {"ignoreNullFields": "false"})
    return F.substring(said, F.lit(2), F.length(said) - 2)


def _document(*parts: Column) -> Column:
    """One JSON object of the parts that are not null."""
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def _summary(measure: str, names: Sequence[str] = SUMMARY) -> Column:
    return F.struct(*(F.col("asymmetry")[measure][n].alias(n) for n in names))


def body(version: str) -> Column:
    """The body of a version, from ``asymmetry`` and ``patterns`` (maps or null) and the head's fields."""
    v = VERSIONS.get(version, VERSIONS[OLDEST])
    head = _inner(F.struct(*v.head))
    if not v.nested:
        m = F.col("asymmetry")[v.measures[0]]
        flat = F.struct(m["left"].alias(f"left_{v.measures[0]}"), m["right"].alias(f"right_{v.measures[0]}"), m["asymmetric_events"].alias("asymmetric_events"), m["symmetric_events"].alias("symmetric_events"))
        return _document(head, _inner(F.struct(flat.alias("asymmetry"))))
    parts = [F.when(F.col("asymmetry").isNotNull(), _inner(F.struct(F.struct(*(_summary(m).alias(m) for m in v.measures)).alias("asymmetry"))))]
    if v.patterns:
        parts.append(F.when(F.col("patterns").isNotNull(), _inner(F.struct(F.struct(*(_sides(F.col("patterns")[p]).alias(p) for p in v.patterns)).alias("movement_patterns")))))
    return _document(head, *parts)


def asymmetry_record(version: str) -> Column:
    """The kept record of a version, from ``asymmetry``, ``time_blocks`` and the head's fields."""
    v = VERSIONS.get(version, VERSIONS[OLDEST])
    kept = v.kept or v.measures
    names = ("left", "right", "symmetric_events", "asymmetric_events", "percent_events_asymmetric")
    sides = ("left", "right", "significant")
    blocks = F.coalesce("time_blocks", F.array())
    if v.nested:
        head = F.struct("user_id", "event_date", "seconds_duration", "session_id", *(_summary(m, names).alias(m) for m in kept))
        blocks = F.transform(blocks, lambda b: F.struct(*(b[n].alias(n) for n in ("time_block", "start_time", "end_time")), *(F.struct(*(b["sides"][m][s].alias(s) for s in sides)).alias(m) for m in kept)))
        return _document(_inner(head), _inner(F.struct(blocks.alias("time_blocks"))))
    m = F.col("asymmetry")[kept[0]]
    flat = F.struct("user_id", "event_date", "session_id", m["left"].alias(f"left_{kept[0]}"), m["right"].alias(f"right_{kept[0]}"), *(m[n].alias(n) for n in names[2:]), "seconds_duration")
    blocks = F.transform(blocks, lambda b: F.struct(*(b[n].alias(n) for n in ("time_block", "start_time", "end_time")), *(b["sides"][kept[0]][s].alias(s) for s in sides)))
    return _document(_inner(flat), _inner(F.struct(blocks.alias("time_blocks"))))


def pattern_record() -> Column:
    """The kept record of the patterns, the same in every version: a list of regressions each, empty where there are none."""
    lists = (F.coalesce(F.col("patterns")[p], F.array()).alias(s) for p, s in zip(PATTERNS, STATS))
    return F.to_json(F.struct("user_id", "event_date", "seconds_duration", "session_id", *lists), {"ignoreNullFields": "false"})


def reserve() -> Column:
    """The body of the latest version that is kept beside an older one: null if the session's version is the latest."""
    extra = _inner(F.struct(F.lit(LATEST).alias("plans_version"), "user_id"))
    latest = body(LATEST)
    return F.when(F.coalesce("version", F.lit(DEFAULT)) != LATEST, F.concat(F.substring(latest, F.lit(1), F.length(latest) - 1), F.lit(","), extra, F.lit("}")))


def payloads(sessions: DataFrame) -> DataFrame:
    """``session_id, version, body, record, patterns, reserve`` of sessions by their ``version``.

    ``sessions`` has the head's fields, ``asymmetry``, ``patterns`` and ``time_blocks``.
    """
    version = F.coalesce("version", F.lit(DEFAULT))

    def chosen(build) -> Column:
        out = build(OLDEST)
        for name in VERSIONS:
            out = F.when(version == name, build(name)).otherwise(out)
        return out

    return sessions.select("session_id", version.alias("version"), chosen(body).alias("body"), chosen(asymmetry_record).alias("record"), pattern_record().alias("patterns"), reserve().alias("reserve"))
