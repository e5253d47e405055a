"""Session metadata: ids, times, states and change events as column expressions."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

FORMATS = ("yyyy-MM-dd'T'HH:mm:ss.SSSSSSX", "yyyy-MM-dd'T'HH:mm:ss.SSSX", "yyyy-MM-dd'T'HH:mm:ssX", "yyyy-MM-dd HH:mm:ss")
#: Allowed changes of a session's state.
TRANSITIONS = (("CREATE_COMPLETE", "UPLOAD_IN_PROGRESS"), ("UPLOAD_IN_PROGRESS", "UPLOAD_COMPLETE"), ("CREATE_COMPLETE", "UPLOAD_COMPLETE"), ("CREATE_COMPLETE", "CREATE_COMPLETE"))


def session_id(accessory: Column, sensors: Column, user: Column, date: Column, prefix: str = "http://session.example.com/") -> Column:
    """Name-based UUID (version 5, URL namespace) of the parts; a missing part prints as None.

    ``prefix`` is the URL that the deployment puts before its names.
    """
    parts = (accessory, F.array_join(F.array_sort(sensors), ","), user, date)
    name = F.concat(F.lit(prefix), F.concat_ws("_", *(F.coalesce(p, F.lit("None")) for p in parts)))
    h = F.sha1(F.concat(F.lit(uuid.NAMESPACE_URL.bytes), name.cast("binary")))
    variant = F.substring(F.lit("89ab"), (F.conv(F.substring(h, 17, 1), 16, 10).cast("int") % 4) + 1, F.lit(1))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 18, 3)), F.substring(h, 21, 12))


def parse_time(text: Column) -> Column:
    """A timestamp in any accepted format, else null."""
    return F.coalesce(*(F.try_to_timestamp(text, F.lit(f)) for f in FORMATS))


def local_time(at: Column, offset: Column) -> Column:
    """UTC to local time by an offset such as +05:30."""
    sign = F.when(F.substring(offset, 1, 1) == "-", -1).otherwise(1)
    minutes = sign * (F.substring(offset, 2, 2).cast("int") * 60 + F.substring(offset, 5, 2).cast("int"))
    return F.timestamp_micros(F.unix_micros(at) + minutes.cast("long") * 60_000_000)


def corrected_event_date(said: Column, server: Column, mobile: Column) -> Column:
    """The server's time for errors and dates over five minutes ahead; mobile callers are five seconds late."""
    t = F.unix_micros(said)
    now = F.unix_micros(server)
    micros = F.when(t.isNull() | (t > now + 300_000_000), now).otherwise(t + F.when(mobile, 5_000_000).otherwise(0))
    return F.timestamp_micros(micros)


def may_change(old: Column, new: Column) -> Column:
    return F.concat_ws(">", old, new).isin(*(">".join(t) for t in TRANSITIONS))


def changed(new: Column, old: Column) -> Column:
    """Entries of a map that are new or differ."""
    return F.map_filter(new, lambda k, v: ~v.eqNullSafe(F.try_element_at(old, k)))


def decoded_attribute(tagged: Column) -> Column:
    """Value of a tagged attribute (struct of S, N, SS, L, NULL) as text."""
    return F.when(tagged["NULL"], None).otherwise(F.coalesce(tagged["S"], tagged["N"], F.array_join(tagged["SS"], ","), F.to_json(tagged["L"])))
