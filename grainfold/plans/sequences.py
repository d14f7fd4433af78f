"""Ordered queries: imputation, sessions, intervals, frames, jump scan."""

from __future__ import annotations

from pyspark.sql import functions as F

from grainfold.functions.dates import epoch_seconds
from grainfold.operators import clean, sequence
from grainfold.plans.registry import query, r, r_half
from grainfold.sources.readers import read_table

ORDER = ["ts", "event_id"]
# every seventh value is taken out, so that there is something to fill
_GAPPY = "(SELECT *, CASE WHEN event_id % 7 <> 0 THEN value END AS v, CASE WHEN event_id % 7 <> 0 THEN event_type END AS kind FROM events)"


def _gappy(spark, sf):
    known = F.col("event_id") % 7 != 0
    return read_table(spark, sf, "events").withColumns(
        {"v": F.when(known, F.col("value")), "kind": F.when(known, F.col("event_type"))}
    )


@query(f"""SELECT event_id, round(coalesce(v, avg(v) OVER (PARTITION BY user_id, event_type)) + 1e-7, 4) AS v FROM {_GAPPY}""")
def impute_group_mean(spark, sf):
    out = clean.impute_group_mean(_gappy(spark, sf), ["v"], ["user_id", "event_type"])
    return out.select("event_id", r_half("v").alias("v"))


@query(f"""SELECT event_id, coalesce(v, round_even(avg(v) OVER (PARTITION BY user_id), 0)) AS v FROM {_GAPPY}""")
def impute_group_round(spark, sf):
    return clean.impute_group_mean(_gappy(spark, sf), ["v"], ["user_id"], half_even=True).select("event_id", "v")


@query(f"""WITH m AS (SELECT user_id, kind AS mode FROM (SELECT user_id, kind, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, kind) AS k
  FROM {_GAPPY} WHERE kind IS NOT NULL GROUP BY user_id, kind) WHERE k = 1)
SELECT event_id, coalesce(kind, mode) AS kind FROM {_GAPPY} LEFT JOIN m USING (user_id)""")
def impute_group_mode(spark, sf):
    return clean.impute_group_mode(_gappy(spark, sf), "kind", ["user_id"]).select("event_id", "kind")


@query("""SELECT l_orderkey, l_partkey, l_linenumber, count(*) OVER (PARTITION BY l_partkey) AS group_size FROM lineitem""")
def group_size(spark, sf):
    t = read_table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    return clean.group_size(t, ["l_partkey"])


@query("""SELECT event_id, round(value - lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id), 4) AS diff FROM events""")
def first_diff(spark, sf):
    t = read_table(spark, sf, "events").select("event_id", "ts", "user_id", "value")
    return sequence.first_diff(t, "value", ["user_id"], ORDER).select("event_id", r("diff").alias("diff"))


@query(f"""WITH p AS (SELECT *, row_number() OVER w AS pos FROM {_GAPPY} WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
  n AS (SELECT *, max(CASE WHEN v IS NOT NULL THEN pos END) OVER (PARTITION BY user_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS lo,
    min(CASE WHEN v IS NOT NULL THEN pos END) OVER (PARTITION BY user_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS hi FROM p)
SELECT n.event_id, round(coalesce(n.v, a.v + (b.v - a.v) * (n.pos - n.lo) / (n.hi - n.lo)) + 1e-7, 4) AS filled FROM n
LEFT JOIN p a ON a.user_id = n.user_id AND a.pos = n.lo LEFT JOIN p b ON b.user_id = n.user_id AND b.pos = n.hi""")
def interpolate_linear(spark, sf):
    t = _gappy(spark, sf).select("event_id", "ts", "user_id", "v")
    return sequence.interpolate_linear(t, "v", ["user_id"], ORDER).select("event_id", r_half("filled").alias("filled"))


_SESSIONS = """(SELECT *, sum(jump) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS session FROM
  (SELECT *, (coalesce(epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id), 0) > 7200000000)::INT AS jump FROM events))"""


def _sessions(spark, sf):
    t = read_table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type")
    return sequence.gap_sessions(t, epoch_seconds(F.col("ts")), 7200, ["user_id"], ORDER)


@query(f"SELECT event_id, user_id, session FROM {_SESSIONS}")
def gap_sessions(spark, sf):
    return _sessions(spark, sf).select("event_id", "user_id", "session")


@query(f"""SELECT user_id, session, text FROM (SELECT user_id, session, string_agg(event_type, ' ' ORDER BY ts, event_id) AS text
FROM {_SESSIONS} GROUP BY user_id, session) WHERE length(text) > 20""")
def session_concat(spark, sf):
    return sequence.session_concat(_sessions(spark, sf), "event_type", ["user_id", "session"], ORDER)


# intervals: every event lasts 30 seconds per unit of value; times in whole seconds since 2024
_SPANS = """(SELECT user_id, floor(epoch_us(ts) / 1000000)::BIGINT - 1704067200 AS s,
  floor(epoch_us(ts) / 1000000)::BIGINT - 1704067200 + (round(value) * 30)::BIGINT AS e FROM events)"""
_MERGED = f"""(SELECT user_id, min(s) AS s, max(e) AS e FROM (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island
  FROM (SELECT *, coalesce(s > max(e) OVER (PARTITION BY user_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false)::INT AS fresh
  FROM {_SPANS})) GROUP BY user_id, island)"""


def _spans(spark, sf):
    start = F.floor(epoch_seconds(F.col("ts"))).cast("long") - 1704067200
    return read_table(spark, sf, "events").select(
        "user_id", start.alias("start"), (start + (F.round("value") * 30).cast("long")).alias("end")
    )


@query(f'SELECT user_id, s AS start, e AS "end" FROM {_MERGED}')
def merge_intervals(spark, sf):
    return sequence.merge_intervals(_spans(spark, sf), "start", "end", ["user_id"])


@query(f"""WITH m AS {_MERGED}, f AS (SELECT user_id, unnest(range(floor(min(s) / 3600)::BIGINT, ceil(max(e) / 3600)::BIGINT)) AS frame FROM m GROUP BY user_id)
SELECT f.user_id, frame, round(coalesce(sum(CASE WHEN s IS NOT NULL THEN least(e, (frame + 1) * 3600) - greatest(s, frame * 3600) END), 0) / 3600.0, 6) AS covered,
  (coalesce(sum(CASE WHEN s IS NOT NULL THEN least(e, (frame + 1) * 3600) - greatest(s, frame * 3600) END), 0) > 1800)::INT AS label
FROM f LEFT JOIN m ON m.user_id = f.user_id AND s < (frame + 1) * 3600 AND e > frame * 3600 GROUP BY f.user_id, frame""")
def interval_overlap_label(spark, sf):
    spans = _spans(spark, sf)
    whole = spans.groupBy("user_id").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    out = sequence.label_frames(whole, spans, 3600, "user_id")
    return out.select("user_id", "frame", r("covered", 6).alias("covered"), "label")


# The scan step by step: the window of each row by lead(), then one recursion step per move.
@query("""WITH RECURSIVE v AS (SELECT user_id, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY user_id) AS n,
    CASE WHEN event_id % 3 = 0 THEN value ELSE -value END AS x FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
  l AS (SELECT *, lead(x, 1) OVER w AS x1, lead(x, 2) OVER w AS x2, lead(x, 3) OVER w AS x3, lead(x, 4) OVER w AS x4
    FROM v WINDOW w AS (PARTITION BY user_id ORDER BY i)),
  g AS (SELECT *, CASE WHEN x >= 0 THEN 0 WHEN x1 >= 0 THEN 1 WHEN x2 >= 0 THEN 2 WHEN x3 >= 0 THEN 3 WHEN x4 >= 0 THEN 4 END AS good,
    greatest(x1, x2, x3, x4) AS top4 FROM l),
  s AS (SELECT user_id, 0::BIGINT AS i, false AS still, 0.0::DOUBLE AS total FROM v GROUP BY user_id
    UNION ALL
    SELECT s.user_id, CASE WHEN g.x >= 0 THEN s.i + 1 WHEN good IS NOT NULL THEN s.i + good WHEN s.i + 5 >= g.n THEN g.n
        WHEN NOT still AND g.x >= top4 THEN s.i
        ELSE s.i + CASE top4 WHEN x1 THEN 1 WHEN x2 THEN 2 WHEN x3 THEN 3 ELSE 4 END END,
      good IS NULL AND s.i + 5 < g.n AND NOT still AND g.x >= top4,
      total + CASE WHEN g.x >= 0 THEN g.x WHEN good IS NOT NULL OR s.i + 5 >= g.n THEN 0
        WHEN NOT still AND g.x >= top4 THEN g.x ELSE top4 END
    FROM s JOIN g ON g.user_id = s.user_id AND g.i = s.i)
SELECT user_id, round(arg_max(total, i * 2 + still::INT), 4) AS score FROM s GROUP BY user_id""")
def bounded_jump_score(spark, sf):
    signed = F.when(F.col("event_id") % 3 == 0, F.col("value")).otherwise(-F.col("value"))
    t = read_table(spark, sf, "events").select("user_id", *ORDER, signed.alias("x"))
    return sequence.bounded_jump_score(t, "x", ["user_id"], ORDER).withColumn("score", r("score"))
