"""Time-series and signal queries, on the events seen as series."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from grainfold.functions.dates import epoch_seconds
from grainfold.operators import signals, timeseries as ts
from grainfold.plans.registry import query, r, r_half
from grainfold.session import stored
from grainfold.sources.readers import read_table

_HOURLY = """(SELECT date_trunc('hour', ts) AS bin, datediff('hour', (SELECT date_trunc('hour', min(ts)) FROM events), date_trunc('hour', ts)) AS idx,
  avg(value) AS mean FROM events GROUP BY 1, 2)"""


def _hourly(spark, sf):
    return ts.bin_index(ts.resample(read_table(spark, sf, "events"), "ts", "value", "hour"), "hour")


@query("""SELECT date_trunc('day', ts) AS bin, event_type, round(avg(value) + 1e-7, 4) AS mean FROM events GROUP BY 1, 2""")
def resample_daily(spark, sf):
    out = ts.resample(read_table(spark, sf, "events"), "ts", "value", "day", ["event_type"])
    return out.withColumn("mean", r_half("mean"))


@query("""WITH b AS (SELECT user_id, date_trunc('day', ts) AS bin, avg(value) AS mean FROM events GROUP BY 1, 2),
  s AS (SELECT user_id, unnest(generate_series(min(bin), max(bin), INTERVAL 1 DAY)) AS bin FROM b GROUP BY user_id)
SELECT user_id, bin, round(mean + 1e-7, 4) AS mean FROM s LEFT JOIN b USING (user_id, bin)""")
def resample_gapfill(spark, sf):
    binned = ts.resample(read_table(spark, sf, "events"), "ts", "value", "day", ["user_id"])
    return ts.fill_bins(binned, "day", ["user_id"]).withColumn("mean", r_half("mean"))


@query("""SELECT event_id, ts FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-12 23:59:00'""")
def time_slice(spark, sf):
    t = read_table(spark, sf, "events").select("event_id", "ts")
    return ts.time_slice(t, "ts", "2024-01-05 00:00:00", "2024-01-12 23:59:00")


@query(f"""WITH h AS {_HOURLY}, c AS (SELECT bin, mean - (SELECT avg(mean) FROM h) AS x FROM h),
  d AS (SELECT bin::DATE AS day, list(x ORDER BY bin) AS v FROM c GROUP BY 1 HAVING count(*) = 24)
SELECT day::VARCHAR AS day, round(list_sum(v[1:23]), 4) AS feature_sum, round(v[1], 4) AS first, round(v[24], 4) AS target FROM d""")
def frame_series(spark, sf):
    days = ts.day_frames(_hourly(spark, sf))
    total = F.aggregate("features", F.lit(0.0), lambda a, x: a + x)
    return days.select(F.col("day").cast("string").alias("day"), r(total).alias("feature_sum"), r(F.col("features")[0]).alias("first"), r("target").alias("target"))


@query(f"""WITH h AS {_HOURLY}, c AS (SELECT idx, mean - (SELECT avg(mean) FROM h) AS x FROM h)
SELECT k::INT AS lag, round(sum(a.x * b.x) / (SELECT sum(x * x) FROM c), 6) AS acf FROM c a, range(0, 701) t(k) JOIN c b ON b.idx = a.idx + k GROUP BY k""")
def acf(spark, sf):
    return ts.acf(_hourly(spark, sf), "idx", "mean", 700).withColumn("acf", r("acf", 6))


@query(f"""WITH RECURSIVE h AS {_HOURLY}, c AS (SELECT idx, mean - (SELECT avg(mean) FROM h) AS x FROM h),
  a AS (SELECT k, sum(a.x * b.x) / (SELECT sum(x * x) FROM c) AS r FROM c a, range(1, 701) t(k) JOIN c b ON b.idx = a.idx + k GROUP BY k),
  r AS MATERIALIZED (SELECT list(r ORDER BY k) AS r, count(*) AS n FROM a),
  d AS (SELECT 0 AS k, []::DOUBLE[] AS phi, 1.0::DOUBLE AS error, 1.0::DOUBLE AS last
    UNION ALL
    SELECT k + 1, list_append(list_transform(range(1, k + 1), lambda i: phi[i] - new * phi[k + 1 - i]), new), error * (1 - new * new), new
    FROM (SELECT d.*, (r[k + 1] - coalesce(list_sum(list_transform(range(1, k + 1), lambda i: phi[i] * r[k + 1 - i])), 0)) / error AS new FROM d, r WHERE k < n))
SELECT k::INT AS lag, round(last, 4) AS pacf FROM d""")
def pacf(spark, sf):
    return ts.pacf(_hourly(spark, sf), "idx", "mean", 700).withColumn("pacf", r("pacf"))


@query(f"""WITH h AS {_HOURLY}, l AS (SELECT a.mean AS y, b.mean AS x FROM h a JOIN h b ON b.idx = a.idx - 1)
SELECT 'intercept' AS term, round(regr_intercept(y, x), 4) AS coefficient FROM l UNION ALL SELECT 'lag_1', round(regr_slope(y, x), 4) FROM l""")
def ar_fit(spark, sf):
    return ts.ar_fit(_hourly(spark, sf), "idx", "mean", 1).withColumn("coefficient", r("coefficient"))


@query()
def ar_fit_daily_lags(spark, sf):
    return ts.ar_fit(_hourly(spark, sf), "idx", "mean", 24)


@query(f"""WITH h AS {_HOURLY}, k AS (SELECT unnest(range(0, 401)) AS lag),
  w AS (SELECT idx FROM (SELECT idx, count(*) OVER (ORDER BY idx RANGE BETWEEN 400 PRECEDING AND CURRENT ROW) AS n FROM h) WHERE n = 401)
SELECT lag, (SELECT count(*) FROM w) AS rows, 0.0 AS residual FROM k""")
def ar_residuals(spark, sf):
    """The errors of an autoregression of order 400 are at right angles to every lag and to the constant (lag 0)."""
    hourly, order = stored(_hourly(spark, sf)), 400
    fit = {row.term: row.coefficient for row in ts.ar_fit(hourly, "idx", "mean", order).collect()}
    mean, n, sums, products = ts.ar_equations(hourly, "idx", "mean", order)
    slope = np.array([fit[f"lag_{h}"] for h in range(1, order + 1)])
    first = fit["intercept"] - mean * (1 - slope.sum())
    left = [sums[0] - n * first - slope @ sums[1:], *(products[0, 1:] - first * sums[1:] - slope @ products[1:, 1:])]
    scale = max(float(products[0, 0]), 1.0)
    return spark.createDataFrame([(h, n, abs(round(float(v) / scale, 6))) for h, v in enumerate(left)], "lag long, rows long, residual double")


@query(f"""WITH h AS {_HOURLY}, g AS (SELECT idx - min(idx) OVER () AS i, max(idx) OVER () - min(idx) OVER () + 1 AS n, mean - avg(mean) OVER () AS x FROM h),
  s AS (SELECT k, sum(x * cos(2 * pi() * ((k * i) % n) / n)) AS re, sum(-x * sin(2 * pi() * ((k * i) % n) / n)) AS im
    FROM g, (SELECT unnest(range(1, (SELECT max(n) FROM g) // 2 + 1)) AS k) GROUP BY k)
SELECT k, round(re, 4) AS re, round(im, 4) AS im, round(sqrt(re ** 2 + im ** 2), 4) AS magnitude FROM s""")
def periodogram(spark, sf):
    out = signals.periodogram(_hourly(spark, sf), "idx", "mean")
    return out.select("k", *[r(c).alias(c) for c in ("re", "im", "magnitude")])


@query(f"""WITH h AS (SELECT user_id, datediff('hour', TIMESTAMP '2024-01-01', ts) AS idx, avg(value) AS mean FROM events GROUP BY 1, 2),
  g AS (SELECT user_id, idx - min(idx) OVER w AS i, max(idx) OVER w - min(idx) OVER w + 1 AS n, mean - avg(mean) OVER w AS x FROM h WINDOW w AS (PARTITION BY user_id)),
  e AS (SELECT *, unnest(range(1, n // 2 + 1)) AS k FROM g),
  s AS (SELECT user_id, k, sqrt(sum(x * cos(2 * pi() * ((k * i) % n) / n)) ** 2 + sum(x * sin(2 * pi() * ((k * i) % n) / n)) ** 2) AS m FROM e GROUP BY user_id, k)
SELECT user_id, arg_max(k, m) AS k, round(max(m), 4) AS magnitude FROM s GROUP BY user_id""")
def dominant_bin(spark, sf):
    hour = F.floor((epoch_seconds(F.col("ts")) - 1704067200) / 3600)
    series = read_table(spark, sf, "events").groupBy("user_id", hour.alias("idx")).agg(F.avg("value").alias("mean"))
    out = signals.dominant_bin(signals.periodogram(series, "idx", "mean", ["user_id"]), ["user_id"])
    return out.select("user_id", "k", r("magnitude").alias("magnitude"))


_MORLET = """(cos(7 * x) - exp(-24.5)) * exp(x * x * -0.5) * pow(pi(), -0.25) * 1.6"""


@query(f"""WITH h AS {_HOURLY}, n AS (SELECT max(idx) + 1 AS n FROM h),
  f AS (SELECT mean - 45 AS y, -2 * pi() * 0.6 + 4 * pi() * 0.6 * least(idx + 90, n - 1) / (n - 1) AS x FROM h, n)
SELECT round(1 - sum((y - {_MORLET}) ** 2) / (var_pop(y) * count(*)), 6) AS r2, round(sqrt(sum((y - {_MORLET}) ** 2)), 4) AS residual FROM f""")
def template_fit(spark, sf):
    hourly = _hourly(spark, sf)
    length = hourly.select(F.max("idx") + 1).scalar()
    out = signals.template_fit(hourly.withColumn("y", F.col("mean") - 45), "idx", "y", length)
    return out.select(r("r2", 6).alias("r2"), r("residual").alias("residual"))


_CELLS = 20


@query(f"""WITH e AS (SELECT epoch_us(ts) / 1e6 AS t, value AS y FROM events WHERE event_type = 'purchase'),
  p AS (SELECT t - (SELECT min(t) FROM e) + 1 AS x, y FROM e),
  m AS (SELECT count(*) AS n, min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1, pow(count(*), -1.0 / 3) AS f2,
    var_samp(x) AS vx, var_samp(y) AS vy, covar_samp(x, y) AS vxy FROM p),
  g AS (SELECT i, j, x0 + i * (x1 - x0) / {_CELLS - 1} AS gx, y0 + j * (y1 - y0) / {_CELLS - 1} AS gy FROM m, range({_CELLS}) a(i), range({_CELLS}) b(j))
SELECT i, j, round(sum(exp(-0.5 * ((gx - x) ** 2 * vy - 2 * (gx - x) * (gy - y) * vxy + (gy - y) ** 2 * vx) / (f2 * (vx * vy - vxy * vxy))))
  / any_value(n * 2 * pi() * f2 * sqrt(vx * vy - vxy * vxy)) * 1e9, 4) AS density FROM g, p, m GROUP BY i, j""")
def kde_grid(spark, sf):
    t = read_table(spark, sf, "events").where("event_type = 'purchase'")
    t = t.select(epoch_seconds(F.col("ts")).alias("t"), "value")
    first = t.select(F.min("t")).scalar()
    out = signals.kde_grid(t.withColumn("t", F.col("t") - first + 1), "t", "value", _CELLS)
    return out.select("i", "j", r(F.col("density") * 1e9).alias("density"))


_EVENTS = """SELECT epoch_us(ts) / 1e6 AS x, value AS y FROM events"""


@query(f"""WITH p AS ({_EVENTS}),
  m AS (SELECT count(*) AS n, min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1, pow(count(*), -1.0 / 3) AS f2,
    var_samp(x) AS vx, var_samp(y) AS vy, covar_samp(x, y) AS vxy FROM p),
  g AS (SELECT i, j, x0 + i * (x1 - x0) / 199 AS gx, y0 + j * (y1 - y0) / 199 AS gy FROM m, range(0, 200, 20) a(i), range(0, 200, 20) b(j)),
  d AS (SELECT i, j, sum(exp(-0.5 * ((gx - x) ** 2 * vy - 2 * (gx - x) * (gy - y) * vxy + (gy - y) ** 2 * vx) / (f2 * (vx * vy - vxy * vxy))))
    / any_value(n * 2 * pi() * f2 * sqrt(vx * vy - vxy * vxy)) AS density FROM g, p, m GROUP BY i, j)
SELECT i, j, round(density / (SELECT max(density) FROM d), 2) AS share FROM d""")
def kde_fine(spark, sf):
    """Density of all events on 200 x 200 cells, of which every twentieth a side is given, in shares of the largest of them (the SQL twin adds up all kernels)."""
    t = read_table(spark, sf, "events").select(epoch_seconds(F.col("ts")).alias("t"), "value")
    cells = stored(signals.kde_binned(t, "t", "value", 200, fine=10).where("i % 20 = 0 AND j % 20 = 0"))
    top = cells.agg(F.max("density")).first()[0]
    return cells.select("i", "j", r(F.col("density") / top, 2).alias("share"))


def _minute_signal(spark, sf):
    """Mean value per event type and ten minutes, as samples (event_type, idx, value)."""
    slot = F.floor((epoch_seconds(F.col("ts")) - 1704067200) / 600)
    return read_table(spark, sf, "events").groupBy("event_type", slot.alias("idx")).agg(F.avg("value").alias("value"))


_SIGNAL = """(SELECT event_type, floor((epoch_us(ts) / 1e6 - 1704067200) / 600)::BIGINT AS idx, avg(value) AS v FROM events GROUP BY 1, 2)"""


@query(f"""WITH s AS (SELECT event_type, idx + 32 AS i, v FROM {_SIGNAL}),
  n AS (SELECT event_type, ceil((max(i) + 33 - 64) / 32.0)::BIGINT + 1 AS frames FROM s GROUP BY 1),
  f AS (SELECT event_type, i // 32 - b AS frame, i - 32 * (i // 32 - b) AS p, v FROM s, range(0, 2) t(b)),
  x AS (SELECT event_type, frame, k, sum(v * (0.5 - 0.5 * cos(2 * pi() * p / 64)) * cos(2 * pi() * ((k * p) % 64) / 64)) / 32 AS re,
    sum(v * (0.5 - 0.5 * cos(2 * pi() * p / 64)) * sin(2 * pi() * ((k * p) % 64) / 64)) / 32 AS im FROM f, range(0, 33) t(k) WHERE frame >= 0 GROUP BY 1, 2, 3)
SELECT event_type, frame // 3 AS example, 3 AS width, round(sum(re * re + im * im), 4) AS total FROM x JOIN n USING (event_type)
WHERE frame < frames GROUP BY 1, 2, frames HAVING frame // 3 < any_value(frames) // 3""")
def stft_power(spark, sf):
    frames = signals.stft_power(_minute_signal(spark, sf), "event_type", "idx", "value", nperseg=64)
    return signals.group_frames(frames, "event_type", 3).select(
        "event_type", "example", F.size("power").alias("width"),
        r(F.aggregate(F.flatten("power"), F.lit(0.0), lambda a, x: a + x)).alias("total"),
    )


@query()
def cwt_ricker(spark, sf):
    out = signals.cwt_ricker(_minute_signal(spark, sf), "event_type", "idx", "value")
    return out.select("event_type", "idx", F.transform("coef", lambda x: F.round(x, 6)).alias("coef"))


_U = "(CAST(CAST('0x' || substr(md5('1{0}|' || event_id), 1, 13) AS BIGINT) AS DOUBLE) + 1) / 4503599627370496.0"


@query(f"""SELECT event_id, round(value + sqrt(-2 * ln({_U.format('a')})) * cos(2 * pi() * {_U.format('b')}) * sqrt(2000.0), 4) AS value FROM events""")
def add_noise(spark, sf):
    noisy = signals.add_noise(read_table(spark, sf, "events").select("event_id", "value"), "value", 8000, 1, "event_id")
    return noisy.withColumn("value", r("value"))


@query("""SELECT event_type, frame, n, round(total, 4) AS total FROM (SELECT event_type, idx // 12 AS frame, count(*) AS n, sum(v) AS total
  FROM (SELECT event_type, row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS idx, value AS v FROM events) GROUP BY 1, 2) WHERE n = 12""")
def cut_frames(spark, sf):
    from grainfold.operators.ordered import OrderedGroups

    t = read_table(spark, sf, "events").select("event_type", "event_id", "value")
    numbered = OrderedGroups(t, ["event_type"], ["event_id"]).position("pos").frame()
    numbered = numbered.withColumn("idx", F.col("pos") - 1)
    frames = signals.cut_frames(numbered, "event_type", "idx", "value", 12)
    total = F.aggregate("samples", F.lit(0.0), lambda a, x: a + x)
    return frames.select("event_type", "frame", F.size("samples").cast("long").alias("n"), r(total).alias("total"))
