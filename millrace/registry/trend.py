"""Queries of the bending trend and of back-tested bands, on events by hour."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import trend
from ..operators.forecast import hourly_series, predict
from .base import query, sql_time, table, time_text
from .taxi import HOURLY_SQL, MODEL_SQL

HOURS = 24 * 60
TERMS_SQL = "[1.0::DOUBLE, t, {}]".format(
    ", ".join(
        [f"greatest(t - {trend.BEND_SHARE}::DOUBLE * {k} / {trend.CHANGE_POINTS + 1}, 0)" for k in range(1, trend.CHANGE_POINTS + 1)]
        + [f"{w}(2 * pi() * {k} * hour(ds) / 24)" for k in range(1, trend.DAILY_WAVES + 1) for w in ("sin", "cos")]
        + [
            f"{w}(2 * pi() * {k} * ((isodow(ds) - 1) * 24 + hour(ds)) / 168)"
            for k in range(1, trend.WEEKLY_WAVES + 1)
            for w in ("sin", "cos")
        ]
    )
)
# Normal equations of ``hourly (series, ds, y)``: term ``i`` against ``j``, the target as the last ``j``.
SUMS_SQL = f"""
    spans AS (SELECT series, min(ds) AS first_ds, max(ds) AS last_ds,
                     greatest(datediff('hour', min(ds), max(ds)), 1) AS span FROM hourly GROUP BY 1),
    placed AS (SELECT *, datediff('hour', first_ds, ds)::DOUBLE / span AS t FROM hourly JOIN spans USING (series)),
    termed AS (SELECT series, y, list_append({TERMS_SQL}, y) AS x FROM placed),
    sums AS (SELECT series, i, j, sum(x[i + 1] * x[j + 1]) AS total
             FROM termed, range({trend.TERMS}) a(i), range({trend.TERMS + 1}) b(j) GROUP BY ALL)
"""


@query(
    "trend_sums",
    f"""WITH hourly AS (SELECT event_type AS series, date_trunc('hour', ts) AS ds, sum(value) AS y FROM events GROUP BY 1, 2),
             {SUMS_SQL}
        SELECT series AS event_type, i::INTEGER AS term, j::INTEGER AS other, round(total + 1e-9, 4) AS total FROM sums""",
)
def trend_sums(spark, folder):
    """Normal equations of the bending trend, per type of event."""
    hours = hourly_series(table(spark, folder, "events"), "ts", "value", ["event_type"])
    sums = trend.normal_sums(hours, ["event_type"])
    both = F.posexplode(F.concat("products", F.array("target"))).alias("other", "total")
    return sums.select("event_type", "term", both).withColumn("total", F.round(F.col("total") + 1e-9, 4))


@query(
    "trend_forecast",
    f"""WITH RECURSIVE hourly AS (SELECT 0 AS series, ds, y FROM ({HOURLY_SQL})), {SUMS_SQL},
        ridged AS (SELECT i, j, total + CASE WHEN i <> j THEN 0 WHEN i < 2 THEN 1e-9 ELSE {trend.RIDGE} END AS v FROM sums),
        equations AS (SELECT list(r ORDER BY i) AS m FROM (SELECT i, list(v ORDER BY j) AS r FROM ridged GROUP BY i)),
        solving AS (
            SELECT 1 AS k, m FROM equations
            UNION ALL
            SELECT k + 1, list_transform(m, lambda r, i: CASE WHEN i = k THEN list_transform(r, lambda v: v / r[k])
                       ELSE list_transform(r, lambda v, c: v - r[k] / m[k][k] * m[k][c]) END)
            FROM solving WHERE k <= {trend.TERMS}),
        model AS (SELECT list_transform(m, lambda r: r[{trend.TERMS + 1}]) AS w FROM solving WHERE k = {trend.TERMS + 1}),
        spread AS (SELECT sqrt(sum(power(y - list_dot_product(x[1:{trend.TERMS}], w), 2)) / (count(*) - 1)) AS sigma
                   FROM termed CROSS JOIN model),
        grid AS (SELECT ds FROM hourly UNION ALL
                 SELECT unnest(generate_series(last_ds + INTERVAL 1 HOUR, last_ds + INTERVAL {HOURS} HOUR, INTERVAL 1 HOUR))
                 FROM spans),
        guess AS (SELECT ds, list_dot_product({TERMS_SQL}, w) AS yhat, sigma
                  FROM (SELECT ds, datediff('hour', first_ds, ds)::DOUBLE / span AS t FROM grid CROSS JOIN spans)
                  CROSS JOIN model CROSS JOIN spread)
        SELECT {sql_time('ds')} AS ds, round(yhat, 3) AS yhat, round(yhat - 1.2816 * sigma, 3) AS yhat_lower,
               round(yhat + 1.2816 * sigma, 3) AS yhat_upper FROM guess""",
)
def trend_forecast(spark, folder):
    """Hours of all events seen and to come, with change points."""
    hours = hourly_series(table(spark, folder, "events"), "ts", "value")
    return trend.predict_bending(hours, hours=HOURS).select(
        time_text(F.col("ds")).alias("ds"), *(F.round(c, 3).alias(c) for c in ("yhat", "yhat_lower", "yhat_upper"))
    )


# Misses of the additive model after each cut; ``seen (e, ds, y)`` holds the hours by type.
MISSES_SQL = f"""
    seen AS (SELECT event_type AS e, date_trunc('hour', ts) AS ds, sum(value) AS y FROM events GROUP BY 1, 2),
    ends AS (SELECT e, min(ds) AS first_ds, max(ds) AS last_ds,
                    greatest((datediff('hour', min(ds), max(ds)) // 24 - {trend.DAYS_AHEAD + trend.MIN_DAYS}) // {trend.CUTS - 1}, 1)
                    AS step FROM seen GROUP BY 1),
    wanted AS (SELECT e, first_ds, last_ds - to_days({trend.DAYS_AHEAD}) - to_days((k * step)::INTEGER) AS nominal
               FROM ends, range({trend.CUTS}) r(k)),
    cuts AS (SELECT DISTINCT e, cut FROM (
                 SELECT e, first_ds, max(ds) AS cut FROM seen JOIN wanted USING (e) WHERE ds <= nominal
                 GROUP BY e, first_ds, nominal)
             WHERE cut >= first_ds + to_days({trend.MIN_DAYS})),
    hourly AS (SELECT {{'e': e, 'cut': cut}} AS series, ds, y FROM seen JOIN cuts USING (e) WHERE ds <= cut),
    {MODEL_SQL},
    held AS (SELECT {{'e': e, 'cut': cut}} AS series, e, ds, y, CAST(ceil(datediff('hour', cut, ds) / 24.0) AS INTEGER) AS day_ahead
             FROM seen JOIN cuts USING (e) WHERE ds > cut AND ds <= cut + to_days({trend.DAYS_AHEAD})),
    misses AS (SELECT e, day_ahead, y - (intercept + slope * datediff('hour', TIMESTAMP '2000-01-01', ds)
                      + coalesce(hour_effect, 0) + coalesce(day_effect, 0)) AS miss
               FROM held JOIN trend USING (series)
               LEFT JOIN hours ON hours.series = held.series AND hours.h = hour(ds)
               LEFT JOIN days ON days.series = held.series AND days.d = isodow(ds) - 1),
    sizes AS (SELECT e, day_ahead, quantile_cont(abs(miss), 0.8) AS own, count(*) AS n_misses FROM misses GROUP BY 1, 2),
    bands AS (SELECT e, day_ahead, max(own) OVER (PARTITION BY e ORDER BY day_ahead) AS reach, n_misses FROM sizes)
"""


@query(
    "forecast_backtest",
    f"""WITH {MISSES_SQL}
        SELECT e AS event_type, day_ahead, round(reach, 4) AS reach, n_misses FROM bands""",
)
def forecast_backtest(spark, folder):
    """Band per day ahead of the additive model, per type of event."""
    hours = hourly_series(table(spark, folder, "events"), "ts", "value", ["event_type"])
    bands = trend.tested_bands(trend.back_test(hours, predict, ["event_type"]), ["event_type"])
    return bands.withColumn("reach", F.round("reach", 4))
