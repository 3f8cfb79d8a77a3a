"""Contact journey and audience queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog import inputs as src
from millrace.catalog.registry import query, table
from millrace.functions.dates import slot_start
from millrace.operators.sessions import sessionize
from millrace.plans import audience, journey

TOUCHES = (
    "CASE touch_point WHEN 'Pay my Bill' THEN 'pay' WHEN 'Renewal' THEN 'renewal' WHEN 'Billing Call' THEN 'bill' WHEN 'Audit Notice' THEN 'audit' "
    "WHEN 'Get Quote' THEN 'quote' WHEN 'Missing Info' THEN 'unknown' WHEN 'Cancellation' THEN 'cancel' END"
)


def _counts(col: str, listed) -> str:
    return ", ".join(f"nullif(count(*) FILTER ({col} = '{v}'), 0) AS no_of_{v.lower()}_cnts" for v in listed)


WIDE = ", ".join([
    _counts("channel", journey.CHANNELS), _counts("day_part", journey.DAY_PARTS), _counts("term_phase", journey.PHASES),
    _counts("weekday", journey.WEEKDAYS), _counts("status", journey.STATUSES),
])
WORK = " + ".join(f"no_of_{d.lower()}_cnts" for d in journey.WEEKDAYS[:5])


@query(f"""WITH {src.CONTACT_SQL},
wide AS (SELECT pol_id, term_eff_dt, count(channel) AS no_of_cnts, {WIDE} FROM (SELECT *, {TOUCHES} AS status FROM journey) GROUP BY 1, 2)
SELECT *, {WORK} AS no_of_weekday_cnts, no_of_sat_cnts + no_of_sun_cnts AS no_of_weekendday_cnts FROM wide""")
def journey_features(spark, sf):
    return journey.journey_features(src.contact_events(spark, sf), src.contact_terms(spark, sf), journey.touch_map(spark))


@query(f"""WITH {src.CONTACT_SQL}
SELECT event_id, pol_id, term_eff_dt, channel, day_part, term_phase, weekday, coalesce(touch_point, 'unknown') AS touch_point, {TOUCHES} AS touch_point_status FROM journey""")
def journey_events(spark, sf):
    out = journey.journey_events(src.contact_events(spark, sf), src.contact_terms(spark, sf), journey.touch_map(spark))
    return out.select("event_id", "pol_id", "term_eff_dt", "channel", "day_part", "term_phase", "weekday", "touch_point", "touch_point_status")


CELLS = ["state", "location_class"]


def rolled_sql(base: str, by: str) -> str:
    """Cells of ``base`` with all-states, urban+rural and urban rows added, and the people of each."""
    return f"""
SELECT s.state, c.location_class, {by}, CAST(sum(raw_reach) AS BIGINT) AS raw_reach, CAST(sum(raw_watchtime) AS BIGINT) AS raw_watchtime,
       CAST(sum(reach) AS DOUBLE) AS reach, CAST(sum(watchtime) AS DOUBLE) AS watchtime, any_value(p.universe) AS universe, any_value(p.active_pop) AS active_pop
FROM {base} b, LATERAL (SELECT unnest([b.state, 'India']) AS state) s,
LATERAL (SELECT unnest(CASE WHEN upper(trim(b.location_class)) <> 'RURAL' THEN [b.location_class, 'U+R', 'U'] ELSE [b.location_class, 'U+R'] END) AS location_class) c
LEFT JOIN people p ON p.state = s.state AND p.location_class = c.location_class
GROUP BY s.state, c.location_class, {by}"""


def weighted_sql(viewing: str, by: str, seconds: str) -> str:
    return f"""
SELECT v.state, v.location_class, {by}, count(DISTINCT device) AS raw_reach, sum({seconds}) AS raw_watchtime,
       CAST(count(DISTINCT device) * (any_value(u.universe)::DOUBLE / any_value(active_pop)) AS DECIMAL(30,6)) AS reach,
       CAST(sum({seconds})::BIGINT * (any_value(u.universe)::DOUBLE / any_value(active_pop)) AS DECIMAL(30,6)) AS watchtime
FROM {viewing} v LEFT JOIN universe u USING (state, location_class) LEFT JOIN actives a USING (state, location_class)
GROUP BY v.state, v.location_class, {by}"""


def _plain(df):
    return df.withColumns({c: F.col(c).cast("double") for c in ("reach", "watchtime")})


SLOT_RATIOS = """
round(reach / universe * 100, 6) AS reach_perc, round(watchtime / 60.0::DOUBLE / 30.0::DOUBLE, 6) AS impressions,
round(watchtime / 60.0::DOUBLE / nullif(reach, 0), 6) AS tsv, round(watchtime / 60.0::DOUBLE / 30.0::DOUBLE / universe * 100, 6) AS tvr"""

SLOTS = f"""
tv AS (SELECT * FROM (SELECT * REPLACE (unnest([channel, 'ANYTV']) AS channel) FROM viewing)),
slots AS (SELECT *, time_bucket(INTERVAL 30 MINUTE, ts) AS slot_start, CAST(week(ts) AS INTEGER) AS week FROM tv),
slot_base AS ({weighted_sql("slots", "channel, slot_start, week", "seconds")}),
slot_rolled AS ({rolled_sql("slot_base", "channel, slot_start, week")}),
slot_rows AS (SELECT *, {SLOT_RATIOS} FROM slot_rolled)"""


def _people(spark, sf):
    v = src.viewing(spark, sf)
    return v, src.universe(spark, sf), audience.active_ids(v, CELLS, "device")


def _slots(spark, sf):
    v, universe, actives = _people(spark, sf)
    v = v.withColumns({"slot_start": slot_start(F.col("ts")), "week": F.weekofyear("ts")})
    return audience.slot_summary(v, universe, actives, CELLS, ["slot_start", "week"], "channel", "device", "seconds")


@query(f"WITH {src.AUDIENCE_SQL}, {SLOTS} SELECT * FROM slot_rows")
def audience_slot(spark, sf):
    return _plain(_slots(spark, sf))


@query(f"""WITH {src.AUDIENCE_SQL}, {SLOTS},
week_base AS ({weighted_sql("slots", "channel, week", "seconds")}),
week_rolled AS ({rolled_sql("week_base", "channel, week")}),
gross AS (SELECT state, location_class, channel, week, CAST(sum(CAST(impressions AS DECIMAL(30,6))) AS DOUBLE) AS g, CAST(sum(CAST(tvr AS DECIMAL(30,6))) AS DOUBLE) AS grp FROM slot_rows GROUP BY ALL)
SELECT w.state, w.location_class, w.channel, w.week, universe, active_pop, round(reach, 6) AS creach, round(reach / universe * 100, 6) AS reach_perc,
round(g.g, 6) AS gross_impressions, round(a.g, 6) AS gross_impressions_anytv, round(g.grp, 6) AS grp, round(g.g / nullif(a.g, 0) * 100, 6) AS share,
round(watchtime / 60.0::DOUBLE / nullif(reach, 0), 6) AS tsv
FROM week_rolled w LEFT JOIN gross g USING (state, location_class, channel, week)
LEFT JOIN (SELECT * FROM gross WHERE channel = 'ANYTV') a ON w.state = a.state AND w.location_class = a.location_class AND w.week = a.week""")
def audience_week(spark, sf):
    v, universe, actives = _people(spark, sf)
    v = v.withColumn("week", F.weekofyear("ts"))
    base = audience.weighted_cells(v, universe, actives, CELLS, ["channel", "week"], "device", "seconds", any_of="channel")
    reach = audience.with_population(audience.region_rollups(base, ["channel", "week"]), universe, actives, CELLS)
    out = audience.weekly_summary(_slots(spark, sf), reach, CELLS, "channel", "week")
    return out.select(
        *CELLS, "channel", "week", "universe", "active_pop", "creach", "reach_perc", "gross_impressions", "gross_impressions_anytv", "grp", "share", "tsv"
    )


@query(f"""WITH {src.AUDIENCE_SQL},
dots AS (SELECT device, channel, CAST(epoch_us(ts) AS BIGINT) AS t, max(CAST(epoch_us(ts) AS BIGINT) + seconds * 1000000) AS e FROM viewing GROUP BY 1, 2, 3),
seen AS (SELECT *, max(e) OVER (PARTITION BY device, channel ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM dots),
runs AS (SELECT *, sum(CASE WHEN p IS NULL OR t > p + 7200 * 1000000::BIGINT THEN 1 ELSE 0 END) OVER (PARTITION BY device, channel ORDER BY t ROWS UNBOUNDED PRECEDING) AS g FROM seen),
sessions AS (SELECT device, channel, make_timestamp(min(t)) AS a0, make_timestamp(max(e)) AS a1 FROM runs GROUP BY device, channel, g HAVING max(e) > min(t)),
programmes AS (SELECT channel, unnest([day + INTERVAL 8 HOUR + INTERVAL 29 SECOND, day + INTERVAL 18 HOUR + INTERVAL 29 SECOND]) AS prg_start,
                      unnest([day + INTERVAL 8 HOUR + INTERVAL 1815 SECOND, day + INTERVAL 22 HOUR + INTERVAL 15 SECOND]) AS prg_end
               FROM (SELECT DISTINCT channel, date_trunc('day', ts) AS day FROM viewing)),
views AS (SELECT s.device, c.state, c.location_class, s.channel, prg_start, prg_end,
                 (epoch_us(least(a1, prg_end)) - epoch_us(greatest(a0, prg_start))) // 1000000 AS secs
          FROM sessions s JOIN programmes p ON s.channel = p.channel AND a0 < prg_end AND a1 > prg_start JOIN cells c ON s.device = c.device),
base AS ({weighted_sql("views", "channel, prg_start, prg_end", "secs")}),
rolled AS ({rolled_sql("base", "channel, prg_start, prg_end")}),
m AS (SELECT *, (epoch_us(prg_end) - epoch_us(prg_start)) / 60000000.0::DOUBLE AS mins FROM rolled)
SELECT * EXCLUDE (mins), round(reach / universe * 100, 6) AS reach_perc, round(watchtime / 60.0::DOUBLE / 30.0::DOUBLE, 6) AS gvt,
round(watchtime / 60.0::DOUBLE / mins, 6) AS tvt, round(watchtime / 60.0::DOUBLE / nullif(reach, 0), 6) AS tsv, round(watchtime / 60.0::DOUBLE / mins / universe * 100, 6) AS tvr FROM m""")
def programme_summary(spark, sf):
    v, universe, actives = _people(spark, sf)
    sessions = sessionize(v, ["device", "channel"], "ts", "seconds", gap=7200)
    days = v.select("channel", F.to_date("ts").cast("timestamp_ntz").alias("day")).distinct()

    def at(hours: int, secs: int):
        return F.col("day") + F.make_dt_interval(hours=F.lit(hours), secs=F.lit(secs))

    slots = F.array(
        F.struct(at(8, 29).alias("prg_start"), at(8, 1815).alias("prg_end")), F.struct(at(18, 29).alias("prg_start"), at(22, 15).alias("prg_end"))
    )
    programmes = days.select("channel", F.inline(slots))
    views = audience.programme_views(sessions, programmes, "channel", ("start_time", "end_time"), ("prg_start", "prg_end"))
    views = views.join(src.device_cells(spark, sf), "device")
    return _plain(audience.programme_summary(views, universe, actives, CELLS, ["channel", "prg_start", "prg_end"], "device", "prg_start", "prg_end"))


@query("""
WITH v AS (SELECT event_id, trim(regexp_replace(replace(regexp_replace(event_type || CASE WHEN value > 100 THEN '_(tbr)' ELSE '(V)' END, '(?i)\\((tbr|nw|na|v)\\)', '', 'g'), '_', ' '), ' +', ' ', 'g')) AS channel FROM events),
m AS (SELECT event_type AS channel, upper(event_type) || ' HD' AS display_name FROM events WHERE event_type <> 'error' GROUP BY 1)
SELECT event_id, channel, display_name FROM v LEFT JOIN m USING (channel) WHERE channel IN (SELECT event_type FROM events WHERE value > 335 GROUP BY 1)""")
def channel_mapping(spark, sf):
    e = table(spark, sf, "events")
    views = e.select("event_id", F.concat("event_type", F.when(F.col("value") > 100, "_(tbr)").otherwise("(V)")).alias("channel"))
    names = e.filter(F.col("event_type") != "error").groupBy(F.concat(F.col("event_type"), F.lit("(na)")).alias("channel")).agg(
        F.max(F.concat(F.upper("event_type"), F.lit(" HD"))).alias("display_name")
    )
    approved = e.filter(F.col("value") > 335).select(F.col("event_type").alias("channel")).distinct()
    return audience.map_channels(views, names, "channel", approved).select("event_id", "channel", "display_name")
