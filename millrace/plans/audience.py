"""Audience measurement: viewing sessions to programme, 30-minute and weekly metrics with region roll-ups.

The weighting and ratio rules were worked out from published sample rows; every
unproven one is a parameter (see README, "Known limits").
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.text import tidy_of
from millrace.operators.aggregates import rollup_labels
from millrace.operators.filters import keep_listed, same_text
from millrace.operators.ranges import overlap_join

# Labels of the roll-ups and of the pseudo-channel that stands for all viewing.
ALL_STATES = "India"
URBAN_RURAL = "U+R"
URBAN = "U"
RURAL = "rural"
ANY_CHANNEL = "ANYTV"

# Weighted counts are decimals, so that their sums do not depend on the order of rows.
METRIC = "decimal(30,6)"
ADDITIVE = ("raw_reach", "raw_watchtime", "reach", "watchtime")


def class_rules(col: str = "location_class") -> dict[str, Column]:
    """Urban and rural together; urban alone."""
    return {URBAN_RURAL: F.lit(True), URBAN: ~same_text(F.col(col), RURAL)}


def active_ids(signals: DataFrame, cells: list[str], device: str) -> DataFrame:
    return signals.groupBy(*cells).agg(F.count_distinct(device).alias("active_pop"))


def weighted_cells(viewing: DataFrame, universe: DataFrame, actives: DataFrame, cells: list[str], by: list[str],
                   device: str, seconds: str, any_of: str | None = None) -> DataFrame:
    """Raw and weighted reach and watch time per (cell, ``by``); weight = universe / active ids of the cell.

    Rows are sorted by device and the first of each device in a group is marked, so that devices are counted without a table of
    all of them in memory. ``any_of`` names a column of ``by`` whose values are also counted together under the all-viewing label.
    """
    rest = [c for c in by if c != any_of]
    order = Window.partitionBy(device, *cells, *rest).orderBy(F.col(any_of) if any_of else F.lit(0))
    known = F.col(device).isNotNull()
    first = F.row_number().over(order) == 1
    rows = viewing.select(*cells, *by, device, F.col(seconds).cast("long").alias("__watch"))
    if any_of:
        new = first | ~F.lag(any_of).over(order).eqNullSafe(F.col(any_of))
        rows = rows.withColumns({"__whole": first & known, "__own": new & known})
        # The all-viewing half is added before rows are combined per group, which holds a channel with a third of all rows to one row a task.
        both = F.array(F.struct(F.col(any_of), F.col("__own").alias("__new")), F.struct(F.lit(ANY_CHANNEL).alias(any_of), F.col("__whole").alias("__new")))
        rows = rows.select(*cells, *rest, "__watch", F.inline(both))
    else:
        rows = rows.withColumn("__new", first & known)
    raw = rows.groupBy(*cells, *by).agg(F.count_if("__new").alias("raw_reach"), F.sum("__watch").alias("raw_watchtime"))
    weight = F.try_divide(F.col("universe").cast("double"), F.col("active_pop").cast("double"))
    weights = universe.join(actives, cells).select(*cells, weight.alias("__weight"))
    return (
        raw.join(weights, cells, "left")
        .withColumns({n: (F.col(f"raw_{n}") * F.col("__weight")).cast(METRIC) for n in ("reach", "watchtime")})
        .drop("__weight")
    )


def region_rollups(cells: DataFrame, by: list[str], sums: list[str] | None = None, state: str = "state",
                   cls: str = "location_class", state_rules: dict[str, Column] | None = None) -> DataFrame:
    """Add all-states (or the given state groups), urban+rural and urban rows beside the single cells."""
    sums = list(sums or ADDITIVE)
    keys = [state, cls, *by]
    rules = {ALL_STATES: F.lit(True)} if state_rules is None else state_rules
    wide = rollup_labels(cells.select(*keys, *sums), keys, state, rules, sums)
    return rollup_labels(wide, keys, cls, class_rules(cls), sums)


def with_population(rolled: DataFrame, universe: DataFrame, actives: DataFrame, cells: list[str], **rules) -> DataFrame:
    """Universe and active ids of every cell and roll-up, viewed or not."""
    people = universe.join(actives, cells, "left").select(*cells, "universe", "active_pop")
    return rolled.join(region_rollups(people, [], ["universe", "active_pop"], *cells, **rules), cells, "left")


def _minutes() -> Column:
    return F.col("watchtime").cast("double") / 60.0


def programme_ratios(df: DataFrame, exact_minutes: Column, nominal_minutes: Column, digits: int = 6) -> DataFrame:
    """reach %, GVT, TVT, TSV and TVR from weighted reach, watch seconds and universe."""
    minutes, reach, pop = _minutes(), F.col("reach").cast("double"), F.col("universe").cast("double")
    gvt, tvt = F.try_divide(minutes, nominal_minutes), F.try_divide(minutes, exact_minutes)
    return df.withColumns({
        "reach_perc": F.round(F.try_divide(reach, pop) * 100, digits),
        "gvt": F.round(gvt, digits),
        "tvt": F.round(tvt, digits),
        "tsv": F.round(F.try_divide(minutes, reach), digits),
        "tvr": F.round(F.try_divide(tvt, pop) * 100, digits),
    })


def programme_views(sessions: DataFrame, programmes: DataFrame, channel: str, session_iv: tuple[str, str],
                    programme_iv: tuple[str, str]) -> DataFrame:
    """Sessions cut to the programmes of their channel, with the seconds watched of each."""
    pairs = overlap_join(sessions, programmes, channel, session_iv, programme_iv)
    start, end = F.col("overlap_start").cast("timestamp"), F.col("overlap_end").cast("timestamp")
    return pairs.withColumn("seen_seconds", F.floor((F.unix_micros(end) - F.unix_micros(start)) / 1_000_000))


def programme_summary(views: DataFrame, universe: DataFrame, actives: DataFrame, cells: list[str], programme: list[str],
                      device: str, start: str, end: str, nominal_minutes: float = 30.0) -> DataFrame:
    """Programme metrics per state and class with roll-ups. ``programme`` names its keys, start and end included."""
    base = weighted_cells(views, universe, actives, cells, programme, device, "seen_seconds")
    rolled = with_population(region_rollups(base, programme), universe, actives, cells)
    seconds = F.unix_micros(F.col(end).cast("timestamp")) - F.unix_micros(F.col(start).cast("timestamp"))
    return programme_ratios(rolled, seconds / 60_000_000.0, F.lit(nominal_minutes))


def slot_summary(viewing: DataFrame, universe: DataFrame, actives: DataFrame, cells: list[str], slot: list[str],
                 channel: str, device: str, seconds: str, minutes: float = 30.0, digits: int = 6) -> DataFrame:
    """30-minute metrics per state, class, channel and slot, the all-viewing pseudo-channel included."""
    base = weighted_cells(viewing, universe, actives, cells, [channel, *slot], device, seconds, any_of=channel)
    rolled = with_population(region_rollups(base, [channel, *slot]), universe, actives, cells)
    watched, reach, pop = _minutes(), F.col("reach").cast("double"), F.col("universe").cast("double")
    impressions = watched / minutes
    return rolled.withColumns({
        "reach_perc": F.round(F.try_divide(reach, pop) * 100, digits),
        "impressions": F.round(impressions, digits),
        "tsv": F.round(F.try_divide(watched, reach), digits),
        "tvr": F.round(F.try_divide(impressions, pop) * 100, digits),
    })


def weekly_summary(slots: DataFrame, weekly_reach: DataFrame, keys: list[str], channel: str, week: str, digits: int = 6) -> DataFrame:
    """Week metrics: cumulative reach, gross impressions (Σ over slots), GRP (Σ TVR), share of all viewing, TSV.

    ``slots`` comes from ``slot_summary`` with the week of each slot; ``weekly_reach`` has
    the weighted distinct reach, watch time and universe per (keys, channel, week).
    """
    gross = slots.groupBy(*keys, channel, week).agg(
        *[F.sum(F.col(c).cast(METRIC)).cast("double").alias(out) for c, out in (("impressions", "gross_impressions"), ("tvr", "grp"))]
    )
    anytv = gross.filter(F.col(channel) == ANY_CHANNEL).select(*keys, week, F.col("gross_impressions").alias("gross_impressions_anytv"))
    joined = weekly_reach.join(gross, [*keys, channel, week], "left").join(anytv, [*keys, week], "left")
    reach, pop = F.col("reach").cast("double"), F.col("universe").cast("double")
    return joined.withColumns({
        "creach": F.round(reach, digits),
        "reach_perc": F.round(F.try_divide(reach, pop) * 100, digits),
        "share": F.round(F.try_divide(F.col("gross_impressions"), F.col("gross_impressions_anytv")) * 100, digits),
        "tsv": F.round(F.try_divide(_minutes(), reach), digits),
        "gross_impressions": F.round("gross_impressions", digits),
        "gross_impressions_anytv": F.round("gross_impressions_anytv", digits),
        "grp": F.round("grp", digits),
    })


def map_channels(views: DataFrame, mapping: DataFrame, channel: str, approved: DataFrame | None = None) -> DataFrame:
    """Tidy names, left-join the channel map, keep both names, keep approved channels when given.

    ``mapping`` has (``channel``, display name); its names are tidied the same way.
    """
    tidy = views.withColumn(channel, tidy_of(F.col(channel)))
    names = mapping.withColumn(channel, tidy_of(F.col(channel)))
    joined = tidy.join(names, channel, "left")
    return joined if approved is None else keep_listed(joined, approved, channel)


