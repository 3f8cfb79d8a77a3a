"""Small hand-made frames for the rules that change answers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import dates, text
from millrace.operators import aggregates, filters, joins, ranges, ranking, shape
from millrace.operators.quality import null_profile
from millrace.plans import audience, journey, scoring
from millrace.schemas import claim_sheet, loss_history
from millrace.streaming import streams

D = dt.date


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def one(spark, expr):
    return spark.range(1).select(expr).first()[0]


def test_latest_puts_null_dates_first_and_breaks_ties(spark):
    df = spark.createDataFrame([(1, D(2020, 1, 1), 5), (1, None, 2), (2, D(2020, 1, 1), 1), (2, D(2020, 1, 1), 9)], "k int, d date, t int")
    assert rows(ranking.latest(df, ["k"], ["d"], ["t"])) == [(1, None, 2), (2, D(2020, 1, 1), 9)]


def test_keep_last_treats_null_keys_as_one_key(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (1, 3)], "k int, v int")
    assert rows(ranking.keep_last(df, ["k"], ["v"])) == [(1, 3), (None, 2)]


def test_number_rows_over_many_partitions(spark):
    df = spark.range(0, 5000, 1, 16).withColumn("x", (F.col("id") * 7919) % 5003)
    got = ranking.number_rows(df, [F.col("x").asc()])
    want = {r.id: n for n, r in enumerate(sorted(df.collect(), key=lambda r: r.x), 1)}
    assert {r.id: r.row_no for r in got.collect()} == want


def test_surrogate_modes(spark):
    df = spark.createDataFrame([("a", "A1"), ("b", None), ("c", None)], "p string, acct string")
    assert rows(ranking.surrogate(df, "acct", [F.col("p").asc()])) == [("a", "A1"), ("b", "2AUTOGEN"), ("c", "3AUTOGEN")]
    hashed = {r.p: r.acct for r in ranking.surrogate(df, "acct", [], mode="hash").collect()}
    assert hashed["a"] == "A1" and hashed["b"] != hashed["c"] and hashed["b"].endswith("AUTOGEN")


def test_term_days_needs_both_dates(spark):
    df = spark.createDataFrame([(D(2020, 1, 1), D(2022, 1, 1)), (D(2020, 1, 1), None), (D(2020, 1, 1), D(2020, 1, 1))], "a date, b date")
    assert [r.policy_term for r in dates.term_days(df, "a", "b").collect()] == [365, None, 0]


def test_annualise_zero_term(spark):
    df = spark.createDataFrame([(100.0, 0), (100.0, 73)], "x double, n int")
    assert [r.x for r in dates.annualise(df, ["x"], "n").collect()] == [None, 500.0]
    with pytest.raises(Exception, match="zero-day term"):
        dates.annualise(df, ["x"], "n", strict=True).collect()


def test_month_ends_stick(spark):
    day = F.lit("2019-02-28").cast("date")
    assert one(spark, dates.add_months_eom(day, 12)) == D(2020, 2, 29)
    assert one(spark, dates.add_months_eom(F.lit("2020-01-15").cast("date"), -3)) == D(2019, 10, 15)


def test_fixed_months(spark):
    df = spark.createDataFrame([(D(2020, 1, 31),)], "d date")
    got = [dates.shift_months(df, "d", n, "fixed").first()[0] - D(2020, 1, 31) for n in (12, -13, 3)]
    assert [g.days for g in got] == [365, -396, 91]


@pytest.mark.parametrize(("hour", "band"), [(2, "Overnight"), (5, "Overnight"), (6, "Morning"), (10, "Daytime"), (17, "Primetime"), (22, "Primetime"), (23, "Latenight"), (0, "Latenight"), (1, "Latenight")])
def test_day_bands(spark, hour, band):
    assert one(spark, dates.band_of(F.lit(hour))) == band


@pytest.mark.parametrize(("days", "phase"), [(90, "Startperiod"), (91, None), (274, None), (275, "Endperiod")])
def test_term_phase(spark, days, phase):
    assert one(spark, dates.phase_of(F.lit(days))) == phase


@pytest.mark.parametrize(("raw", "number"), [("-5", 5.0), ("-5.5", -5.5), ("1,234.50", 1.0), ("12.5%", 12.5), (".75 of", 0.75), ("none", None), (None, None)])
def test_first_number(spark, raw, number):
    assert one(spark, text.number_in(F.lit(raw).cast("string"))) == number


def test_first_number_with_thousands(spark):
    assert one(spark, text.number_in(F.lit("USD 1,234,567.50"), thousands=True)) == 1234567.5


@pytest.mark.parametrize(("raw", "day"), [("on 3/4/2019 ok", D(2019, 3, 4)), ("2019-03-04 00:00", D(2019, 3, 4)), ("2/30/2019", None), ("x", None)])
def test_first_date(spark, raw, day):
    assert one(spark, text.date_in(F.lit(raw))) == day


def test_fold(spark):
    df = spark.createDataFrame([("Café – ½ ﬁn “x” ß", "plain"), ("abc", None)], "a string, b string")
    assert rows(text.ascii_fold(df, ["a", "b"])) == [("Cafe - 12 fin x ", "plain"), ("abc", None)]


@pytest.mark.parametrize(("raw", "want"), [
    ("RE: National Account Acme, Inc. - Loss Run 01/02/2019", "ACME, INC"),
    ("FW: ACCOUNTS  Finance Co 2019", "FINANCE CO"),
    ("loss run", None), ("nan", None), ("", None),
])
def test_account_names(spark, raw, want):
    assert one(spark, text.account_name_of(F.lit(raw))) == want


def test_legacy_deletes_missing_words_inside_names(spark):
    assert one(spark, text.account_name_of(F.lit("Finance Co"), legacy=True)) == "FICE CO"


@pytest.mark.parametrize(("raw", "want"), [("Acme Holdings (West), LLC - Springfield - Eff", "ACME"), ("C & L Service Group", None), ("Smith Corporation", "SMITH")])
def test_match_keys(spark, raw, want):
    assert one(spark, text.match_key_of(F.lit(raw))) == want


def test_token_key_sorts_words(spark):
    assert one(spark, text.token_key_of(F.lit("(beta-Alpha 10)"))) == "10 ALPHA BETA"


def test_market_and_names(spark):
    assert one(spark, text.market_of(F.lit("North / Coast (Rural) - x"))) == "North-Coast"
    assert one(spark, text.tidy_of(F.lit("RIVER_ONE(tbr) (V)"))) == "RIVER ONE"


def test_null_profile_equal_null_finds_nothing(spark):
    df = spark.createDataFrame([(None,), ("null",), ("x",)], "a string")
    assert rows(null_profile(df, ["a"])) == [("a", 3, 1, 0, 1)]
    assert df.filter(F.col("a") == F.lit(None)).count() == 0


def test_exclude_like_eight_patterns(spark):
    names = ["{DNU x", "a {DNU} b", "*DNU*", "(x DNU)", "DNU-x", "x-DNU", "x - DNU", "DNU- x", "Fine", None]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert rows(filters.exclude_like(df, "n")) == [("Fine",)]


def test_interval_join_is_half_open(spark):
    ev = spark.createDataFrame([("p", dt.datetime(2020, 1, 1)), ("p", dt.datetime(2021, 1, 1)), (None, dt.datetime(2020, 1, 1))], "k string, ts timestamp_ntz")
    terms = spark.createDataFrame([("p", D(2020, 1, 1), D(2021, 1, 1))], "k string, s date, e date")
    assert ranges.interval_join(ev, terms, "k", "ts", "s", "e").select("ts").collect() == [(dt.datetime(2020, 1, 1),)]


def test_asof_excludes_same_day(spark):
    left = spark.createDataFrame([("o", D(2020, 5, 1)), ("o", D(2020, 1, 1)), (None, D(2020, 1, 1))], "k string, d date")
    snaps = spark.createDataFrame([("o", D(2020, 5, 1), 9.0), ("o", D(2020, 2, 1), 4.0), ("o", D(2020, 2, 1), 3.0)], "k string, s date, v double")
    got = ranges.asof_latest(left, snaps, "k", "d", "s", [F.sum("v").alias("v")]).select("k", "d", "v")
    assert rows(got) == [("o", D(2020, 1, 1), None), ("o", D(2020, 5, 1), 7.0), (None, D(2020, 1, 1), None)]


def test_merge_outer_matches_null_keys(spark):
    a = spark.createDataFrame([(1, None, "a1"), (2, 5, "a2")], "k int, j int, v string")
    b = spark.createDataFrame([(1, None, "b1"), (3, None, "b3")], "k int, j int, v string")
    assert rows(joins.merge_outer(a, b, ["k", "j"])) == [(1, None, "a1", "b1"), (2, 5, "a2", None), (3, None, None, "b3")]


def test_spread_max_null_key_gets_null(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), (None, 2)], "k string, v int")
    assert rows(joins.spread_max(df, ["k"], "v", "m")) == [("a", 1, 3), ("a", 3, 3), (None, 2, None)]


def test_fallback_order(spark):
    rq = spark.createDataFrame([(1,), (2,), (3,)], "rq int")
    sold = spark.createDataFrame([(1, 10)], "rq int, id int")
    rest = spark.createDataFrame([(1, 99), (2, 7), (2, 8)], "rq int, id int")
    assert rows(joins.fallback_lookup(rq, [sold, rest], "rq", "id")) == [(1, 10), (2, 8), (3, None)]


def test_eav_scalar_needs_exactly_one_row(spark):
    vals = spark.createDataFrame([(1, 7, 2.0, None), (2, 7, 1.0, "x"), (2, 7, 2.0, "y"), (3, 8, 1.0, None)], "e int, el int, v double, t string")
    elems = spark.createDataFrame([(7, 189), (8, 42)], "el int, no int")
    got = aggregates.eav_scalar(vals, elems, "e", "el", "no", text.as_plain(F.col("v")), "t", {"admin": 189})
    assert rows(got) == [(1, "2"), (2, None), (3, None)]


def test_pivot_counts_absent_is_null(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k int, c string")
    assert rows(aggregates.pivot_counts(df, ["k"], {"c": {"a": "na", "b": "nb"}})) == [(1, 2, None), (2, None, 1)]


def test_names_must_not_collide(spark):
    df = spark.range(1).select(F.lit(1).alias("a b"), F.lit(2).alias("A_B"))
    with pytest.raises(ValueError, match="collide"):
        shape.normalise_names(df)


def test_conform_fills_and_types(spark):
    df = spark.createDataFrame([("no 12.5", "seen 1/2/2020", "é")], "n string, d string, t string")
    schema = T.StructType([T.StructField("N", T.DoubleType()), T.StructField("D", T.DateType()), T.StructField("T", T.StringType()), T.StructField("X", T.LongType())])
    assert rows(shape.conform(df, schema)) == [(12.5, D(2020, 1, 2), "e", None)]


def test_declared_layouts():
    assert len(claim_sheet()) == 60 and len(loss_history()) == 69


def test_within_lookback_bounds(spark):
    t = D(2020, 12, 31)
    df = spark.createDataFrame([(D(2020, 1, 1), t), (D(2019, 12, 31), t), (t, t), (None, t), (t, None)], "v date, t date")
    assert len(filters.within_lookback(df, "v", "t").collect()) == 4


def test_tier_rules(spark):
    base = {p: 0.0 for p in (*scoring.VEHICLE_PREMIUMS, *scoring.POLICY_PREMIUMS)}

    def tier(**kw):
        row = {**base, "writing_company_cd": "H", "n_vehicles": 1, "n_part_support": 0, "policy_term": 365, **kw}
        df = spark.createDataFrame([row])
        out = scoring.touch_tiers(df).first()
        return out.touch, out.touch_reason

    assert tier(liab_prm=29999.0) == ("LOW", "Less than $30K liability premium")
    assert tier(liab_prm=30000.0) == ("NOT LOW", "Greater than $30K liability premium")
    assert tier(writing_company_cd="Z") == ("NOT APPLICABLE", "Writing company not scored")
    assert tier(writing_company_cd="Z", n_vehicles=0, doc_prm=2999.0)[0] == "LOW"
    assert tier(n_vehicles=0, doc_prm=3000.0) == ("NOT LOW", "HNO only, greater than $3K total premium")
    assert tier(n_part_support=1) == ("NOT LOW", "Partially supported")
    assert tier(policy_term=0)[0] == "NOT LOW"


def test_unmapped_touch_keeps_null_status(spark):
    ev = spark.createDataFrame([("0001-000001/E", dt.datetime(2020, 2, 1, 7), "eMail", "Nowhere"), ("0001-000001/E", dt.datetime(2020, 2, 1, 7), "Web", None)], "pol_id string, date_time timestamp_ntz, channel string, touch_point string")
    terms = spark.createDataFrame([("0001 000001", D(2020, 1, 1))], "pol_id string, term_eff_dt date")
    touches = journey.touch_map(spark)
    row = journey.journey_features(ev, terms, touches).first()
    assert (row.no_of_cnts, row.no_of_email_cnts, row.no_of_web_cnts, row.no_of_unknown_cnts, row.no_of_weekday_cnts) == (2, 1, 1, None, None)
    assert journey.journey_features(ev, terms, touches, fill_status=True).first().no_of_unknown_cnts == 2
    assert touches.count() == 117


def test_programme_ratios_on_published_row(spark):
    df = spark.createDataFrame([(95183943, 368367.468588, 3794636.335988 * 60)], "universe long, reach double, watchtime double")
    row = audience.programme_ratios(df, F.lit(29 + 46 / 60), F.lit(30.0)).first()
    assert row.reach_perc == 0.387006
    assert row.gvt == pytest.approx(126487.877866, abs=1e-5)
    assert row.tvt == pytest.approx(127479.384188, abs=1e-2)
    assert row.tsv == 10.301225
    assert row.tvr == 0.13393


def test_rollup_all_states_is_sum_of_groups(spark):
    df = spark.createDataFrame([("HSM", "Metro", 640034), ("South", "Metro", 97723), ("HSM", "rural", 10)], "state string, location_class string, n long")
    got = {(r.state, r.location_class): r.n for r in audience.region_rollups(df, [], ["n"]).collect()}
    assert got[("India", "Metro")] == 737757
    assert got[("HSM", "U+R")] == 640044 and got[("HSM", "U")] == 640034


def test_samples_are_cut_and_members_upserted(spark):
    df = spark.createDataFrame([("12.9:45.67", 1000), ("12.9:45.67", 3000), ("1:2", 2000)], "member string, score long")
    got = streams.parse_sample(df).select("cpu_whole", "mem_whole").collect()
    assert got[0] == (12, 45)
    assert rows(streams.upsert_member(df, "member", "score")) == [("12.9:45.67", 3000), ("1:2", 2000)]
    assert streams.upsert_member(df, "member", "score", collapse=False).count() == 3


def test_zone_shift(spark):
    df = spark.createDataFrame([(0,)], "ms long")
    row = dates.to_local(df, "ms").first()
    assert (row.ts_utc, row.ts_local) == (dt.datetime(1970, 1, 1), dt.datetime(1970, 1, 1, 5, 30))
