import datetime as dt

import pytest
from pyspark.sql import functions as F

from fleetmart.functions import calendar, cleaning, domain, jsonpath
from fleetmart.functions.keys import integer_key, surrogate_key
from fleetmart.functions.numbers import mean, percent, ratio, round_to
from fleetmart.plans.facts import parse_event_payload, parse_gateway_response
from fleetmart.plans.marts import performance_score


def apply(spark, values, fn, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(fn(F.col("v"))).collect()]


def test_clean_phone_cases(spark):
    given = ["+6281234567890", "0812-3456-7890", "081234567890", "12345", None, "62 21 1234567", "0812", "0812345678901234", "abc"]
    assert apply(spark, given, cleaning.clean_phone) == [
        "081234567890", "081234567890", "081234567890", None, None, "0211234567", None, None, None,
    ]


def test_clean_national_id_cases(spark):
    given = ["3271 0123 4567 8901", "327101234567890", "3271012345678901", None]
    assert apply(spark, given, cleaning.clean_national_id) == ["3271012345678901", None, "3271012345678901", None]


def test_clean_plate_and_email(spark):
    assert apply(spark, [" b  1234  abc ", None], cleaning.clean_plate) == ["B 1234 ABC", None]
    assert apply(spark, [" A.b+1@Mail.co.id ", "x@y", "no", "a@b.c1", None], cleaning.is_valid_email) == [True, False, False, False, None]


def test_dirty_flags(spark):
    assert apply(spark, ["+62812", "0812-1", "0812", None], cleaning.phone_was_dirty) == [True, True, False, False]
    assert apply(spark, ["3271 0123 4567 8901", "32710123456789", None], cleaning.national_id_was_dirty) == [False, True, False]
    assert apply(spark, ["b 1 c", "B 1 c", "123", None], cleaning.plate_was_dirty) == [True, False, True, False]


def test_clamp(spark):
    got = apply(spark, ["0.50", "7.10", "4.20", None], lambda c: cleaning.clamp(c.cast("decimal(5,2)"), 1.0, 5.0, 5.0).cast("double"))
    assert got == [1.0, 5.0, 4.2, 5.0]


@pytest.mark.parametrize("text, expected", [
    ('{"a": 1.5}', "1.5"), ('{"a": "x"}', "x"), ('{"a": true}', "true"), ('{"a": null}', None), ("{}", None), ('{"a": {"b": 1}}', None),
    ('{"a": [1, 2]}', None), ('{"a": "{not json"}', "{not json"), ('{"a": ', None), (None, None),
])
def test_json_scalar(spark, text, expected):
    assert apply(spark, [text], lambda c: jsonpath.json_scalar(c, "a")) == [expected]


def test_json_subtree_and_typed(spark):
    doc = ['{"tags": ["a","b"], "n": "12", "f": "x", "b": "true", "m": {"d": "ios"}}']
    assert apply(spark, doc, lambda c: jsonpath.json_subtree(c, "tags")) == ['["a","b"]']
    assert apply(spark, doc, lambda c: jsonpath.json_as(c, "n", "bigint")) == [12]
    assert apply(spark, doc, lambda c: jsonpath.json_as(c, "f", "double")) == [None]
    assert apply(spark, doc, lambda c: jsonpath.json_as(c, "b", "boolean")) == [True]
    assert apply(spark, doc, lambda c: jsonpath.json_scalar(c, "$.m.d")) == ["ios"]
    assert apply(spark, doc, lambda c: jsonpath.first_scalar(c, "missing", "n")) == ["12"]


def test_event_payload_key_sets(spark):
    events = spark.createDataFrame(
        [("e1", '{"surge": 1.5, "zone": "Z1"}'), ("e2", '{"surge_multiplier": 1.2, "pickup_zone": "Z2"}'), ("e3", '{"fare": "x", "zone": {"id": 1}}'), ("e4", "{bad")],
        "event_id string, event_payload string",
    )
    both = {r.event_id: (r.req_surge, r.req_zone, r.cmp_fare) for r in parse_event_payload(events).collect()}
    assert both == {"e1": (1.5, "Z1", None), "e2": (1.2, "Z2", None), "e3": (None, None, None), "e4": (None, None, None)}
    contract_only = {r.event_id: r.req_surge for r in parse_event_payload(events, both_key_sets=False).collect()}
    assert contract_only["e2"] is None and contract_only["e1"] == 1.5


def test_gateway_response(spark):
    doc = '{"gateway":"gw","reference":"R1","status":"ok","amount":"12.5","timestamp":"t","metadata":{"ip":"1.2.3.4","device":{"os":"x"}}}'
    row = parse_gateway_response(spark.createDataFrame([(doc,)], "gateway_raw_response string")).first()
    assert (row.gateway_name, row.gateway_amount, row.client_ip, row.client_device) == ("gw", 12.5, "1.2.3.4", None)


def test_surrogate_key_is_null_safe(spark):
    rows = spark.createDataFrame([(None, "a"), ("a", None), ("a", "b")], "x string, y string")
    keys = [r[0] for r in rows.select(surrogate_key(F.col("x"), F.col("y"))).collect()]
    assert len(set(keys)) == 3 and all(len(k) == 32 for k in keys)
    assert rows.select(integer_key(F.col("y")).alias("k")).filter("k < 0").count() == 0


def test_calendar_rules(spark):
    days = [dt.date(2026, 1, 4), dt.date(2026, 1, 3), dt.date(2026, 12, 31), dt.date(2027, 1, 1)]
    assert apply(spark, days, calendar.week_start_sunday, "date") == [dt.date(2026, 1, 4), dt.date(2025, 12, 28), dt.date(2026, 12, 27), dt.date(2026, 12, 27)]
    assert apply(spark, days, calendar.week_number_sunday, "date") == [int(d.strftime("%U")) for d in days]
    assert apply(spark, days, calendar.calendar_year_iso_week, "date") == [d.strftime("%Y-W%V") for d in days]
    assert apply(spark, days, calendar.date_key, "date") == [20260104, 20260103, 20261231, 20270101]


def test_recency_bucket_both_rules(spark):
    today = F.lit("2026-03-01").cast("date")
    days = [dt.date(2026, 3, 5), dt.date(2026, 2, 25), dt.date(2026, 2, 10), dt.date(2025, 12, 20), dt.date(2025, 1, 1)]
    assert apply(spark, days, lambda c: calendar.recency_bucket(c, today), "date") == ["future", "last_7d", "last_30d", "last_90d", "older"]
    assert apply(spark, days[:1], lambda c: calendar.recency_bucket(c, today, future_first=False), "date") == ["last_7d"]


def test_durations_truncate(spark):
    row = spark.sql("SELECT timestamp'2026-01-01 00:00:00' a, timestamp'2026-01-01 00:01:59.9' b").select(
        calendar.minutes_between(F.col("a"), F.col("b")), calendar.seconds_between(F.col("a"), F.col("b")), calendar.seconds_between(F.col("b"), F.lit(None).cast("timestamp"))
    ).first()
    assert tuple(row) == (1, 119, None)


def test_classes(spark):
    assert apply(spark, [1000, 999, 500, 100, 99], domain.experience_tier, "int") == ["Platinum", "Gold", "Gold", "Silver", "Bronze"]
    assert apply(spark, [200, 50, 10, 9], domain.loyalty_tier, "int") == ["Platinum", "Gold", "Silver", "New"]
    assert apply(spark, [17, 18, 25, 26, 55, 56, None], domain.age_bucket, "int") == ["56+", "18-25", "18-25", "26-35", "46-55", "56+", "56+"]
    hours = [dt.datetime(2026, 1, 1, h) for h in (4, 5, 7, 9, 10, 17, 19, 21, 22, 0)]
    assert apply(spark, hours, domain.time_bucket, "timestamp") == [
        "late_night", "off_peak", "morning_peak", "morning_peak", "off_peak", "evening_peak", "evening_peak", "off_peak", "late_night", "late_night",
    ]
    assert apply(spark, ["MOTOR", "COMFORT", "BOAT"], domain.vehicle_category) == ["2-Wheeler", "Standard Car", None]
    assert apply(spark, [9999, 10000, 20000], domain.fare_tier, "int") == ["Economy", "Mid-Range", "Premium"]
    assert apply(spark, ["Jakarta", "X"], domain.province) == ["DKI Jakarta", "Other"]
    assert apply(spark, ["JKT-SEL", "BSD"], domain.area_type) == ["Jakarta Core", "Greater Jakarta"]


def test_rounding_goes_by_decimal_digits(spark):
    assert apply(spark, [1.005, 2.675, None], lambda c: round_to(c, 2), "double") == [1.01, 2.68, None]


def test_ratios_and_means(spark):
    df = spark.createDataFrame([(1, 0), (2, 3), (None, 4)], "a int, b int")
    got = df.agg(mean(F.col("a")), percent(F.sum("a"), F.sum("b")), ratio(F.sum("a"), F.lit(0))).first()
    assert tuple(got) == (1.5, 42.86, None)


def test_score_tops_out_at_64(spark):
    row = spark.range(1).select(performance_score(F.lit(100.0), F.lit(5.0), F.lit(10_000)), performance_score(F.lit(None).cast("double"), F.lit(None).cast("double"), F.lit(None).cast("long"))).first()
    assert tuple(row) == (64.0, 0.0)
