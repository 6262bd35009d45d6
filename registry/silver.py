"""Dimensions, facts and the column rules behind them."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetmart.functions import calendar, cleaning, domain, jsonpath
from fleetmart.functions.keys import surrogate_key, utc_text
from fleetmart.functions.numbers import ratio
from fleetmart.operators.joins import lookup_join
from fleetmart.operators.shred import document_members
from fleetmart.plans import dims, facts
from registry.core import CTES, NOW, SNAPSHOT_NOW, n, now, query, today

NULL_MARK = "_dbt_utils_surrogate_key_null_"


def phone_sql(c: str) -> str:
    d = f"regexp_replace({c}, '[^0-9]', '', 'g')"
    nat = f"CASE WHEN {d} LIKE '62%' THEN '0' || substr({d}, 3) WHEN {d} LIKE '0%' THEN {d} END"
    return f"CASE WHEN length({nat}) BETWEEN 10 AND 13 THEN {nat} END"


def nik_sql(c: str) -> str:
    d = f"regexp_replace({c}, '[^0-9]', '', 'g')"
    return f"CASE WHEN length({d}) = 16 THEN {d} END"


def plate_sql(c: str) -> str:
    return f"upper(trim(regexp_replace({c}, '\\s+', ' ', 'g')))"


def phone_dirty_sql(c: str) -> str:
    return f"coalesce({c} LIKE '+62%' OR {c} LIKE '%-%', false)"


CTES["o_zones"] = f"""
SELECT md5(coalesce(zone_id::varchar, '{NULL_MARK}')) AS zone_key, zone_id, zone_code, zone_name, city, latitude, longitude,
       is_active,
       CASE city WHEN 'Jakarta' THEN 'DKI Jakarta' WHEN 'Banten' THEN 'Banten' WHEN 'Jawa Barat' THEN 'Jawa Barat' ELSE 'Other' END AS province,
       CASE WHEN left(zone_code, 4) = 'JKT-' THEN 'Jakarta Core' ELSE 'Greater Jakarta' END AS area_type, created_at
FROM {{zones}} WHERE is_active
"""
CTES["o_types"] = """
SELECT md5(vehicle_type_id::varchar) AS vehicle_type_key, vehicle_type_id, type_code, type_name, base_fare, per_km_rate,
       per_minute_rate, capacity,
       CASE type_code WHEN 'MOTOR' THEN '2-Wheeler' WHEN 'ECONOMI' THEN 'Standard Car' WHEN 'COMFORT' THEN 'Standard Car'
                      WHEN 'SUV' THEN 'Large Car' WHEN 'PREMIUM' THEN 'Premium Car' END AS vehicle_category,
       CASE WHEN base_fare < 10000 THEN 'Economy' WHEN base_fare < 20000 THEN 'Mid-Range' ELSE 'Premium' END AS fare_tier,
       created_at
FROM {vehicle_types}
"""
CTES["o_drivers"] = f"""
SELECT md5(d.driver_id || '-' || d.updated_at::varchar || '+00') AS driver_key, d.driver_id, d.driver_code,
       d.full_name AS driver_name, {phone_sql('d.phone_number')} AS phone_number, d.email, {nik_sql('d.nik')} AS nik,
       d.sim_number, {plate_sql('d.license_plate')} AS license_plate, upper(d.status) AS driver_status,
       least(greatest(coalesce(d.rating, 5.0), 1.0), 5.0)::decimal(5,2) AS rating, coalesce(d.total_trips, 0) AS total_trips,
       d.joined_at, d.updated_at, {phone_dirty_sql('d.phone_number')} AS phone_was_dirty,
       length(regexp_replace(d.nik, '\\s', '', 'g')) <> 16 AS nik_was_dirty, lower(d.license_plate) = d.license_plate AS plate_was_dirty,
       t.vehicle_type_id, t.type_code AS vehicle_type_code, t.type_name AS vehicle_type_name, t.capacity AS vehicle_capacity,
       t.vehicle_category, d.vehicle_brand, d.vehicle_model, d.vehicle_year, d.vehicle_color,
       CASE WHEN d.total_trips >= 1000 THEN 'Platinum' WHEN d.total_trips >= 500 THEN 'Gold'
            WHEN d.total_trips >= 100 THEN 'Silver' ELSE 'Bronze' END AS experience_tier,
       z.zone_code AS home_zone_code, z.zone_name AS home_zone_name, z.city AS home_city, z.province AS home_province,
       z.area_type AS home_area_type, d.updated_at AS valid_from, NULL::timestamp AS valid_to, true AS is_current
FROM {{drivers}} d LEFT JOIN {{o_types}} t USING (vehicle_type_id) LEFT JOIN {{o_zones}} z ON z.zone_id = d.home_zone_id
"""
# Years between year boundaries up to the day of the snapshot.
AGE_SQL = f"date_diff('year', p.birth_date, DATE '{SNAPSHOT_NOW[:10]}')::int"
CTES["o_passengers"] = f"""
SELECT md5(p.passenger_id || '-' || p.updated_at::varchar || '+00') AS passenger_key, p.passenger_id, p.passenger_code,
       p.full_name AS passenger_name, {phone_sql('p.phone_number')} AS phone_number, p.email, p.birth_date,
       {AGE_SQL} AS age_years,
       CASE WHEN {AGE_SQL} BETWEEN 18 AND 25 THEN '18-25' WHEN {AGE_SQL} BETWEEN 26 AND 35 THEN '26-35'
            WHEN {AGE_SQL} BETWEEN 36 AND 45 THEN '36-45' WHEN {AGE_SQL} BETWEEN 46 AND 55 THEN '46-55'
            ELSE '56+' END AS age_bucket,
       coalesce(upper(p.gender), 'UNKNOWN') AS gender, p.referral_code, p.is_verified, coalesce(p.total_trips, 0) AS total_trips,
       upper(p.status) AS passenger_status, p.registered_at, p.updated_at, {phone_dirty_sql('p.phone_number')} AS phone_was_dirty,
       CASE WHEN p.total_trips >= 200 THEN 'Platinum' WHEN p.total_trips >= 50 THEN 'Gold'
            WHEN p.total_trips >= 10 THEN 'Silver' ELSE 'New' END AS loyalty_tier,
       z.zone_code AS home_zone_code, z.zone_name AS home_zone_name, z.city AS home_city, z.province AS home_province,
       p.updated_at AS valid_from, NULL::timestamp AS valid_to, true AS is_current
FROM {{passengers}} p LEFT JOIN {{o_zones}} z ON z.zone_id = p.home_zone_id
"""
_BUCKET = """CASE WHEN hour({c}) BETWEEN 7 AND 9 THEN 'morning_peak' WHEN hour({c}) BETWEEN 17 AND 19 THEN 'evening_peak'
            WHEN hour({c}) >= 22 OR hour({c}) <= 4 THEN 'late_night' ELSE 'off_peak' END"""
CTES["o_rides"] = f"""
SELECT md5(r.ride_id) AS ride_key, d.driver_key, p.passenger_key, a.zone_key, t.vehicle_type_key, r.ride_id, r.ride_code,
       r.driver_id, r.passenger_id, r.vehicle_type_id, r.pickup_zone_id, r.dropoff_zone_id, r.requested_at::date AS requested_date,
       upper(r.ride_status) AS ride_status, {_BUCKET.replace('{c}', 'r.requested_at')} AS time_bucket,
       coalesce(r.surge_multiplier > 1, false) AS is_surge, coalesce(r.promo_discount > 0, false) AS has_promo,
       d.driver_name, d.vehicle_type_code, d.vehicle_type_name, d.experience_tier AS driver_tier,
       p.passenger_name, p.loyalty_tier AS passenger_tier, p.age_bucket AS passenger_age_bucket, p.gender AS passenger_gender,
       a.zone_code AS pickup_zone_code, a.zone_name AS pickup_zone_name, a.city AS pickup_city, a.province AS pickup_province,
       a.area_type AS pickup_area_type, b.zone_code AS dropoff_zone_code, b.zone_name AS dropoff_zone_name,
       b.city AS dropoff_city, b.province AS dropoff_province, b.area_type AS dropoff_area_type,
       coalesce(r.pickup_zone_id = r.dropoff_zone_id, false) AS is_same_zone_trip,
       t.vehicle_category, t.fare_tier, t.capacity AS vehicle_capacity,
       r.requested_at, r.accepted_at, r.picked_up_at, r.completed_at, r.cancelled_at,
       date_sub('second', r.requested_at, r.accepted_at) AS acceptance_duration_secs,
       date_sub('second', r.accepted_at, r.picked_up_at) AS pickup_wait_secs,
       date_sub('second', r.picked_up_at, r.completed_at) AS trip_duration_secs,
       coalesce(r.distance_km, 0)::decimal(8,2) AS distance_km, coalesce(r.duration_minutes, 0) AS duration_minutes,
       coalesce(r.base_fare, 0)::decimal(10,2) AS base_fare, coalesce(r.distance_fare, 0)::decimal(10,2) AS distance_fare,
       coalesce(r.time_fare, 0)::decimal(10,2) AS time_fare, coalesce(r.surge_multiplier, 1)::decimal(4,2) AS surge_multiplier,
       coalesce(r.promo_discount, 0)::decimal(10,2) AS promo_discount, coalesce(r.total_fare, 0)::decimal(10,2) AS total_fare,
       r.passenger_rating, r.driver_rating, r.cancellation_reason, r.updated_at
FROM {{rides}} r
LEFT JOIN {{o_drivers}} d USING (driver_id) LEFT JOIN {{o_passengers}} p USING (passenger_id)
LEFT JOIN {{o_zones}} a ON a.zone_id = r.pickup_zone_id LEFT JOIN {{o_zones}} b ON b.zone_id = r.dropoff_zone_id
LEFT JOIN {{o_types}} t ON t.vehicle_type_id = r.vehicle_type_id
"""
RIDE_DECIMALS = """distance_km::double AS distance_km, base_fare::double AS base_fare, distance_fare::double AS distance_fare,
 time_fare::double AS time_fare, surge_multiplier::double AS surge_multiplier, promo_discount::double AS promo_discount,
 total_fare::double AS total_fare, passenger_rating::double AS passenger_rating, driver_rating::double AS driver_rating"""


def scalar_sql(doc: str, path: str) -> str:
    """Text of a scalar; NULL for objects, arrays and broken documents."""
    ok = f"CASE WHEN json_valid({doc}) THEN {doc} END"
    return f"CASE WHEN json_type({ok}, '{path}') NOT IN ('OBJECT', 'ARRAY') THEN json_extract_string({ok}, '{path}') END"


def _both(a: str, b: str) -> str:
    return f"coalesce({scalar_sql('event_payload', a)}, {scalar_sql('event_payload', b)})"


CTES["o_events"] = f"""
SELECT md5(e.event_id) AS event_key, r.ride_key, e.event_id, e.ride_id, e.event_type, e.occurred_at, e.occurred_at::date AS occurred_date,
       try_cast({_both('$.surge', '$.surge_multiplier')} AS double) AS req_surge, {_both('$.zone', '$.pickup_zone')} AS req_zone,
       {scalar_sql('event_payload', '$.driver_id')} AS acc_driver_id,
       try_cast({_both('$.fare', '$.total_fare')} AS double) AS cmp_fare,
       try_cast({_both('$.distance', '$.estimated_distance_km')} AS double) AS cmp_distance_km,
       {_both('$.reason', '$.cancellation_reason')} AS can_reason,
       r.ride_status, r.vehicle_type_id, r.pickup_zone_id, r.driver_id, r.passenger_id, r.total_fare, r.requested_date
FROM {{ride_events}} e LEFT JOIN {{o_rides}} r ON r.ride_id = e.ride_id
"""


@query("dim_zones", "SELECT * REPLACE (latitude::double AS latitude, longitude::double AS longitude) FROM {o_zones}")
def _(d):
    return d.zones


@query(
    "dim_vehicle_types",
    """SELECT t.* REPLACE (base_fare::double AS base_fare, per_km_rate::double AS per_km_rate, per_minute_rate::double AS per_minute_rate),
              u.registered_drivers
       FROM {o_types} t LEFT JOIN (SELECT vehicle_type_id, count(*) AS registered_drivers FROM {drivers} GROUP BY ALL) u USING (vehicle_type_id)""",
)
def _(d):
    used = d.table("drivers").groupBy("vehicle_type_id").agg(F.count("*").alias("registered_drivers"))
    return d.vehicle_types.join(used, "vehicle_type_id", "left")


@query("dim_drivers", "SELECT * REPLACE (rating::double AS rating) FROM {o_drivers}")
def _(d):
    return d.drivers


@query("dim_passengers", "SELECT * FROM {o_passengers}")
def _(d):
    return d.passengers


@query("fct_rides", f"SELECT * REPLACE ({RIDE_DECIMALS}) FROM {{o_rides}}")
def _(d):
    return d.rides


@query("fct_ride_events", "SELECT * REPLACE (total_fare::double AS total_fare) FROM {o_events}")
def _(d):
    return d.ride_events


@query(
    "fct_rides_incremental",
    f"SELECT * REPLACE ({RIDE_DECIMALS}) FROM {{o_rides}} WHERE updated_at >= TIMESTAMP '{NOW}' - INTERVAL 3 DAY",
)
def _(d):
    return facts.fct_rides(d.table("rides"), d.drivers, d.passengers, d.zones, d.vehicle_types, now(), facts.LOOKBACK_DAYS)


@query("enrich_rides", """SELECT ride_id, driver_key, passenger_key, zone_key, vehicle_type_key, driver_name, passenger_tier,
 pickup_zone_code, dropoff_zone_code, fare_tier FROM {o_rides}""")
def _(d):
    joined = facts.enrich_rides(d.table("rides"), d.drivers, d.passengers, d.zones, d.vehicle_types)
    return joined.select(
        "ride_id", "driver_key", "passenger_key", "zone_key", "vehicle_type_key", "driver_name", "passenger_tier",
        "pickup_zone_code", "dropoff_zone_code", "fare_tier",
    )


@query("enrich_events", """SELECT e.event_id, e.ride_id, r.ride_key, r.ride_status, r.total_fare::double AS total_fare
 FROM {ride_events} e LEFT JOIN {o_rides} r USING (ride_id)""")
def _(d):
    return facts.enrich_events(d.table("ride_events"), d.ride_context).select("event_id", "ride_id", "ride_key", "ride_status", "total_fare")


@query("enrich_drivers", """SELECT driver_id, vehicle_type_code, vehicle_category, home_zone_code, home_province FROM {o_drivers}""")
def _(d):
    return d.drivers.select("driver_id", "vehicle_type_code", "vehicle_category", "home_zone_code", "home_province")


@query("enrich_passengers", "SELECT passenger_id, home_zone_code, home_city, home_province FROM {o_passengers}")
def _(d):
    return d.passengers.select("passenger_id", "home_zone_code", "home_city", "home_province")


@query(
    "parse_event_payload",
    "SELECT event_id, req_surge, req_zone, acc_driver_id, cmp_fare, cmp_distance_km, can_reason FROM {o_events}",
)
def _(d):
    out = facts.parse_event_payload(d.table("ride_events"))
    return out.select("event_id", *[name for name, _, _ in facts.PAYLOAD_FIELDS])


_NUMBERS = "('surge', 'surge_multiplier', 'fare', 'total_fare', 'distance', 'estimated_distance_km')"
_TEXTS = "('zone', 'pickup_zone', 'driver_id', 'reason', 'cancellation_reason')"
CTES["o_members"] = """SELECT event_id, event_payload AS doc, unnest(json_keys(CASE WHEN json_valid(event_payload) THEN event_payload END)) AS name FROM {ride_events}"""


@query(
    "parse_event_payload_variant",
    f"""WITH kept AS (SELECT event_id, string_agg(name, ',' ORDER BY name) AS rest_keys FROM {{o_members}}
        WHERE CASE WHEN name IN {_NUMBERS} THEN try_cast(json_extract_string(doc, '$.' || name) AS double) IS NULL
                   WHEN name IN {_TEXTS} THEN json_type(doc, '$.' || name) IN ('OBJECT', 'ARRAY') ELSE true END GROUP BY ALL)
        SELECT e.event_id, req_surge, req_zone, acc_driver_id, cmp_fare, cmp_distance_km, can_reason, rest_keys,
               CASE WHEN NOT json_valid(event_payload) THEN event_payload END AS unreadable
        FROM {{o_events}} e JOIN {{ride_events}} USING (event_id) LEFT JOIN kept USING (event_id)""",
)
def _(d):
    out = facts.parse_event_payload_variant(d.table("ride_events"))
    names = F.array_join(F.array_sort(F.json_object_keys("payload_rest")), ",")
    unreadable = F.when(F.try_parse_json("event_payload").isNull(), F.col("payload_rest"))
    return out.select("event_id", *[name for name, _, _ in facts.PAYLOAD_FIELDS], names.alias("rest_keys"), unreadable.alias("unreadable"))


@query(
    "payload_members",
    """SELECT name, count(*) AS documents, CASE WHEN count(DISTINCT k) = 1 THEN min(k) ELSE 'mixed' END AS kind FROM (
         SELECT name, CASE json_type(doc, '$.' || name) WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'VARCHAR' THEN 'text'
                      ELSE 'number' END AS k FROM {o_members}) GROUP BY name""",
)
def _(d):
    kind = F.col("kind")
    word = (
        F.when(kind.startswith("OBJECT"), "object").when(kind.startswith("ARRAY"), "array").when(kind == "BOOLEAN", "boolean")
        .when(kind == "STRING", "text").when(kind == "VARIANT", "mixed").otherwise("number")
    )
    return document_members(d.table("ride_events"), "event_payload").select("name", "documents", word.alias("kind"))


@query(
    "parse_gateway_response",
    f"""SELECT payment_id, {scalar_sql('gateway_raw_response', '$.gateway')} AS gateway_name,
        {scalar_sql('gateway_raw_response', '$.reference')} AS gateway_reference,
        {scalar_sql('gateway_raw_response', '$.status')} AS gateway_status,
        try_cast({scalar_sql('gateway_raw_response', '$.amount')} AS double) AS gateway_amount,
        {scalar_sql('gateway_raw_response', '$.timestamp')} AS gateway_timestamp,
        {scalar_sql('gateway_raw_response', '$.metadata.ip')} AS client_ip,
        {scalar_sql('gateway_raw_response', '$.metadata.device')} AS client_device FROM {{payments}}""",
)
def _(d):
    out = facts.parse_gateway_response(d.table("payments"))
    return out.select("payment_id", *[name for name, _, _ in jsonpath.GATEWAY_FIELDS])


_SPINE = f"""SELECT unnest(generate_series((SELECT min(requested_at)::date FROM {{rides}})::timestamp,
        TIMESTAMP '{NOW}' + INTERVAL 89 DAY, INTERVAL 1 DAY))::date AS d"""
_DATE_SQL = f"""
SELECT md5(d::varchar) AS date_key, d AS date_id, d AS full_date, year(d)::int AS year_num, month(d)::int AS month_num,
       day(d)::int AS day_of_month, (dayofweek(d) + 1)::int AS day_of_week_num, dayofyear(d)::int AS day_of_year,
       strftime(d, '%U')::int AS week_of_year, quarter(d)::int AS quarter_num, strftime(d, '%A') AS day_name,
       strftime(d, '%B') AS month_name, strftime(d, '%Y%m') AS year_month, year(d)::varchar || '-Q' || quarter(d)::varchar AS year_quarter,
       year(d)::varchar || '-W' || strftime(d, '%V') AS iso_year_week, dayofweek(d) IN (0, 6) AS is_weekend,
       dayofweek(d) NOT IN (0, 6) AS is_weekday, {{holiday}} AS is_public_holiday, (DATE '{NOW[:10]}' - d)::int AS days_ago,
       CASE WHEN d > DATE '{NOW[:10]}' THEN 'future' WHEN DATE '{NOW[:10]}' - d <= 7 THEN 'last_7d'
            WHEN DATE '{NOW[:10]}' - d <= 30 THEN 'last_30d' WHEN DATE '{NOW[:10]}' - d <= 90 THEN 'last_90d' ELSE 'older' END AS recency_bucket
FROM ({_SPINE})"""


def _spine(d):
    bounds = d.table("rides").agg(F.min(F.to_date("requested_at")).alias("first_day"))
    return dims.date_spine(bounds, F.col("first_day"), F.date_add(today(), 90))


@query("dim_date", _DATE_SQL.replace("{holiday}", "false"))
def _(d):
    return dims.dim_date(_spine(d), today())


@query(
    "is_public_holiday",
    "SELECT date_id, is_public_holiday FROM ("
    + _DATE_SQL.replace("{holiday}", "d IN (SELECT requested_at::date FROM {rides} WHERE promo_discount = 5000)")
    + ")",
)
def _(d):
    # Days with a large promotion stand in for the holiday lookup file.
    marked = d.table("rides").filter("promo_discount = 5000").select(F.to_date("requested_at").alias("holiday_date"))
    return dims.dim_date(_spine(d), today(), marked).select("date_id", "is_public_holiday")


# Column rules, each over a whole table -------------------------------------------------------------------------------

_PEOPLE = "(SELECT driver_id AS id, phone_number FROM {drivers} UNION ALL SELECT passenger_id, phone_number FROM {passengers})"


def _people(d):
    return d.table("drivers").select(F.col("driver_id").alias("id"), "phone_number").unionByName(
        d.table("passengers").select(F.col("passenger_id").alias("id"), "phone_number")
    )


@query("clean_phone", f"SELECT id, {phone_sql('phone_number')} AS phone FROM {_PEOPLE}")
def _(d):
    return _people(d).select("id", cleaning.clean_phone(F.col("phone_number")).alias("phone"))


@query("clean_national_id", f"SELECT driver_id, {nik_sql('nik')} AS nik FROM {{drivers}}")
def _(d):
    return d.table("drivers").select("driver_id", cleaning.clean_national_id(F.col("nik")).alias("nik"))


@query("clean_plate", f"SELECT driver_id, {plate_sql('license_plate')} AS plate FROM {{drivers}}")
def _(d):
    return d.table("drivers").select("driver_id", cleaning.clean_plate(F.col("license_plate")).alias("plate"))


@query(
    "is_valid_email",
    """SELECT id, regexp_full_match(lower(trim(email)), '[a-z0-9._%+-]+@[a-z0-9.-]+\\.[a-z]{2,}') AS valid FROM
       (SELECT driver_id AS id, email FROM {drivers} UNION ALL SELECT passenger_id, email FROM {passengers})""",
)
def _(d):
    mails = d.table("drivers").select(F.col("driver_id").alias("id"), "email").unionByName(
        d.table("passengers").select(F.col("passenger_id").alias("id"), "email")
    )
    return mails.select("id", cleaning.is_valid_email(F.col("email")).alias("valid"))


@query("dirty_flags", "SELECT driver_id, phone_was_dirty, nik_was_dirty, plate_was_dirty FROM {o_drivers}")
def _(d):
    return d.table("drivers").select(
        "driver_id",
        cleaning.phone_was_dirty(F.col("phone_number")).alias("phone_was_dirty"),
        cleaning.national_id_was_dirty(F.col("nik")).alias("nik_was_dirty"),
        cleaning.plate_was_dirty(F.col("license_plate")).alias("plate_was_dirty"),
    )


@query("clamp", "SELECT driver_id, least(5.0, greatest(1.0, coalesce(rating, 5.0)))::double AS rating FROM {drivers}")
def _(d):
    return d.table("drivers").select("driver_id", cleaning.clamp(F.col("rating"), 1.0, 5.0, 5.0).alias("rating"))


@query(
    "default_nulls",
    """SELECT ride_id, coalesce(distance_km, 0)::double AS distance_km, coalesce(duration_minutes, 0) AS duration_minutes,
       coalesce(surge_multiplier, 1)::double AS surge_multiplier, coalesce(promo_discount, 0)::double AS promo_discount FROM {rides}""",
)
def _(d):
    return facts.derive_rides(d.table("rides")).select("ride_id", "distance_km", "duration_minutes", "surge_multiplier", "promo_discount")


@query("experience_tier", "SELECT driver_id, experience_tier FROM {o_drivers}")
def _(d):
    trips = F.coalesce("total_trips", F.lit(0))
    return d.table("drivers").select("driver_id", domain.experience_tier(trips).alias("experience_tier"))


@query("loyalty_tier", "SELECT passenger_id, loyalty_tier FROM {o_passengers}")
def _(d):
    trips = F.coalesce("total_trips", F.lit(0))
    return d.table("passengers").select("passenger_id", domain.loyalty_tier(trips).alias("loyalty_tier"))


@query("age_bucket", "SELECT passenger_id, age_years, age_bucket FROM {o_passengers}")
def _(d):
    age = calendar.years_between_boundaries(today(SNAPSHOT_NOW), F.col("birth_date"))
    return d.table("passengers").select("passenger_id", age.alias("age_years"), domain.age_bucket(age).alias("age_bucket"))


@query(
    "vehicle_category",
    """SELECT vehicle_category, fare_tier, count(*) AS rides FROM {rides} LEFT JOIN {o_types} USING (vehicle_type_id) GROUP BY ALL""",
)
def _(d):
    types = d.vehicle_types.select(F.col("vehicle_type_id").alias("_type"), "vehicle_category", "fare_tier")
    joined = lookup_join(d.table("rides"), types, "vehicle_type_id", "_type", "ride_id")
    return joined.groupBy("vehicle_category", "fare_tier").agg(F.count("*").alias("rides"))


@query("province", "SELECT zone_id, province, area_type FROM {o_zones}")
def _(d):
    return d.table("zones").filter("is_active").select(
        "zone_id", domain.province(F.col("city")).alias("province"), domain.area_type(F.col("zone_code")).alias("area_type")
    )


@query("durations", "SELECT ride_id, acceptance_duration_secs, pickup_wait_secs, trip_duration_secs FROM {o_rides}")
def _(d):
    return facts.derive_rides(d.table("rides")).select("ride_id", "acceptance_duration_secs", "pickup_wait_secs", "trip_duration_secs")


@query("fare_flags", "SELECT ride_id, is_surge, has_promo FROM {o_rides}")
def _(d):
    return facts.derive_rides(d.table("rides")).select("ride_id", "is_surge", "has_promo")


@query("time_bucket", "SELECT ride_id, time_bucket FROM {o_rides}")
def _(d):
    return d.table("rides").select("ride_id", domain.time_bucket(F.col("requested_at")).alias("time_bucket"))


@query("same_zone_flag", "SELECT ride_id, is_same_zone_trip FROM {o_rides}")
def _(d):
    return facts.derive_rides(d.table("rides")).select("ride_id", "is_same_zone_trip")


@query(
    "surrogate_key",
    f"SELECT ride_id, md5(coalesce(driver_id, '{NULL_MARK}') || '-' || requested_at::varchar || '+00') AS key FROM {{rides}}",
)
def _(d):
    return d.table("rides").select("ride_id", surrogate_key(F.col("driver_id"), utc_text(F.col("requested_at"))).alias("key"))


# Function checks -----------------------------------------------------------------------------------------------------

_DOC = "event_payload"


@query("fn_clean_phone", f"SELECT phone, count(*) AS people FROM (SELECT {phone_sql('phone_number')} AS phone FROM {_PEOPLE}) GROUP BY ALL")
def _(d):
    return _people(d).groupBy(cleaning.clean_phone(F.col("phone_number")).alias("phone")).agg(F.count("*").alias("people"))


@query("fn_clean_nik", f"SELECT nik IS NULL AS raw_missing, {nik_sql('nik')} IS NULL AS rejected, count(*) AS drivers FROM {{drivers}} GROUP BY ALL")
def _(d):
    nik = F.col("nik")
    return d.table("drivers").groupBy(nik.isNull().alias("raw_missing"), cleaning.clean_national_id(nik).isNull().alias("rejected")).agg(
        F.count("*").alias("drivers")
    )


@query("fn_plate", f"SELECT left({plate_sql('license_plate')}, 2) AS area, count(*) AS drivers FROM {{drivers}} GROUP BY ALL")
def _(d):
    return d.table("drivers").groupBy(F.left(cleaning.clean_plate(F.col("license_plate")), F.lit(2)).alias("area")).agg(F.count("*").alias("drivers"))


@query(
    "fn_email",
    "SELECT regexp_full_match(lower(trim(email)), '[a-z0-9._%+-]+@[a-z0-9.-]+\\.[a-z]{2,}') AS valid, count(*) AS drivers FROM {drivers} GROUP BY ALL",
)
def _(d):
    return d.table("drivers").groupBy(cleaning.is_valid_email(F.col("email")).alias("valid")).agg(F.count("*").alias("drivers"))


@query("fn_json_scalar", f"SELECT event_id, {scalar_sql(_DOC, '$.zone')} AS zone FROM {{ride_events}}")
def _(d):
    return d.table("ride_events").select("event_id", jsonpath.json_scalar(F.col(_DOC), "zone").alias("zone"))


@query(
    "fn_json_subtree",
    f"SELECT event_id, CASE WHEN json_valid({_DOC}) THEN json_extract({_DOC}, '$.tags')::varchar END AS tags FROM {{ride_events}}",
)
def _(d):
    return d.table("ride_events").select("event_id", jsonpath.json_subtree(F.col(_DOC), "tags").alias("tags"))


@query("fn_json_safe_int", f"SELECT event_id, try_cast({scalar_sql(_DOC, '$.distance')} AS bigint) AS v FROM {{ride_events}}")
def _(d):
    return d.table("ride_events").select("event_id", jsonpath.json_as(F.col(_DOC), "distance", "bigint").alias("v"))


@query("fn_json_safe_float", f"SELECT event_id, try_cast({scalar_sql(_DOC, '$.fare')} AS double) AS v FROM {{ride_events}}")
def _(d):
    return d.table("ride_events").select("event_id", jsonpath.json_as(F.col(_DOC), "fare", "double").alias("v"))


@query("fn_json_safe_bool", f"SELECT event_id, try_cast({scalar_sql(_DOC, '$.retry')} AS boolean) AS v FROM {{ride_events}}")
def _(d):
    return d.table("ride_events").select("event_id", jsonpath.json_as(F.col(_DOC), "retry", "boolean").alias("v"))


@query("fn_json_nested", f"SELECT payment_id, {scalar_sql('gateway_raw_response', '$.metadata.ip')} AS ip FROM {{payments}}")
def _(d):
    return d.table("payments").select("payment_id", jsonpath.json_scalar(F.col("gateway_raw_response"), "$.metadata.ip").alias("ip"))


@query("fn_surrogate_key", f"SELECT count(DISTINCT md5(ride_id || '-' || coalesce(driver_id, '{NULL_MARK}'))) AS keys, count(*) AS rows FROM {{rides}}")
def _(d):
    key = surrogate_key(F.col("ride_id"), F.col("driver_id"))
    return d.table("rides").agg(F.count_distinct(key).alias("keys"), F.count("*").alias("rows"))


@query("fn_time_bucket", "SELECT hour(requested_at)::int AS hour, time_bucket, count(*) AS rides FROM {o_rides} GROUP BY ALL")
def _(d):
    at = F.col("requested_at")
    return d.table("rides").groupBy(F.hour(at).alias("hour"), domain.time_bucket(at).alias("time_bucket")).agg(F.count("*").alias("rides"))


@query(
    "fn_week_sunday",
    "SELECT (requested_at::date - dayofweek(requested_at)::int)::date AS week_start, count(*) AS rides FROM {rides} GROUP BY ALL",
)
def _(d):
    week = calendar.week_start_sunday(F.to_date("requested_at"))
    return d.table("rides").groupBy(week.alias("week_start")).agg(F.count("*").alias("rides"))


@query(
    "fn_calendar",
    """SELECT requested_at::date AS day, strftime(requested_at, '%U')::int AS week, year(requested_at)::varchar || '-W' || strftime(requested_at, '%V') AS iso,
       count(*) AS rides FROM {rides} GROUP BY ALL""",
)
def _(d):
    day = F.to_date("requested_at")
    keys = [day.alias("day"), calendar.week_number_sunday(day).alias("week"), calendar.calendar_year_iso_week(day).alias("iso")]
    return d.table("rides").groupBy(*keys).agg(F.count("*").alias("rides"))


@query(
    "fn_ts_diff",
    "SELECT ride_id, date_sub('minute', requested_at, updated_at) AS minutes, date_sub('second', requested_at, updated_at) AS seconds FROM {rides}",
)
def _(d):
    a, b = F.col("requested_at"), F.col("updated_at")
    return d.table("rides").select("ride_id", calendar.minutes_between(a, b).alias("minutes"), calendar.seconds_between(a, b).alias("seconds"))


@query("fn_try_divide", "SELECT ride_id, total_fare::double / nullif(promo_discount::double, 0) AS v FROM {rides}")
def _(d):
    return d.table("rides").select("ride_id", ratio(F.col("total_fare"), F.col("promo_discount")).alias("v"))


@query(
    "lookup_join_mixed_types",
    """SELECT kind, way, o_orderkey, c_name FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN o_custkey END AS k FROM orders) o LEFT JOIN customer ON c_custkey = k,
       (VALUES ('decimal(20,2)'), ('double'), ('int'), ('bigint')) kinds(kind), (VALUES ('small'), ('large')) ways(way)""",
)
def _(d):
    """One lookup under every pair of key types, with the dimension taken for small and for large."""
    setting = "spark.sql.autoBroadcastJoinThreshold"
    keyed = d.table("orders").select("o_orderkey", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_custkey")).alias("k"))
    names = d.table("customer").select("c_custkey", "c_name")
    before, out = d.spark.conf.get(setting), None
    try:
        for way, limit in (("small", "1g"), ("large", "-1")):
            d.spark.conf.set(setting, limit)
            for kind in ("decimal(20,2)", "double", "int", "bigint"):
                rows = lookup_join(keyed.withColumn("k", F.col("k").cast(kind)), names, "k", "c_custkey", "o_orderkey")
                rows = rows.select(F.lit(kind).alias("kind"), F.lit(way).alias("way"), "o_orderkey", "c_name")
                out = rows if out is None else out.unionByName(rows)
    finally:
        d.spark.conf.set(setting, before)
    return out
