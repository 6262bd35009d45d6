"""Bronze tables derived from the star-schema test tables.

Each text runs unchanged in Spark and in the checking database: integer and decimal arithmetic only, ``{name}`` marks
a table. Orders and line items meet by a shuffle on the order key, as both grow with the data, and the rides that result
are spread over it whatever the files look like. ``bronze(spark, sf_dir, name)`` resolves the names recursively, so a bronze table is one lazy Spark plan over
the parquet files. The rates and codes of the five vehicle types are the fixed seed rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Declared, so that naming a table does not start a job that opens its files.
BASE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
    "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
}
BASE_TABLES = list(BASE_SCHEMAS)

ZONES = """
SELECT cast(n.n_nationkey AS bigint) AS zone_id,
       CASE WHEN r.r_regionkey = 0 THEN 'JKT-' ELSE 'Z' END || lpad(cast(n.n_nationkey AS string), cast(greatest(2, length(cast(n.n_nationkey AS string))) AS int), '0') AS zone_code,
       n.n_name AS zone_name,
       CASE r.r_regionkey WHEN 0 THEN 'Jakarta' WHEN 1 THEN 'Banten' WHEN 2 THEN 'Jawa Barat' ELSE r.r_name END AS city,
       cast(-6.1 - 0.01 * n.n_nationkey AS decimal(10,7)) AS latitude,
       cast(106.6 + 0.02 * n.n_nationkey AS decimal(10,7)) AS longitude,
       n.n_nationkey % 12 <> 11 AS is_active,
       cast('2026-01-01 00:00:00' AS timestamp) AS created_at,
       'postgres' AS _source_system
FROM {nation} n JOIN {region} r ON n.n_regionkey = r.r_regionkey
"""

VEHICLE_TYPES = """
SELECT cast(id AS bigint) AS vehicle_type_id, type_code, type_name,
       cast(base AS decimal(10,2)) AS base_fare, cast(km AS decimal(10,2)) AS per_km_rate,
       cast(mins AS decimal(10,2)) AS per_minute_rate, cast(cap AS bigint) AS capacity,
       cast('2026-01-01 00:00:00' AS timestamp) AS created_at, 'postgres' AS _source_system
FROM (VALUES (1, 'MOTOR', 'Motor', 4000, 1500, 200, 1),
             (2, 'ECONOMI', 'Mobil Ekonomi', 8000, 2500, 400, 4),
             (3, 'COMFORT', 'Mobil Comfort', 12000, 3500, 500, 4),
             (4, 'SUV', 'SUV / XL', 15000, 4500, 600, 6),
             (5, 'PREMIUM', 'Mobil Premium', 25000, 6000, 800, 4))
     AS t(id, type_code, type_name, base, km, mins, cap)
"""

_PHONE = """CASE {k} % 5
         WHEN 0 THEN '+62812' || lpad(cast({k} % 10000000 AS string), 7, '0')
         WHEN 1 THEN '0812-' || lpad(cast({k} % 10000 AS string), 4, '0') || '-7890'
         WHEN 2 THEN '0813' || lpad(cast({k} % 100000000 AS string), 8, '0')
         WHEN 3 THEN '12345'
         ELSE '62 21 ' || lpad(cast({k} % 10000000 AS string), 7, '0') END"""


def _phone(key: str) -> str:
    return _PHONE.replace("{k}", key)


DRIVERS = f"""
SELECT 'D-' || cast(s_suppkey AS string) AS driver_id,
       'DRV' || lpad(cast(s_suppkey AS string), cast(greatest(6, length(cast(s_suppkey AS string))) AS int), '0') AS driver_code,
       s_name AS full_name,
       {_phone('s_suppkey')} AS phone_number,
       CASE WHEN s_suppkey % 4 = 3 THEN 'driver' || cast(s_suppkey AS string)
            ELSE ' Driver' || cast(s_suppkey AS string) || '@Fleet.co.id ' END AS email,
       CASE s_suppkey % 3
         WHEN 0 THEN '3271' || lpad(cast(s_suppkey AS string), cast(greatest(12, length(cast(s_suppkey AS string))) AS int), '0')
         WHEN 1 THEN '3271 0123 ' || lpad(cast(s_suppkey % 10000 AS string), 4, '0') || ' 8901'
         ELSE '327' || lpad(cast(s_suppkey AS string), cast(greatest(12, length(cast(s_suppkey AS string))) AS int), '0') END AS nik,
       'SIM' || cast(s_suppkey AS string) AS sim_number,
       CASE s_suppkey % 3
         WHEN 0 THEN 'b ' || cast(1000 + s_suppkey % 9000 AS string) || ' abc'
         WHEN 1 THEN 'B ' || cast(1000 + s_suppkey % 9000 AS string) || ' XYZ'
         ELSE ' B  ' || cast(1000 + s_suppkey % 9000 AS string) || '  QRS ' END AS license_plate,
       s_suppkey % 5 + 1 AS vehicle_type_id,
       CASE WHEN s_suppkey % 2 = 0 THEN 'Honda' ELSE 'Toyota' END AS vehicle_brand,
       'M' || cast(s_suppkey % 7 AS string) AS vehicle_model,
       2015 + s_suppkey % 10 AS vehicle_year,
       CASE WHEN s_suppkey % 2 = 0 THEN 'Hitam' ELSE 'Putih' END AS vehicle_color,
       cast(s_nationkey AS bigint) AS home_zone_id,
       CASE WHEN s_suppkey % 29 = 0 THEN NULL ELSE cast(s_acctbal / 1500 AS decimal(5,2)) END AS rating,
       CASE WHEN s_suppkey % 31 = 0 THEN NULL ELSE s_suppkey * 37 % 1500 END AS total_trips,
       CASE s_suppkey % 4 WHEN 0 THEN 'ACTIVE' WHEN 1 THEN 'inactive' WHEN 2 THEN 'SUSPENDED' ELSE 'PENDING' END AS status,
       cast('2025-01-01 00:00:00' AS timestamp) + INTERVAL '1' HOUR * (s_suppkey % 8760) AS joined_at,
       cast('2026-01-01 00:00:00' AS timestamp) + INTERVAL '1' MINUTE * (s_suppkey % 525600) AS updated_at,
       'postgres' AS _source_system
FROM {{supplier}}
"""

PASSENGERS = f"""
SELECT 'P-' || cast(c_custkey AS string) AS passenger_id,
       'PSG' || lpad(cast(c_custkey AS string), cast(greatest(8, length(cast(c_custkey AS string))) AS int), '0') AS passenger_code,
       c_name AS full_name,
       {_phone('c_custkey')} AS phone_number,
       'p' || cast(c_custkey AS string) || '@mail.id' AS email,
       CASE WHEN c_custkey % 50 = 0 THEN NULL
            ELSE DATE '1950-01-01' + cast(c_custkey * 37 % 22000 AS int) END AS birth_date,
       CASE c_custkey % 5 WHEN 0 THEN 'M' WHEN 1 THEN 'F' WHEN 2 THEN 'other' WHEN 3 THEN 'UNKNOWN' ELSE NULL END AS gender,
       cast(c_nationkey AS bigint) AS home_zone_id,
       CASE WHEN c_custkey % 3 = 0 THEN 'REF' || cast(c_custkey AS string) ELSE NULL END AS referral_code,
       c_custkey % 2 = 0 AS is_verified,
       CASE WHEN c_custkey % 41 = 0 THEN NULL ELSE c_custkey * 13 % 400 END AS total_trips,
       CASE c_custkey % 3 WHEN 0 THEN 'ACTIVE' WHEN 1 THEN 'inactive' ELSE 'BANNED' END AS status,
       cast('2024-01-01 00:00:00' AS timestamp) + INTERVAL '1' HOUR * (c_custkey % 8760) AS registered_at,
       cast('2026-01-01 00:00:00' AS timestamp) + INTERVAL '1' MINUTE * (c_custkey % 525600) AS updated_at,
       CASE WHEN c_custkey % 10 = 9 THEN NULL ELSE 'postgres' END AS _source_system
FROM {{customer}}
"""

RIDES = """
WITH item AS (
    SELECT l_orderkey AS k, min(l_suppkey) AS supp, cast(sum(cast(l_quantity AS decimal(8,2))) AS decimal(8,2)) AS km
    FROM {lineitem} GROUP BY l_orderkey
), base AS (
    SELECT /*+ MERGE(i) */ o.o_orderkey AS k, o.o_custkey AS cust, i.supp, i.km, cast(c.c_nationkey AS bigint) AS zone,
           cast(o.o_totalprice AS decimal(10,2)) AS price, o.o_orderpriority AS prio,
           cast(o.o_orderdate AS timestamp) + INTERVAL '1' SECOND * (o.o_orderkey * 7919 % 86400) AS req,
           CASE WHEN i.k IS NULL THEN 'NO_DRIVER'
                WHEN o.o_orderstatus = 'F' THEN 'COMPLETED'
                WHEN o.o_orderstatus = 'O' THEN 'CANCELLED'
                WHEN o.o_orderkey % 3 = 0 THEN 'REQUESTED'
                WHEN o.o_orderkey % 3 = 1 THEN 'ACCEPTED'
                ELSE 'PICKED_UP' END AS st
    FROM {orders} o
    LEFT JOIN item i ON o.o_orderkey = i.k
    LEFT JOIN {customer} c ON o.o_custkey = c.c_custkey
), timed AS (
    SELECT b.*, k % 5 + 1 AS vt,
           CASE WHEN st IN ('ACCEPTED', 'PICKED_UP', 'COMPLETED') OR (st = 'CANCELLED' AND k % 2 = 0)
                THEN req + INTERVAL '1' SECOND * (20 + k % 161) END AS acc,
           CASE WHEN k % 53 = 0 THEN NULL ELSE 5 + k % 55 END AS mins,
           CASE WHEN prio LIKE '1%' THEN 2.0 WHEN prio LIKE '2%' THEN 1.5 WHEN prio LIKE '3%' THEN 1.2 ELSE 1.0 END AS mult,
           CASE k % 10 WHEN 0 THEN 2000 WHEN 1 THEN 3000 WHEN 2 THEN 5000 WHEN 3 THEN NULL ELSE 0 END AS promo
    FROM base b
), staged AS (
    SELECT t.*,
           CASE WHEN st IN ('PICKED_UP', 'COMPLETED')
                THEN acc + INTERVAL '1' SECOND * (CASE WHEN k % 997 = 0 THEN -60 ELSE 120 + k % 781 END) END AS pick,
           CASE WHEN st = 'CANCELLED' THEN req + INTERVAL '1' SECOND * (300 + k % 1800) END AS canc
    FROM timed t
), done AS (
    SELECT s.*,
           CASE WHEN st = 'COMPLETED' THEN pick + INTERVAL '1' MINUTE * coalesce(mins, 30) END AS fin
    FROM staged s
)
SELECT 'R-' || cast(k AS string) AS ride_id,
       'RIDE-' || replace(cast(cast(req AS date) AS string), '-', '') || '-' || lpad(cast(k AS string), cast(greatest(6, length(cast(k AS string))) AS int), '0') AS ride_code,
       CASE WHEN acc IS NOT NULL THEN 'D-' || cast(supp AS string) END AS driver_id,
       'P-' || cast(cust AS string) AS passenger_id,
       vt AS vehicle_type_id,
       zone AS pickup_zone_id,
       (zone + k % 4) % 25 AS dropoff_zone_id,
       'Jl. Asal No. ' || cast(k % 200 AS string) AS pickup_address,
       'Jl. Tujuan No. ' || cast(k % 300 AS string) AS dropoff_address,
       cast(-6.1 - 0.01 * zone AS decimal(10,7)) AS pickup_lat,
       cast(106.6 + 0.02 * zone AS decimal(10,7)) AS pickup_lon,
       cast(-6.1 - 0.01 * ((zone + k % 4) % 25) AS decimal(10,7)) AS dropoff_lat,
       cast(106.6 + 0.02 * ((zone + k % 4) % 25) AS decimal(10,7)) AS dropoff_lon,
       req AS requested_at, acc AS accepted_at, pick AS picked_up_at, fin AS completed_at, canc AS cancelled_at,
       km AS distance_km,
       mins AS duration_minutes,
       v.base_fare AS base_fare,
       cast(v.per_km_rate * km AS decimal(10,2)) AS distance_fare,
       cast(v.per_minute_rate * mins AS decimal(10,2)) AS time_fare,
       CASE WHEN k % 89 = 0 THEN NULL ELSE cast(mult AS decimal(4,2)) END AS surge_multiplier,
       cast(promo AS decimal(10,2)) AS promo_discount,
       CASE WHEN k % 4 = 0 AND km IS NOT NULL AND mins IS NOT NULL
            THEN cast(greatest(cast(7000 AS decimal(10,2)),
                               cast((v.base_fare + cast(v.per_km_rate * km AS decimal(10,2))
                                     + cast(v.per_minute_rate * mins AS decimal(10,2))) * cast(mult AS decimal(4,2))
                                    - coalesce(promo, 0) AS decimal(12,2))) AS decimal(10,2))
            ELSE price END AS total_fare,
       CASE WHEN k % 11 = 0 THEN lower(st) ELSE st END AS ride_status,
       CASE WHEN st = 'CANCELLED' THEN
            CASE k % 5 WHEN 0 THEN 'PASSENGER_CANCELLED' WHEN 1 THEN 'DRIVER_DELAYED' WHEN 2 THEN 'WRONG_PICKUP_POINT'
                       WHEN 3 THEN 'PASSENGER_NO_SHOW' END END AS cancellation_reason,
       CASE WHEN st = 'COMPLETED' THEN cast((30 + k % 21) * 0.1 AS decimal(3,1)) END AS passenger_rating,
       CASE WHEN st = 'COMPLETED' THEN cast((30 + k % 19) * 0.1 AS decimal(3,1)) END AS driver_rating,
       CASE WHEN k % 6 = 0 THEN 'bawa bagasi kecil' END AS notes,
       req AS created_at,
       coalesce(fin, canc, pick, acc, req) AS updated_at,
       CASE WHEN k % 13 = 0 THEN NULL ELSE 'postgres' END AS _source_system
FROM done LEFT JOIN {vehicle_types} v ON done.vt = v.vehicle_type_id
"""

RIDE_EVENTS = """
WITH first_ride AS (SELECT o_custkey, min(o_orderkey) AS k FROM {orders} GROUP BY o_custkey)
SELECT 'E-' || cast(event_id AS string) AS event_id,
       'R-' || coalesce(cast(f.k AS string), 'none-' || cast(user_id AS string)) AS ride_id,
       CASE event_type WHEN 'view' THEN 'RIDE_REQUESTED' WHEN 'click' THEN 'RIDE_ACCEPTED'
                       WHEN 'signup' THEN 'PASSENGER_PICKED_UP' WHEN 'purchase' THEN 'RIDE_COMPLETED'
                       ELSE 'RIDE_CANCELLED' END AS event_type,
       CASE WHEN event_id % 97 = 0 THEN substr(props, 1, length(props) - 1)
            ELSE substr(props, 1, length(props) - 1)
              || CASE WHEN event_type = 'view' AND event_id % 10 = 0
                        THEN ', "surge_multiplier": 1.2, "pickup_zone": "Z' || cast(event_id % 25 AS string) || '"'
                      WHEN event_type = 'view'
                        THEN ', "surge": ' || cast(cast(value AS decimal(12,2)) AS string) || ', "zone": "Z' || cast(event_id % 25 AS string) || '"'
                      WHEN event_type = 'click' THEN ', "driver_id": "D-' || cast(user_id AS string) || '"'
                      WHEN event_type = 'signup' THEN ', "zone": ' || chr(123) || '"id": 3' || chr(125) || ', "tags": ["a", "b"]'
                      WHEN event_type = 'purchase' AND event_id % 10 = 0
                        THEN ', "total_fare": ' || cast(cast(value * 1000 AS decimal(12,2)) AS string)
                      WHEN event_type = 'purchase'
                        THEN ', "fare": ' || cast(cast(value * 1000 AS decimal(12,2)) AS string) || ', "distance": "' || CASE WHEN event_id % 7 = 0 THEN 'n/a' ELSE cast(event_id % 40 AS string) END || '"'
                      ELSE ', "reason": "R' || cast(event_id % 4 AS string) || '", "retry": ' || CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END END
              || chr(125) END AS event_payload,
       cast(ts AS timestamp) AS occurred_at,
       'mongodb' AS _source_system
FROM {events} LEFT JOIN first_ride f ON f.o_custkey = user_id
"""

PAYMENTS = """
SELECT 'PAY-' || cast(o_orderkey AS string) AS payment_id,
       'PC' || lpad(cast(o_orderkey AS string), cast(greatest(9, length(cast(o_orderkey AS string))) AS int), '0') AS payment_code,
       CASE WHEN o_orderkey % 199 = 0 THEN 'R-none-' ELSE 'R-' END || cast(o_orderkey AS string) AS ride_id,
       'P-' || cast(o_custkey AS string) AS passenger_id,
       o_orderkey % 4 + 1 AS method_id,
       cast(o_totalprice AS decimal(12,2)) AS amount,
       cast(cast(o_totalprice AS decimal(12,2)) * 0.20 AS decimal(12,2)) AS platform_fee,
       cast(o_totalprice AS decimal(12,2)) - cast(cast(o_totalprice AS decimal(12,2)) * 0.20 AS decimal(12,2)) AS driver_earning,
       cast(CASE o_orderkey % 10 WHEN 0 THEN 2000 WHEN 1 THEN 3000 WHEN 2 THEN 5000 ELSE 0 END AS decimal(12,2)) AS promo_discount,
       cast(cast(o_totalprice AS decimal(12,2)) * 0.11 AS decimal(12,2)) AS tax_amount,
       cast(o_orderkey % 5 * 1000 AS decimal(12,2)) AS toll_amount,
       cast(o_orderkey % 7 * 500 AS decimal(12,2)) AS tip_amount,
       cast(cast(o_totalprice AS decimal(12,2)) + cast(cast(o_totalprice AS decimal(12,2)) * 0.11 AS decimal(12,2)) + o_orderkey % 5 * 1000 + o_orderkey % 7 * 500
            - CASE o_orderkey % 10 WHEN 0 THEN 2000 WHEN 1 THEN 3000 WHEN 2 THEN 5000 ELSE 0 END AS decimal(14,2)) AS net_amount,
       'IDR' AS currency,
       CASE o_orderkey % 10 WHEN 4 THEN 'FAILED' WHEN 7 THEN 'PENDING' ELSE 'SUCCESS' END AS payment_status,
       'gw' || cast(o_orderkey % 3 AS string) AS payment_gateway,
       'REF' || cast(o_orderkey AS string) AS gateway_ref,
       CASE WHEN o_orderkey % 61 = 0 THEN NULL ELSE
         chr(123) || '"gateway": "gw' || cast(o_orderkey % 3 AS string) || '", "reference": "REF' || cast(o_orderkey AS string)
         || '", "status": "' || CASE o_orderkey % 10 WHEN 4 THEN 'denied' ELSE 'ok' END
         || '", "amount": ' || CASE WHEN o_orderkey % 23 = 0 THEN '"unknown"' ELSE cast(cast(o_totalprice AS decimal(12,2)) AS string) END
         || ', "timestamp": "2026-01-01T00:00:00", "metadata": ' || chr(123) || '"ip": "10.0.' || cast(o_orderkey % 256 AS string)
         || '.1", "device": ' || CASE WHEN o_orderkey % 2 = 0 THEN '"android"' ELSE chr(123) || '"os": "ios"' || chr(125) END
         || chr(125) || chr(125) END AS gateway_raw_response,
       CASE WHEN o_orderkey % 10 NOT IN (4, 7) THEN cast(o_orderdate AS timestamp) + INTERVAL '1' HOUR * (o_orderkey % 24) END AS paid_at,
       cast(o_orderdate AS timestamp) AS created_at,
       cast(o_orderdate AS timestamp) + INTERVAL '1' HOUR * (o_orderkey % 24) AS updated_at
FROM {orders}
"""

PROMO_USAGE = """
SELECT 'U-' || cast(l_orderkey AS string) || '-' || cast(l_linenumber AS string) || '-' || cast(l_partkey AS string)
            || '-' || cast(l_suppkey AS string) AS usage_id,
       cast((l_partkey - l_partkey % 50) / 50 AS bigint) + 1 AS promo_id,
       'R-' || cast(l_orderkey AS string) AS ride_id,
       'P-' || cast(o.o_custkey AS string) AS passenger_id,
       cast(l_discount * 50000 AS decimal(12,2)) AS discount_given,
       CASE l_linenumber % 4 WHEN 0 THEN 'CANCELLED' ELSE 'REDEEMED' END AS redemption_status,
       cast(l_shipdate AS timestamp) AS used_at,
       cast(l_shipdate AS timestamp) AS created_at,
       cast(l_shipdate AS timestamp) + INTERVAL '1' HOUR * l_linenumber AS updated_at
FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey
WHERE l_discount > 0.05
"""

PROMOTIONS = """
SELECT promo_id, 'PROMO' || lpad(cast(promo_id AS string), cast(greatest(3, length(cast(promo_id AS string))) AS int), '0') AS promo_code,
       'Promo ' || cast(promo_id AS string) AS promo_name,
       CASE promo_id % 2 WHEN 0 THEN 'PERCENT' ELSE 'FIXED' END AS promo_type,
       CASE promo_id % 2 WHEN 0 THEN 'PERCENTAGE' ELSE 'AMOUNT' END AS discount_type,
       cast(count(*) AS bigint) AS current_usage,
       cast(sum(price) AS decimal(14,2)) AS budget_amount,
       CASE WHEN count(*) % 2 = 0 THEN 'ACTIVE' ELSE 'ENDED' END AS promo_status,
       cast(max(price) AS decimal(12,2)) AS discount_value,
       cast('1995-01-01 00:00:00' AS timestamp) AS valid_from,
       cast('2002-01-01 00:00:00' AS timestamp) AS valid_until
FROM (SELECT cast((p_partkey - p_partkey % 50) / 50 AS bigint) + 1 AS promo_id, cast(p_retailprice AS decimal(12,2)) AS price FROM {part}) p
GROUP BY promo_id
"""

PAYOUTS = """
SELECT 'PO-' || cast(k AS string) AS payout_id, driver_id, ride_id, payout_date,
       base_earning, incentive_amount, bonus_amount, deduction_amount,
       cast(base_earning + incentive_amount + bonus_amount - deduction_amount AS decimal(14,2)) AS final_payout_amount,
       CASE k % 9 WHEN 0 THEN 'PENDING' ELSE 'PAID' END AS payout_status, created_at, updated_at
FROM (SELECT cast(substr(ride_id, 3) AS bigint) AS k, driver_id, ride_id, cast(completed_at AS date) AS payout_date,
             cast(total_fare * 0.8 AS decimal(12,2)) AS base_earning,
             cast(CASE WHEN surge_multiplier > 1.2 THEN 1500 ELSE 0 END AS decimal(12,2)) AS incentive_amount,
             cast(CASE WHEN passenger_rating >= 4.5 THEN 1000 ELSE 0 END AS decimal(12,2)) AS bonus_amount,
             cast(CASE WHEN passenger_rating < 3.2 THEN 500 ELSE 0 END AS decimal(12,2)) AS deduction_amount,
             completed_at AS created_at, updated_at
      FROM {rides} WHERE upper(ride_status) = 'COMPLETED') x
"""

TRIPS = """
SELECT r.*, 'V-' || r.driver_id AS vehicle_id,
       cast(r.distance_km * (9 + cast(substr(r.ride_id, 3) AS bigint) % 3) * 0.1 AS decimal(12,2)) AS estimated_distance_km,
       cast(r.base_fare + r.distance_fare + r.time_fare AS decimal(12,2)) AS estimated_fare
FROM {rides} r
"""

SEGMENTS = """
SELECT 'P-' || cast(o_custkey AS string) AS passenger_id,
       CASE WHEN count(*) >= 4 THEN 'LOYAL' WHEN count(*) >= 2 THEN 'REGULAR' ELSE 'NEW' END AS segment_name,
       cast(sum(cast(o_totalprice AS decimal(12,2))) AS decimal(20,2)) AS segment_score,
       cast(date_trunc('year', o_orderdate) AS date) AS snapshot_date
FROM {orders} GROUP BY o_custkey, cast(date_trunc('year', o_orderdate) AS date)
"""

CAMPAIGN_SPEND = """
SELECT 'C' || cast(user_id % 5 AS string) AS campaign_id, 'Campaign ' || cast(user_id % 5 AS string) AS campaign_name,
       CASE user_id % 3 WHEN 0 THEN 'search' WHEN 1 THEN 'social' ELSE 'video' END AS channel_name,
       cast(ts AS date) AS spend_date,
       cast(value * 100 AS decimal(12,2)) AS spend_amount,
       cast(CASE WHEN event_type = 'view' THEN 10 ELSE 1 END AS bigint) AS impressions,
       cast(CASE WHEN event_type IN ('click', 'signup', 'purchase') THEN 1 ELSE 0 END AS bigint) AS clicks,
       cast(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END AS bigint) AS installs
FROM {events}
"""

CHANGE_LOG = """
WITH log AS (
    SELECT o_custkey AS cust, o_orderstatus AS status, o_orderkey AS lsn,
           cast(o_orderdate AS timestamp) + INTERVAL '1' SECOND * (o_orderkey * 7919 % 86400) AS ts
    FROM {orders}
), opening AS (
    SELECT cust, min_by(lsn, ts) AS first_lsn FROM log GROUP BY cust
)
SELECT 'C-' || cast(log.cust AS string) AS customer_id, log.status, log.ts, log.lsn,
       CASE WHEN log.lsn % 17 = 0 THEN 'd' WHEN log.lsn = opening.first_lsn THEN 'c' ELSE 'u' END AS op
FROM log JOIN opening ON log.cust = opening.cust
"""

TABLES = {
    "zones": ZONES,
    "vehicle_types": VEHICLE_TYPES,
    "drivers": DRIVERS,
    "passengers": PASSENGERS,
    "rides": RIDES,
    "ride_events": RIDE_EVENTS,
    "payments": PAYMENTS,
    "promo_usage": PROMO_USAGE,
    "promotions": PROMOTIONS,
    "payouts": PAYOUTS,
    "trips": TRIPS,
    "segments": SEGMENTS,
    "campaign_spend": CAMPAIGN_SPEND,
    "change_log": CHANGE_LOG,
}


def inputs_of(name: str) -> list[str]:
    """Tables a bronze text reads, in the order of their first mention."""
    known = BASE_TABLES + list(TABLES)
    found = {t: TABLES[name].find("{" + t + "}") for t in known}
    return sorted((t for t, at in found.items() if at >= 0), key=lambda t: found[t])


def base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(BASE_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def bronze(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A bronze table (or a base table) as one lazy plan."""
    if name in BASE_TABLES:
        return base(spark, sf_dir, name)
    return spark.sql(TABLES[name], **{t: bronze(spark, sf_dir, t) for t in inputs_of(name)})
