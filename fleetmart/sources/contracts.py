"""Declared table contracts: columns, types, keys, recency, layout."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Declared warehouse type -> Spark type. JSON lands as text.
TYPE_MAP = {
    "INTEGER": T.LongType(),
    "INT64": T.LongType(),
    "STRING": T.StringType(),
    "BOOL": T.BooleanType(),
    "BOOLEAN": T.BooleanType(),
    "NUMERIC": T.DecimalType(38, 9),
    "BIGNUMERIC": T.DecimalType(38, 9),
    "TIMESTAMP": T.TimestampType(),
    "DATETIME": T.TimestampType(),
    "DATE": T.DateType(),
    "FLOAT64": T.DoubleType(),
}
GRAINS = ("DAY", "MONTH", "YEAR")
METADATA_COLUMNS = ["_ingested_at", "_source_system"]
MAX_CLUSTER_COLUMNS = 4


@dataclass(frozen=True)
class TableSpec:
    """One ingested table. ``declared`` lists ``name TYPE`` pairs, ``!`` marks a required column.

    ``window_col`` bounds the extract, ``order_cols`` decide which of two rows is newer, ``partition_col`` lays out the
    table. They are separate because a row's partition column often never changes while the row does; the older rule,
    one column for all three, is available through ``single_recency_column()``.
    """

    name: str
    key: str
    declared: str
    window_col: str
    partition_col: str
    order_cols: tuple[str, ...] = ()
    partition_type: str = "MONTH"
    cluster_cols: tuple[str, ...] = ()
    append_only: bool = False
    json_cols: tuple[str, ...] = ()
    source_system: str = "source"
    columns: str | None = None
    types: dict[str, str] = field(init=False, default_factory=dict, compare=False)
    required: tuple[str, ...] = field(init=False, default=())

    def __post_init__(self) -> None:
        types, required = {}, []
        for item in self.declared.replace("\n", ",").split(","):
            if not item.strip():
                continue
            name, kind = item.split()
            if kind.endswith("!"):
                required.append(name)
                kind = kind[:-1]
            if kind not in TYPE_MAP:
                raise ValueError(f"{self.name}.{name}: unknown type {kind}")
            types[name] = kind
        object.__setattr__(self, "types", types)
        object.__setattr__(self, "required", tuple(required))
        if not self.order_cols:
            object.__setattr__(self, "order_cols", (self.window_col,))
        if self.partition_type not in GRAINS:
            raise ValueError(f"{self.name}: partition type must be one of {GRAINS}")
        if len(self.cluster_cols) > MAX_CLUSTER_COLUMNS:
            raise ValueError(f"{self.name}: at most {MAX_CLUSTER_COLUMNS} cluster columns")
        named = {self.key, self.window_col, self.partition_col, *self.order_cols, *self.cluster_cols, *self.json_cols}
        missing = sorted(c for c in named if c not in types)
        if missing:
            raise ValueError(f"{self.name}: not declared: {', '.join(missing)}")

    def single_recency_column(self) -> "TableSpec":
        """The rule under which the partition column also bounds the extract and decides what is newer."""
        return TableSpec(
            self.name, self.key, self.declared, self.partition_col, self.partition_col, (self.partition_col,),
            self.partition_type, self.cluster_cols, self.append_only, self.json_cols, self.source_system, self.columns,
        )

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, TYPE_MAP[k], c not in self.required) for c, k in self.types.items()])


SPECS = {
    s.name: s
    for s in [
        TableSpec(
            "zones", "zone_id",
            "zone_id INT64!, zone_code STRING!, zone_name STRING!, city STRING!, latitude NUMERIC, longitude NUMERIC, "
            "is_active BOOL!, created_at TIMESTAMP!",
            "created_at", "created_at", cluster_cols=("city", "is_active"), source_system="ride_ops_pg",
        ),
        TableSpec(
            "vehicle_types", "vehicle_type_id",
            "vehicle_type_id INT64!, type_code STRING!, type_name STRING!, base_fare NUMERIC!, per_km_rate NUMERIC!, "
            "per_minute_rate NUMERIC!, capacity INT64!, created_at TIMESTAMP!",
            "created_at", "created_at", cluster_cols=("type_code",), source_system="ride_ops_pg",
        ),
        TableSpec(
            "drivers", "driver_id",
            "driver_id STRING!, driver_code STRING!, full_name STRING!, phone_number STRING!, email STRING, nik STRING, "
            "sim_number STRING, license_plate STRING!, vehicle_type_id INT64, vehicle_brand STRING, vehicle_model STRING, "
            "vehicle_year INT64, vehicle_color STRING, home_zone_id INT64, rating NUMERIC, total_trips INT64, "
            "status STRING, joined_at TIMESTAMP!, updated_at TIMESTAMP!",
            "updated_at", "updated_at", cluster_cols=("status", "home_zone_id", "vehicle_type_id"),
            source_system="ride_ops_pg",
        ),
        TableSpec(
            "passengers", "passenger_id",
            "passenger_id STRING!, passenger_code STRING!, full_name STRING!, phone_number STRING!, email STRING, "
            "birth_date DATE, gender STRING, home_zone_id INT64, referral_code STRING, is_verified BOOL, "
            "total_trips INT64, status STRING, registered_at TIMESTAMP!, updated_at TIMESTAMP!",
            "updated_at", "updated_at", cluster_cols=("status", "home_zone_id"), source_system="ride_ops_pg",
        ),
        TableSpec(
            "rides", "ride_id",
            "ride_id STRING!, ride_code STRING!, driver_id STRING, passenger_id STRING, vehicle_type_id INT64, "
            "pickup_zone_id INT64, dropoff_zone_id INT64, pickup_address STRING, dropoff_address STRING, "
            "pickup_lat NUMERIC, pickup_lon NUMERIC, dropoff_lat NUMERIC, dropoff_lon NUMERIC, requested_at TIMESTAMP!, "
            "accepted_at TIMESTAMP, picked_up_at TIMESTAMP, completed_at TIMESTAMP, cancelled_at TIMESTAMP, "
            "distance_km NUMERIC, duration_minutes INT64, base_fare NUMERIC, distance_fare NUMERIC, time_fare NUMERIC, "
            "surge_multiplier NUMERIC, promo_discount NUMERIC, total_fare NUMERIC, ride_status STRING, "
            "cancellation_reason STRING, passenger_rating NUMERIC, driver_rating NUMERIC, notes STRING, "
            "created_at TIMESTAMP!, updated_at TIMESTAMP!",
            "updated_at", "requested_at", ("updated_at", "created_at", "requested_at"), "DAY",
            ("ride_status", "driver_id", "passenger_id", "pickup_zone_id"), source_system="ride_ops_pg",
        ),
        TableSpec(
            "ride_events", "event_id",
            "event_id STRING!, ride_id STRING!, event_type STRING!, event_payload STRING, occurred_at TIMESTAMP!",
            "occurred_at", "occurred_at", partition_type="DAY", cluster_cols=("event_type",), append_only=True,
            json_cols=("event_payload",), source_system="ride_ops_pg",
        ),
        TableSpec(
            "payment_methods", "method_id",
            "method_id INT64!, method_code STRING!, method_name STRING!, method_type STRING!, provider STRING, "
            "is_active BOOL!, created_at TIMESTAMP!",
            "created_at", "created_at", cluster_cols=("method_type", "is_active"), source_system="ride_marketing_mysql",
        ),
        TableSpec(
            "payments", "payment_id",
            "payment_id STRING!, payment_code STRING!, ride_id STRING!, passenger_id STRING!, method_id INT64!, "
            "amount NUMERIC!, platform_fee NUMERIC, driver_earning NUMERIC!, promo_discount NUMERIC, currency STRING!, "
            "payment_status STRING!, payment_gateway STRING, gateway_ref STRING, gateway_raw_response STRING, "
            "paid_at TIMESTAMP, expired_at TIMESTAMP, refunded_at TIMESTAMP, refund_reason STRING, created_at TIMESTAMP!, "
            "updated_at TIMESTAMP!",
            "updated_at", "created_at", ("updated_at",), "DAY",
            ("payment_status", "ride_id", "passenger_id", "method_id"), source_system="ride_marketing_mysql",
        ),
        TableSpec(
            "promotions", "promo_id",
            "promo_id INT64!, promo_code STRING!, promo_name STRING!, description STRING, promo_type STRING!, "
            "discount_value NUMERIC!, max_discount NUMERIC, min_fare NUMERIC, applicable_vehicle_types STRING, "
            "applicable_zones STRING, max_usage_total INT64, max_usage_per_user INT64, current_usage INT64, "
            "valid_from TIMESTAMP!, valid_until TIMESTAMP!, is_active BOOL, created_at TIMESTAMP!",
            "valid_from", "valid_from", cluster_cols=("promo_type", "is_active"), source_system="ride_marketing_mysql",
        ),
        TableSpec(
            "promo_usage", "usage_id",
            "usage_id INT64!, promo_id INT64!, passenger_id STRING!, ride_id STRING!, discount_given NUMERIC!, "
            "used_at TIMESTAMP!",
            "used_at", "used_at", partition_type="DAY", cluster_cols=("promo_id", "passenger_id", "ride_id"),
            append_only=True, source_system="ride_marketing_mysql",
        ),
        TableSpec(
            "driver_incentives", "incentive_id",
            "incentive_id INT64!, driver_id STRING!, incentive_type STRING!, reference_id STRING, amount NUMERIC!, "
            "description STRING, period_date DATE!, is_paid BOOL, paid_at TIMESTAMP, created_at TIMESTAMP!",
            "period_date", "period_date", cluster_cols=("driver_id", "incentive_type", "is_paid"),
            source_system="ride_marketing_mysql",
        ),
    ]
}
