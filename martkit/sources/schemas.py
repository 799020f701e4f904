"""Declared table schemas. Reading with them costs no inference job and settles column widths once."""

from __future__ import annotations

from pyspark.sql import types as T

_INT, _LONG, _DOUBLE, _STRING = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()
_NTZ, _UTC, _DATE, _BOOL = T.TimestampNTZType(), T.TimestampType(), T.DateType(), T.BooleanType()


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# Raw trips as the source delivers them. Ids are declared wide, because months differ in width and a
# narrow file can be read wide but not the other way round.
TRIP_SOURCE = _schema(
    vendorid=_LONG,
    tpep_pickup_datetime=_NTZ,
    tpep_dropoff_datetime=_NTZ,
    passenger_count=_DOUBLE,
    trip_distance=_DOUBLE,
    ratecodeid=_DOUBLE,
    store_and_fwd_flag=_STRING,
    pulocationid=_LONG,
    dolocationid=_LONG,
    payment_type=_LONG,
    fare_amount=_DOUBLE,
    extra=_DOUBLE,
    mta_tax=_DOUBLE,
    tip_amount=_DOUBLE,
    tolls_amount=_DOUBLE,
    improvement_surcharge=_DOUBLE,
    total_amount=_DOUBLE,
    congestion_surcharge=_DOUBLE,
    airport_fee=_DOUBLE,
)
RAW_TRIPS = T.StructType(
    TRIP_SOURCE.fields + _schema(driver_email=_STRING, driver_pseudo=_STRING).fields
)
LINEAGE = _schema(_ingested_at=_UTC, _source_file=_STRING, _source_row=_LONG)
MONTH_FOLDERS = _schema(year=_INT, month=_STRING)
LANDED_TRIPS = T.StructType(RAW_TRIPS.fields + LINEAGE.fields + MONTH_FOLDERS.fields)

RAW_ZONES = _schema(location_id=_LONG, borough=_STRING, zone_name=_STRING, service_zone=_STRING)
RAW_WEATHER = _schema(
    weather_date=_STRING,
    temperature_2m_mean=_DOUBLE,
    temperature_2m_max=_DOUBLE,
    precipitation_sum=_DOUBLE,
)
LANDED_WEATHER = T.StructType(RAW_WEATHER.fields + MONTH_FOLDERS.fields)
WEATHER_DOCUMENT = T.StructType(
    [
        T.StructField(
            "daily",
            T.StructType(
                [
                    T.StructField("time", T.ArrayType(_STRING)),
                    T.StructField("temperature_2m_mean", T.ArrayType(_DOUBLE)),
                    T.StructField("temperature_2m_max", T.ArrayType(_DOUBLE)),
                    T.StructField("precipitation_sum", T.ArrayType(_DOUBLE)),
                ]
            ),
        )
    ]
)

SILVER_TRIPS = _schema(
    vendor_id=_LONG,
    pickup_ts=_NTZ,
    dropoff_ts=_NTZ,
    pickup_date=_DATE,
    pickup_hour=_INT,
    pickup_dow_iso=_INT,
    is_weekend=_BOOL,
    is_rush_hour=_BOOL,
    passenger_count=_INT,
    trip_distance=_DOUBLE,
    trip_duration_min=_LONG,
    pu_location_id=_LONG,
    do_location_id=_LONG,
    pu_borough=_STRING,
    pu_zone=_STRING,
    do_borough=_STRING,
    do_zone=_STRING,
    payment_type=_INT,
    fare_amount=_DOUBLE,
    tip_amount=_DOUBLE,
    total_amount=_DOUBLE,
    tip_pct=_DOUBLE,
    temp_mean_c=_DOUBLE,
    temp_max_c=_DOUBLE,
    precip_mm=_DOUBLE,
    driver_pseudo=_STRING,
)
# The clean layer as the pipeline stores it: with the rows' origin, in month folders.
STORED_SILVER = T.StructType(
    SILVER_TRIPS.fields + _schema(_source_file=_STRING, _source_row=_LONG).fields + MONTH_FOLDERS.fields
)
DEMAND = _schema(
    pu_borough=_STRING,
    pu_zone=_STRING,
    pickup_hour=_INT,
    pickup_dow_iso=_INT,
    trips=_LONG,
    revenue_total=_DOUBLE,
    avg_ticket=_DOUBLE,
    avg_distance_mi=_DOUBLE,
    avg_duration_min=_DOUBLE,
)
TIPS = _schema(
    pu_borough=_STRING,
    payment_type=_INT,
    is_rush_hour=_BOOL,
    is_rainy=_BOOL,
    trips=_LONG,
    avg_tip_pct=_DOUBLE,
    avg_tip_amount=_DOUBLE,
    avg_ticket=_DOUBLE,
)
PREDICTIONS = _schema(
    pickup_date=_STRING,
    pu_zone=_STRING,
    pu_borough=_STRING,
    actual_total=_DOUBLE,
    predicted_total=_DOUBLE,
    abs_error=_DOUBLE,
    is_anomaly=_LONG,
)
ML_METRICS = T.StructType(
    [
        T.StructField("run_id", _STRING),
        T.StructField("model", _STRING),
        T.StructField("n_train", _LONG),
        T.StructField("n_test", _LONG),
        T.StructField("baseline", _schema(mae=_DOUBLE, rmse=_DOUBLE)),
        T.StructField("model_metrics", _schema(mae=_DOUBLE, rmse=_DOUBLE, r2=_DOUBLE)),
        T.StructField("improvement_mae_pct", _DOUBLE),
        T.StructField("feature_importance", T.MapType(_STRING, _DOUBLE)),
        T.StructField("anomalies_detected", _LONG),
    ]
)
