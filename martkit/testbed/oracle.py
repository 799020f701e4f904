"""The same queries as SQL over the driver tables, for an independent engine (DuckDB).

Written from the definition of each result, with functions of that engine; nothing here is used by the
library. Sums of doubles are stated exactly (whole units of 1e-8), so that no result depends on the order
in which rows are added.
"""

from __future__ import annotations

from martkit.testbed.adapters import SALT


def exact(x: str) -> str:
    return f"CAST(SUM(CAST(ROUND({x} * 1e8) AS HUGEINT)) AS DOUBLE) / 1e8"


def mean(x: str) -> str:
    return f"({exact(x)}) / COUNT({x})"


_TRIPS = f"""
bt AS (
  SELECT *, fare_amount * disc AS tip_amount, fare_amount + fare_amount * disc + tax * 10 AS total_amount,
    p AS tpep_pickup_datetime,
    p + to_seconds(CAST((pk * 37 + sk * 101) % 15600 - 300 AS BIGINT)) AS tpep_dropoff_datetime,
    left(sha256('{SALT}' || driver_email), 16) AS driver_pseudo
  FROM (
    SELECT l_partkey AS pk, l_suppkey AS sk, l_discount AS disc, l_tax AS tax,
      l_shipdate + to_seconds(CAST((l_orderkey * 7919 + l_linenumber * 3607 + l_partkey * 13) % 86400
        AS BIGINT)) AS p,
      CAST(l_suppkey % 2 + 1 AS INTEGER) AS vendorid,
      CASE WHEN l_quantity <> 50 THEN l_quantity % 10 END AS passenger_count,
      (l_quantity - 1) * CAST(4.1 AS DOUBLE) AS trip_distance,
      CAST(l_partkey % 27 AS INTEGER) AS pulocationid,
      CAST(l_suppkey % 26 AS INTEGER) AS dolocationid,
      CAST(l_linenumber % 5 + 1 AS BIGINT) AS payment_type,
      CASE WHEN l_linenumber = 7 AND l_returnflag = 'R' THEN CAST(0 AS DOUBLE)
           ELSE l_extendedprice / 1000 - 2 END AS fare_amount,
      'driver' || CAST(CAST(l_orderkey AS HUGEINT) * 2654435761 % 5000 AS VARCHAR) || '@example.test'
        AS driver_email,
      concat_ws(':', l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_quantity AS BIGINT),
        CAST(round_even(l_extendedprice * 100, 0) AS BIGINT)) AS trip_key
    FROM lineitem
  )
)"""

_ZONES = """
bz AS (
  SELECT CAST(n_nationkey AS BIGINT) AS location_id, r_name AS borough, n_name AS zone_name,
    CAST(NULL AS VARCHAR) AS service_zone
  FROM nation JOIN region ON n_regionkey = r_regionkey
)"""

_WEATHER = """
bw AS (
  SELECT CAST(day AS VARCHAR) AS weather_date, mean AS temperature_2m_mean, mean + 5 AS temperature_2m_max,
    CASE WHEN n % 3 = 0 THEN n / 2.0::DOUBLE ELSE CAST(0 AS DOUBLE) END AS precipitation_sum
  FROM (
    SELECT CAST(o_orderdate AS DATE) AS day, CAST(SUM(o_custkey) % 400 AS DOUBLE) / 10 AS mean,
      COUNT(*) AS n
    FROM orders GROUP BY 1
  )
)"""

_RULES = {
    "pickup_present": "tpep_pickup_datetime IS NOT NULL",
    "dropoff_after_pickup": "tpep_dropoff_datetime > tpep_pickup_datetime",
    "distance_above_0": "trip_distance > 0",
    "distance_below_200": "trip_distance < 200",
    "fare_not_negative": "fare_amount >= 0",
    "total_not_negative": "total_amount >= 0",
    "passengers_1_to_8": "passenger_count BETWEEN 1 AND 8",
    "duration_1_to_240": "date_diff('minute', tpep_pickup_datetime, tpep_dropoff_datetime)"
    " BETWEEN 1 AND 240",
}
_CLEAN = "\n  AND ".join(_RULES.values())

_RUSH = "(EXTRACT(hour FROM {t}) BETWEEN 7 AND 9 OR EXTRACT(hour FROM {t}) BETWEEN 16 AND 19)"
_TIP = "CASE WHEN fare_amount > 0 THEN ROUND(100.0 * tip_amount / fare_amount, 2) END"
_TIMES = f"""
    CAST(tpep_pickup_datetime AS DATE) AS pickup_date,
    CAST(EXTRACT(hour FROM tpep_pickup_datetime) AS INTEGER) AS pickup_hour,
    CAST(EXTRACT(isodow FROM tpep_pickup_datetime) AS INTEGER) AS pickup_dow_iso,
    EXTRACT(isodow FROM tpep_pickup_datetime) >= 6 AS is_weekend,
    {_RUSH.format(t="tpep_pickup_datetime")} AS is_rush_hour"""

_SILVER_COLUMNS = """vendor_id, pickup_ts, dropoff_ts, pickup_date, pickup_hour, pickup_dow_iso, is_weekend,
  is_rush_hour, passenger_count, trip_distance, trip_duration_min, pu_location_id, do_location_id,
  pu_borough, pu_zone, do_borough, do_zone, payment_type, fare_amount, tip_amount, total_amount, tip_pct,
  temp_mean_c, temp_max_c, precip_mm, driver_pseudo"""

_SILVER = f"""
sv AS (
  SELECT trip_key, vendorid AS vendor_id, tpep_pickup_datetime AS pickup_ts,
    tpep_dropoff_datetime AS dropoff_ts, {_TIMES},
    CAST(passenger_count AS INTEGER) AS passenger_count, trip_distance,
    date_diff('minute', tpep_pickup_datetime, tpep_dropoff_datetime) AS trip_duration_min,
    pulocationid AS pu_location_id, dolocationid AS do_location_id,
    pz.borough AS pu_borough, pz.zone_name AS pu_zone, dz.borough AS do_borough, dz.zone_name AS do_zone,
    CAST(payment_type AS INTEGER) AS payment_type, fare_amount, tip_amount, total_amount,
    {_TIP} AS tip_pct, temperature_2m_mean AS temp_mean_c, temperature_2m_max AS temp_max_c,
    precipitation_sum AS precip_mm, driver_pseudo
  FROM bt
  LEFT JOIN bz pz ON pulocationid = pz.location_id
  LEFT JOIN bz dz ON dolocationid = dz.location_id
  LEFT JOIN bw ON CAST(tpep_pickup_datetime AS DATE) = CAST(weather_date AS DATE)
  WHERE {_CLEAN}
)"""

_DEMAND = f"""
dm AS (
  SELECT pu_borough, pu_zone, pickup_hour, pickup_dow_iso, COUNT(*) AS trips,
    ROUND({exact("total_amount")}, 2) AS revenue_total,
    ROUND({mean("total_amount")}, 2) AS avg_ticket,
    ROUND({mean("trip_distance")}, 2) AS avg_distance_mi,
    ROUND(AVG(trip_duration_min), 1) AS avg_duration_min
  FROM sv WHERE pu_borough IS NOT NULL
  GROUP BY pu_borough, pu_zone, pickup_hour, pickup_dow_iso HAVING COUNT(*) >= 5
)"""

_TIPS = f"""
tp AS (
  SELECT pu_borough, payment_type, is_rush_hour, COALESCE(precip_mm > 0, FALSE) AS is_rainy,
    COUNT(*) AS trips,
    ROUND({mean("tip_pct")}, 2) AS avg_tip_pct,
    ROUND({mean("tip_amount")}, 2) AS avg_tip_amount,
    ROUND({mean("total_amount")}, 2) AS avg_ticket
  FROM sv WHERE tip_pct IS NOT NULL AND pu_borough IS NOT NULL
  GROUP BY ALL HAVING COUNT(*) >= 5
)"""

_MEDIANS = "(SELECT MEDIAN(temp_mean_c) AS mt, MEDIAN(precip_mm) AS mp FROM sv)"
_READY = f"""
ready AS (
  SELECT sv.* REPLACE (COALESCE(temp_mean_c, mt) AS temp_mean_c, COALESCE(precip_mm, mp) AS precip_mm)
  FROM sv, {_MEDIANS}
),
placed AS (
  SELECT *, ROW_NUMBER() OVER (ORDER BY md5('42:split:' || trip_key), trip_key)
    <= CEIL(0.2 * COUNT(*) OVER ()) AS in_test
  FROM ready WHERE temp_mean_c IS NOT NULL AND precip_mm IS NOT NULL
)"""

_GUESS = """
gm AS (
  SELECT CAST(pickup_date AS VARCHAR) AS pickup_date, pu_zone, pu_borough, total_amount AS actual_total,
    ROUND(p, 2) AS predicted_total, ROUND(ABS(total_amount - ROUND(p, 2)), 2) AS abs_error,
    CAST(ABS(total_amount - p) > 40 AS BIGINT) AS is_anomaly
  FROM (SELECT *, 12 + trip_distance * 0.25::DOUBLE AS p FROM sv)
)"""

_USAGE = f"""
priced AS (
  SELECT scenario, item, SUM(q / unit_size * unit_price) AS cost
  FROM (
    SELECT CASE WHEN user_id % 2 = 0 THEN 'dev' ELSE 'run' END AS scenario, event_type AS item,
      CASE WHEN event_type IN ('view', 'click') THEN CAST(1024 AS DOUBLE)
           WHEN event_type = 'purchase' THEN 1000 ELSE 1 END AS unit_size,
      CASE WHEN event_type IN ('view', 'click') THEN CAST(5.0 AS DOUBLE)
           WHEN event_type = 'purchase' THEN 0.005 ELSE 0.023 END AS unit_price,
      {exact("value")} AS q
    FROM events GROUP BY ALL
  )
  GROUP BY ALL
),
costs AS (
  SELECT scenario, item, cost FROM priced
  UNION ALL SELECT scenario, 'TOTAL', {exact("cost")} FROM priced GROUP BY scenario
)"""


def _with(text: str, *parts: str) -> str:
    return f"WITH {', '.join(parts)}\n{text}"


def trips(text: str) -> str:
    return _with(text, _TRIPS)


def raw(text: str) -> str:
    return _with(text, _TRIPS, _ZONES, _WEATHER)


def silver(text: str) -> str:
    return _with(text, _TRIPS, _ZONES, _WEATHER, _SILVER)


def demand(text: str) -> str:
    return _with(text, _TRIPS, _ZONES, _WEATHER, _SILVER, _DEMAND)


def tips(text: str) -> str:
    return _with(text, _TRIPS, _ZONES, _WEATHER, _SILVER, _TIPS)


def ready(text: str) -> str:
    return _with(text, _TRIPS, _ZONES, _WEATHER, _SILVER, _READY)


def _root_split() -> str:
    """The best split by variance over all features and the midpoints between any two neighbouring values."""
    names = (
        "trip_distance", "passenger_count", "pickup_hour", "pickup_dow_iso", "is_weekend", "is_rush_hour",
        "pu_location_id", "do_location_id", "temp_mean_c", "precip_mm",
    )
    values = " UNION ALL ".join(
        f"SELECT '{c}' AS variable, {i} AS place, CAST({c} AS DOUBLE) AS v, COUNT(*) AS n, SUM(total_amount) AS s FROM placed GROUP BY {c}"
        for i, c in enumerate(names)
    )
    return ready(
        f"""SELECT variable, threshold, CAST(nl AS BIGINT) AS left_rows, CAST(n - nl AS BIGINT) AS right_rows,
        ROUND(sl / nl, 4) AS left_value, ROUND((s - sl) / (n - nl), 4) AS right_value, 1.0::DOUBLE AS importance
        FROM (SELECT variable, place, (v + LEAD(v) OVER w) / 2 AS threshold, SUM(n) OVER w AS nl, SUM(s) OVER w AS sl,
            SUM(n) OVER (PARTITION BY variable) AS n, SUM(s) OVER (PARTITION BY variable) AS s
          FROM ({values}) WINDOW w AS (PARTITION BY variable ORDER BY v))
        WHERE nl < n ORDER BY sl * sl / nl + (s - sl) * (s - sl) / (n - nl) DESC, place, threshold LIMIT 1"""
    )


def guess(text: str) -> str:
    return _with(text, _TRIPS, _ZONES, _WEATHER, _SILVER, _GUESS)


def usage(text: str) -> str:
    return _with(text, _USAGE)


_WEEKDAY = """CASE {d} WHEN 1 THEN 'Lun' WHEN 2 THEN 'Mar' WHEN 3 THEN 'Mer' WHEN 4 THEN 'Jeu'
  WHEN 5 THEN 'Ven' WHEN 6 THEN 'Sam' WHEN 7 THEN 'Dim' END"""
_PAYMENT = """CASE {c} WHEN 1 THEN 'Carte' WHEN 2 THEN 'Espèces' WHEN 3 THEN 'Gratuit'
  WHEN 4 THEN 'Litige' WHEN 5 THEN 'Inconnu' ELSE 'Autre' END"""
_ISODOW = "EXTRACT(isodow FROM tpep_pickup_datetime)"

def _one_check(name: str, severity: str, table: str, failed: str, total: str, passed: str, detail: str):
    return f"""SELECT '{name}' AS name, {passed} AS passed, '{severity}' AS severity,
      CAST({failed} AS BIGINT) AS failed_rows, CAST({total} AS BIGINT) AS total_rows,
      {detail} AS detail FROM {table}"""


def _checks(table: str, missing: tuple[str, ...] = (), leaked: bool = False) -> str:
    """The checks over a table; ``missing`` names columns it does not have."""
    n = "COUNT(*)"
    parts = [
        _one_check(
            "volume_non_vide", "critical", table, f"CASE WHEN {n} > 0 THEN 0 ELSE 1 END", n, f"{n} > 0",
            f"{n} || ' lignes'",
        )
    ]
    for c in ("pickup_ts", "total_amount", "pu_location_id"):
        nulls = n if c in missing else f"COUNT(*) FILTER (WHERE {c} IS NULL)"
        name, text = f"non_null__{c}", f"{nulls} || ' nulls'"
        parts.append(_one_check(name, "critical", table, nulls, n, f"{nulls} = 0", text))
    for name, c, rule in (
        ("total_amount_positif", "total_amount", "total_amount >= 0"),
        ("duree_plausible_1_240min", "trip_duration_min", "trip_duration_min BETWEEN 1 AND 240"),
    ):
        if c not in missing:
            bad = f"COUNT(*) FILTER (WHERE NOT COALESCE({rule}, FALSE))"
            parts.append(_one_check(name, "critical", table, bad, n, f"{bad} = 0", "''"))
    good = "COUNT(*) FILTER (WHERE tip_pct BETWEEN 0 AND 100)"
    share = f"CAST({good} AS DOUBLE) / COUNT(tip_pct)"
    parts.append(
        _one_check(
            "tip_pct_borne_0_100", "warning", table, f"COUNT(tip_pct) - {good}", "COUNT(tip_pct)",
            f"{share} > 0.99", f"printf('%.2f', {share} * 100) || '% dans [0,100]'",
        )
    )
    share = f"CAST(COUNT(pu_borough) AS DOUBLE) / {n}"
    parts.append(
        _one_check(
            "jointure_zones_ok", "warning", table, f"{n} - COUNT(pu_borough)", n, f"{share} > 0.95",
            f"printf('%.1f', {share} * 100) || '% des courses ont un borough'",
        )
    )
    parts.append(
        _one_check(
            "rgpd_pas_de_pii_claire", "critical", table, n if leaked else "0 * COUNT(*)", n,
            "FALSE" if leaked else "TRUE",
            "'FUITE: driver_email présent !'" if leaked else "'driver_email absent de silver'",
        )
    )
    return "\nUNION ALL ".join(parts)


def _isolation_forest(trees: int = 100, sample: int = 256, height: int = 8, seed: int = 42) -> tuple[str, str]:
    """Drawing, growing level by level, and scoring all rows, stated from the definition of the forest."""
    columns = ["trip_distance", "trip_duration_min", "total_amount", "tip_amount"]
    values = ", ".join(f"COALESCE({c}, 0)::DOUBLE AS f{i}" for i, c in enumerate(columns))
    names, prime = "f0, f1, f2, f3", 2147483647

    def number(text: str, digits: int) -> str:
        return f"('0x' || substr(md5({text}), 1, {digits}))::BIGINT"

    def chosen(prefix: str) -> str:
        return f"CASE feature {' '.join(f'WHEN {i} THEN {prefix}{i}' for i in range(4))} END"

    path = """CASE WHEN {n} <= 1 THEN 0::DOUBLE WHEN {n} = 2 THEN 1
      ELSE 2 * (ln({n} - 1) + 0.5772156649015329::DOUBLE) - 2::DOUBLE * ({n} - 1) / {n} END"""
    levels, walk = [], []
    for d in range(height):
        votes = ", ".join(f"CASE WHEN lo{i} < hi{i} THEN md5(concat_ws(':', {seed}, tree, node, {i})) || ':{i}' END" for i in range(4))
        ranges = ", ".join(f"min(f{i}) AS lo{i}, max(f{i}) AS hi{i}" for i in range(4))
        levels.append(
            f"""g{d} AS (SELECT tree, node, count(*) AS n, {ranges} FROM l{d} GROUP BY tree, node),
            p{d} AS (SELECT *, right(least({votes}), 1)::INTEGER AS feature FROM g{d} WHERE n > 1),
            q{d} AS (SELECT tree, node, feature, {chosen("lo")} AS lo, {chosen("hi")} AS hi,
              {number(f"concat_ws(':', {seed}, tree, node, 'cut')", 13)}::DOUBLE / 4503599627370496 AS share FROM p{d} WHERE feature IS NOT NULL),
            c{d} AS (SELECT tree, node, feature, CASE WHEN lo + share * (hi - lo) < hi THEN lo + share * (hi - lo) ELSE lo END AS cut FROM q{d}),
            l{d + 1} AS (SELECT tree, {names}, CASE WHEN cut IS NULL THEN node WHEN {chosen("f")} <= cut THEN 2 * node + 1
              ELSE 2 * node + 2 END AS node FROM l{d} LEFT JOIN c{d} USING (tree, node))"""
        )
        walk.append(
            f"""w{d + 1} AS (SELECT trip_key, tree, {names}, CASE WHEN cut IS NULL THEN node WHEN {chosen("f")} <= cut THEN 2 * node + 1
              ELSE 2 * node + 2 END AS node FROM w{d} LEFT JOIN c{d} USING (tree, node))"""
        )
    return f"""SELECT trip_key, trip_distance, trip_duration_min, total_amount, tip_amount, ROUND(s, 6) AS anomaly_score,
      CAST(s > (SELECT quantile_cont(s, 0.98) FROM scores) AS INTEGER) AS is_anomaly FROM sv JOIN scores USING (trip_key)""", f"""
    rows_ AS (SELECT trip_key, {values}, {number(f"'{seed}:' || trip_key", 8)} % {prime} AS place FROM sv),
    sizes AS (SELECT least({sample}, count(*)) AS size, ceil(least(1::DOUBLE, 2::DOUBLE * least({sample}, count(*)) / count(*)) * {prime}) AS lim FROM sv),
    trees AS (SELECT t::INTEGER AS tree, {number(f"'{seed}:factor:' || t", 8)} % {prime - 1} + 1 AS factor,
      {number(f"'{seed}:shift:' || t", 8)} % {prime} AS shift FROM range({trees}) AS r(t)),
    marks AS (SELECT tree, trip_key, {names}, (place * factor + shift) % {prime} AS mark FROM rows_, trees),
    l0 AS (SELECT tree, {names}, 0 AS node FROM (SELECT marks.* FROM marks, sizes WHERE mark < lim
      QUALIFY row_number() OVER (PARTITION BY tree ORDER BY mark, trip_key) <= size)),
    {", ".join(levels)},
    leaves AS (SELECT tree, node, round((length(bin(node + 1)) - 1 + {path.format(n="n")}) * 100000000)::BIGINT AS units
      FROM (SELECT tree, node, count(*) AS n FROM l{height} GROUP BY tree, node)),
    w0 AS (SELECT trip_key, tree, {names}, 0 AS node FROM rows_, trees),
    {", ".join(walk)},
    scores AS (SELECT trip_key, pow(2::DOUBLE, -(sum(units)::BIGINT / 100000000::DOUBLE / {trees}) / any_value({path.format(n="size")})) AS s
      FROM w{height} JOIN leaves USING (tree, node), sizes GROUP BY trip_key)"""


def all_oracles() -> dict[str, str]:
    stated = _oracles()
    verdict = """SELECT '{layer}' AS layer, COUNT(*) FILTER (WHERE NOT passed AND severity = 'critical') > 0 AS stopped,
      string_agg(name, ', ' ORDER BY name) FILTER (WHERE NOT passed AND severity = 'critical') AS failed FROM ({report})"""
    reports = {"clean": stated["quality_report"], "raw": stated["quality_report_raw"]}
    stated["gate_verdicts"] = " UNION ALL ".join(verdict.format(layer=k, report=r) for k, r in reports.items())
    return stated


def _oracles() -> dict[str, str]:
    hours = ", ".join(
        f"CAST(SUM(trips) FILTER (WHERE pickup_hour = {h}) AS BIGINT) AS h{h:02d}" for h in range(24)
    )
    month = "strftime(tpep_pickup_datetime, '%Y-%m')"
    metrics = "AVG(ABS(y - p)) AS mae, SQRT(AVG((y - p) * (y - p))) AS rmse"
    zone_rank = """SELECT pu_borough, pu_zone, CAST(SUM(trips) AS BIGINT) AS trips,
      ROUND({rev}, {n}) AS revenue_total FROM dm GROUP BY pu_borough, pu_zone
      ORDER BY revenue_total DESC NULLS LAST, pu_borough, pu_zone LIMIT 10"""
    revenue = exact("revenue_total")
    forest, forest_steps = _isolation_forest()
    month_again = _with(
        """SELECT weather_date, temperature_2m_mean, temperature_2m_max,
        CASE WHEN left(weather_date, 7) = '1996-01' THEN 99.0::DOUBLE ELSE precipitation_sum END
          AS precipitation_sum,
        CAST(left(weather_date, 4) AS INTEGER) AS year, substr(weather_date, 6, 2) AS month FROM bw""",
        _WEATHER,
    )
    return {
        "partitioned_layer": trips(
            f"""SELECT CAST(year(tpep_pickup_datetime) AS INTEGER) AS year,
            strftime(tpep_pickup_datetime, '%m') AS month, COUNT(*) AS trips,
            ROUND({exact("fare_amount")}, 2) AS fares FROM bt GROUP BY 1, 2"""
        ),
        "month_selection": trips(
            f"""SELECT trip_key, CAST(year(tpep_pickup_datetime) AS INTEGER) AS year,
            strftime(tpep_pickup_datetime, '%m') AS month, tpep_pickup_datetime, fare_amount
            FROM bt WHERE {month} IN ('1996-01', '1996-02', '1999-12')"""
        ),
        "month_rewrite": month_again,
        "month_swap": month_again,
        "zones_csv": _with("SELECT * FROM bz", _ZONES),
        "weather_documents": _with("SELECT * FROM bw", _WEATHER),
        "json_rows": demand("SELECT * FROM dm"),
        "recursive_folder": demand("SELECT * FROM dm"),
        "layer_row_counts": _with(
            """SELECT 'silver_trips' AS layer, COUNT(*) AS row_count FROM sv
            UNION ALL SELECT 'gold_demand_by_zone_hour', COUNT(*) FROM dm
            UNION ALL SELECT 'gold_tips_analysis', COUNT(*) FROM tp
            UNION ALL SELECT 'gold_ml_predictions', NULL""",
            _TRIPS, _ZONES, _WEATHER, _SILVER, _DEMAND, _TIPS,
        ),
        "landed_trips": trips(
            """SELECT trip_key, CAST(vendorid AS BIGINT) AS vendorid, fare_amount, email AS driver_email,
            left(sha256('"""
            + SALT
            + """' || email), 16) AS driver_pseudo, n AS _source_row, 2024 AS year, TRUE AS stamped FROM (
              SELECT *, 'driver' || CAST(CAST(n AS HUGEINT) * 2654435761 % 5000 AS VARCHAR) || '@example.test' AS email
              FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY trip_key) - 1 AS n FROM bt))"""
        ),
        "drifted_files": trips("SELECT trip_key, CAST(vendorid AS BIGINT) AS vendorid, passenger_count, total_amount FROM bt"),
        "lake_build": _with(
            """SELECT 'silver_trips' AS layer, COUNT(*) AS row_count FROM sv
            UNION ALL SELECT 'gold_demand_by_zone_hour', COUNT(*) FROM dm
            UNION ALL SELECT 'gold_tips_analysis', COUNT(*) FROM tp""",
            _TRIPS, _ZONES, _WEATHER, _SILVER, _DEMAND, _TIPS,
        ),
        "external_table": demand("SELECT * FROM dm"),
        "table_as_select": demand("SELECT * FROM dm WHERE trips >= 6"),
        "rebuilt_table": demand("SELECT * FROM dm WHERE pickup_hour < 12"),
        "table_swap": demand(
            """SELECT 'old' AS reader, COUNT(*) AS n, CAST(SUM(trips) AS BIGINT) AS t FROM dm
            UNION ALL SELECT 'new', COUNT(*), CAST(SUM(trips) AS BIGINT) FROM dm WHERE pickup_hour < 12"""
        ),
        "view_read": tips("SELECT pu_borough, payment_type, trips FROM tp WHERE is_rainy"),
        "key_guard": """SELECT 'zones' AS table_name, 'location_id' AS key_name,
              COUNT(DISTINCT n_nationkey) = COUNT(*) AS is_unique FROM nation
            UNION ALL SELECT 'orders', 'o_orderkey', COUNT(DISTINCT o_orderkey) = COUNT(*) FROM orders
            UNION ALL SELECT 'orders', 'o_custkey', COUNT(DISTINCT o_custkey) = COUNT(*) FROM orders""",
        "observed_counts": demand("SELECT COUNT(*) AS row_count, CAST(SUM(trips) AS BIGINT) AS trips FROM dm"),
        "month_list": """SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS month,
            CAST(date_trunc('month', o_orderdate) AS DATE) AS first_day,
            last_day(CAST(o_orderdate AS DATE)) AS last_day FROM orders""",
        "silver_trips": silver(f"SELECT {_SILVER_COLUMNS} FROM sv"),
        "derived_time_columns": trips(f"SELECT trip_key, {_TIMES} FROM bt"),
        "minutes_between_times": trips(
            """SELECT trip_key,
            date_diff('minute', tpep_pickup_datetime, tpep_dropoff_datetime) AS boundary_minutes,
            date_sub('minute', tpep_pickup_datetime, tpep_dropoff_datetime) AS elapsed_minutes FROM bt"""
        ),
        "round_to_whole": trips(
            "SELECT trip_key, CAST(passenger_count / 2 AS INTEGER) AS half_rounded FROM bt"
        ),
        "round_decimals": trips(
            """SELECT trip_key, ROUND(fare_amount, 2) AS fare_2, ROUND(tip_amount, 1) AS tip_1,
            ROUND(total_amount, 0) AS total_0 FROM bt"""
        ),
        "tip_percentage": trips(f"SELECT trip_key, {_TIP} AS tip_pct FROM bt"),
        "rain_flag": silver(
            """SELECT trip_key, precip_mm, CASE WHEN precip_mm > 0 THEN TRUE ELSE FALSE END AS is_rainy
            FROM sv"""
        ),
        "pseudonyms": trips("SELECT trip_key, driver_pseudo FROM bt"),
        "synthetic_subjects": """SELECT l_orderkey, 'driver' ||
            CAST(CAST(l_orderkey AS HUGEINT) * 2654435761 % 5000 AS VARCHAR) || '@example.test'
            AS driver_email FROM lineitem""",
        "protect_pii": trips("SELECT trip_key, driver_pseudo, fare_amount FROM bt"),
        "payment_labels": trips(
            f"""SELECT trip_key, payment_type + 1 AS code, {_PAYMENT.format(c="payment_type + 1")} AS label
            FROM bt"""
        ),
        "weekday_labels": trips(f"SELECT trip_key, {_WEEKDAY.format(d=_ISODOW)} AS jour FROM bt"),
        "weekday_flags": trips(
            f"""SELECT {_ISODOW} >= 6 AS is_weekend,
            {_RUSH.format(t="tpep_pickup_datetime")} AS is_rush_hour, COUNT(*) AS trips,
            ROUND({mean("fare_amount")}, 4) AS avg_fare FROM bt GROUP BY 1, 2"""
        ),
        "missing_values": trips(
            f"""SELECT payment_type, COUNT(*) AS trips, COUNT(fare_amount) AS known_fares,
            ROUND({mean("fare_amount")}, 4) AS avg_fare
            FROM (SELECT payment_type, NULLIF(fare_amount, 0) AS fare_amount FROM bt) GROUP BY 1"""
        ),
        "clean_rows": trips(
            f"""SELECT trip_key, passenger_count, trip_distance, fare_amount, total_amount
            FROM bt WHERE {_CLEAN}"""
        ),
        "clean_rows_elapsed": trips(
            f"""SELECT trip_key,
            date_sub('minute', tpep_pickup_datetime, tpep_dropoff_datetime) AS minutes
            FROM bt WHERE {_CLEAN.replace("date_diff", "date_sub")}"""
        ),
        "rejected_by_rule": trips(
            "\nUNION ALL ".join(
                f"SELECT '{n}' AS rule, COUNT(*) AS rejected FROM bt WHERE NOT COALESCE({r}, FALSE)"
                for n, r in _RULES.items()
            )
        ),
        "zone_enrich_pickup": raw(
            """SELECT trip_key, pulocationid, borough AS pu_borough, zone_name AS pu_zone
            FROM bt LEFT JOIN bz ON pulocationid = location_id"""
        ),
        "zone_enrich_dropoff": raw(
            """SELECT trip_key, dolocationid, borough AS do_borough, zone_name AS do_zone
            FROM bt LEFT JOIN bz ON dolocationid = location_id"""
        ),
        "weather_enrich": raw(
            """SELECT trip_key, tpep_pickup_datetime, temperature_2m_mean, temperature_2m_max,
            precipitation_sum FROM bt
            LEFT JOIN bw ON CAST(tpep_pickup_datetime AS DATE) = CAST(weather_date AS DATE)"""
        ),
        "star_enrich": raw(
            """SELECT trip_key, tpep_pickup_datetime, pulocationid, dolocationid,
            pz.borough AS pu_borough, pz.zone_name AS pu_zone,
            dz.borough AS do_borough, dz.zone_name AS do_zone, temperature_2m_mean, temperature_2m_max,
            precipitation_sum FROM bt
            LEFT JOIN bz pz ON pulocationid = pz.location_id
            LEFT JOIN bz dz ON dolocationid = dz.location_id
            LEFT JOIN bw ON CAST(tpep_pickup_datetime AS DATE) = CAST(weather_date AS DATE)"""
        ),
        "demand_by_zone_hour": demand("SELECT * FROM dm"),
        "tips_analysis": tips("SELECT * FROM tp"),
        "demand_from_months": demand("SELECT * FROM dm"),
        "tips_from_months": tips("SELECT * FROM tp"),
        "k_suppressed_groups": silver(
            """SELECT COUNT(*) AS all_groups, COUNT(*) FILTER (WHERE n < 5) AS hidden_groups,
            CAST(COALESCE(SUM(n) FILTER (WHERE n < 5), 0) AS BIGINT) AS hidden_rows
            FROM (SELECT COUNT(*) AS n FROM sv WHERE pu_borough IS NOT NULL
                  GROUP BY pu_borough, pu_zone, pickup_hour, pickup_dow_iso)"""
        ),
        "top_zones": demand(zone_rank.format(rev=revenue, n=2)),
        "top_zones_whole": demand(zone_rank.format(rev=revenue, n=0)),
        "busiest_hours": demand(
            """SELECT pickup_hour, CAST(SUM(trips) AS BIGINT) AS trips FROM dm GROUP BY 1
            ORDER BY trips DESC, pickup_hour LIMIT 5"""
        ),
        "tips_by_payment": tips(
            f"""SELECT payment_type, ROUND({mean("avg_tip_pct")}, 1) AS avg_tip_pct,
            CAST(SUM(trips) AS BIGINT) AS trips FROM tp GROUP BY 1"""
        ),
        "kpis": demand(
            f"""SELECT CAST(SUM(trips) AS BIGINT) AS trips, {revenue} AS revenue_total,
            {mean("avg_ticket")} AS avg_ticket, COUNT(DISTINCT pu_zone) AS zones FROM dm"""
        ),
        "dashboard_top_zones": demand(
            f"""SELECT pu_borough, pu_zone, {revenue} AS revenue_total FROM dm
            WHERE pu_zone IS NOT NULL GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 15"""
        ),
        "demand_heat": demand(
            f"""SELECT pickup_dow_iso, pickup_hour, CAST(SUM(trips) AS BIGINT) AS trips,
            {_WEEKDAY.format(d="pickup_dow_iso")} AS jour FROM dm GROUP BY 1, 2"""
        ),
        "heat_matrix": demand(
            f"""SELECT CAST(d AS INTEGER) AS pickup_dow_iso, {_WEEKDAY.format(d="d")} AS jour, {hours}
            FROM range(1, 8) days(d) LEFT JOIN dm ON pickup_dow_iso = d GROUP BY d"""
        ),
        "demand_listing": demand(
            """SELECT * FROM dm ORDER BY trips DESC, pu_borough, pu_zone, pickup_hour, pickup_dow_iso
            LIMIT 50"""
        ),
        "demand_filtered": demand(
            """SELECT * FROM dm WHERE pu_borough = 'ASIA' AND pickup_hour = 0
            ORDER BY trips DESC, pu_borough, pu_zone, pickup_hour, pickup_dow_iso LIMIT 500"""
        ),
        "tips_ranked": tips("SELECT * FROM tp"),
        "labelled_tips": tips(f"SELECT *, {_PAYMENT.format(c='payment_type')} AS paiement FROM tp"),
        "dearest_trips": silver(
            """SELECT trip_key, pu_zone, total_amount FROM sv
            ORDER BY total_amount DESC, trip_key LIMIT 25"""
        ),
        "quality_report": silver(_checks("sv")),
        "quality_from_months": silver(_checks("sv")),
        "quality_report_raw": _with(
            _checks("src", missing=("total_amount",), leaked=True),
            _TRIPS,
            _ZONES,
            f"""src AS (SELECT tpep_pickup_datetime AS pickup_ts, pulocationid AS pu_location_id,
            date_diff('minute', tpep_pickup_datetime, tpep_dropoff_datetime) AS trip_duration_min,
            {_TIP} AS tip_pct, borough AS pu_borough
            FROM bt LEFT JOIN bz ON pulocationid = location_id)""",
        ),
        "sampled_trips": silver(
            """SELECT trip_key, total_amount FROM sv
            ORDER BY md5('42:' || trip_key), trip_key LIMIT 20000"""
        ),
        "impute_median": ready("SELECT trip_key, temp_mean_c, precip_mm FROM ready"),
        "complete_rows": silver(
            "SELECT trip_key, temp_mean_c FROM sv WHERE temp_mean_c IS NOT NULL AND precip_mm IS NOT NULL"
        ),
        "split_rows": ready(
            "SELECT trip_key, CASE WHEN in_test THEN 'test' ELSE 'train' END AS part FROM placed"
        ),
        "forest_root_split": _root_split(),
        "mean_baseline": ready(
            f"""SELECT ROUND(mae, 4) AS mae, ROUND(rmse, 4) AS rmse FROM (SELECT {metrics} FROM (
              SELECT total_amount AS y, (SELECT AVG(total_amount) FROM placed WHERE NOT in_test) AS p
              FROM placed WHERE in_test))"""
        ),
        "regression_metrics": silver(
            f"""SELECT ROUND(mae, 4) AS mae, ROUND(rmse, 4) AS rmse,
            ROUND(1 - sse / sst, 4) AS r2, ROUND((1 - mae / flat) * 100, 2) AS gain_pct FROM (
              SELECT {metrics}, SUM((y - p) * (y - p)) AS sse, VAR_POP(y) * COUNT(*) AS sst,
                AVG(ABS(y - 40)) AS flat
              FROM (SELECT total_amount AS y, 12 + trip_distance * 0.25 AS p FROM sv))"""
        ),
        "guess_mart": guess("SELECT * FROM gm"),
        "guess_top_errors": guess(
            """SELECT * FROM gm ORDER BY abs_error DESC, pickup_date, pu_borough, pu_zone, actual_total,
            predicted_total, is_anomaly LIMIT 100"""
        ),
        "guess_anomalies": guess(
            """SELECT * FROM gm WHERE is_anomaly = 1 ORDER BY abs_error DESC, pickup_date, pu_borough,
            pu_zone, actual_total, predicted_total LIMIT 20"""
        ),
        "guess_scatter": guess(
            """SELECT actual_total, predicted_total, is_anomaly,
            (SELECT MAX(actual_total) FROM gm) AS diagonal_end FROM gm"""
        ),
        "guess_metrics_document": ready(
            f"""SELECT 'fixed' AS run_id, 'RandomForestRegressor' AS model, n_train, n_test,
            ROUND(base_mae, 4) AS base_mae, ROUND(base_rmse, 4) AS base_rmse, ROUND(mae, 4) AS mae,
            ROUND(rmse, 4) AS rmse, ROUND(1 - sse / sst, 4) AS r2,
            ROUND((1 - mae / base_mae) * 100, 2) AS improvement_mae_pct, far AS anomalies_detected
            FROM (SELECT {metrics}, SUM((y - p) * (y - p)) AS sse, VAR_POP(y) * COUNT(*) AS sst,
                COUNT(*) AS n_test, COUNT(*) FILTER (WHERE ABS(y - p) > 40) AS far,
                AVG(ABS(y - m)) AS base_mae, SQRT(AVG((y - m) * (y - m))) AS base_rmse
              FROM (SELECT total_amount AS y, 12 + trip_distance * 0.25 AS p,
                (SELECT AVG(total_amount) FROM placed WHERE NOT in_test) AS m FROM placed WHERE in_test)),
            (SELECT COUNT(*) AS n_train FROM placed WHERE NOT in_test)"""
        ),
        "importance_listing": silver(
            """SELECT pu_borough AS variable, CAST(COUNT(*) AS DOUBLE) AS importance FROM sv
            WHERE pu_borough IS NOT NULL GROUP BY 1"""
        ),
        "later_months": silver(
            """SELECT strftime(pickup_date, '%Y-%m') AS month, COUNT(*) AS rows,
            CAST(SUM(CAST(ROUND(100 * total_amount) AS BIGINT)) AS BIGINT) AS actual_cents, COUNT(*) AS predicted
            FROM sv WHERE pickup_date >= DATE '1997-01-01' GROUP BY 1"""
        ),
        "trained_facts": ready(
            """SELECT COUNT(*) FILTER (WHERE NOT in_test) AS n_train, COUNT(*) FILTER (WHERE in_test) AS n_test,
            COUNT(*) FILTER (WHERE in_test) AS rows, TRUE AS shares_add_up,
            TRUE AS few_flagged FROM placed"""
        ),
        "scored_test_rows": ready(
            """SELECT CAST(pickup_date AS VARCHAR) AS pickup_date, pu_zone, pu_borough,
            total_amount AS actual_total FROM placed WHERE in_test"""
        ),
        "fixed_forest_scores": silver(
            """SELECT trip_key, ROUND(s, 6) AS anomaly_score, CAST(s > 0.6 AS INTEGER) AS is_anomaly FROM (
              SELECT trip_key, pow(2.0, -(a + b) / 2 / 4.0) AS s FROM (
                SELECT trip_key,
                  CASE WHEN total_amount <= 20 THEN CASE WHEN trip_distance <= 60 THEN 2.0 ELSE 3.0 END
                       ELSE CASE WHEN trip_duration_min <= 100 THEN 3.5 ELSE 1.0 END END AS a,
                  CASE WHEN total_amount <= 30 THEN 4.0 ELSE 1.5 END AS b FROM sv))"""
        ),
        "isolation_forest": _with(forest, _TRIPS, _ZONES, _WEATHER, _SILVER, forest_steps),
        "cost_report": usage("SELECT scenario, item, ROUND(cost, 4) AS cost FROM costs"),
        "cost_annualized": usage(
            """SELECT scenario, ROUND(cost * 12, 2) AS yearly_cost FROM costs WHERE item = 'TOTAL'"""
        ),
    }
