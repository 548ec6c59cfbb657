"""The registered queries as SQL for DuckDB, over the same test tables.

Written apart from the operators: whole-ring windows instead of blocked ones,
a plain top-n instead of the prefix cut, the power form of the projection.
"""

from __future__ import annotations

import math

TRIPS = """trips AS (
  SELECT event_id AS trip_id, ts AS pick,
         ts + to_seconds(CAST(floor(value * 12) + (event_id * 37) % 600 - 60
              + CASE WHEN event_id % 50 = 0 THEN 10000 ELSE 0 END AS bigint)) AS drop_,
         CASE WHEN event_id % 61 = 0 THEN 0.0 WHEN event_id % 89 = 0 THEN 150.0
              WHEN event_id % 83 = 0 THEN 4.0
              ELSE value / 5.0::double END::double AS trip_distance,
         CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 23 = 0 THEN 264
              ELSE CAST((user_id * 7) % 265 + 1 AS integer) END AS PULocationID,
         CASE WHEN event_id % 101 = 0 THEN NULL WHEN event_id % 29 = 0 THEN 265
              ELSE CAST((event_id * 13) % 265 + 1 AS integer) END AS DOLocationID
  FROM events)"""

TIMED = TRIPS + """,
timed AS (
  SELECT *, CAST(hour(pick) AS integer) AS pickup_hour,
         CAST(dayofweek(pick) + 1 AS integer) AS pickup_dow,
         (epoch_us(drop_) // 1000000 - epoch_us(pick) // 1000000) / 60.0::double
           AS trip_duration_mins
  FROM trips)"""

CLEAN = TIMED + """,
clean AS (
  SELECT trip_id, trip_distance, PULocationID, DOLocationID, pickup_hour, pickup_dow,
         trip_duration_mins
  FROM timed
  WHERE trip_duration_mins > 2 AND trip_duration_mins < 120
    AND trip_distance > 0 AND trip_distance < 100
    AND PULocationID IS NOT NULL AND DOLocationID IS NOT NULL
    AND pickup_hour IS NOT NULL AND pickup_dow IS NOT NULL)"""

ZONES = """zones AS (
  SELECT CAST(id AS integer) AS LocationID, 'Zone_' || id::varchar AS zone,
         'Borough_' || (id % 6)::varchar AS borough,
         -74.23::double + (id * 37 % 263) * 0.002::double AS longitude,
         40.53::double + (id * 91 % 263) * 0.0014::double AS latitude
  FROM range(1, 264) t(id))"""

FEED = ZONES + """,
feed AS (
  SELECT *, LocationID::bigint + 1000 AS record FROM zones
  UNION ALL BY NAME
  SELECT * REPLACE ('Old_' || zone AS zone, 0.0::double AS latitude),
         LocationID::bigint AS record
  FROM zones WHERE LocationID % 5 = 0),
latest AS (
  SELECT * FROM feed QUALIFY row_number() OVER (PARTITION BY LocationID ORDER BY record DESC) = 1)"""

HOT = CLEAN + ", " + FEED + """,
ranked AS (
  SELECT PULocationID, count(*) AS trip_count FROM clean GROUP BY PULocationID
  ORDER BY trip_count DESC, PULocationID LIMIT 100),
hot AS (
  SELECT z.LocationID, z.zone, z.borough, z.latitude, z.longitude, r.trip_count
  FROM ranked r JOIN latest z ON r.PULocationID = z.LocationID)"""

PREDICTED = CLEAN + """,
predicted AS (
  SELECT *, trip_distance + 4 AS prediction,
         abs(trip_duration_mins - (trip_distance + 4)) AS abs_error
  FROM clean)"""

BANDED = PREDICTED + """,
bands(band, lo, hi) AS (VALUES (1, 3.0, 4.0), (2, 4.0, 5.0), (3, 5.0, 6.0), (4, 6.0, 10.0)),
banded AS (
  SELECT b.band, p.* FROM predicted p JOIN bands b ON p.trip_distance BETWEEN b.lo AND b.hi),
picked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY band ORDER BY trip_distance, trip_id)
                 AS integer) AS rn
  FROM banded WHERE abs_error < 1.5 QUALIFY rn <= 5)"""

METRICS = PREDICTED + """,
metrics AS (
  SELECT round(sqrt(avg((trip_duration_mins - prediction) ** 2)), 2) AS RMSE,
         round(1 - sum((trip_duration_mins - prediction) ** 2)
                   / (count(*) * var_pop(trip_duration_mins)), 4) AS R2_Score,
         round(avg(abs_error), 2) AS MAE
  FROM predicted)"""

REQUESTS = """requests AS (
  SELECT event_id AS trip_id,
         CASE WHEN event_id % 37 = 0 THEN NULL WHEN event_id % 41 = 0 THEN 'abc'
              ELSE CAST(value AS varchar) END AS trip_distance,
         CAST((user_id * 7) % 265 + 1 AS varchar) AS PULocationID,
         CASE WHEN event_id % 53 = 0 THEN ''
              ELSE CAST((event_id * 13) % 265 + 1 AS varchar) END AS DOLocationID,
         CASE WHEN event_id % 43 = 0 THEN '24' ELSE CAST(hour(ts) AS varchar) END AS pickup_hour,
         CASE WHEN event_id % 47 = 0 THEN '0'
              ELSE CAST(dayofweek(ts) + 1 AS varchar) END AS pickup_dow
  FROM events),
checked AS (
  SELECT *,
         CASE WHEN try_cast(trip_distance AS double) IS NULL THEN 'trip_distance' END AS bad1,
         CASE WHEN try_cast(PULocationID AS integer) IS NULL THEN 'PULocationID' END AS bad2,
         CASE WHEN try_cast(DOLocationID AS integer) IS NULL THEN 'DOLocationID' END AS bad3,
         CASE WHEN coalesce(try_cast(pickup_hour AS integer), -1) NOT BETWEEN 0 AND 23
              THEN 'pickup_hour' END AS bad4,
         CASE WHEN coalesce(try_cast(pickup_dow AS integer), -1) NOT BETWEEN 1 AND 7
              THEN 'pickup_dow' END AS bad5,
         coalesce(bad1, bad2, bad3, bad4, bad5) AS first_invalid
  FROM requests),
valid AS (
  SELECT trip_id, CAST(trip_distance AS double) AS trip_distance,
         CAST(PULocationID AS integer) AS PULocationID,
         CAST(DOLocationID AS integer) AS DOLocationID,
         CAST(pickup_hour AS integer) AS pickup_hour, CAST(pickup_dow AS integer) AS pickup_dow
  FROM checked WHERE first_invalid IS NULL)"""

CUSTOMER_RINGS = """shape(part_id, ring_id, seq, x, y) AS (VALUES
  (1, 1, 0, 0.0, 0.0), (1, 1, 1, 4.0, 0.0), (1, 1, 2, 4.0, 4.0), (1, 1, 3, 0.0, 4.0),
  (1, 1, 4, 0.0, 0.0),
  (1, 2, 0, 1.0, 1.0), (1, 2, 1, 1.0, 2.0), (1, 2, 2, 2.0, 2.0), (1, 2, 3, 2.0, 1.0),
  (1, 2, 4, 1.0, 1.0),
  (2, 1, 0, 10.0, 0.0), (2, 1, 1, 12.0, 0.0), (2, 1, 2, 12.0, 2.0), (2, 1, 3, 10.0, 2.0),
  (2, 1, 4, 10.0, 0.0)),
rings AS (
  SELECT CAST(c_custkey AS integer) AS LocationID, part_id, ring_id,
         CAST(CASE WHEN ring_id = 2 AND c_custkey % 3 = 0 OR part_id = 2 AND c_custkey % 4 = 0
                   THEN 4 - seq ELSE seq END AS bigint) AS seq,
         x::double + c_custkey % 100 AS x, y::double + 2 * (c_custkey % 100) AS y
  FROM customer, shape)"""

EVENT_RINGS = f"""turned AS (
  SELECT *, (epoch_us(ts) // 1000000 - epoch_us(TIMESTAMP '2024-01-01') // 1000000)
            / 2678400.0::double * {2 * math.pi!r}::double AS turn
  FROM events),
rings AS (
  SELECT CASE WHEN event_id % 3 = 0 THEN 1 ELSE CAST(user_id % 250 + 2 AS integer) END
           AS LocationID, 1 AS part_id, 1 AS ring_id, event_id AS seq,
         (1 + value / 100.0::double) * cos(turn) AS x,
         (1 + value / 100.0::double) * sin(turn) AS y
  FROM turned)"""

EDGES = """edges AS (
  SELECT *, coalesce(lead(x) OVER w, first_value(x) OVER w) AS x1,
         coalesce(lead(y) OVER w, first_value(y) OVER w) AS y1
  FROM rings WINDOW w AS (PARTITION BY LocationID, part_id, ring_id ORDER BY seq))"""

CENTROIDS = EDGES + """,
ring_sums AS (
  SELECT LocationID, ring_id, sum(x * y1 - x1 * y) AS c2,
         sum((x + x1) * (x * y1 - x1 * y)) AS sx, sum((y + y1) * (x * y1 - x1 * y)) AS sy,
         sign(sum(x * y1 - x1 * y)) * CASE WHEN ring_id = 1 THEN 1 ELSE -1 END AS s
  FROM edges GROUP BY LocationID, part_id, ring_id),
sums AS (SELECT LocationID, sum(s * c2) AS c2, sum(s * sx) AS sx, sum(s * sy) AS sy
         FROM ring_sums GROUP BY LocationID)
SELECT LocationID, round(sx / (3 * nullif(c2, 0)), 6) AS longitude,
       round(sy / (3 * nullif(c2, 0)), 6) AS latitude, round(abs(c2 / 2), 6) AS area
FROM sums"""


NY_FEET = {"a": 6378137.0, "rf": 298.257222101, "unit": 0.304800609601219, "fe": 984250.0,
           "fn": 0.0, "lon0": -74.0, "p1": 41.0333333333333, "p2": 40.6666666666667,
           "p0": 40.1666666666667}
JAMAICA = {"a": 6378137.0, "rf": 298.257223563, "unit": 1.0, "fe": 750000.0, "fn": 650000.0,
           "lon0": -77.0, "p1": 18.0, "p2": 18.0, "p0": 18.0}


def _projection(system: dict[str, float] = NY_FEET, k: str = "") -> str:
    """Inverse Lambert conformal conic of ``vertices`` into ``lonlat``; constants
    derived in SQL from the system's parameters, latitude iterated in six steps.
    ``k`` keeps the names of several apart."""
    s = {name: f"{value!r}::double" for name, value in system.items()}
    ratio = "power((1 - e * sin({p})) / (1 + e * sin({p})), e / 2)"
    t = "tan(pi() / 4 - {p} / 2) / " + ratio
    m = "cos({p}) / sqrt(1 - e * e * sin({p}) * sin({p}))"
    n = "sin(p1)" if system["p1"] == system["p2"] else "ln(m1 / m2) / ln(t1 / t2)"
    steps = "".join(
        f""",
s{k}{i + 1} AS (SELECT * REPLACE (
  pi() / 2 - 2 * atan(tt * {ratio.format(p='phi')}) AS phi) FROM s{k}{i})""" for i in range(6))
    return f"""c{k}0 AS (
  SELECT sqrt(2 / {s['rf']} - 1 / ({s['rf']} * {s['rf']})) AS e, {s['a']} / {s['unit']} AS a,
         radians({s['p1']}) AS p1, radians({s['p2']}) AS p2, radians({s['p0']}) AS p0),
c{k}1 AS (
  SELECT e, a, p1, {m.format(p='p1')} AS m1, {m.format(p='p2')} AS m2,
         {t.format(p='p1')} AS t1, {t.format(p='p2')} AS t2, {t.format(p='p0')} AS t0
  FROM c{k}0),
c{k}2 AS (SELECT *, {n} AS n FROM c{k}1),
c{k}3 AS (SELECT *, a * m1 / (n * power(t1, n)) AS af FROM c{k}2),
c{k}4 AS (SELECT *, af * power(t0, n) AS rho0 FROM c{k}3),
polar{k} AS (
  SELECT v.*, x - {s['fe']} AS dx, rho0 - (y - {s['fn']}) AS dy, e, n, af FROM vertices v, c{k}4),
cone{k} AS (
  SELECT *, degrees(atan2(dx, dy) / n) + {s['lon0']} AS lon,
         power(sqrt(dx * dx + dy * dy) / af, 1 / n) AS tt
  FROM polar{k}),
s{k}0 AS (SELECT *, pi() / 2 - 2 * atan(tt) AS phi FROM cone{k}){steps},
lonlat{k} AS (SELECT *, degrees(phi) AS lat FROM s{k}6)"""


EVENT_VERTICES = """vertices AS (
  SELECT event_id AS seq, 913000.0::double + (event_id * 7919) % 160000 + value AS x,
         120000.0::double + (event_id * 104729) % 160000 + value AS y
  FROM events)"""

ZONE_TABLE = f"""WITH {CUSTOMER_RINGS},
vertices AS (
  SELECT * REPLACE (x * 1000 + 930000.0::double AS x, y * 500 + 130000.0::double AS y) FROM rings),
{_projection()},
local AS (
  SELECT *, first_value(lon) OVER z AS lon0, first_value(lat) OVER z AS lat0,
         lead(lon) OVER r - lon0 AS u1, lead(lat) OVER r - lat0 AS v1,
         lon - lon0 AS u, lat - lat0 AS v
  FROM lonlat
  WINDOW z AS (PARTITION BY LocationID ORDER BY part_id, ring_id, seq),
         r AS (PARTITION BY LocationID, part_id, ring_id ORDER BY seq)),
ring_sums AS (
  SELECT LocationID, any_value(lon0) AS lon0, any_value(lat0) AS lat0,
         sum(u * v1 - u1 * v) AS c2, sum((u + u1) * (u * v1 - u1 * v)) AS su,
         sum((v + v1) * (u * v1 - u1 * v)) AS sv,
         sign(sum(u * v1 - u1 * v)) * CASE WHEN ring_id = 1 THEN 1 ELSE -1 END AS s
  FROM local WHERE u1 IS NOT NULL GROUP BY LocationID, part_id, ring_id),
sums AS (
  SELECT LocationID, any_value(lon0) AS lon0, any_value(lat0) AS lat0, sum(s * c2) AS c2,
         sum(s * su) AS su, sum(s * sv) AS sv
  FROM ring_sums GROUP BY LocationID)
SELECT LocationID, 'Zone_' || LocationID::varchar AS zone,
       'Borough_' || (LocationID % 6)::varchar AS borough,
       round(lon0 + su / (3 * c2), 6) AS longitude, round(lat0 + sv / (3 * c2), 6) AS latitude
FROM sums"""


def _distance(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = (f"(power(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1}))"
         f" * cos(radians({lat2})) * power(sin(radians({lon2} - {lon1}) / 2), 2))")
    return f"round(3958.8::double * 2 * atan2(sqrt({a}), sqrt(1 - {a})) * 1.35::double, 2)"


ZONE_MAP = """records AS (
  SELECT event_id, CAST((user_id * 7) % 265 + 1 AS integer) AS id,
         round(40.53::double + value * 0.001::double, 6) AS lat,
         round(-74.23::double + (event_id % 263) * 0.002::double, 6) AS lon
  FROM events),
zone_rows AS (
  SELECT id::varchar AS zone_id, lat, lon FROM records
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY event_id DESC) = 1)"""

REJECTED = f"""WITH {REQUESTS}
SELECT trip_id, trip_distance, PULocationID, DOLocationID, pickup_hour, pickup_dow,
       first_invalid, concat_ws(',', bad1, bad2, bad3, bad4, bad5) AS all_invalid
FROM checked WHERE first_invalid IS NOT NULL"""

ESTIMATE = _distance("pu.latitude", "pu.longitude", '"do".latitude', '"do".longitude')

ESTIMATED = f"""{REQUESTS}, {ZONES},
filled AS (
  SELECT r.* REPLACE (CASE WHEN coalesce(trim(r.trip_distance), '') = ''
                                AND pu.LocationID IS NOT NULL AND "do".LocationID IS NOT NULL
                           THEN {ESTIMATE}::varchar ELSE r.trip_distance END AS trip_distance),
         CASE WHEN coalesce(trim(r.trip_distance), '') <> '' THEN NULL
              WHEN try_cast(r.PULocationID AS integer) IS NOT NULL AND pu.LocationID IS NULL
              THEN 'PULocationID unknown'
              WHEN try_cast(r.DOLocationID AS integer) IS NOT NULL AND "do".LocationID IS NULL
              THEN 'DOLocationID unknown' END AS bad0
  FROM requests r
  LEFT JOIN zones pu ON try_cast(r.PULocationID AS integer) = pu.LocationID
  LEFT JOIN zones "do" ON try_cast(r.DOLocationID AS integer) = "do".LocationID),
judged AS (
  SELECT *,
         CASE WHEN try_cast(trip_distance AS double) IS NULL THEN 'trip_distance' END AS bad1,
         CASE WHEN try_cast(PULocationID AS integer) IS NULL THEN 'PULocationID' END AS bad2,
         CASE WHEN try_cast(DOLocationID AS integer) IS NULL THEN 'DOLocationID' END AS bad3,
         CASE WHEN coalesce(try_cast(pickup_hour AS integer), -1) NOT BETWEEN 0 AND 23
              THEN 'pickup_hour' END AS bad4,
         CASE WHEN coalesce(try_cast(pickup_dow AS integer), -1) NOT BETWEEN 1 AND 7
              THEN 'pickup_dow' END AS bad5,
         coalesce(bad0, bad1, bad2, bad3, bad4, bad5) AS first_invalid
  FROM filled)"""

ESTIMATED_REPLIES = f"""WITH {ESTIMATED}
SELECT trip_id, round(trip_distance::double + 4, 2) AS predicted_duration_mins,
       trip_distance::double AS trip_distance, CAST(PULocationID AS integer) AS PULocationID,
       CAST(DOLocationID AS integer) AS DOLocationID, CAST(pickup_hour AS integer) AS pickup_hour,
       CAST(pickup_dow AS integer) AS pickup_dow
FROM judged WHERE first_invalid IS NULL"""

ROUNDED_CLEAN = """SELECT trip_id, round(trip_distance, 4) AS trip_distance, PULocationID,
  DOLocationID, pickup_hour, pickup_dow, round(trip_duration_mins, 4) AS trip_duration_mins
FROM clean"""

PAIR = """round(trip_duration_mins, 2) AS actual_mins, round(prediction, 2) AS predicted_mins"""

SAMPLE_COLUMNS = """round(trip_distance, 4) AS trip_distance, PULocationID, DOLocationID,
  pickup_hour, pickup_dow, round(trip_duration_mins, 2) AS trip_duration_mins"""

MONTH_TRIPS = """trips AS (
  SELECT o_orderdate AS pick, o_orderdate + to_seconds(o_orderkey * 37 % 7500) AS drop_,
         o_totalprice / 4000.0::double AS trip_distance,
         CAST(year(o_orderdate) AS integer) AS year, CAST(month(o_orderdate) AS integer) AS month,
         (epoch_us(drop_) // 1000000 - epoch_us(pick) // 1000000) / 60.0::double AS mins,
         o_custkey, o_orderkey
  FROM orders WHERE o_orderdate IS NOT NULL),
flags AS (
  SELECT *, coalesce(mins > 2 AND mins < 120, false) AS a,
         coalesce(trip_distance > 0 AND trip_distance < 100, false) AS b,
         o_custkey IS NOT NULL AND o_orderkey IS NOT NULL AS c
  FROM trips)"""

ORACLE: dict[str, str] = {
    "clean_trips": f"WITH {CLEAN} {ROUNDED_CLEAN}",
    "stream_ingest": f"WITH {CLEAN} {ROUNDED_CLEAN}",
    "clean_audit": f"""WITH {TIMED}, flags AS (
  SELECT coalesce(trip_duration_mins > 2 AND trip_duration_mins < 120, false) AS a,
         coalesce(trip_distance > 0 AND trip_distance < 100, false) AS b,
         PULocationID IS NOT NULL AND DOLocationID IS NOT NULL AND pickup_hour IS NOT NULL
           AND pickup_dow IS NOT NULL AS c
  FROM timed)
SELECT count(*) AS rows_in, count(*) FILTER (NOT a) AS dropped_duration,
       count(*) FILTER (a AND NOT b) AS dropped_distance,
       count(*) FILTER (a AND b AND NOT c) AS dropped_missing,
       count(*) FILTER (a AND b AND c) AS rows_out
FROM flags""",
    "hotspots": f"""WITH {HOT}
SELECT LocationID, zone, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude,
       trip_count
FROM hot ORDER BY trip_count DESC, LocationID""",
    "hotspots_raw": f"WITH {HOT} SELECT * FROM ranked ORDER BY trip_count DESC, PULocationID",
    "hotspot_markers": f"""WITH {HOT}
SELECT LocationID, zone, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude,
       trip_count,
       round(least(greatest(trip_count / 120.0::double * 35, 5), 35), 6) AS radius,
       CASE WHEN trip_count > 60 THEN 'high' ELSE 'normal' END AS demand,
       format('{{:,}}', trip_count) || ' Trips' AS trips_text
FROM hot
WHERE latitude IS NOT NULL AND latitude <> 0 AND longitude IS NOT NULL AND longitude <> 0""",
    "zone_map": f"WITH {ZONE_MAP} SELECT * FROM zone_rows",
    "zone_map_json": f"""WITH {ZONE_MAP}
SELECT zone_id, '{{"' || zone_id || '":' || json_object('lat', lat, 'lon', lon)::varchar || '}}'
         AS entry
FROM zone_rows""",
    "zone_distance": f"""WITH {CLEAN}, {ZONES}
SELECT c.trip_id, c.PULocationID, c.DOLocationID, round(c.trip_distance, 4) AS trip_distance,
       {ESTIMATE} AS estimated_miles
FROM clean c JOIN zones pu ON c.PULocationID = pu.LocationID
JOIN zones "do" ON c.DOLocationID = "do".LocationID""",
    "zone_distance_audit": f"""WITH {CLEAN}, {ZONES}
SELECT c.trip_id, c.PULocationID, c.DOLocationID,
       pu.LocationID IS NOT NULL AND "do".LocationID IS NOT NULL AS is_estimable,
       {ESTIMATE} AS estimated_miles
FROM clean c LEFT JOIN zones pu ON c.PULocationID = pu.LocationID
LEFT JOIN zones "do" ON c.DOLocationID = "do".LocationID""",
    "train_test_split": f"""WITH {CLEAN}
SELECT CASE WHEN ('0x' || substr(md5(trip_id::varchar), 1, 8))::bigint % 100 < 80
            THEN 'train' ELSE 'test' END AS side,
       count(*) AS trips, CAST(sum(trip_id) AS bigint) AS key_sum
FROM clean GROUP BY side""",
    "content_split": f"""WITH {CLEAN}, keyed AS (
  SELECT *, md5(concat_ws('|', PULocationID, DOLocationID, pickup_hour, pickup_dow)) AS content
  FROM clean)
SELECT CASE WHEN ('0x' || substr(md5(content), 1, 8))::bigint % 100 < 80
            THEN 'train' ELSE 'test' END AS side, pickup_dow, count(*) AS trips
FROM keyed GROUP BY ALL""",
    "exact_sample": f"""WITH {TRIPS}
SELECT trip_id, PULocationID, DOLocationID, round(trip_distance, 4) AS trip_distance
FROM trips ORDER BY md5('42' || trip_id::varchar), trip_id LIMIT 500""",
    "regression_metrics": f"""WITH {METRICS}
SELECT *, round(CAST(R2_Score * 100 AS decimal(12, 4)), 1)::decimal(12, 1)::varchar || '%'
         AS r2_text
FROM metrics""",
    "metrics_roundtrip": f"WITH {METRICS} SELECT * FROM metrics",
    "error_margin": f"""WITH {PREDICTED}
SELECT trip_id, {PAIR}, round(abs_error, 2) AS error_mins FROM predicted""",
    "banded_samples": f"WITH {BANDED} SELECT band, rn, trip_id, {SAMPLE_COLUMNS} FROM picked",
    "banded_samples_union": f"WITH {BANDED} SELECT band, trip_id, {SAMPLE_COLUMNS} FROM picked",
    "samples_roundtrip": f"WITH {BANDED} SELECT {SAMPLE_COLUMNS} FROM picked",
    "band_errors": f"""WITH {PREDICTED}, wide(band, lo, hi) AS (
  VALUES (1, 3.0, 4.0), (2, 4.0, 5.0), (3, 5.0, 6.0), (4, 6.0, 10.0), (5, 10.0, 'inf'::double))
SELECT band, count(*) AS trips, count(*) FILTER (abs_error < 1.5) AS close_trips,
       round(avg(abs_error), 4) AS mean_error
FROM predicted JOIN wide ON trip_distance BETWEEN lo AND hi GROUP BY band""",
    "sample_labels": f"""WITH {BANDED}, numbered AS (
  SELECT CAST(row_number() OVER (ORDER BY band, rn) AS integer) AS idx, * FROM picked)
SELECT idx, trip_id, 'Trip #' || idx::varchar || ' ('
       || round(CAST(trip_distance AS decimal(9, 3)), 1)::decimal(9, 1)::varchar || 'm)' AS label
FROM numbered""",
    "actual_vs_predicted_line": f"""WITH {PREDICTED}, firsts AS (
  SELECT * FROM predicted ORDER BY trip_id LIMIT 100)
SELECT CAST(row_number() OVER (ORDER BY trip_id) AS integer) AS idx, trip_id, {PAIR}
FROM firsts""",
    "actual_vs_predicted_scatter": f"""WITH {PREDICTED}
SELECT trip_id, {PAIR} FROM predicted ORDER BY md5(trip_id::varchar), trip_id LIMIT 2000""",
    "validate_requests": f"WITH {REQUESTS} SELECT * FROM valid",
    "rejected_requests": REJECTED,
    "stream_rejected": REJECTED,
    "stream_replies": f"""WITH {REQUESTS}
SELECT trip_id, round(trip_distance + 4, 2) AS predicted_duration_mins, trip_distance,
       PULocationID, DOLocationID, pickup_hour, pickup_dow
FROM valid""",
    "request_replies": f"""WITH {REQUESTS}
SELECT trip_id, CAST(json_object('predicted_duration_mins', round(trip_distance + 4, 2),
  'inputs', json_object('trip_distance', trip_distance, 'PULocationID', PULocationID,
    'DOLocationID', DOLocationID, 'pickup_hour', pickup_hour, 'pickup_dow', pickup_dow))
  AS varchar) AS reply
FROM valid""",
    "estimated_replies": ESTIMATED_REPLIES,
    "stream_estimated_replies": ESTIMATED_REPLIES,
    "estimated_rejects": f"""WITH {ESTIMATED}
SELECT trip_id, trip_distance, PULocationID, DOLocationID, pickup_hour, pickup_dow,
       first_invalid, concat_ws(',', bad0, bad1, bad2, bad3, bad4, bad5) AS all_invalid
FROM judged WHERE first_invalid IS NOT NULL""",
    "model_checks": f"""WITH {REQUESTS}
SELECT (SELECT count(*) FROM valid) AS scored, 0::bigint AS out_of_range,
       0::bigint AS reload_mismatches, 5::bigint AS importances,
       0::bigint AS negative_importances, 1.0::double AS importance_sum,
       0::integer AS metric_mismatches, true AS r2_above_half,
       'run the training job first' AS missing_artefact""",
    "stream_model_checks": f"""WITH {REQUESTS}
SELECT count(*) AS scored, 0::bigint AS mismatches FROM valid""",
    "landed_and_pending": """SELECT CAST(year(o_orderdate) AS integer) AS year,
  CAST(month(o_orderdate) AS integer) AS month, count(*) AS trips, count(*) AS ids
FROM orders GROUP BY ALL""",
    "ring_edges": f"""WITH {CUSTOMER_RINGS}, {EDGES}
SELECT LocationID, part_id, ring_id, seq, x, y, x1, y1 FROM edges""",
    "polygon_centroids": f"WITH {CUSTOMER_RINGS}, {CENTROIDS}",
    "large_ring_centroids": f"WITH {EVENT_RINGS}, {CENTROIDS}",
    "project_vertices": f"""WITH {EVENT_VERTICES}, {_projection()}
SELECT seq, round(lon, 7) AS longitude, round(lat, 7) AS latitude FROM lonlat""",
    "zone_table": ZONE_TABLE,
    "projected_by_wkt": f"""WITH {EVENT_VERTICES}, {_projection(NY_FEET, 'a')}, {_projection(JAMAICA, 'b')}
SELECT seq, 'two' AS system, round(lon, 7) AS longitude, round(lat, 7) AS latitude FROM lonlata
UNION ALL SELECT seq, 'one', round(lon, 7), round(lat, 7) FROM lonlatb""",
    "late_file_landing": f"""WITH {MONTH_TRIPS}
SELECT year, month, count(*) AS trips, count(*) AS ids,
       count(DISTINCT o_orderkey % 10 < 8) AS landings
FROM trips GROUP BY year, month""",
    "mixed_months": f"""WITH {MONTH_TRIPS}, ids AS (
  SELECT year, month, o_custkey % 265 + 1 AS pu,
         CASE WHEN (o_orderkey % 265 + 1) % 50 <> 0 THEN o_orderkey % 265 + 1 END AS dropoff
  FROM trips)
SELECT year, month, count(*) AS trips, sum(pu)::bigint AS pickup_sum,
       sum(dropoff)::bigint AS dropoff_sum, count(*) - count(dropoff) AS gaps
FROM ids GROUP BY year, month""",
    "stream_corrections": f"""WITH {MONTH_TRIPS}, fixed AS (
  SELECT * REPLACE (CASE WHEN year >= 2000 THEN trip_distance / 2 ELSE trip_distance END
                    AS trip_distance) FROM flags),
checked AS (SELECT *, trip_distance > 0 AND trip_distance < 100 AS near FROM fixed)
SELECT year, month, count(*) AS trips, count(*) AS ids, round(sum(trip_distance), 3) AS miles,
       CASE WHEN year >= 2000 THEN '2024-02-05' ELSE '2024-01-05' END AS delivery
FROM checked WHERE a AND near AND c GROUP BY year, month""",
    "stream_audit": f"""WITH {MONTH_TRIPS}
SELECT count(*) AS rows_in, count(*) FILTER (NOT a) AS dropped_duration,
       count(*) FILTER (a AND NOT b) AS dropped_distance,
       count(*) FILTER (a AND b AND NOT c) AS dropped_missing,
       count(*) FILTER (a AND b AND c) AS rows_out, count(*) FILTER (a AND b AND c) AS written
FROM flags""",
    "stream_answers": f"""WITH {REQUESTS}
SELECT trip_id, CASE WHEN first_invalid IS NULL
                     THEN round(try_cast(trip_distance AS double) + 4, 2) END
         AS predicted_duration_mins, first_invalid
FROM checked""",
    "stream_model_versions": f"""WITH {REQUESTS}
SELECT trip_id, CASE WHEN first_invalid IS NULL
                     THEN round(try_cast(trip_distance AS double) + 4 + 2 * (trip_id % 2), 2) END
         AS predicted_duration_mins, first_invalid,
       CASE WHEN first_invalid IS NULL THEN 1 + (trip_id % 2)::integer END AS model_version
FROM checked""",
    "published_hotspots": f"""WITH {HOT}, {METRICS.removeprefix(CLEAN + ",")}
SELECT LocationID, zone, trip_count, 2::integer AS version, (SELECT RMSE FROM metrics) AS RMSE
FROM hot""",
    "month_of_file": """SELECT CAST(year(o_orderdate) AS integer) AS year,
  CAST(month(o_orderdate) AS integer) AS month, count(*) AS trips,
  CAST(0 AS bigint) AS other_month
FROM orders GROUP BY ALL""",
    "monthly_landing": f"""WITH {MONTH_TRIPS}
SELECT year, month, count(*) AS rows_in, count(*) FILTER (NOT a) AS dropped_duration,
       count(*) FILTER (a AND NOT b) AS dropped_distance,
       count(*) FILTER (a AND b AND NOT c) AS dropped_missing,
       count(*) FILTER (a AND b AND c) AS rows_out
FROM flags GROUP BY year, month""",
    "stream_months": f"""WITH {MONTH_TRIPS}
SELECT year, month, count(*) AS trips, round(sum(trip_distance), 3) AS miles,
       round(sum(mins), 3) AS minutes
FROM flags WHERE a AND b AND c GROUP BY year, month""",
    "json_csv_roundtrip": f"""WITH {HOT}
SELECT LocationID, zone, borough, round(latitude, 6) AS latitude,
       round(longitude, 6) AS longitude, trip_count
FROM hot""",
}
