"""SQL twins of the registered queries, for DuckDB.

Relations are written independently of the Spark plans: ranking windows, self-joins and a full
node-by-node distance table where the library aggregates, reuses windows or looks nodes up.
"""

from __future__ import annotations

import re

from checks.feeds import EXTRACTS
from checks.feeds import SQL as FEED_SQL
from checks.feeds import with_clause
from freightloom.schemas import CONTRACT, FEEDS, FLAGS, declared

OUT_OF_RANGE, NULL_SOURCE = "out_of_range", "null_in_source"


def case(*rules: tuple[str, str], default: str = "'ok'") -> str:
    body = " ".join(f"WHEN {cond} THEN {label if label.startswith('*') else repr(label)}" for cond, label in rules)
    return f"CASE {body.replace('*', '')} ELSE {default} END"


def number(col: str, bad: str = "", low=None, high=None, label: str = "invalid_value") -> str:
    rules = [(f"{col} IS NULL", NULL_SOURCE)]
    if bad:
        rules.append((f"{col} {bad}", label))
    if high is not None:
        rules.append((f"{col} > {high}", OUT_OF_RANGE))
    if low is not None:
        rules.append((f"{col} < {low}", OUT_OF_RANGE))
    return case(*rules)


def first(table: str, feed: str, keys: str, select: str = "*") -> str:
    """Keep-first as a ranking window over all columns."""
    order = ", ".join(f"{c} NULLS FIRST" for c in FEEDS[feed].columns)
    return f"""SELECT * EXCLUDE (rn) FROM (SELECT {select},
      row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn,
      count(*) OVER (PARTITION BY {keys}) AS copies FROM {table}) WHERE rn = 1"""


def as_loaded(feed: str, table: str) -> str:
    """Rows as a CSV file gives them back: an empty field is NULL."""
    return f"SELECT {', '.join(f'nullif({c}, {chr(39) * 2}) AS {c}' for c in FEEDS[feed].columns)} FROM {table}"


def rnd(expr: str, places: int) -> str:
    return f"CAST(round(TRY_CAST(({expr}) AS DECIMAL(38,9)), {places}) AS DOUBLE)"


def number_cast(expr: str, kind: str = "DOUBLE") -> str:
    """A cast that reads only plain numbers, with an exponent or without (DuckDB alone also rounds '3.7' to 4)."""
    shape = r"^[+-]?[0-9]+$" if kind == "BIGINT" else r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
    return f"CASE WHEN regexp_matches({expr}, '{shape}') THEN TRY_CAST({expr} AS {kind}) END"


def datetime(col: str) -> str:
    return (f"coalesce(CASE WHEN regexp_matches({col}, '^\\d{{4}}-\\d\\d?-\\d\\d?( \\d\\d?:\\d\\d?:\\d\\d?)?$') "
            f"THEN TRY_CAST({col} AS TIMESTAMP) END, try_strptime({col}, '%d/%m/%Y %H:%M:%S'))")


def date(col: str) -> str:
    return (f"coalesce(CASE WHEN regexp_matches({col}, '^\\d{{4}}-\\d\\d?-\\d\\d?$') THEN TRY_CAST({col} AS DATE) END, "
            f"CAST(try_strptime({col}, '%d/%m/%Y') AS DATE))")


def km(a: str, b: str) -> str:
    half = "0.5 * radians(CAST({b}.{x} AS DOUBLE) - CAST({a}.{x} AS DOUBLE))"
    dlat, dlon = half.format(a=a, b=b, x="latitude"), half.format(a=a, b=b, x="longitude")
    return rnd(f"12742 * asin(least(1, sqrt(pow(sin({dlat}), 2) + cos(radians(CAST({a}.latitude AS DOUBLE))) "
               f"* cos(radians(CAST({b}.latitude AS DOUBLE))) * pow(sin({dlon}), 2))))", 2)


def reference(value: str, found: str, wrong: str, label: str, null=NULL_SOURCE, missing="referential_integrity_fail"):
    return case((f"{value} IS NULL", null), (f"{found} IS NULL", missing), (wrong, label))


def any_flag(flags: list[str]) -> str:
    return " OR ".join(f"{f} <> 'ok'" for f in flags)


def scored(inner: str, critical: list[str], warning: list[str] | None = None, exclude: str = "") -> str:
    soft = f"WHEN {any_flag(warning)} THEN 'warning'" if warning else ""
    cut = f" EXCLUDE ({exclude})" if exclude else ""
    return (f"SELECT *{cut}, CASE WHEN {any_flag(critical)} THEN 'critical' {soft} ELSE 'clean' END "
            f"AS quality_record FROM ({inner})")


EXPECTED = case(("upper(trim(node_id)) LIKE 'ON%'", "origin_node"), ("upper(trim(node_id)) LIKE 'CH%'", "consolidation_hub"),
                ("upper(trim(node_id)) LIKE 'DN%'", "delivery_node"), default="'unknown_prefix'")
KNOWN_TYPES = "('origin_node', 'consolidation_hub', 'delivery_node')"
FIXED_TYPE = f"CASE WHEN lower(trim(node_type)) NOT IN {KNOWN_TYPES} THEN {EXPECTED} ELSE lower(trim(node_type)) END"


def network_sql(country: str = "country") -> str:
    typed = f"""SELECT upper(trim(node_id)) AS node_id, {FIXED_TYPE} AS node_type,
      nullif(trim(city), '') AS city, nullif(trim({country}), '') AS country,
      CAST({number_cast("nullif(trim(latitude), '')", 'DECIMAL(38,9)')} AS DECIMAL(38,9)) AS latitude,
      CAST({number_cast("nullif(trim(longitude), '')", 'DECIMAL(38,9)')} AS DECIMAL(38,9)) AS longitude,
      upper(trim(node_capability)) AS node_capability,
      lower(trim(node_type)) AS raw_type, regexp_matches(node_id, '^(ON|CH|DN)_[A-Z]{{2,4}}$') AS formed
      FROM ({first('raw_network', 'mdm_network', 'node_id')})"""
    flagged = f"""SELECT *,
      {case(("node_id IS NULL", NULL_SOURCE), ("formed IS NOT TRUE", "unexpected_node_format"))} AS node_quality_flag,
      {case(("node_type = 'unknown_prefix'", "invalid_value"), ("raw_type IS NULL", NULL_SOURCE),
            ("node_type <> raw_type", "corrected"))} AS node_type_quality_flag,
      {case(("city IS NULL", NULL_SOURCE))} AS city_quality_flag,
      {case(("country IS NULL", NULL_SOURCE), ("length(country) <> 2", "not_iso_format"))} AS country_quality_flag,
      {case(("latitude IS NULL OR longitude IS NULL", NULL_SOURCE),
            ("latitude NOT BETWEEN 35 AND 72 OR longitude NOT BETWEEN -10 AND 40", "invalid_value"))}
        AS coordinates_quality_flag,
      {case(("node_capability IS NULL", NULL_SOURCE),
            ("node_capability NOT IN ('BOX', 'MTL', 'ALL')", "unexpected_capability"))} AS capabilities_quality_flag
      FROM ({typed})"""
    return f"""SELECT * EXCLUDE (raw_type, formed), CASE
      WHEN node_quality_flag <> 'ok' OR node_type_quality_flag NOT IN ('ok', 'corrected')
        OR coordinates_quality_flag <> 'ok' THEN 'critical'
      WHEN {any_flag(['city_quality_flag', 'capabilities_quality_flag', 'country_quality_flag'])} THEN 'warning'
      ELSE 'clean' END AS quality_record FROM ({flagged})"""


RATE_FLAGS = ["duplicates_flag", "country_quality_flag", "carrier_quality_flag", "fixed_cost_quality_flag",
              "cost_per_km_quality_flag"]
_rates = f"""SELECT upper(trim(country)) AS country, trim(carrier) AS carrier,
  {number_cast("nullif(fixed_cost_eur, '')")} AS fixed_cost_eur,
  {number_cast("nullif(cost_per_km_eur, '')")} AS cost_per_km_eur, carrier AS raw_carrier, copies
  FROM (SELECT * EXCLUDE (rn) FROM (SELECT *,
      row_number() OVER (PARTITION BY upper(trim(country)), trim(carrier) ORDER BY upper(trim(country)) NULLS FIRST,
        trim(carrier) NULLS FIRST, fixed_cost_eur NULLS FIRST, cost_per_km_eur NULLS FIRST, carrier NULLS FIRST) AS rn,
      count(*) OVER (PARTITION BY upper(trim(country)), trim(carrier)) AS copies FROM raw_rates) WHERE rn = 1)"""
_rates_flagged = f"""SELECT country, carrier, fixed_cost_eur, cost_per_km_eur,
  {case(("copies > 1", "duplicate"))} AS duplicates_flag,
  {case(("country IS NULL", NULL_SOURCE), ("length(country) <> 2", "invalid_format"),
        ("country NOT IN ('FR', 'DE', 'ES', 'IT', 'NL', 'BE', 'PL', 'CZ')", "invalid_country"))} AS country_quality_flag,
  {case(("raw_carrier IS NULL", NULL_SOURCE), ("carrier <> raw_carrier", "corrected"))} AS carrier_quality_flag,
  {number('fixed_cost_eur', '<= 0', 200, 500)} AS fixed_cost_quality_flag,
  {number('cost_per_km_eur', '<= 0', 0.5, 5)} AS cost_per_km_quality_flag FROM ({_rates})"""

_handling = f"""SELECT h.node_id, h.cost_per_package_eur,
  {case(("h.node_id IS NULL", NULL_SOURCE), ("n.node_id IS NULL", "referential_integrity_fail"),
        ("n.node_type <> 'consolidation_hub'", "invalid_node_type"), ("copies > 1", "duplicate"))}
    AS node_integrity_quality_flag,
  {number('h.cost_per_package_eur', '<= 0', 1, 2.5, 'invalid_cost')} AS cost_quality_flag
  FROM (SELECT upper(trim(node_id)) AS node_id, copies,
          CAST({number_cast("nullif(cost_per_package_eur, '')", 'DECIMAL(38,9)')} AS DECIMAL(38,9)) AS cost_per_package_eur
        FROM (SELECT *, row_number() OVER (PARTITION BY upper(trim(node_id)) ORDER BY cost_per_package_eur NULLS FIRST) AS rn,
                count(*) OVER (PARTITION BY upper(trim(node_id))) AS copies FROM raw_handling) WHERE rn = 1) h
  LEFT JOIN network n ON n.node_id = h.node_id"""

_procurement = f"""SELECT *, {case(("item IS NULL", NULL_SOURCE))} AS item_quality_flag,
  {number('cost_per_unit_eur', '<= 0', label='invalid_cost')} AS cost_per_unit_quality_flag,
  {case(("reusable IS NULL", "invalid_format"))} AS reusable_quality_flag
  FROM (SELECT upper(trim(item)) AS item, {number_cast('cost_per_unit_eur')} AS cost_per_unit_eur,
    CASE lower(trim(reusable)) WHEN 'yes' THEN TRUE WHEN 'true' THEN TRUE WHEN '1' THEN TRUE
      WHEN 'no' THEN FALSE WHEN 'false' THEN FALSE WHEN '0' THEN FALSE END AS reusable, description
    FROM raw_procurement)"""

CONFIGURED_FLAGS = ["origin_node_integrity_quality_flag", "transit_time_quality_flag",
                    "destination_node_integrity_quality_flag"]
_configured = f"""SELECT c.*,
  {reference('c.origin_node_id', 'o.node_id', "o.node_type NOT IN ('origin_node', 'consolidation_hub')", 'cant_be_an_origin',
             'null_in_origin', 'unknown_node')} AS origin_node_integrity_quality_flag,
  {number('c.configured_transit_time_hours', '<= 0')} AS transit_time_quality_flag,
  {reference('c.destination_node_id', 'd.node_id', "d.node_type NOT IN ('consolidation_hub', 'delivery_node')", 'cant_be_a_destination',
             missing='unknown_node')} AS destination_node_integrity_quality_flag
  FROM (SELECT origin_node_id, destination_node_id,
          {number_cast('configured_transit_time_hours')} AS configured_transit_time_hours, configuration_type
        FROM raw_configured) c
  LEFT JOIN network o ON o.node_id = c.origin_node_id LEFT JOIN network d ON d.node_id = c.destination_node_id"""

TMS_CRITICAL = ["origin_integrity_quality_flag", "destination_integrity_quality_flag", "truck_id_quality_flag",
                "transit_time_quality_flag", "container_count_quality_flag", "arrival_datetime_quality_flag",
                "departure_datetime_quality_flag"]
_tms_typed = f"""SELECT truck_id, upper(trim(origin_node_id)) AS origin_node_id,
  upper(trim(destination_node_id)) AS destination_node_id, trim(carrier) AS carrier,
  {datetime('departure_datetime')} AS departure_datetime,
  {number_cast("nullif(trim(transit_time_hours), '')")} AS transit_time_hours,
  {datetime('arrival_datetime')} AS arrival_datetime,
  {number_cast("nullif(container_count, '')", 'BIGINT')} AS container_count,
  {number_cast("nullif(package_count, '')", 'BIGINT')} AS package_count,
  {number_cast("nullif(cbm, '')")} AS cbm,
  departure_datetime AS departure_text, arrival_datetime AS arrival_text, copies
  FROM ({first('raw_tms', 'tms_transportation', 'truck_id')})"""
_tms = f"""SELECT t.* EXCLUDE (departure_text, arrival_text, copies),
  {reference('t.origin_node_id', 'o.node_id', "o.node_type NOT IN ('origin_node', 'consolidation_hub')", 'cant_be_an_origin')}
    AS origin_integrity_quality_flag,
  {reference('t.destination_node_id', 'd.node_id', "d.node_type NOT IN ('consolidation_hub', 'delivery_node')", 'cant_be_a_destination')}
    AS destination_integrity_quality_flag,
  {case(("carrier IS NULL", NULL_SOURCE),
        ("carrier NOT IN (SELECT carrier FROM rates WHERE quality_record <> 'critical')", "unknown_node"))}
    AS carrier_integrity_quality_flag,
  {number('transit_time_hours', '<= 0')} AS transit_time_quality_flag,
  {case(("truck_id IS NULL", NULL_SOURCE), ("NOT regexp_matches(truck_id, '^TRK_[0-9]{7}$')", "invalid_format"),
        ("copies > 1", "duplicate"))} AS truck_id_quality_flag,
  {case(("departure_text IS NULL", NULL_SOURCE), ("departure_datetime IS NULL", "unexpected_format"))}
    AS departure_datetime_quality_flag,
  {case(("arrival_text IS NULL", NULL_SOURCE), ("arrival_datetime IS NULL", "unexpected_format"),
        ("departure_datetime IS NULL", "ok"),
        ("date_diff('minute', departure_datetime, arrival_datetime) <= 0", "arrival_before_departure"))}
    AS arrival_datetime_quality_flag,
  {number('container_count', '<= 0', high=32)} AS container_count_quality_flag,
  {number('package_count', '< 0')} AS package_count_quality_flag,
  {case(("cbm IS NULL", NULL_SOURCE), ("cbm < 0", "invalid_value"), ("container_count IS NULL", "ok"),
        ("cbm > container_count", OUT_OF_RANGE))} AS cbm_quality_flag
  FROM ({_tms_typed}) t LEFT JOIN network o ON o.node_id = t.origin_node_id
  LEFT JOIN network d ON d.node_id = t.destination_node_id"""

WMS_CRITICAL = ["order_date_quality_flag", "truck_integrity_quality_flag", "origin_integrity_quality_flag",
                "destination_integrity_quality_flag", "container_coherence_flag", "shipment_coherence_flag",
                "sort_code_quality_flag"]
_wms_typed = f"""SELECT trim(shipment_id) AS shipment_id, trim(truck_id) AS truck_id, trim(container_id) AS container_id,
  {date('order_date')} AS order_date, trim(origin_node_id) AS origin_node_id,
  trim(destination_node_id) AS destination_node_id, trim(sort_code) AS sort_code, rn,
  count(*) OVER (PARTITION BY trim(shipment_id), trim(truck_id)) AS copies
  FROM (SELECT *, row_number() OVER (PARTITION BY shipment_id, truck_id ORDER BY
        {", ".join(f"{c} NULLS FIRST" for c in FEEDS["wms_shipment_details"].columns)}) AS rn FROM raw_wms)"""


def agreement(mine: str, other: str, label: str) -> str:
    return case((f"{mine} IS NULL", NULL_SOURCE), (f"{other} IS NULL", "ok"), (f"{mine} <> {other}", label))


_wms_flagged = f"""SELECT w.* EXCLUDE (rn, copies), t.package_count AS packages,
  {case(("w.order_date IS NULL", NULL_SOURCE), ("t.departure_datetime IS NULL", "ok"),
        ("w.order_date > CAST(t.departure_datetime AS DATE)", "date_integrity_fail"))} AS order_date_quality_flag,
  {case(("w.truck_id IS NULL", NULL_SOURCE), ("t.truck_id IS NULL", "truck_integrity_fail"))}
    AS truck_integrity_quality_flag,
  {agreement('w.origin_node_id', 't.origin_node_id', 'origin_integrity_fail')} AS origin_integrity_quality_flag,
  {agreement('w.destination_node_id', 't.destination_node_id', 'destination_integrity_fail')}
    AS destination_integrity_quality_flag,
  {case(("container_id IS NULL", NULL_SOURCE), ("left(container_id, 3) NOT IN ('MTL', 'BOX')", "invalid_container"))}
    AS container_integrity_quality_flag,
  {case(("shipment_id IS NULL", NULL_SOURCE), ("copies > 1", "duplicate_shipment_in_truck"),
        ("NOT regexp_matches(shipment_id, '^SHP_[0-9]{9}$')", "invalid_format"))} AS shipment_integrity_quality_flag,
  {reference('sort_code', 's.node_id', "s.node_type <> 'delivery_node'", 'cant_be_a_sort_code',
             missing='sort_code_integrity_fail')} AS sort_code_quality_flag
  FROM ({_wms_typed}) w LEFT JOIN tms t ON t.truck_id = w.truck_id LEFT JOIN network s ON s.node_id = w.sort_code
  WHERE rn = 1"""
_wms = f"""SELECT * EXCLUDE (packages), container_integrity_quality_flag AS container_coherence_flag,
  {case(("shipment_integrity_quality_flag <> 'ok'", "*shipment_integrity_quality_flag"), ("packages IS NULL", "ok"),
        ("count(shipment_id) OVER (PARTITION BY truck_id) <> packages", "incoherent_package_count"))}
    AS shipment_coherence_flag FROM ({_wms_flagged})"""

# -- facts ------------------------------------------------------------------------------------

PERIOD = "DATE '2025-07-01' AND DATE '2025-12-31'"
LEG = ("CASE WHEN origin_node_id LIKE 'ON\\_%' ESCAPE '\\' AND destination_node_id LIKE 'DN\\_%' ESCAPE '\\' THEN 'direct' "
       "WHEN origin_node_id LIKE 'ON\\_%' ESCAPE '\\' AND destination_node_id LIKE 'CH\\_%' ESCAPE '\\' THEN 'indirect_leg1' "
       "WHEN origin_node_id LIKE 'CH\\_%' ESCAPE '\\' AND destination_node_id LIKE 'DN\\_%' ESCAPE '\\' THEN 'indirect_leg2' "
       "ELSE 'unknown' END")
QUANTILES = {"p50": 0.5, "p90": 0.9, "p95": 0.95, "p98": 0.98}


def advised(thin: str, thick: str, hub_leg: bool = False) -> str:
    """Simulation from ``costed``: category, hub, price."""
    leg1 = "h1.distance_km" if hub_leg else "distance1_km"
    fixed2, km2 = ("hr.f", "hr.k") if hub_leg else ("leg2_avg_fixed_cost_eur", "leg2_avg_cost_per_km_eur")
    extra = ("LEFT JOIN distance h1 ON h1.o = r.origin_node_id AND h1.d = r.recommended_hub "
             "LEFT JOIN mean_rate hr ON hr.country = h2.o_country") if hub_leg else ""
    return f"""SELECT *, current_monthly_cost_ratio - cost_of_recommended_design AS cost_reduction FROM (
      SELECT r.*, CASE WHEN category = 'thin' THEN recommended_hub IS NOT NULL END AS deprecation_feasible,
        CASE category
          WHEN 'thin' THEN (leg1_avg_fixed_cost_eur + leg1_avg_cost_per_km_eur * {leg1}) * (adjusted_triplet_cbm / 28)
            + ({fixed2} + {km2} * h2.distance_km) * (adjusted_triplet_cbm / 28) + processing_cost_ratio
          WHEN 'thick' THEN (leg1_avg_fixed_cost_eur + leg1_avg_cost_per_km_eur * direct_distance_km)
            * (adjusted_triplet_cbm / 28) END AS cost_of_recommended_design
      FROM (SELECT c.*, CASE WHEN category = 'thin' THEN best.hub ELSE 'not applicable' END AS recommended_hub
            FROM (SELECT *, CASE WHEN triplet_type = 'indirect' AND adjusted_triplet_cbm > {thick} THEN 'thick'
                    WHEN triplet_type = 'direct' AND adjusted_triplet_cbm < {thin} THEN 'thin' ELSE 'healthy' END
                    AS category FROM costed) c
            LEFT JOIN best_hub best ON best.origin_node_id = c.origin_node_id AND best.sort_code = c.sort_code) r
      LEFT JOIN distance h2 ON h2.o = r.recommended_hub AND h2.d = r.sort_code {extra})"""


RELATIONS: dict[str, str] = {
    "network": network_sql(),
    "rates": scored(_rates_flagged, RATE_FLAGS),
    "handling": scored(_handling, ["node_integrity_quality_flag", "cost_quality_flag"]),
    "procurement": scored(_procurement, ["item_quality_flag", "cost_per_unit_quality_flag"], ["reusable_quality_flag"]),
    "configured": scored(_configured, CONFIGURED_FLAGS),
    "tms": scored(_tms, TMS_CRITICAL, ["carrier_integrity_quality_flag"]),
    "wms": scored(_wms, WMS_CRITICAL),
    "good_node": "SELECT * FROM network WHERE quality_record <> 'critical'",
    "good_run": "SELECT * FROM tms WHERE quality_record <> 'critical'",
    "good_leg": "SELECT * FROM wms WHERE quality_record <> 'critical'",
    "mean_rate": """SELECT country, avg(fixed_cost_eur) AS f, avg(cost_per_km_eur) AS k FROM rates
      WHERE quality_record <> 'critical' GROUP BY country""",
    "distance": f"""SELECT a.node_id AS o, a.country AS o_country, a.node_type AS o_type, b.node_id AS d,
        b.country AS d_country, b.node_type AS d_type, {km('a', 'b')} AS distance_km
      FROM good_node a JOIN good_node b ON (a.node_type = 'origin_node' AND b.node_type <> 'origin_node')
        OR (a.node_type = 'consolidation_hub' AND b.node_type = 'delivery_node')""",
    "run_lane": f"""SELECT t.truck_id, t.origin_node_id, t.destination_node_id, coalesce(t.carrier, 'UNKNOWN') AS carrier,
        CAST(t.departure_datetime AS DATE) AS day, t.package_count, t.cbm, a.country AS origin_node_country,
        a.node_type AS origin_node_type, b.country AS destination_node_country, b.node_type AS destination_node_type,
        {km('a', 'b')} AS distance_km
      FROM good_run t JOIN good_node a ON a.node_id = t.origin_node_id
      JOIN good_node b ON b.node_id = t.destination_node_id""",
    "actual": """SELECT day, origin_node_id, destination_node_id, carrier, count(truck_id) AS daily_trucks,
        CAST(sum(package_count) AS BIGINT) AS daily_packages, sum(cbm) AS daily_cbm FROM run_lane GROUP BY ALL""",
    "calendar": "SELECT CAST(unnest(generate_series(DATE '2025-07-01', DATE '2025-12-31', INTERVAL 1 DAY)) AS DATE) AS date",
    "lane_day": f"""SELECT date, l.*, coalesce(daily_trucks, 0) AS daily_trucks, coalesce(daily_packages, 0) AS daily_packages,
        coalesce(daily_cbm, 0) AS daily_cbm
      FROM (SELECT DISTINCT * EXCLUDE (truck_id, day, package_count, cbm) FROM run_lane WHERE carrier <> 'UNKNOWN') l
      CROSS JOIN calendar LEFT JOIN actual a ON a.day = date AND a.origin_node_id = l.origin_node_id
        AND a.destination_node_id = l.destination_node_id AND a.carrier = l.carrier
      UNION ALL
      SELECT a.day, l.*, daily_trucks, daily_packages, daily_cbm
      FROM (SELECT DISTINCT * EXCLUDE (truck_id, day, package_count, cbm) FROM run_lane WHERE carrier = 'UNKNOWN') l
      JOIN actual a USING (origin_node_id, destination_node_id, carrier) WHERE a.day BETWEEN {PERIOD}""",
    "priced": """SELECT d.*, d.carrier = 'UNKNOWN' AS cost_is_imputed, coalesce(CASE WHEN d.carrier = 'UNKNOWN'
          THEN (m.f + d.distance_km * m.k) * d.daily_trucks
          ELSE (q.fixed_cost_eur + d.distance_km * q.cost_per_km_eur) * d.daily_trucks END, 0) AS cost
      FROM lane_day d LEFT JOIN rates q ON q.country = d.origin_node_country AND q.carrier = d.carrier
        AND q.quality_record <> 'critical' LEFT JOIN mean_rate m ON m.country = d.origin_node_country""",
    "daily": f"""SELECT date, origin_node_country, origin_node_id, origin_node_type, destination_node_country,
        destination_node_id, destination_node_type, carrier, distance_km, daily_trucks, daily_packages, daily_cbm,
        {rnd('cost', 2)} AS daily_linehaul_cost_eur, cost_is_imputed,
        {rnd('avg(daily_cbm) OVER thirty', 2)} AS rolling_avg_cbm_30d,
        {rnd('avg(cost) OVER thirty', 2)} AS rolling_avg_cost_30d
      FROM priced WINDOW thirty AS (PARTITION BY origin_node_id, destination_node_id, carrier ORDER BY date
        ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)""",
    "lane_month": """SELECT origin_node_id, destination_node_id, CAST(date_trunc('month', date) AS DATE) AS departure_month,
        sum(daily_linehaul_cost_eur) AS monthly_linehaul_cost_eur, sum(daily_cbm) AS monthly_cbm FROM daily GROUP BY ALL""",
    "truck_triplet": """SELECT w.*, CAST(date_trunc('month', t.departure_datetime) AS DATE) AS departure_month,
        t.cbm AS truck_cbm, t.package_count AS truck_packages,
        CASE WHEN w.destination_node_id = w.sort_code AND w.origin_node_id LIKE 'ON_%' THEN 'direct' ELSE 'indirect' END
          AS triplet_type,
        CAST(triplet_shipment_count AS DOUBLE) / nullif(t.package_count, 0) * t.cbm AS triplet_cbm
      FROM (SELECT truck_id, origin_node_id, destination_node_id, sort_code, count(shipment_id) AS triplet_shipment_count
            FROM good_leg GROUP BY ALL) w JOIN good_run t ON t.truck_id = w.truck_id""",
    "triplet": """SELECT departure_month, origin_node_id, destination_node_id, sort_code, triplet_type,
        CAST(sum(triplet_shipment_count) AS BIGINT) AS monthly_triplet_packages, sum(triplet_cbm) AS monthly_triplet_cbm
      FROM truck_triplet GROUP BY ALL""",
    "hub_total": """SELECT destination_node_id AS hub_node_id, sort_code, departure_month,
        CAST(sum(monthly_triplet_packages) AS BIGINT) AS total_hub_dn_packages,
        sum(monthly_triplet_cbm) AS total_hub_dn_cbm FROM triplet WHERE triplet_type = 'indirect' GROUP BY ALL""",
    "prorated": """SELECT t.*, CASE WHEN triplet_type = 'indirect'
          THEN monthly_triplet_packages / total_hub_dn_packages * total_hub_dn_cbm ELSE monthly_triplet_cbm END
          AS adjusted_triplet_cbm
      FROM triplet t LEFT JOIN hub_total h ON h.hub_node_id = t.destination_node_id AND h.sort_code = t.sort_code
        AND h.departure_month = t.departure_month""",
    "routed": """SELECT p.*, a.distance_km AS distance1_km, a.o_type AS origin_node_type, a.o_country AS origin_node_country,
        a.d_type AS destination_node_type, a.d_country AS destination_node_country, b.distance_km AS direct_distance_km,
        c.distance_km AS distance2_km, m1.f AS leg1_avg_fixed_cost_eur, m1.k AS leg1_avg_cost_per_km_eur,
        m2.f AS leg2_avg_fixed_cost_eur, m2.k AS leg2_avg_cost_per_km_eur
      FROM prorated p JOIN distance a ON a.o = p.origin_node_id AND a.d = p.destination_node_id AND a.o_type = 'origin_node'
      LEFT JOIN distance b ON b.o = p.origin_node_id AND b.d = p.sort_code
      LEFT JOIN distance c ON c.o = p.destination_node_id AND c.d = p.sort_code
      LEFT JOIN mean_rate m1 ON m1.country = a.o_country LEFT JOIN mean_rate m2 ON m2.country = a.d_country""",
    "best_hub": """SELECT origin_node_id, sort_code, destination_node_id AS hub FROM (SELECT *, row_number() OVER (
          PARTITION BY origin_node_id, sort_code ORDER BY distance1_km, destination_node_id, departure_month) AS rn
        FROM routed WHERE destination_node_type = 'consolidation_hub') WHERE rn = 1""",
    "costed": """SELECT * EXCLUDE (part), part * current_monthly_costs AS current_monthly_cost_ratio,
        part * monthly_processing_costs AS processing_cost_ratio
      FROM (SELECT r.*, l.monthly_linehaul_cost_eur AS current_monthly_costs,
          CASE WHEN triplet_type = 'indirect' THEN CAST(h.cost_per_package_eur AS DOUBLE) * monthly_triplet_packages ELSE 0 END
            AS monthly_processing_costs,
          monthly_triplet_packages / sum(monthly_triplet_packages) OVER (
            PARTITION BY r.origin_node_id, r.destination_node_id, r.departure_month) AS part
        FROM routed r JOIN lane_month l ON l.origin_node_id = r.origin_node_id
          AND l.destination_node_id = r.destination_node_id AND l.departure_month = r.departure_month
        LEFT JOIN handling h ON h.node_id = r.destination_node_id AND h.quality_record <> 'critical')""",
    "simulated": advised("60", "90"),
    "compliant": f"""SELECT departure_date, origin_node_id, destination_node_id, node_capability, mtl_container_count,
        box_container_count,
        NOT (coalesce(node_capability = 'MTL' AND box_container_count > 0, FALSE)
          OR coalesce(node_capability = 'BOX' AND mtl_container_count > 0, FALSE)) AS is_compliant,
        CASE WHEN node_capability IN ('MTL', 'BOX') THEN
          {rnd("(CASE node_capability WHEN 'MTL' THEN mtl_container_count ELSE box_container_count END)"
               " / nullif(mtl_container_count + box_container_count, 0) * 100", 2)} END AS compliance_percentage,
        CASE node_capability WHEN 'MTL' THEN {rnd('box_container_count * cost_per_unit_eur', 2)} WHEN 'BOX' THEN 0.0
          END AS avoidable_cost
      FROM (SELECT CAST(t.departure_datetime AS DATE) AS departure_date, w.origin_node_id, w.destination_node_id,
          n.node_capability,
          count(DISTINCT CASE WHEN left(container_id, 3) = 'MTL' THEN container_id END) AS mtl_container_count,
          count(DISTINCT CASE WHEN left(container_id, 3) = 'BOX' THEN container_id END) AS box_container_count
        FROM good_leg w JOIN good_run t ON t.truck_id = w.truck_id AND t.origin_node_id = w.origin_node_id
          AND t.destination_node_id = w.destination_node_id
        LEFT JOIN good_node n ON n.node_id = w.destination_node_id GROUP BY ALL) c
      LEFT JOIN procurement p ON p.item = 'BOX_CONTAINER' AND p.quality_record <> 'critical'""",
    "timed": """SELECT CAST(t.departure_datetime AS DATE) AS departure_date, CAST(hour(t.departure_datetime) AS INT) AS departure_hour,
        t.origin_node_id, t.destination_node_id, t.carrier, t.transit_time_hours, c.configured_transit_time_hours
      FROM good_run t JOIN configured c USING (origin_node_id, destination_node_id) WHERE c.quality_record <> 'critical'""",
    "observed": "SELECT origin_node_id, destination_node_id, " + ", ".join(
        f"{rnd(f'quantile_cont(transit_time_hours, {q})', 2)} AS {p}" for p, q in QUANTILES.items())
        + " FROM good_run GROUP BY ALL",
    "threshold": f"""SELECT {rnd("quantile_cont(adjusted_triplet_cbm, 0.1) FILTER (triplet_type = 'direct')", 2)} AS thin_cbm,
        {rnd("quantile_cont(adjusted_triplet_cbm, 0.9) FILTER (triplet_type = 'indirect')", 2)} AS thick_cbm FROM prorated""",
    "leg_count": """SELECT shipment_id, count(*) AS legs,
        bool_or(coalesce(destination_node_id = sort_code AND origin_node_id LIKE 'ON_%', FALSE)) AS is_direct
      FROM wms WHERE shipment_id IS NOT NULL GROUP BY shipment_id""",
}


def doubles(columns: str, places: int = 4) -> str:
    return ", ".join(f"{rnd(c.strip(), places)} AS {c.strip()}" for c in columns.split(","))


def replace(relation: str, columns: str, places: int = 4) -> str:
    return f"SELECT * REPLACE ({doubles(columns, places)}) FROM {relation}"


SIM_KEYS = "departure_month, origin_node_id, destination_node_id, sort_code, triplet_type"
SIM_DOUBLES = ("distance1_km, distance2_km, direct_distance_km, adjusted_triplet_cbm, current_monthly_cost_ratio, "
               "monthly_triplet_cbm, processing_cost_ratio, leg1_avg_fixed_cost_eur, leg1_avg_cost_per_km_eur, "
               "leg2_avg_fixed_cost_eur, leg2_avg_cost_per_km_eur, current_monthly_costs, monthly_processing_costs, "
               "cost_of_recommended_design, cost_reduction")


def simulation(relation: str) -> str:
    return f"SELECT * EXCLUDE (origin_node_type, destination_node_type) REPLACE ({doubles(SIM_DOUBLES, 2)}) FROM {relation}"


RATED = "leg1_avg_fixed_cost_eur, leg1_avg_cost_per_km_eur, leg2_avg_fixed_cost_eur, leg2_avg_cost_per_km_eur"


def distribution(table: str, relation: str, flags: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{f}' AS flag, {f} AS label, count(*) AS row_count FROM {relation} GROUP BY {f}"
        for f in [*flags, "quality_record"])


NETWORK_FLAGS = ["node_quality_flag", "node_type_quality_flag", "city_quality_flag", "country_quality_flag",
                 "coordinates_quality_flag", "capabilities_quality_flag"]
TMS_FLAGS = [*TMS_CRITICAL, "carrier_integrity_quality_flag", "package_count_quality_flag", "cbm_quality_flag"]
WMS_FLAGS = [*WMS_CRITICAL, "container_integrity_quality_flag", "shipment_integrity_quality_flag"]


def orphan(table: str, relation: str, column: str, parent: str, key: str) -> str:
    return (f"SELECT '{table}' AS table_name, '{column}' AS column_name, {column} AS value, count(*) AS row_count "
            f"FROM {relation} c WHERE {column} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{key} = c.{column}) "
            f"GROUP BY {column}")


def repeated(table: str, relation: str, *keys: str) -> str:
    joined = " || '|' || ".join(f"coalesce({k}, 'NULL')" for k in keys)
    return (f"SELECT '{table}' AS table_name, {joined} AS key_value, count(*) AS row_count FROM {relation} "
            f"GROUP BY {', '.join(keys)} HAVING count(*) > 1")


def nearest(source: str, target: str, k: int, prefer: str = "FALSE") -> str:
    return f"""SELECT source_id, node_id, distance_km, rank FROM (
      SELECT a.node_id AS source_id, b.node_id, {km('a', 'b')} AS distance_km, CAST(row_number() OVER (
        PARTITION BY a.node_id ORDER BY {prefer}, {km('a', 'b')}, b.node_id) AS INT) AS rank
      FROM good_node a JOIN good_node b ON a.node_type = '{source}' AND b.node_type = '{target}') WHERE rank <= {k}"""


def compliance_rollup(keys: str, more: str = "") -> str:
    return f"""SELECT {keys}, count(*) AS lane_days, count(*) FILTER (is_compliant) AS compliant_days, {more}
      {rnd('sum(avoidable_cost)', 2)} AS avoidable_cost,
      {rnd('count(*) FILTER (is_compliant) / count(*)', 4)} AS compliant_share FROM compliant GROUP BY {keys}"""


QUERIES: dict[str, str] = {
    "safe_casts": f"""SELECT truck_id, {number_cast("nullif(trim(transit_time_hours), '')")} AS transit_time_hours,
      {number_cast("nullif(container_count, '')", 'BIGINT')} AS container_count,
      {number_cast("nullif(package_count, '')", 'BIGINT')} AS package_count,
      {number_cast("nullif(cbm, '')")} AS cbm FROM raw_tms""",
    "normalised_text": """SELECT upper(trim(node_id)) AS node_id, lower(trim(node_type)) AS node_type,
      nullif(trim(city), '') AS city, upper(trim(node_capability)) AS node_capability FROM raw_network""",
    "parsed_datetimes": f"""SELECT truck_id, departure_datetime AS departure_text,
      {datetime('departure_datetime')} AS departure_datetime, {datetime('arrival_datetime')} AS arrival_datetime FROM raw_tms""",
    "parsed_dates": f"SELECT shipment_id, order_date AS order_text, {date('order_date')} AS order_date FROM raw_wms",
    "parsed_booleans": """SELECT item, reusable AS reusable_text, CASE lower(trim(reusable)) WHEN 'yes' THEN TRUE
      WHEN 'true' THEN TRUE WHEN '1' THEN TRUE WHEN 'no' THEN FALSE WHEN 'false' THEN FALSE WHEN '0' THEN FALSE END
      AS reusable FROM raw_procurement""",
    "corrected_node_types": f"""SELECT node_id, lower(trim(node_type)) AS node_type_raw, {FIXED_TYPE} AS node_type,
      count(*) AS registrations FROM raw_network GROUP BY ALL""",
    "unscored_runs": """SELECT truck_id, origin_node_id, destination_node_id, carrier, departure_datetime,
      transit_time_hours, arrival_datetime, container_count, package_count, cbm FROM tms""",
    "imputed_carriers": "SELECT coalesce(carrier, 'UNKNOWN') AS carrier, count(*) AS runs FROM tms GROUP BY ALL",
    "usable_runs": "SELECT truck_id, origin_node_id, destination_node_id, carrier, quality_record FROM good_run",
    "id_formats": """SELECT coalesce(regexp_matches(shipment_id, '^SHP_[0-9]{9}$'), FALSE) AS good_shipment,
      coalesce(regexp_matches(truck_id, '^TRK_[0-9]{7}$'), FALSE) AS good_truck, origin_node_id LIKE 'ON_%' AS from_origin,
      count(*) AS legs FROM raw_wms GROUP BY ALL""",
    "costs_out_of_range": """SELECT country, carrier, fixed_cost_eur, cost_per_km_eur FROM rates
      WHERE fixed_cost_eur < 200 OR fixed_cost_eur > 500 OR cost_per_km_eur < 0.5 OR cost_per_km_eur > 5
        OR country NOT IN ('FR', 'DE', 'ES', 'IT', 'NL', 'BE', 'PL', 'CZ')""",
    "carriers_without_rate": """SELECT trim(carrier) AS carrier, trim(carrier) NOT IN (
        SELECT carrier FROM rates WHERE quality_record <> 'critical') AS no_rate, count(*) AS runs FROM raw_tms GROUP BY ALL""",
    "first_registrations": first("raw_network", "mdm_network", "node_id").replace("AS copies", "AS registrations"),
    "first_rates": first("raw_rates", "fin_transport_rates", "country, carrier"),
    "first_runs": first("raw_tms", "tms_transportation", "truck_id"),
    "first_legs": first("raw_wms", "wms_shipment_details", "shipment_id, truck_id"),
    "repeated_legs": """SELECT trim(shipment_id) AS shipment_id, trim(truck_id) AS truck_id, count(*) AS copies
      FROM raw_wms GROUP BY ALL HAVING count(*) > 1""",
    "latest_run_per_lane": """SELECT origin_node_id, destination_node_id, departure_datetime, truck_id, carrier, transit_time_hours
      FROM good_run QUALIFY row_number() OVER (PARTITION BY origin_node_id, destination_node_id
        ORDER BY departure_datetime DESC, truck_id DESC) = 1""",
    "load_status": " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, 'OK' AS status, count(*) AS row_count, 0 AS bad_records FROM raw_{name}"
        for name, table in EXTRACTS.items()),
    "loaded_runs": as_loaded("tms_transportation", "raw_tms"),
    "quoted_records": """SELECT item, cost_per_unit_eur, reusable,
      description || chr(10) || '"' || coalesce(item, 'none') || '",' || chr(10) || chr(10) || reusable AS description
      FROM raw_procurement""",
    "replaced_runs": """SELECT coalesce(carrier, 'none') AS carrier, count(*) AS runs,
      count(*) FILTER (quality_record <> 'critical') AS usable_runs FROM tms GROUP BY ALL""",
    "appended_legs": as_loaded("wms_shipment_details", "raw_wms"),
    "distinct_lane_carriers": """SELECT DISTINCT origin_node_id, destination_node_id, coalesce(carrier, 'UNKNOWN') AS carrier
      FROM good_run""",
    "silver_network": "SELECT * FROM network",
    "silver_rates": "SELECT * FROM rates",
    "silver_handling": "SELECT * FROM handling",
    "silver_procurement": "SELECT * FROM procurement",
    "silver_configured": "SELECT * FROM configured",
    "silver_tms": "SELECT * FROM tms",
    "silver_wms": "SELECT * FROM wms",
    "silver_network_upper_country": network_sql("upper(country)"),
    "silver_tms_contract_score": """SELECT cbm_quality_flag, CASE WHEN cbm_quality_flag <> 'ok' THEN 'critical'
      ELSE quality_record END AS quality_record, count(*) AS runs FROM tms GROUP BY ALL""",
    "quality_distribution": " UNION ALL ".join([
        distribution("mdm_network", "network", NETWORK_FLAGS),
        distribution("fin_transport_rates", "rates", RATE_FLAGS),
        distribution("fin_handling_costs", "handling", ["node_integrity_quality_flag", "cost_quality_flag"]),
        distribution("fin_procurement", "procurement",
                     ["item_quality_flag", "cost_per_unit_quality_flag", "reusable_quality_flag"]),
        distribution("mdm_configured_transit_times", "configured", CONFIGURED_FLAGS),
        distribution("tms_transportation", "tms", TMS_FLAGS),
        distribution("wms_shipment_details", "wms", WMS_FLAGS)]),
    "lane_distances": """SELECT o AS origin_node, o_country AS origin_node_country, o_type AS origin_node_type,
      d AS destination_node, d_country AS destination_node_country, d_type AS destination_node_type, distance_km
      FROM distance WHERE (o, d) IN (SELECT (origin_node_id, destination_node_id) FROM tms UNION
        SELECT (origin_node_id, sort_code) FROM wms)""",
    "nearest_hubs": nearest("delivery_node", "consolidation_hub", 3),
    "nearest_hubs_by_cells": nearest("delivery_node", "consolidation_hub", 3),
    "all_hub_distances": nearest("delivery_node", "consolidation_hub", 1_000_000),
    "hub_coverage_by_distance": nearest("consolidation_hub", "delivery_node", 10, "a.country <> b.country"),
    "daily_actuals": f"""SELECT CAST(departure_datetime AS DATE) AS departure_date, origin_node_id, destination_node_id,
      coalesce(carrier, 'UNKNOWN') AS carrier, count(truck_id) AS daily_trucks,
      CAST(sum(package_count) AS BIGINT) AS daily_packages, {rnd('sum(cbm)', 4)} AS daily_cbm FROM good_run GROUP BY ALL""",
    "average_rates": f"SELECT country, {rnd('f', 4)} AS avg_fixed_cost, {rnd('k', 4)} AS avg_cost_per_km FROM mean_rate",
    "run_endpoints": """SELECT t.truck_id, t.origin_node_id, t.destination_node_id,
      a.node_type AS origin_node_type, a.country AS origin_node_country, a.latitude AS origin_node_latitude,
      a.longitude AS origin_node_longitude, b.node_type AS destination_node_type, b.country AS destination_node_country,
      b.latitude AS destination_node_latitude, b.longitude AS destination_node_longitude
      FROM good_run t JOIN good_node a ON a.node_id = t.origin_node_id JOIN good_node b ON b.node_id = t.destination_node_id""",
    "lane_calendar": """SELECT date, origin_node_id, destination_node_id FROM calendar
      CROSS JOIN (SELECT DISTINCT origin_node_id, destination_node_id FROM good_run)""",
    "lane_days_filled": replace("lane_day", "daily_cbm"),
    "linehaul_costs": f"""SELECT date, origin_node_id, destination_node_id, carrier, {rnd('cost', 4)} AS daily_linehaul_cost_eur,
      cost_is_imputed FROM priced""",
    "lane_daily_fact": replace("daily", "daily_cbm"),
    "clustered_lane_daily": replace("daily", "daily_cbm"),
    "truck_triplets": replace("truck_triplet", "triplet_cbm, truck_cbm"),
    "monthly_triplets": replace("triplet", "monthly_triplet_cbm"),
    "hub_totals": replace("hub_total", "total_hub_dn_cbm"),
    "prorated_triplets": replace("prorated", "monthly_triplet_cbm, adjusted_triplet_cbm"),
    "enriched_triplets": replace("routed", f"monthly_triplet_cbm, adjusted_triplet_cbm, {RATED}"),
    "nearest_connected_hubs": """SELECT DISTINCT r.origin_node_id, r.sort_code, b.hub AS hub_node_id FROM routed r
      LEFT JOIN best_hub b ON b.origin_node_id = r.origin_node_id AND b.sort_code = r.sort_code""",
    "monthly_lane_costs": replace("lane_month", "monthly_linehaul_cost_eur, monthly_cbm", 2),
    "triplet_costs": f"""SELECT {SIM_KEYS}, {doubles('current_monthly_costs, current_monthly_cost_ratio, '
      'monthly_processing_costs, processing_cost_ratio', 2)} FROM costed""",
    "lane_categories": """SELECT triplet_type, CASE WHEN triplet_type = 'indirect' AND adjusted_triplet_cbm > 90 THEN 'thick'
      WHEN triplet_type = 'direct' AND adjusted_triplet_cbm < 60 THEN 'thin' ELSE 'healthy' END AS category,
      count(*) AS triplets FROM prorated GROUP BY ALL""",
    "calibrated_categories": """SELECT triplet_type, CASE WHEN triplet_type = 'indirect' AND adjusted_triplet_cbm > thick_cbm
      THEN 'thick' WHEN triplet_type = 'direct' AND adjusted_triplet_cbm < thin_cbm THEN 'thin' ELSE 'healthy' END AS category,
      count(*) AS triplets FROM prorated CROSS JOIN threshold GROUP BY ALL""",
    "lane_simulation": simulation("simulated"),
    "lane_simulation_default_thresholds": simulation(f"({advised('138', '322')})"),
    "lane_simulation_hub_leg": simulation(f"({advised('60', '90', True)})"),
    "container_counts": """SELECT departure_date, origin_node_id, destination_node_id, mtl_container_count,
      box_container_count FROM compliant""",
    "container_compliance": "SELECT * FROM compliant",
    "transit_time": "SELECT * FROM timed",
    "transit_percentiles": "SELECT * FROM observed",
    "transit_percentiles_from_sketches": "SELECT origin_node_id, destination_node_id, count(transit_time_hours) AS runs, "
      + ", ".join(f"TRUE AS {p}_within" for p in QUANTILES) + " FROM good_run WHERE transit_time_hours IS NOT NULL GROUP BY ALL",
    "transit_drift": f"""SELECT *, p95_transit_time_hours > configured_transit_time_hours AS is_drifting FROM (
      SELECT origin_node_id, destination_node_id, carrier, configured_transit_time_hours, count(*) AS runs,
        {rnd('quantile_cont(transit_time_hours, 0.95)', 2)} AS p95_transit_time_hours FROM timed GROUP BY ALL)""",
    "configuration_status": """SELECT o.*, configured_transit_time_hours, CASE WHEN configured_transit_time_hours < p90
      THEN 'under_configured' WHEN configured_transit_time_hours > p98 + 3 THEN 'over_configured' ELSE 'correct' END
      AS configuration_status FROM observed o JOIN configured c USING (origin_node_id, destination_node_id)
      WHERE c.quality_record <> 'critical'""",
    "audit_package_count": """SELECT t.truck_id, package_count, coalesce(n, 0) AS shipment_legs FROM tms t
      LEFT JOIN (SELECT truck_id, count(shipment_id) AS n FROM wms GROUP BY truck_id) w ON w.truck_id = t.truck_id
      WHERE package_count <> coalesce(n, 0)""",
    "audit_capacity": "SELECT truck_id, container_count, cbm FROM tms WHERE cbm > container_count",
    "audit_truck_lane": """SELECT truck_id, count(DISTINCT origin_node_id) AS origins,
      count(DISTINCT destination_node_id) AS destinations FROM wms WHERE truck_id IS NOT NULL GROUP BY truck_id
      HAVING count(DISTINCT origin_node_id) > 1 OR count(DISTINCT destination_node_id) > 1""",
    "audit_final_stop": """SELECT shipment_id, truck_id, destination_node_id, sort_code FROM (
        SELECT w.*, row_number() OVER (PARTITION BY shipment_id ORDER BY departure_datetime DESC NULLS LAST,
          w.truck_id DESC, w.destination_node_id DESC NULLS LAST, sort_code DESC NULLS LAST) AS rn
        FROM wms w JOIN tms t ON t.truck_id = w.truck_id WHERE shipment_id IS NOT NULL)
      WHERE rn = 1 AND destination_node_id <> sort_code""",
    "audit_direct_legs": "SELECT *, 'direct_has_one_leg' AS rule FROM leg_count WHERE is_direct AND legs <> 1",
    "audit_indirect_legs": "SELECT *, 'indirect_has_two_legs' AS rule FROM leg_count WHERE NOT is_direct AND legs <> 2",
    "audit_path_types": """SELECT origin_node_id, sort_code, count(*) FILTER (destination_node_id = sort_code) AS direct_legs,
      count(*) FILTER (destination_node_id <> sort_code) AS indirect_legs FROM wms
      WHERE starts_with(origin_node_id, 'ON_') AND sort_code IS NOT NULL GROUP BY ALL
      HAVING count(DISTINCT destination_node_id = sort_code) > 1""",
    "audit_hub_containers": """SELECT i.hub AS hub_node_id, i.container_id, i.n AS inbound_legs, o.n AS outbound_legs
      FROM (SELECT destination_node_id AS hub, container_id, count(*) AS n FROM wms
            WHERE starts_with(destination_node_id, 'CH_') GROUP BY ALL) i
      JOIN (SELECT origin_node_id AS hub, container_id, count(*) AS n FROM wms
            WHERE starts_with(origin_node_id, 'CH_') GROUP BY ALL) o ON o.hub = i.hub AND o.container_id = i.container_id""",
    "audit_foreign_keys": " UNION ALL ".join([
        *[orphan("tms_transportation", "tms", c, "network", "node_id") for c in ("origin_node_id", "destination_node_id")],
        *[orphan("wms_shipment_details", "wms", c, "network", "node_id")
          for c in ("origin_node_id", "destination_node_id", "sort_code")],
        orphan("wms_shipment_details", "wms", "truck_id", "tms", "truck_id"),
        orphan("fin_handling_costs", "handling", "node_id", "network", "node_id")]),
    "audit_unreachable_nodes": """SELECT node_id, city, country FROM network WHERE node_type = 'delivery_node'
      AND node_id NOT IN (SELECT destination_node_id FROM run_lane)""",
    "audit_container_count": """SELECT t.truck_id, container_count, coalesce(n, 0) AS containers_seen FROM tms t
      LEFT JOIN (SELECT truck_id, count(DISTINCT container_id) AS n FROM wms GROUP BY truck_id) w ON w.truck_id = t.truck_id
      WHERE container_count <> coalesce(n, 0)""",
    "audit_primary_keys": " UNION ALL ".join([
        repeated("mdm_network", "network", "node_id"),
        repeated("fin_transport_rates", "rates", "country", "carrier"),
        repeated("fin_handling_costs", "handling", "node_id"),
        repeated("fin_procurement", "procurement", "item"),
        repeated("mdm_configured_transit_times", "configured", "origin_node_id", "destination_node_id"),
        repeated("wms_shipment_details", "wms", "shipment_id", "truck_id"),
        repeated("tms_transportation", "tms", "truck_id")]),
    "compliance_by_lane": compliance_rollup(
        "origin_node_id, destination_node_id",
        "CAST(sum(mtl_container_count) AS BIGINT) AS mtl_containers, CAST(sum(box_container_count) AS BIGINT) AS box_containers,"),
    "compliance_by_origin": compliance_rollup("origin_node_id"),
    "savings_summary": f"""SELECT category, departure_month, count(*) AS triplets,
      {rnd('sum(current_monthly_cost_ratio)', 2)} AS current_cost, {rnd('sum(cost_of_recommended_design)', 2)} AS recommended_cost,
      {rnd('sum(cost_reduction)', 2)} AS saving, count(*) FILTER (cost_reduction < 0) AS non_actionable
      FROM simulated GROUP BY ALL""",
    "ranked_interventions": f"""SELECT departure_month, origin_node_id, destination_node_id, sort_code, category, recommended_hub,
      {rnd('cost_reduction', 2)} AS cost_reduction FROM simulated WHERE cost_reduction IS NOT NULL
      ORDER BY {rnd('cost_reduction', 2)} DESC, departure_month, origin_node_id, destination_node_id, sort_code LIMIT 50""",
    "on_time_share": f"""SELECT leg_type, count(*) AS trucks, count(*) FILTER (hour(arrival_datetime) < 10) AS on_time,
      {rnd('count(*) FILTER (hour(arrival_datetime) < 10) / count(*)', 4)} AS on_time_share
      FROM (SELECT *, {LEG} AS leg_type FROM tms) WHERE leg_type IN ('direct', 'indirect_leg2')
        AND arrival_datetime IS NOT NULL GROUP BY leg_type""",
    "departure_window_share": f"""SELECT *, {rnd('in_window / trucks', 4)} AS in_window_share FROM (
      SELECT origin_node_id AS hub_node_id, count(*) AS trucks,
        count(*) FILTER (hour(departure_datetime) NOT BETWEEN 6 AND 21) AS in_window
      FROM tms WHERE {LEG} = 'indirect_leg2' AND departure_datetime IS NOT NULL GROUP BY origin_node_id)""",
    "container_bands": f"""SELECT band, n AS trucks, {rnd('n / sum(n) OVER ()', 4)} AS share FROM (
      SELECT CASE WHEN container_count BETWEEN 1 AND 9 THEN 'light' WHEN container_count BETWEEN 10 AND 25 THEN 'mid'
        WHEN container_count BETWEEN 26 AND 29 THEN 'heavy' WHEN container_count BETWEEN 30 AND 32 THEN 'peak' END AS band,
        count(*) AS n FROM tms GROUP BY ALL) WHERE band IS NOT NULL""",
    "fill_rate": f"""SELECT {LEG} AS leg_type, count(*) AS trucks, {rnd('avg(cbm / container_count)', 4)} AS avg_fill_rate
      FROM tms WHERE container_count > 0 GROUP BY ALL""",
    "lane_leg_types": f"""SELECT origin_node_id, destination_node_id, count(*) AS runs, {LEG} AS leg_type FROM tms GROUP BY ALL""",
    "hub_coverage": f"""SELECT DISTINCT origin_node_id AS hub_node_id, destination_node_id AS delivery_node_id FROM tms
      WHERE {LEG} = 'indirect_leg2'""",
    "calibrated_thresholds": "SELECT * FROM threshold",
    "cross_border_lanes": """SELECT DISTINCT origin_node_id, destination_node_id, origin_node_country AS origin_country,
      destination_node_country AS destination_country,
      upper(origin_node_country) IS DISTINCT FROM upper(destination_node_country) AS is_cross_border FROM run_lane""",
    "transit_delay": f"""SELECT origin_node_id, destination_node_id, count(*) AS runs, distance_km,
      {rnd('distance_km / 80', 4)} AS expected_transit_hours,
      {rnd('avg(transit_time_hours) - any_value(distance_km) / 80', 4)} AS avg_delay_hours
      FROM (SELECT l.*, t.transit_time_hours FROM run_lane l JOIN good_run t USING (truck_id)) GROUP BY ALL""",
}


def nulls(table: str, column: str) -> str:
    return f"(SELECT count(*) FILTER ({column} IS NULL) FROM {table})"


def schema_differences() -> str:
    """One row for each column whose type is not that of the raw text, and for each column that scoring adds."""
    out = []
    for short, name in EXTRACTS.items():
        head = f"SELECT '{name}' AS table_name"
        for f in CONTRACT[name]:
            kind = f.dataType.simpleString()
            if f.name in FEEDS[name].columns and kind != "string":
                out.append(f"{head}, '{f.name}' AS column_name, 'retyped' AS change, 'string' AS before, '{kind}' AS after, "
                           f"TRUE AS is_breaking, {nulls('raw_' + short, f.name)} AS nulls_before, {nulls(short, f.name)} AS nulls_after")
        out += [f"{head}, '{c}' AS column_name, 'added' AS change, NULL AS before, 'string' AS after, FALSE AS is_breaking, "
                f"CAST(NULL AS BIGINT) AS nulls_before, {nulls(short, c)} AS nulls_after" for c in (*FLAGS[name], "quality_record")]
    return " UNION ALL ".join(out)


def contract_profile() -> str:
    """Counts per declared column; the types are those the contract declares."""
    relations = {name: short for short, name in EXTRACTS.items()} | {
        "fact_lane_daily": "daily", "fact_lane_simulation": "simulated", "fact_container_compliance": "compliant",
        "fact_transit_time": "timed"}
    out = []
    for name, (schema, keys) in declared().items():
        for f in schema:
            labels = (f"(SELECT coalesce(string_agg(v, ',' ORDER BY v), '') FROM (SELECT DISTINCT {f.name} AS v FROM {relations[name]}))"
                      if f.name.endswith("_flag") or f.name == "quality_record" else "CAST(NULL AS VARCHAR)")
            place = keys.index(f.name) + 1 if f.name in keys else "CAST(NULL AS INTEGER)"
            out.append(f"SELECT '{name}' AS table_name, '{f.name}' AS column_name, '{f.dataType.simpleString()}' AS data_type, "
                       f"{place} AS key_position, (SELECT count(*) FROM {relations[name]}) AS row_count, "
                       f"{nulls(relations[name], f.name)} AS null_count, {labels} AS flag_values")
    return " UNION ALL ".join(out)


QUERIES |= {
    "schema_differences": schema_differences(),
    "contract_profile": contract_profile(),
    "incremental_legs": QUERIES["silver_wms"],
    **{f"{name}_by_bucket": QUERIES[name] for name in ("truck_triplets", "container_counts", "audit_package_count")},
}


def trimmed(sql: str) -> str:
    """``trim`` in these statements takes off white space of any kind, which DuckDB's own does not."""
    return re.sub(r"\btrim\(((?:[^()]|\([^()]*\))*)\)",
                  r"regexp_replace(\1, '^[\\s\\x0B\\x{85}\\p{Z}]+|[\\s\\x0B\\x{85}\\p{Z}]+$', '', 'g')", sql)


def oracle_queries() -> dict[str, str]:
    library = {**FEED_SQL, **{name: trimmed(body) for name, body in RELATIONS.items()}}
    out = {}
    for name, body in QUERIES.items():
        needed = {**library, "_final": trimmed(body)}
        out[name] = with_clause(["_final"], needed, "MATERIALIZED") + "\nSELECT * FROM _final"
    return out
