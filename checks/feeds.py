"""Raw logistics extracts derived from the driver's tables.

Each feed is one SELECT over ``orders``, ``lineitem``, ``customer``, ``supplier``, ``part``,
``nation`` and ``region`` in the SQL that Spark and DuckDB share, so both engines start from the
same all-text rows.  Every table is read whole and each feed grows with its source:

* truck runs       one per order; orders 3n+1 and 3n+2 are the two legs of one indirect route
* shipment legs    one per line item; the two legs of a route share their shipment ids
* network          one registration per customer and supplier, so node ids repeat heavily
* rates, items     one row per part (only the first parts name real countries and carriers)
* handling         one row per supplier
* configured times one row per lane driven, plus one odd row per nation

Defects (bad dates, unknown carriers, late orders, copies, ...) are placed by key arithmetic.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

#: Feed and extract it stands for.
EXTRACTS = {
    "network": "mdm_network", "rates": "fin_transport_rates", "handling": "fin_handling_costs",
    "procurement": "fin_procurement", "configured": "mdm_configured_transit_times", "tms": "tms_transportation",
    "wms": "wms_shipment_details"}


def letter(n: str) -> str:
    return f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ', CAST({n} AS INT) + 1, 1)"


def node(prefix: str, n: str) -> str:
    return f"'{prefix}_A' || {letter(n)}"


def text(n: str, width: int = 0) -> str:
    cast = f"CAST({n} AS STRING)"
    return f"lpad({cast}, {width}, '0')" if width else cast


def div(a: str, b: int) -> str:
    return f"CAST(floor(({a}) / {b}) AS INT)"


def pick(n: str, values: list[str]) -> str:
    branches = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values[:-1]))
    return f"(CASE CAST({n} AS INT) {branches} ELSE '{values[-1]}' END)"


def day_text(n: str) -> str:
    return f"CAST(DATE '2025-07-01' + CAST({n} AS INT) AS STRING)"


def day_first(iso: str) -> str:
    return f"substr({iso}, 9, 2) || '/' || substr({iso}, 6, 2) || '/' || substr({iso}, 1, 4)"


def clock(minutes: str) -> str:
    return f"{text(div(f'({minutes}) % 1440', 60), 2)} || ':' || {text(f'({minutes}) % 60', 2)} || ':00'"


COUNTRIES = ["FR", "DE", "ES", "IT", "NL", "BE", "PL", "CZ"]
CARRIERS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def registration(prefix: str, kind: str, k: str, shift: str, city_pad: str) -> str:
    """SELECT list of one node registration; ``k`` numbers the node within its kind."""
    country = pick(f"{k} % 8", COUNTRIES)
    return f"""{node(prefix, k)} AS node_id, {kind} AS node_type,
      'City ' || {text(k)} || {city_pad} AS city,
      CASE WHEN {k} % 9 = 4 THEN lower({country}) ELSE {country} END AS country,
      CASE WHEN '{prefix}' = 'DN' AND {k} = 11 THEN ' ' WHEN '{prefix}' = 'DN' AND {k} = 19 THEN '34.9'
           ELSE {text(f'36 + (7 * {k}) % 35')} || '{shift}' END AS latitude,
      {text(f'-9 + (11 * {k}) % 48')} || '{shift}' AS longitude,
      CASE WHEN '{prefix}' = 'DN' AND {k} = 13 THEN 'X' WHEN '{prefix}' = 'DN' AND {k} = 17 THEN NULL
           ELSE {pick(f'{k} % 3', ['MTL', 'BOX', ' all'])} END AS node_capability"""


_delivery = "CASE WHEN n.n_nationkey = 7 THEN 'delivry_node' ELSE 'delivery_node' END"
_typo = "CASE WHEN c.c_custkey % 97 = 3 OR c.c_nationkey = 7 THEN 'delivry_node' ELSE 'Delivery_Node ' END"

# minutes since the start of the departure day
_depart = "CASE WHEN leg = 2 THEN ((22 + k % 8) % 24) * 60 ELSE ((5 * k) % 24) * 60 END + (k % 4) * 15"
_transit = "60 + 15 * ((7 * k) % 150)"
_cbm = "CASE WHEN k % 200 = 77 THEN 130 ELSE 60 + (3 * k) % 40 END * containers"
_origin = f"CASE WHEN leg = 2 THEN {node('CH', 'rk')} ELSE {node('ON', 'base % 5')} END"
_destination = f"CASE WHEN leg = 1 THEN {node('CH', 'rk')} ELSE {node('DN', 'nk')} END"
_line = "(10 * r.k + l.l_linenumber)"
# containers are named by the truck they first ride on; some go on from the hub with the second truck
_container_truck = f"CASE WHEN {_line} % 20 = 3 THEN r.base ELSE r.k END"
_order_day = f"r.day - 1 - l.l_linenumber + CASE WHEN {_line} % 200 = 9 THEN 20 ELSE 0 END"

SQL: dict[str, str] = {
    "route": f"""
      SELECT o.o_orderkey AS k, o.o_orderkey % 3 AS leg, b.o_orderkey AS base, c.c_nationkey AS nk,
        n.n_regionkey AS rk, o.o_orderpriority AS priority,
        CAST(extract(doy FROM b.o_orderdate) AS INT) % 186 - 1
          + CASE WHEN o.o_orderkey % 3 = 2 THEN 1 ELSE 0 END AS day
      FROM orders o
      JOIN orders b ON b.o_orderkey = o.o_orderkey - CASE WHEN o.o_orderkey % 3 = 2 THEN 1 ELSE 0 END
      JOIN customer c ON c.c_custkey = b.o_custkey
      JOIN nation n ON n.n_nationkey = c.c_nationkey""",
    "run": f"""
      SELECT k, leg, base, nk, rk, priority, day, {_depart} AS depart, {_transit} AS transit,
        CASE WHEN k % 1100 = 9 THEN 33 WHEN k % 1300 = 11 THEN 0 ELSE 1 + k % 32 END AS containers,
        {_origin} AS origin, {_destination} AS destination
      FROM route""",
    "load": "SELECT l_orderkey AS lk, count(DISTINCT l_linenumber) AS lines FROM lineitem GROUP BY l_orderkey",
    "raw_tms": f"""
      SELECT CASE WHEN k % 4000 = 3999 THEN 'TRUCK-' || {text('k', 7)} WHEN k % 5000 = 4998 THEN NULL
                  ELSE 'TRK_' || {text('k', 7)} END AS truck_id,
        CASE WHEN k % 800 = 81 THEN 'ON_ZZ' WHEN k % 400 = 82 THEN lower(origin) || ' ' WHEN k % 400 = 182 THEN origin || chr(13)
             WHEN k % 1600 = 83 THEN NULL ELSE origin END AS origin_node_id,
        CASE WHEN k % 900 = 91 THEN 'ON_AA' ELSE destination END AS destination_node_id,
        CASE WHEN k % 100 = 42 THEN NULL WHEN k % 777 = 5 THEN 'GHOST LINE'
             WHEN k % 50 = 3 THEN priority || ' ' WHEN k % 50 = 13 THEN priority || chr(9)
                  WHEN k % 50 = 23 THEN chr(160) || priority ELSE priority END AS carrier,
        CASE WHEN k % 2000 = 8 THEN NULL WHEN k % 900 = 33 THEN 'soon'
             WHEN k % 300 = 17 THEN {day_first(day_text('day'))} || ' ' || {clock('depart')}
             ELSE {day_text('day')} || ' ' || {clock('depart')} END AS departure_datetime,
        CASE WHEN k % 1500 = 100 THEN '-2.0' WHEN k % 1500 = 101 THEN ' '
             ELSE {text(div('transit', 60))} || {pick(div('transit % 60', 15), ['.0', '.25', '.5', '.75'])}
             END AS transit_time_hours,
        CASE WHEN k % 700 = 60 THEN {day_text('day')} || ' ' || {clock('depart')}
             WHEN k % 1400 = 61 THEN '2025-13-45 00:00:00'
             ELSE {day_text('day + ' + div('depart + transit', 1440))} || ' ' || {clock('depart + transit')}
             END AS arrival_datetime,
        CASE WHEN k % 1700 = 13 THEN NULL ELSE {text('containers')} END AS container_count,
        {text('coalesce(lines, 0) + CASE WHEN k % 50 = 7 THEN 1 ELSE 0 END')} AS package_count,
        CASE WHEN k % 1900 = 14 THEN '' ELSE {text(div(_cbm, 100))} || '.' || {text(f'({_cbm}) % 100', 2)} END AS cbm
      FROM (SELECT * FROM run UNION ALL SELECT * FROM run WHERE k % 1000 = 500) x LEFT JOIN load ON lk = k""",
    "raw_wms": f"""
      SELECT CASE WHEN {_line} % 2000 = 5 THEN NULL WHEN {_line} % 40 = 6 AND l.l_partkey % 2 = 0 THEN ' ' ELSE '' END
          || 'SHP_' || {text('10 * r.base + l.l_linenumber', 9)} AS shipment_id,
        CASE WHEN {_line} % 3000 = 15 THEN NULL ELSE 'TRK_' || {text('r.k', 7)} END AS truck_id,
        CASE WHEN {_line} % 300 = 7 THEN 'M-' WHEN l.l_returnflag = 'R' THEN 'BOX_' ELSE 'MTL_' END
          || 'TRK_' || {text(_container_truck, 7)} || '_' || {text('l.l_linenumber', 3)} AS container_id,
        CASE WHEN {_line} % 1000 = 13 THEN 'n/a' WHEN {_line} % 150 = 11 THEN {day_first(day_text(_order_day))}
             ELSE {day_text(_order_day)} END AS order_date,
        CASE WHEN {_line} % 500 = 21 THEN 'ON_ZZ' ELSE r.origin END AS origin_node_id,
        r.destination AS destination_node_id,
        CASE WHEN {_line} % 100 = 3 THEN NULL WHEN {_line} % 250 = 4 THEN {node('CH', 'r.rk')}
             WHEN {_line} % 2500 = 24 THEN 'DN_ZZ' ELSE {node('DN', 'r.nk')} END AS sort_code
      FROM lineitem l JOIN run r ON r.k = l.l_orderkey""",
    "raw_network": f"""
      SELECT {registration('DN', _delivery, 'n.n_nationkey', '.25', "''")} FROM nation n
      UNION ALL SELECT {registration('ON', "'origin_node'", 'n.n_nationkey', '.5', "''")} FROM nation n
        WHERE n.n_nationkey < 5
      UNION ALL SELECT {registration('CH', "'consolidation_hub'", 'r.r_regionkey', '.75', "''")} FROM region r
      UNION ALL SELECT {registration('DN', _typo, 'c.c_nationkey', '.25', "' '")} FROM customer c
      UNION ALL SELECT {registration('ON', "'origin_node'", '(s.s_nationkey % 5)', '.5', "'  '")} FROM supplier s
      UNION ALL SELECT 'XX_' || {letter('s.s_suppkey % 26')} || {letter('s.s_suppkey % 7')}, 'depot', ' ', 'FRA',
        '48.5', '2.5', 'MTL' FROM supplier s""",
    "raw_rates": f"""
      SELECT CASE WHEN p_partkey = 40 THEN 'IT' WHEN p_partkey < 40 THEN {pick('p_partkey % 8', COUNTRIES)}
                  WHEN p_partkey % 5 = 0 THEN 'FRA' ELSE lower('X' || {letter('p_partkey % 26')}) END AS country,
        CASE WHEN p_partkey = 40 THEN '3-MEDIUM' WHEN p_partkey = 14 THEN ' 2-HIGH'
             WHEN p_partkey < 40 THEN {pick(div('p_partkey', 8), CARRIERS)}
             WHEN p_partkey % 31 = 0 THEN NULL ELSE 'LOCAL ' || {text('p_partkey')} END AS carrier,
        CASE WHEN p_partkey = 3 THEN '-250.0' WHEN p_partkey = 27 THEN '500.01' WHEN p_partkey = 33 THEN '199.99'
             WHEN p_partkey = 0 THEN '200' WHEN p_partkey = 1 THEN '500'
             ELSE {text('210 + (17 * p_partkey) % 280')} || '.5' END AS fixed_cost_eur,
        CASE WHEN p_partkey = 9 THEN '' WHEN p_partkey % 47 = 46 THEN 'n/a'
             WHEN p_partkey % 47 = 45 THEN '1.2d' WHEN p_partkey % 47 = 44 THEN '1e1' WHEN p_partkey % 47 = 43 THEN '0x1p1'
             ELSE '1.' || {text('(13 * p_partkey) % 90 + 10')} END AS cost_per_km_eur
      FROM part""",
    "raw_handling": f"""
      SELECT CASE WHEN s_suppkey < 5 THEN lower({node('CH', 's_suppkey')}) || ' '
                  WHEN s_suppkey % 3 = 0 THEN 'CH_ZZ' WHEN s_suppkey % 3 = 1 THEN {node('DN', 's_nationkey')}
                  ELSE 'CH_Q' || {letter('s_suppkey % 26')} END AS node_id,
        CASE WHEN s_suppkey = 2 THEN '2.75' WHEN s_suppkey = 4 THEN '' WHEN s_suppkey % 11 = 9 THEN '0'
             WHEN s_suppkey % 13 = 6 THEN 'free' ELSE '1.' || {text('(7 * s_suppkey) % 90 + 10')} END
             AS cost_per_package_eur
      FROM supplier""",
    "raw_procurement": f"""
      SELECT CASE WHEN p_partkey = 0 THEN ' box_container' WHEN p_partkey = 1 THEN 'mtl_container'
                  WHEN p_partkey % 400 = 199 THEN NULL ELSE 'part_' || {text('p_partkey')} END AS item,
        CASE WHEN p_partkey = 0 THEN '12.35' WHEN p_partkey % 90 = 7 THEN '0' WHEN p_partkey % 90 = 8 THEN 'ask'
             ELSE {text('5 + p_size')} || '.5' END AS cost_per_unit_eur,
        {pick('p_partkey % 6', ['no', 'Yes', 'TRUE ', '0', '1', 'maybe'])} AS reusable,
        p_name AS description
      FROM part""",
    "raw_configured": f"""
      SELECT origin AS origin_node_id, destination AS destination_node_id,
        {text('6 + count(*) % 37')} || '.5' AS configured_transit_time_hours,
        {pick('count(*) % 3', ['correct', 'under_configured', 'over_configured'])} AS configuration_type
      FROM run GROUP BY origin, destination
      UNION ALL
      SELECT CASE WHEN n_nationkey % 5 = 0 THEN NULL WHEN n_nationkey % 5 = 1 THEN 'ON_ZZ'
                  WHEN n_nationkey % 5 = 2 THEN {node('DN', 'n_nationkey')}
                  WHEN n_nationkey % 5 = 3 THEN 'XX_BB' ELSE 'ON_AA' END,
        CASE WHEN n_nationkey % 7 = 0 THEN NULL WHEN n_nationkey % 7 = 1 THEN 'DN_ZZ'
             WHEN n_nationkey % 7 = 2 THEN 'XX_BB' ELSE 'ON_AB' END,
        CASE WHEN n_nationkey % 4 = 0 THEN '0' WHEN n_nationkey % 4 = 1 THEN NULL ELSE '12' END, 'odd'
      FROM nation""",
}


def with_clause(names: list[str], library: dict[str, str], materialize: str = "") -> str:
    """Common table expressions for ``names`` and all they refer to, in dependency order."""
    done: dict[str, str] = {}

    def add(name: str) -> None:
        if name in done:
            return
        for other in library:
            if other != name and re.search(rf"\b{other}\b", library[name]):
                add(other)
        done[name] = library[name]

    for name in names:
        add(name)
    return "WITH " + ",\n".join(f"{n} AS {materialize} ({body}\n)" for n, body in done.items())


# Large sources and the key to spread them by where they come as fewer files than there are cores or portions of this many rows.
SPREAD = {"orders": "o_orderkey", "lineitem": "l_orderkey"}
ROWS = 250_000


def source(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    if table in SPREAD:
        # a fixed number of portions would grow with the table, and so would every file and task made from them
        portions = max(spark.sparkContext.defaultParallelism, -(-df.count() // ROWS))
        if len(df.inputFiles()) < portions:
            return df.repartition(portions, SPREAD[table])
    return df


def feed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One raw feed as a Spark frame."""
    text_sql = with_clause([name], SQL) + f"\nSELECT * FROM {name}"
    used = {t: source(spark, sf_dir, t) for t in TABLES if re.search(rf"\b{t}\b", text_sql)}
    for t in used:
        text_sql = re.sub(rf"\b(FROM|JOIN) {t}\b", rf"\1 {{{t}}}", text_sql)
    return spark.sql(text_sql, **used)
