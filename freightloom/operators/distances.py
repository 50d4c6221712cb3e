"""Distances between the node pairs that occur, and nearest nodes, without pairing every node with every node."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import ceil, radians, sin

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from freightloom.functions.flags import usable
from freightloom.functions.geo import EARTH_RADIUS_KM, haversine_km
from freightloom.operators.lookup import bounded, node_lookup
from freightloom.sources.workspace import new_workspace

#: Cell widths a search goes through, as powers of two into which a full circle is cut: 0.35 to 90 degrees.
LEVELS = (10, 7, 4, 2)

# The roles a truck can connect.
LANE_ROLES = (
    ("origin_node", "consolidation_hub"),
    ("origin_node", "delivery_node"),
    ("consolidation_hub", "delivery_node"),
)


def lane_distance(
    df: DataFrame, network: DataFrame, start: str, end: str, out: str, take: dict[str, str] | None = None
) -> DataFrame:
    """Add the distance of the lane ``start`` -> ``end``; NULL where that is no valid lane.

    ``network`` holds the nodes that may take part (usable ones, as a rule).  A valid lane joins two
    of them in one of ``LANE_ROLES``.  ``take`` maps
    ``start_type``, ``start_country``, ``end_type`` or ``end_country`` to an output name; these are
    NULL too for an invalid lane.
    """
    take = take or {}
    for role, node in (("start", start), ("end", end)):
        df = node_lookup(df, network, node, {
            "node_type": f"_{role}_type", "country": f"_{role}_country",
            "latitude": f"_{role}_lat", "longitude": f"_{role}_lon"})
    valid = F.lit(False)
    for first, second in LANE_ROLES:
        valid = valid | ((F.col("_start_type") == first) & (F.col("_end_type") == second))
    km = haversine_km(F.col("_start_lat"), F.col("_start_lon"), F.col("_end_lat"), F.col("_end_lon"))
    added = {out: F.when(valid, km), **{name: F.when(valid, F.col(f"_{c}")) for c, name in take.items()}}
    temporary = [f"_{r}_{c}" for r in ("start", "end") for c in ("type", "country", "lat", "lon")]
    return df.withColumns(added).drop(*temporary)


def lane_distances(pairs: DataFrame, network: DataFrame) -> DataFrame:
    """Distance table of the (origin, destination) pairs in ``pairs`` that are valid lanes."""
    lanes = pairs.toDF("origin_node", "destination_node").distinct()
    out = lane_distance(lanes, bounded(usable(network)), "origin_node", "destination_node", "distance_km", {
        "start_country": "origin_node_country", "start_type": "origin_node_type",
        "end_country": "destination_node_country", "end_type": "destination_node_type"})
    return out.filter(F.col("origin_node_type").isNotNull()).select(
        "origin_node", "origin_node_country", "origin_node_type",
        "destination_node", "destination_node_country", "destination_node_type", "distance_km")


def _located(df: DataFrame) -> DataFrame:
    return df.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())


def _sources(sources: DataFrame) -> DataFrame:
    return _located(sources).select(
        F.col("node_id").alias("source_id"), F.col("country").alias("_country"),
        F.col("latitude").cast("double").alias("_lat"), F.col("longitude").cast("double").alias("_lon"))


def _ranked(rated: DataFrame, k: int | None) -> DataFrame:
    """The first ``k`` of each source by ``_best`` (foreign, distance, id)."""
    out = rated.withColumn("rank", F.row_number().over(W.partitionBy("source_id").orderBy("_best")))
    return out if k is None else out.filter(F.col("rank") <= k)


def _rated(node_id: Column, country: Column, lat: Column, lon: Column, same_country_first: bool) -> Column:
    foreign = ~country.eqNullSafe(F.col("_country")) if same_country_first else F.lit(False)
    return F.struct(foreign.alias("foreign"), haversine_km(F.col("_lat"), F.col("_lon"), lat, lon).alias("distance_km"),
                    node_id.alias("node_id"))


def _all_candidates(sources: DataFrame, candidates: DataFrame, k: int | None, same_country_first: bool, block: int,
                    count: int) -> DataFrame:
    """source_id, _best and rank from every candidate.

    Candidates are packed into blocks of about ``block`` nodes.  Each source meets each block once and keeps the best ``k``
    of it inside the row, so at most ``k`` rows per source and block leave the join.
    """
    blocks = max(1, ceil(count / block))
    packed = _located(candidates).groupBy(F.pmod(F.xxhash64("node_id"), F.lit(blocks)).alias("_block")).agg(
        F.collect_list(F.struct("node_id", "country", F.col("latitude").cast("double").alias("lat"),
                                F.col("longitude").cast("double").alias("lon"))).alias("_nodes"))
    spread = sources.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))))
    best = F.array_sort(F.transform("_nodes", lambda n: _rated(
        n["node_id"], n["country"], n["lat"], n["lon"], same_country_first)))
    if k is not None:
        best = F.slice(best, 1, k)
    return _ranked(spread.join(bounded(packed, 64), "_block").select("source_id", F.explode(best).alias("_best")), k)


def cell_pairs(sources: DataFrame, candidates: DataFrame, level: int, same_country_first: bool) -> DataFrame:
    """source_id, _lat, _needed and _best of every candidate in the cell of a source or one of the eight around it.

    A cell spans 360 / 2**level degrees of latitude and longitude; cells east of the date line are neighbours of those west of it.
    """
    cells = 2 ** level
    size = 360.0 / cells

    def cell(lat, lon):
        return (F.floor((lat + 90) / size).alias("y"), F.pmod(F.floor((lon + 180) / size), F.lit(cells)).alias("x"))

    homes = _located(candidates).select(
        "node_id", "country", F.col("latitude").cast("double").alias("lat"), F.col("longitude").cast("double").alias("lon"))
    homes = homes.select("*", *cell(F.col("lat"), F.col("lon")))
    near = F.array(*[F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx")) for dy in (-1, 0, 1) for dx in (-1, 0, 1)])
    y, x = cell(F.col("_lat"), F.col("_lon"))
    asks = sources.select("*", y.alias("_y"), x.alias("_x"), F.explode(near).alias("_d")).select(
        *sources.columns, (F.col("_y") + F.col("_d.dy")).alias("_y"), F.pmod(F.col("_x") + F.col("_d.dx"), F.lit(cells)).alias("_x"))
    met = asks.join(homes, (F.col("_y") == F.col("y")) & (F.col("_x") == F.col("x")))
    return met.select("source_id", "_lat", "_needed", _rated(
        F.col("node_id"), F.col("country"), F.col("lat"), F.col("lon"), same_country_first).alias("_best"))


def unseen_from_km(lat: Column, level: int) -> Column:
    """No point outside a source's nine cells is nearer than this.

    Such a point is a cell's width away in latitude, or beyond a meridian a cell's width away, whose great circle is
    asin(cos(latitude) * sin(width)) from the source.
    """
    width = radians(360.0 / 2 ** level)
    return F.lit(EARTH_RADIUS_KM) * F.least(F.lit(width), F.asin(F.cos(F.radians(lat)) * F.lit(sin(width))))


def nearest_nodes(
    sources: DataFrame, candidates: DataFrame, k: int | None, same_country_first: bool = False, block: int = 1024,
    levels: Sequence[int] = LEVELS
) -> DataFrame:
    """The ``k`` candidates closest to each source, or all of them; ties go to the smaller id.

    Both frames have ``node_id`` (unique), ``country``, ``latitude`` and ``longitude``; rows without a position take no part.
    With ``same_country_first`` a candidate of the source's country beats any foreign one.

    More than ``block`` candidates are searched by cells, from fine to coarse: a source meets the candidates of its own cell and
    the eight around it, and is done when its k-th distance is below that of anything outside them (and no
    candidate of its country is missing, where those come first).  Only sources that no level settles, as near the poles
    or far from all candidates, meet every candidate.  Each level is a written table, so an unsettled source is all that
    the next one reads.  Without ``k`` the result has every pair, and so has the work.
    """
    count, asked = candidates.count(), _sources(sources)
    columns = ("source_id", F.col("_best.node_id").alias("node_id"), F.col("_best.distance_km").alias("distance_km"), "rank")
    if k is None or count <= block:
        return _all_candidates(asked, candidates, k, same_country_first, block, count).select(*columns)
    needed = F.lit(0)
    if same_country_first:
        # candidates of the source's own country that must be among the first k
        own = _located(candidates).groupBy(F.col("country").alias("_own")).agg(F.count(F.lit(1)).alias("_n"))
        asked = asked.join(own, F.col("_country").eqNullSafe(F.col("_own")), "left").drop("_own")
        needed = F.least(F.coalesce("_n", F.lit(0)), F.lit(k))
    asked = asked.withColumn("_needed", needed.cast("long")).drop("_n")
    folder, done = new_workspace(sources.sparkSession), []
    every = W.partitionBy("source_id")
    for level in levels:
        pairs = cell_pairs(asked, candidates, level, same_country_first)
        best = _ranked(pairs, k).withColumns({
            "_found": F.count(F.lit(1)).over(every), "_own": F.count_if(~F.col("_best.foreign")).over(every),
            "_far": F.max("_best.distance_km").over(every)})
        enough = (F.col("_found") == k) & (~F.lit(same_country_first) | (F.col("_own") == F.col("_needed")))
        # distances are rounded to 0.01 km
        settled = best.filter(enough & (F.col("_far") + 0.02 < unseen_from_km(F.col("_lat"), level)))
        settled.select(*columns).write.parquet(f"{folder}/level_{level}")
        done.append(sources.sparkSession.read.parquet(f"{folder}/level_{level}"))
        asked = asked.join(done[-1].select("source_id").distinct(), "source_id", "left_anti")
        asked.write.parquet(f"{folder}/left_{level}")
        asked = sources.sparkSession.read.parquet(f"{folder}/left_{level}")
        if asked.isEmpty():
            return reduce(DataFrame.unionByName, done)
    rest = _all_candidates(asked.drop("_needed"), candidates, k, same_country_first, block, count).select(*columns)
    return reduce(DataFrame.unionByName, [*done, rest])
