"""Registered queries: the library run over the feeds derived from the driver's tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.feeds import EXTRACTS, feed
from freightloom.functions import casting as C
from freightloom.functions.flags import usable
from freightloom.operators import distances, lookup
from freightloom.operators.keep_first import keep_first, qualify_first
from freightloom.operators.percentiles import RANK_ERROR, sketched_percentiles, value_sketches
from freightloom.plans import audits, compliance, contracts, incremental, lane_daily, measures, simulation, transit
from freightloom.plans import master_data as md
from freightloom.plans.lane_daily import LANE
from freightloom.plans.shipments import silver_wms
from freightloom.plans.transport import silver_tms
from freightloom.schemas import FACT_KEYS, FEEDS
from freightloom.sources import versions
from freightloom.sources.bronze import load_all
from freightloom.sources.colocated import Pair, buckets_for, publish_pair
from freightloom.sources.quoted import read_quoted_csv
from freightloom.sources.sinks import publish, read_table
from freightloom.sources.spine import spread_over_days
from freightloom.sources.workspace import new_workspace
from freightloom.streaming.append import append_bronze


class Tables:
    """Feeds, scored tables and facts of one scale factor, in the layers of a full refresh.

    ``plan(name)`` is the lazy plan of a table over the published tables it depends on.
    ``t.<name>`` is the published table: written once, when first asked for, and read back, so that a
    query plans and runs only its own work.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self.base = spark, sf_dir, new_workspace(spark)
        self._published: dict[str, DataFrame] = {}

    def _kept(self, layer: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        key = f"{layer}/{name}"
        if key not in self._published:
            self._published[key] = publish(build(), self.base, layer, name)
        return self._published[key]

    def raw(self, name: str) -> DataFrame:
        return self._kept("bronze", name, lambda: feed(self.spark, self.sf_dir, f"raw_{name}"))

    def csv(self, name: str, drop: str = "extracts", df: DataFrame | None = None) -> str:
        """Folder of CSV files as delivered: blanks as they are, quotes doubled."""
        path = f"{self.base}/{drop}/{EXTRACTS[name]}.csv"
        (self.raw(name) if df is None else df).write.mode("append").options(
            header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
        return path

    @cached_property
    def load_status(self) -> DataFrame:
        """All extracts written as CSV and loaded; the status of each."""
        for name in EXTRACTS:
            self.csv(name)
        return load_all(self.spark, f"{self.base}/extracts", f"{self.base}/loaded")

    @cached_property
    def by_truck(self) -> Pair:
        """Scored legs and runs bucketed by truck."""
        count = buckets_for(self.wms, self.tms, least=16)
        return publish_pair(self.wms, self.tms, f"{self.base}/derived/by_truck", "truck_id", count)

    def plan(self, name: str) -> DataFrame:
        return PLANS[name](self)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in PLANS:
            raise AttributeError(name)
        return self._kept("derived", name, lambda: self.plan(name))


PLANS: dict[str, Callable[[Tables], DataFrame]] = {
    "network": lambda t: md.silver_network(t.raw("network")),
    "rates": lambda t: md.silver_rates(t.raw("rates")),
    "handling": lambda t: md.silver_handling(t.raw("handling"), t.network),
    "procurement": lambda t: md.silver_procurement(t.raw("procurement")),
    "configured": lambda t: md.silver_configured(t.raw("configured"), t.network),
    "tms": lambda t: silver_tms(t.raw("tms"), t.network, t.rates),
    "wms": lambda t: silver_wms(t.raw("wms"), t.tms, t.network),
    "daily": lambda t: lane_daily.lane_daily(t.tms, t.network, t.rates),
    "triplets": lambda t: simulation.monthly_triplets(t.wms, t.tms),
    "enriched": lambda t: simulation.enrich_triplets(simulation.prorate_cbm(t.triplets), t.network, t.rates),
    "simulated": lambda t: simulation.lane_simulation(
        t.wms, t.tms, t.network, t.rates, t.handling, t.daily, thin=60, thick=90),
    "compliance": lambda t: compliance.container_compliance(t.wms, t.tms, t.network, t.procurement),
    "transit": lambda t: transit.transit_time(t.tms, t.configured),
}


_cache: dict[tuple[str, str], Tables] = {}


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _cache:
        _cache[key] = Tables(spark, sf_dir)
    return _cache[key]


def rounded(df: DataFrame, places: int = 4) -> DataFrame:
    """Round every double so that the order of summation cannot show."""
    return df.select(*[
        C.stable_round(F.col(f.name), places).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
        for f in df.schema])


QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}


def query(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    QUERIES[build.__name__] = build
    return build


# -- loads and sinks --------------------------------------------------------------------------

@query
def load_status(t):
    return t.load_status.select("table_name", "status", "row_count", "bad_records")


@query
def loaded_runs(t):
    t.load_status  # noqa: B018  (the load itself)
    return read_table(t.spark, t.base, "loaded", "tms_transportation").select(*FEEDS["tms_transportation"].columns)


@query
def quoted_records(t):
    """Descriptions with quotes and line breaks, written as CSV and read by byte ranges."""
    names = FEEDS["fin_procurement"].columns
    if "quoted" not in t._published:
        broken = t.raw("procurement").withColumn("description", F.concat(
            F.col("description"), F.lit('\n"'), F.coalesce("item", F.lit("none")), F.lit('",\n\n'), F.col("reusable")))
        t._published["quoted"] = read_quoted_csv(t.spark, t.csv("procurement", "quoted", broken), names)
    return t._published["quoted"].select(*names)


@query
def replaced_runs(t):
    """A table replaced by rows read from itself, as committed versions; the number of runs before and after."""
    def by_carrier(df, name):
        return df.groupBy(F.coalesce("carrier", F.lit("none")).alias("carrier")).agg(F.count(F.lit(1)).alias(name))

    path = f"{t.base}/replaced/tms"
    if not versions.exists(t.spark, path):
        versions.replace(t.tms, path)
        versions.replace(usable(versions.read(t.spark, path)), path)
    before, after = (by_carrier(versions.read(t.spark, path, n), name) for n, name in ((0, "runs"), (1, "usable_runs")))
    return before.join(after, "carrier", "left").withColumn("usable_runs", F.coalesce("usable_runs", F.lit(0).cast("long")))


@query
def appended_legs(t):
    """Legs that arrive in two drops, each appended by its own refresh."""
    out, late = f"{t.base}/appended", F.pmod(F.crc32(F.coalesce("shipment_id", F.lit("")).cast("binary")), F.lit(2)) == 1
    if "appended" not in t._published:
        for drop in (~late, late):
            folder = t.csv("wms", "arrivals", t.raw("wms").filter(drop))
            append_bronze(t.spark, folder, out, f"{t.base}/arrivals_seen", "wms_shipment_details").awaitTermination()
        t._published["appended"] = t.spark.read.parquet(out)
    return t._published["appended"].select(*FEEDS["wms_shipment_details"].columns)


@query
def clustered_lane_daily(t):
    return rounded(publish(t.daily, t.base, "gold", "fact_lane_daily", ["date", "origin_node_id"]))


# -- casts, normalisation, correction ---------------------------------------------------------

@query
def safe_casts(t):
    return t.raw("tms").select(
        "truck_id",
        C.safe_cast(C.blank_to_null(F.col("transit_time_hours")), "double").alias("transit_time_hours"),
        C.safe_cast(C.blank_to_null(F.col("container_count"), trim=False), "bigint").alias("container_count"),
        C.safe_cast(C.blank_to_null(F.col("package_count"), trim=False), "bigint").alias("package_count"),
        C.safe_cast(C.blank_to_null(F.col("cbm"), trim=False), "double").alias("cbm"))


@query
def normalised_text(t):
    return t.raw("network").select(
        C.norm(F.col("node_id"), "upper").alias("node_id"), C.norm(F.col("node_type"), "lower").alias("node_type"),
        C.blank_to_null(F.col("city")).alias("city"), C.norm(F.col("node_capability"), "upper").alias("node_capability"))


@query
def parsed_datetimes(t):
    return t.raw("tms").select(
        "truck_id", F.col("departure_datetime").alias("departure_text"),
        C.parse_datetime(F.col("departure_datetime")).alias("departure_datetime"),
        C.parse_datetime(F.col("arrival_datetime")).alias("arrival_datetime"))


@query
def parsed_dates(t):
    return t.raw("wms").select("shipment_id", F.col("order_date").alias("order_text"),
                               C.parse_date(F.col("order_date")).alias("order_date"))


@query
def parsed_booleans(t):
    return t.raw("procurement").select("item", F.col("reusable").alias("reusable_text"),
                                       C.parse_bool(F.col("reusable")).alias("reusable"))


@query
def corrected_node_types(t):
    raw_type = C.norm(F.col("node_type"), "lower")
    corrected = C.correct_enum(raw_type, tuple(md.NODE_TYPES.values()), md.expected_node_type(F.col("node_id")))
    return t.raw("network").select("node_id", raw_type.alias("node_type_raw"), corrected.alias("node_type")).groupBy(
        "node_id", "node_type_raw", "node_type").agg(F.count(F.lit(1)).alias("registrations"))


@query
def unscored_runs(t):
    flags = [c for c in t.tms.columns if c.endswith("_flag")]
    return t.tms.drop(*flags, "quality_record")


@query
def imputed_carriers(t):
    return t.tms.groupBy(C.impute_label(F.col("carrier")).alias("carrier")).agg(F.count(F.lit(1)).alias("runs"))


# -- filters, predicates, deduplication -------------------------------------------------------

@query
def usable_runs(t):
    return usable(t.tms).select("truck_id", *LANE, "carrier", "quality_record")


@query
def id_formats(t):
    return t.raw("wms").select(
        F.coalesce(F.col("shipment_id").rlike(r"^SHP_[0-9]{9}\z"), F.lit(False)).alias("good_shipment"),
        F.coalesce(F.col("truck_id").rlike(r"^TRK_[0-9]{7}\z"), F.lit(False)).alias("good_truck"),
        F.col("origin_node_id").like("ON_%").alias("from_origin"),
    ).groupBy("good_shipment", "good_truck", "from_origin").agg(F.count(F.lit(1)).alias("legs"))


@query
def costs_out_of_range(t):
    return t.rates.filter(
        ~F.col("fixed_cost_eur").between(*md.FIXED_COST_LIMITS)
        | ~F.col("cost_per_km_eur").between(*md.COST_PER_KM_LIMITS)
        | ~F.col("country").isin(*md.COUNTRIES)
    ).select("country", "carrier", "fixed_cost_eur", "cost_per_km_eur")


@query
def carriers_without_rate(t):
    runs = t.raw("tms").select("truck_id", C.norm(F.col("carrier")).alias("carrier"))
    marked = lookup.member_flag(runs, "carrier", usable(t.rates).select("carrier"), "no_rate")
    return marked.groupBy("carrier", "no_rate").agg(F.count(F.lit(1)).alias("runs"))


@query
def first_registrations(t):
    return keep_first(t.raw("network"), ["node_id"], copies="registrations")


@query
def first_rates(t):
    return keep_first(t.raw("rates"), ["country", "carrier"], copies="copies")


@query
def first_runs(t):
    return keep_first(t.raw("tms"), ["truck_id"], copies="copies")


@query
def first_legs(t):
    return keep_first(t.raw("wms"), ["shipment_id", "truck_id"], copies="copies")


@query
def repeated_legs(t):
    return t.raw("wms").groupBy(C.norm(F.col("shipment_id")).alias("shipment_id"),
                                C.norm(F.col("truck_id")).alias("truck_id")).agg(
        F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


@query
def latest_run_per_lane(t):
    runs = usable(t.tms).select(*LANE, "departure_datetime", "truck_id", "carrier", "transit_time_hours")
    return qualify_first(runs, LANE, ["departure_datetime", "truck_id"], desc=True)


@query
def distinct_lane_carriers(t):
    return usable(t.tms).select(*LANE, C.impute_label(F.col("carrier")).alias("carrier")).distinct()


# -- scored tables ----------------------------------------------------------------------------

for _name in ("network", "rates", "handling", "procurement", "configured", "tms", "wms"):
    QUERIES[f"silver_{_name}"] = lambda t, n=_name: t.plan(n)


@query
def silver_network_upper_country(t):
    return md.silver_network(t.raw("network"), upper_country=True)


@query
def silver_tms_contract_score(t):
    scored = silver_tms(t.raw("tms"), t.network, t.rates, cbm_is_critical=True)
    return scored.groupBy("cbm_quality_flag", "quality_record").agg(F.count(F.lit(1)).alias("runs"))


@query
def quality_distribution(t):
    return measures.quality_distribution({
        "mdm_network": t.network, "fin_transport_rates": t.rates, "fin_handling_costs": t.handling,
        "fin_procurement": t.procurement, "mdm_configured_transit_times": t.configured,
        "tms_transportation": t.tms, "wms_shipment_details": t.wms})


# -- lane daily -------------------------------------------------------------------------------

@query
def lane_distances(t):
    pairs = t.tms.select(*LANE).union(t.wms.select("origin_node_id", "sort_code"))
    return distances.lane_distances(pairs, t.network)


@query
def nearest_hubs(t):
    good = usable(t.network)
    return distances.nearest_nodes(good.filter(F.col("node_type") == "delivery_node"),
                                   good.filter(F.col("node_type") == "consolidation_hub"), 3)


@query
def nearest_hubs_by_cells(t):
    """The same by the cells of a large network, which this small one would not need."""
    good = usable(t.network)
    return distances.nearest_nodes(good.filter(F.col("node_type") == "delivery_node"),
                                   good.filter(F.col("node_type") == "consolidation_hub"), 3, block=1)


@query
def all_hub_distances(t):
    good = usable(t.network)
    return distances.nearest_nodes(good.filter(F.col("node_type") == "delivery_node"),
                                   good.filter(F.col("node_type") == "consolidation_hub"), None)


@query
def hub_coverage_by_distance(t):
    good = usable(t.network)
    return distances.nearest_nodes(good.filter(F.col("node_type") == "consolidation_hub"),
                                   good.filter(F.col("node_type") == "delivery_node"), 10, same_country_first=True)


@query
def daily_actuals(t):
    return rounded(lane_daily.daily_actuals(t.tms))


@query
def average_rates(t):
    return rounded(lane_daily.average_rates(t.rates))


@query
def run_endpoints(t):
    runs = usable(t.tms).select("truck_id", *LANE)
    return lookup.usable_endpoints(runs, t.network, *LANE)


@query
def lane_calendar(t):
    lanes = usable(t.tms).select(*LANE).distinct()
    return spread_over_days(lanes, lane_daily.START, lane_daily.END)


@query
def lane_days_filled(t):
    return rounded(lane_daily.fill_days(lane_daily.lane_carriers(t.tms, t.network)))


@query
def linehaul_costs(t):
    filled = lane_daily.fill_days(lane_daily.lane_carriers(t.tms, t.network))
    costed = lane_daily.linehaul_cost(filled, t.rates)
    return rounded(costed.select("date", *LANE, "carrier", "daily_linehaul_cost_eur", "cost_is_imputed"))


@query
def lane_daily_fact(t):
    return rounded(t.plan("daily"))


# -- simulation -------------------------------------------------------------------------------

@query
def truck_triplets(t):
    return rounded(simulation.truck_triplets(t.wms, t.tms))


@query
def truck_triplets_by_bucket(t):
    return rounded(t.by_truck.by_key(simulation.truck_triplets))


@query
def monthly_triplets(t):
    return rounded(t.plan("triplets"))


@query
def hub_totals(t):
    return rounded(simulation.hub_totals(t.triplets))


@query
def prorated_triplets(t):
    return rounded(simulation.prorate_cbm(t.triplets))


@query
def enriched_triplets(t):
    return rounded(t.plan("enriched"))


@query
def nearest_connected_hubs(t):
    return simulation.nearest_hub(t.enriched, "hub_node_id").select(
        "origin_node_id", "sort_code", "hub_node_id").distinct()


@query
def monthly_lane_costs(t):
    return rounded(simulation.monthly_lane_costs(t.daily), 2)


@query
def triplet_costs(t):
    return rounded(simulation.triplet_costs(t.enriched, t.daily, t.handling).select(
        *simulation.TRIPLET, "current_monthly_costs", "current_monthly_cost_ratio",
        "monthly_processing_costs", "processing_cost_ratio"), 2)


@query
def lane_categories(t):
    return simulation.categorise(simulation.prorate_cbm(t.triplets), 60, 90).groupBy(
        "triplet_type", "category").agg(F.count(F.lit(1)).alias("triplets"))


@query
def calibrated_categories(t):
    triplets = simulation.prorate_cbm(t.triplets)
    return simulation.categorise(triplets, measures.calibrated_thresholds(triplets)).groupBy(
        "triplet_type", "category").agg(F.count(F.lit(1)).alias("triplets"))


@query
def lane_simulation(t):
    return rounded(t.plan("simulated"), 2)


@query
def lane_simulation_default_thresholds(t):
    return rounded(simulation.lane_simulation(t.wms, t.tms, t.network, t.rates, t.handling, t.daily), 2)


@query
def lane_simulation_hub_leg(t):
    return rounded(simulation.lane_simulation(
        t.wms, t.tms, t.network, t.rates, t.handling, t.daily, thin=60, thick=90, hub_leg=True), 2)


# -- compliance and transit -------------------------------------------------------------------

@query
def container_counts(t):
    return compliance.container_counts(t.wms, t.tms)


@query
def container_counts_by_bucket(t):
    return compliance.counted_containers(t.by_truck.by_key(compliance.loaded_containers))


@query
def container_compliance(t):
    return t.plan("compliance")


@query
def transit_time(t):
    return t.plan("transit")


@query
def transit_percentiles(t):
    return transit.transit_percentiles(t.tms)


@query
def transit_percentiles_from_sketches(t):
    """Whether each approximate percentile of a lane, merged from daily sketches, is within its stated rank error."""
    runs = usable(t.tms).select(*LANE, F.to_date("departure_datetime").alias("day"), "transit_time_hours")
    rough = sketched_percentiles(value_sketches(runs, [*LANE, "day"], "transit_time_hours"), LANE, transit.POINTS, "runs")
    below = runs.filter(F.col("transit_time_hours").isNotNull()).join(rough, LANE)
    return below.groupBy(*LANE, "runs").agg(*[
        ((F.count_if(F.col("transit_time_hours") < F.col(p)) <= (q + RANK_ERROR) * F.col("runs"))
         & (F.count_if(F.col("transit_time_hours") <= F.col(p)) >= (q - RANK_ERROR) * F.col("runs"))).alias(f"{p}_within")
        for p, q in transit.POINTS.items()])


@query
def transit_drift(t):
    return transit.transit_drift(t.transit)


@query
def configuration_status(t):
    return transit.configuration_status(t.tms, t.configured)


# -- audits -----------------------------------------------------------------------------------

@query
def audit_package_count(t):
    return audits.package_count_mismatch(t.tms, t.wms)


@query
def audit_package_count_by_bucket(t):
    return t.by_truck.by_key(lambda legs, runs: audits.package_count_mismatch(runs, legs))


@query
def audit_capacity(t):
    return audits.cbm_over_capacity(t.tms)


@query
def audit_truck_lane(t):
    return audits.truck_with_several_lanes(t.wms)


@query
def audit_final_stop(t):
    return audits.shipment_not_at_sort_code(t.wms, t.tms)


@query
def audit_direct_legs(t):
    return audits.direct_leg_violations(t.wms)


@query
def audit_indirect_legs(t):
    return audits.indirect_leg_violations(t.wms)


@query
def audit_path_types(t):
    return audits.mixed_path_types(t.wms)


@query
def audit_hub_containers(t):
    return audits.reused_hub_containers(t.wms)


@query
def audit_foreign_keys(t):
    return audits.foreign_key_orphans(t.network, t.tms, t.wms, t.handling)


@query
def audit_unreachable_nodes(t):
    lanes = measures.cross_border_lanes(usable(t.tms), usable(t.network))
    return audits.unreachable_nodes(t.network, lanes)


@query
def audit_container_count(t):
    return audits.container_reconciliation(t.tms, t.wms)


@query
def audit_primary_keys(t):
    return audits.primary_key_violations({
        "mdm_network": (t.network, ["node_id"]),
        "fin_transport_rates": (t.rates, ["country", "carrier"]),
        "fin_handling_costs": (t.handling, ["node_id"]),
        "fin_procurement": (t.procurement, ["item"]),
        "mdm_configured_transit_times": (t.configured, LANE),
        "wms_shipment_details": (t.wms, ["shipment_id", "truck_id"]),
        "tms_transportation": (t.tms, ["truck_id"])})


FACT_TABLES = {"daily": "fact_lane_daily", "simulated": "fact_lane_simulation", "compliance": "fact_container_compliance",
               "transit": "fact_transit_time"}


@query
def schema_differences(t):
    """What scoring changes against the raw extracts: types, new columns, and the nulls on either side."""
    raw = {name: (t.raw(n), FEEDS[name].grain) for n, name in EXTRACTS.items()}
    scored = {name: (getattr(t, n), FEEDS[name].grain) for n, name in EXTRACTS.items()}
    return contracts.changes(contracts.observed(raw), contracts.observed(scored))


@query
def contract_profile(t):
    """Every column of the scored tables and facts: type, place in the key, rows, nulls, values of a flag."""
    tables = {name: (getattr(t, n), FEEDS[name].grain) for n, name in EXTRACTS.items()}
    tables |= {name: (getattr(t, n), FACT_KEYS[name]) for n, name in FACT_TABLES.items()}
    return contracts.observed(tables).withColumn("flag_values", F.array_join("flag_values", ","))


@query
def incremental_legs(t):
    """Legs and runs that arrive in two drops, scored after each by the buckets touched."""
    base = f"{t.base}/incremental"
    if "incremental" not in t._published:
        publish(t.network, base, "silver", incremental.NETWORK)
        publish(t.rates, base, "silver", incremental.RATES)
        late = F.pmod(F.crc32(F.coalesce("truck_id", F.lit("")).cast("binary")), F.lit(50)) == 1
        for drop in (~late, late):
            for n, name in (("tms", incremental.RUNS), ("wms", incremental.LEGS)):
                incremental.append_raw(t.raw(n).filter(drop), base, name, 64)
            incremental.refresh_scored(t.spark, base, count=64)
        t._published["incremental"] = incremental.read_scored(t.spark, base, incremental.LEGS)
    return t._published["incremental"]


# -- measures ---------------------------------------------------------------------------------

@query
def compliance_by_lane(t):
    return measures.compliance_summary(t.compliance)


@query
def compliance_by_origin(t):
    return measures.compliance_by_origin(t.compliance)


@query
def savings_summary(t):
    return measures.savings_summary(t.simulated)


@query
def ranked_interventions(t):
    return measures.ranked_interventions(t.simulated)


@query
def on_time_share(t):
    return measures.on_time_share(t.tms)


@query
def departure_window_share(t):
    return measures.departure_window_share(t.tms)


@query
def container_bands(t):
    return measures.container_bands(t.tms)


@query
def fill_rate(t):
    return measures.fill_rate(t.tms)


@query
def lane_leg_types(t):
    return measures.lane_leg_types(t.tms)


@query
def hub_coverage(t):
    return measures.hub_coverage(t.tms)


@query
def calibrated_thresholds(t):
    return measures.calibrated_thresholds(simulation.prorate_cbm(t.triplets))


@query
def cross_border_lanes(t):
    return measures.cross_border_lanes(usable(t.tms), usable(t.network))


@query
def transit_delay(t):
    return measures.transit_delay(usable(t.tms), usable(t.network))
