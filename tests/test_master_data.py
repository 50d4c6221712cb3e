from __future__ import annotations

from decimal import Decimal

from freightloom.plans.master_data import (
    silver_configured, silver_handling, silver_network, silver_procurement, silver_rates,
)
from tests.conftest import by


def node(node_id="ON_AA", kind="origin_node", city="Lyon", country="FR", lat="45.75", lon="4.85", cap="ALL"):
    return node_id, kind, city, country, lat, lon, cap


def test_network_flags(raw):
    df = silver_network(raw(
        "mdm_network", node(), node(),
        node("ON_AB", "orign_node"), node("ON_AC", None), node("XX_AAA", "depot"), node("XX_AAB", "origin_node"),
        node(None), node("ON_AD", lat=" "), node("ON_AE", lat="34.9"), node("ON_AF", lat="35"), node("ON_AG", lat="72"),
        node("ON_AH", lat="72.1"), node("ON_AI", lon="-10.1"), node("ON_AJ", lon="40"), node("ON_AK", cap="X"),
        node("ON_AL", cap=None), node("ON_AM", country="fr"), node("ON_AN", country="FRA"), node("ON_AO", country=" "),
        node("ON_AP", city=" "), node("on_aq"), node("ON_AR\n"), node("ON_AS", lat="north"), node("DN_AT", "", cap="mtl ")))
    got = {r.node_id: r for r in df.collect()}
    assert len(got) == 23

    def has(key, **expected):
        for column, value in expected.items():
            assert got[key][column] == value, (key, column, got[key][column])

    has("ON_AA", quality_record="clean", latitude=Decimal("45.75"))
    has("ON_AB", node_type="origin_node", node_type_quality_flag="corrected", quality_record="clean")
    has("ON_AC", node_type=None, node_type_quality_flag="null_in_source", quality_record="critical")
    has("XX_AAA", node_type="unknown_prefix", node_type_quality_flag="invalid_value", quality_record="critical")
    has("XX_AAB", node_type="origin_node", node_quality_flag="unexpected_node_format", quality_record="critical")
    has(None, node_quality_flag="null_in_source", quality_record="critical")
    has("ON_AD", coordinates_quality_flag="null_in_source", quality_record="critical")
    for key in ("ON_AE", "ON_AH", "ON_AI"):
        has(key, coordinates_quality_flag="invalid_value", quality_record="critical")
    for key in ("ON_AF", "ON_AG", "ON_AJ"):
        has(key, coordinates_quality_flag="ok", quality_record="clean")
    has("ON_AK", capabilities_quality_flag="unexpected_capability", quality_record="warning")
    has("ON_AL", capabilities_quality_flag="null_in_source", quality_record="warning")
    has("ON_AM", country="fr", country_quality_flag="ok", quality_record="clean")
    has("ON_AN", country_quality_flag="not_iso_format", quality_record="warning")
    has("ON_AO", country_quality_flag="null_in_source", quality_record="warning")
    has("ON_AP", city_quality_flag="null_in_source", quality_record="warning")
    has("ON_AQ", node_quality_flag="unexpected_node_format")  # the format is tested on the raw id
    has("ON_AS", latitude=None, coordinates_quality_flag="null_in_source")
    has("DN_AT", node_type="delivery_node", node_type_quality_flag="corrected", node_capability="MTL")


def test_network_final_newline_is_no_match(raw):
    assert silver_network(raw("mdm_network", node("ON_AR\n"))).first().node_quality_flag == "unexpected_node_format"


def test_network_upper_country(raw):
    assert silver_network(raw("mdm_network", node(country=" fr")), upper_country=True).first().country == "FR"


def test_rates_flags(raw):
    df = silver_rates(raw(
        "fin_transport_rates",
        ("fr", "A", "200", "0.5"), ("FR", "B", "500", "5"), ("FR", "C", "199.99", "1"), ("FR", "D", "500.01", "1"),
        ("FR", "E", "-1", "1"), ("FR", "F", "0", "1"), ("FR", "G", "", "1"), ("FR", "H", "300", "0.49"),
        ("FR", "I", "300", "5.01"), ("FR", "J", "300", ""), (None, "K", "300", "1"), ("FRA", "L", "300", "1"),
        ("GB", "M", "300", "1"), ("FR", None, "300", "1"), ("FR", " N", "300", "1"), ("FR", "P", "300", "1"),
        ("FR", "P", "300", "1"), ("FR", "Q", "abc", "0")))
    flags = by(df, "carrier", "duplicates_flag", "country_quality_flag", "carrier_quality_flag",
               "fixed_cost_quality_flag", "cost_per_km_quality_flag", "quality_record")
    ok = ["ok"] * 5

    def expect(carrier, record="critical", **at):
        want = list(ok)
        for position, label in at.items():
            want[int(position[1:])] = label
        assert flags[carrier] == (*want, record), carrier

    expect("A", "clean"), expect("B", "clean")
    expect("C", _3="out_of_range"), expect("D", _3="out_of_range")
    expect("E", _3="invalid_value"), expect("F", _3="invalid_value"), expect("G", _3="null_in_source")
    expect("H", _4="out_of_range"), expect("I", _4="out_of_range"), expect("J", _4="null_in_source")
    expect("K", _1="null_in_source"), expect("L", _1="invalid_format"), expect("M", _1="invalid_country")
    expect(None, _2="null_in_source"), expect("N", _2="corrected"), expect("P", _0="duplicate")
    expect("Q", _3="null_in_source", _4="invalid_value")
    assert df.count() == 17


def test_handling_flags(raw, network):
    df = silver_handling(raw(
        "fin_handling_costs", ("ch_aa ", "1.00"), ("CH_BB", "2.51"), ("CH_BB", "2.60"), ("CH_ZZ", "2.50"),
        ("ON_AA", "0.99"), (None, "0"), ("DN_AA", ""), ("DN_BB", "-1")), network)
    got = by(df, "node_id", "node_integrity_quality_flag", "cost_quality_flag", "quality_record")
    assert got == {
        "CH_AA": ("ok", "ok", "clean"), "CH_BB": ("duplicate", "out_of_range", "critical"),
        "CH_ZZ": ("referential_integrity_fail", "ok", "critical"),
        "ON_AA": ("invalid_node_type", "out_of_range", "critical"),
        None: ("null_in_source", "invalid_cost", "critical"),
        "DN_AA": ("invalid_node_type", "null_in_source", "critical"),
        "DN_BB": ("invalid_node_type", "invalid_cost", "critical")}


def test_procurement_flags(raw):
    df = silver_procurement(raw(
        "fin_procurement", (" box_container", "12.5", "no"), ("B", "0", "TRUE"), ("C", "", "yes"), (None, "1", "0"),
        ("E", "1", "maybe"), ("E", "1", "1")))
    got = [(r.item, r.reusable, r.item_quality_flag, r.cost_per_unit_quality_flag, r.reusable_quality_flag,
            r.quality_record) for r in df.collect()]
    assert set(got) == {
        ("BOX_CONTAINER", False, "ok", "ok", "ok", "clean"), ("B", True, "ok", "invalid_cost", "ok", "critical"),
        ("C", True, "ok", "null_in_source", "ok", "critical"), (None, False, "null_in_source", "ok", "ok", "critical"),
        ("E", None, "ok", "ok", "invalid_format", "warning"), ("E", True, "ok", "ok", "ok", "clean")}


def test_configured_flags(raw, network):
    df = silver_configured(raw(
        "mdm_configured_transit_times", ("ON_AA", "DN_AA", "10", "a"), ("CH_AA", "DN_AA", "0", "b"),
        ("DN_AA", "ON_AA", None, "c"), ("ON_ZZ", "DN_ZZ", "x", "d"), (None, None, "-1", "e"),
        ("ON_AA", "CH_AA", "5", "f"), (" ON_AA", "DN_AA", "5", "g")), network)
    got = by(df, "configuration_type", "origin_node_integrity_quality_flag",
             "destination_node_integrity_quality_flag", "transit_time_quality_flag", "quality_record")
    assert got == {
        "a": ("ok", "ok", "ok", "clean"), "b": ("ok", "ok", "invalid_value", "critical"),
        "c": ("cant_be_an_origin", "cant_be_a_destination", "null_in_source", "critical"),
        "d": ("unknown_node", "unknown_node", "null_in_source", "critical"),
        "e": ("null_in_origin", "null_in_source", "invalid_value", "critical"),
        "f": ("ok", "ok", "ok", "clean"), "g": ("unknown_node", "ok", "ok", "critical")}
