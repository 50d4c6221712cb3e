"""The plan of the largest scored table."""

from __future__ import annotations

import re

from freightloom.plans.shipments import silver_wms
from freightloom.schemas import FEEDS


def test_raw_legs_are_read_twice(spark, typed, tmp_path):
    legs = [(f"SHP_{i % 10:09d}" + " " * (i % 3 == 0), f"TRK_{i % 4:07d}", "MTL_1", "2025-07-01", "ON_AA", "DN_AA", "DN_AA")
            for i in range(200)] + [(None, None, None, None, None, None, None)]
    path = str(tmp_path / "legs")
    spark.createDataFrame(legs, FEEDS["wms_shipment_details"].schema).write.parquet(path)
    tms = typed("tms_transportation", *[dict(truck_id=f"TRK_{i:07d}", package_count=3) for i in range(7)])
    network = typed("mdm_network", dict(node_id="DN_AA", node_type="delivery_node"))
    out = silver_wms(spark.read.parquet(path), tms, network)
    rows = out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    final = plan.split("Initial Plan")[0]
    scans = [m for m in re.findall(r"FileScan parquet \[([^\]]*)\]", final)]
    assert len(scans) == 2 and sorted(len(s.split(",")) for s in scans) == [2, 7]
    assert len(rows) == len({(r[0], r[1]) for r in legs})
    assert {r.shipment_integrity_quality_flag for r in rows if r.shipment_id} == {"duplicate_shipment_in_truck"}
