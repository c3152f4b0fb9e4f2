"""Landed station pages: places within a month, and files that don't follow the pages."""

import json
from datetime import datetime, timedelta
from pathlib import Path

from obs_engine.plans.stand_ins import Inputs

SCHEMA = "l_orderkey LONG, l_partkey LONG, l_suppkey LONG, l_linenumber INT, l_quantity DOUBLE, l_shipdate TIMESTAMP_NTZ"


def test_pages_hold_each_month_in_order(spark, tmp_path):
    days = [datetime(2000, 1, 30) + timedelta(days=i) for i in range(4)]
    rows = [(o, 1, s, n, 5.0, d) for o in range(3) for s in (None, 3, 12, 25) for n in (1, 2) for d in days]
    spark.createDataFrame([*rows, (9, 1, 3, 1, 5.0, None)], SCHEMA).write.parquet(str(tmp_path / "lineitem.parquet"))
    path = tmp_path / "pages"
    Inputs(spark, str(tmp_path)).write_station_pages(str(path), per_page=2)
    files = [f for f in Path(path).rglob("*") if f.is_file() and f.name.startswith("part")]
    pages = [json.loads(line) for f in files for line in f.read_text().splitlines()]
    # One report of each station, day and half of it is served: two months of sixteen.
    assert sorted((p["chunk_no"], p["offset"]) for p in pages) == [(c, o) for c in (24001, 24002) for o in range(0, 16, 2)]
    assert {p["total_count"] for p in pages} == {16}
    for chunk in (24001, 24002):
        own = sorted((p for p in pages if p["chunk_no"] == chunk), key=lambda p: p["offset"])
        listed = [r.get("stationcode") for p in own for r in p["results"]]
        assert listed == [None] * 4 + ["3"] * 4 + ["12"] * 4 + ["25"] * 4
    assert len(files) < len(pages)
