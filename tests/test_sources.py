"""Pages, windows and the page provider."""

from datetime import datetime, timedelta, timezone

import pytest
from builders import arc, land, page, station
from pyspark.sql import functions as F

from obs_engine.operators.dedup import dedup_last
from obs_engine.plans import arcs, stations
from obs_engine.schemas import ARC_RECORD, STATION_RECORD
from obs_engine.sources import pages, provider, windows

KEY = pages.ARC_REQUIRED


def read(spark, root, record=ARC_RECORD):
    return pages.read_pages(spark, root, record)


def test_pages_become_records_in_numeric_offset_order(spark, tmp_path):
    root = land(tmp_path / "p", [
        (0, 200, page(3, arc(iu_ac="a"))),
        (0, 1000, page(3, arc(iu_ac="b"), arc(iu_ac="c"))),
    ])
    rows = pages.records_of(read(spark, root)).orderBy(*pages.LINEAGE).collect()
    assert [(r["chunk_no"], r["offset"], r["pos"], r["iu_ac"]) for r in rows] == [
        (0, 200, 0, "a"), (0, 1000, 0, "b"), (0, 1000, 1, "c")
    ]


def test_last_occurrence_wins_across_pages(spark, tmp_path):
    root = land(tmp_path / "p", [
        (0, 0, page(3, arc(iu_ac="101", q=200), arc(iu_ac="102"))),
        (0, 2, page(3, arc(iu_ac="101", q=250))),
    ])
    got = dedup_last(pages.records_of(read(spark, root)), KEY, pages.LINEAGE).collect()
    assert {r["iu_ac"]: r["q"] for r in got} == {"101": "250", "102": "40.5"}


def test_numbers_become_ids_and_blank_nodes_null(spark, tmp_path):
    root = land(tmp_path / "p", [(0, 0, page(1, arc(iu_ac=880, iu_nd_amont="", iu_nd_aval=33)))])
    row = arcs.parse_arcs(pages.records_of(read(spark, root)), None, "r").first()
    assert (row["arc_id"], row["upstream_node_id"], row["downstream_node_id"]) == (
        "880", None, "33"
    )


@pytest.mark.parametrize(
    "document, fault",
    [
        ('{"total_count": "invalid", "results": []}', "invalid total_count"),
        ('{"total_count": -1, "results": []}', "invalid total_count"),
        ('{"total_count": 1}', "invalid results"),
        ('{"total_count": 1, "results": [null]}', "record is not an object"),
        ('{"total_count": 1, "results": [{"iu_ac', "invalid total_count"),
        ("[]", "invalid total_count"),
    ],
)
def test_unusable_pages(spark, tmp_path, document, fault):
    root = land(tmp_path / "p", [(0, 0, document), (0, 1, page(1, arc()))])
    bad = pages.validate_pages(read(spark, root)).collect()
    assert [r["offset"] for r in bad] in ([0], [None])
    assert bad[0]["fault"] in (fault, "not a valid page")


def test_missing_required_fields_are_named(spark, tmp_path):
    root = land(tmp_path / "p", [(0, 0, page(3, arc(), arc(iu_ac=""), arc(iu_ac=None, t_1h=None)))])
    records = pages.records_of(read(spark, root))
    bad = pages.require_fields(records, KEY).orderBy("pos").collect()
    assert [(r["pos"], r["missing"]) for r in bad] == [(1, ["iu_ac"]), (2, ["iu_ac", "t_1h"])]


def complete(spark, root, feed):
    record, key = (ARC_RECORD, KEY) if feed == "arcs" else (STATION_RECORD, pages.STATION_REQUIRED)
    p = read(spark, root, record)
    return [r["fault"] for r in pages.check_completeness(
        p, pages.records_of(p), key, feed == "stations", 10_000 if feed == "arcs" else None
    ).collect()]


def test_completeness(spark, tmp_path):
    early = land(tmp_path / "early", [(0, 0, page(2))])
    assert complete(spark, early, "arcs") == ["empty page before the reported total"]
    oversize = land(tmp_path / "big", [(0, 0, page(10_001, arc()))])
    assert complete(spark, oversize, "arcs") == ["too many records for one query"]
    short = land(tmp_path / "short", [(0, 0, page(3, arc()))])
    assert complete(spark, short, "arcs") == ["pages end before the total"]
    twice = land(tmp_path / "twice", [(0, 0, page(2, station(), station()))])
    assert complete(spark, twice, "stations") == ["fewer unique records than reported"]
    fine = land(tmp_path / "fine", [(0, 0, page(1, station(), station()))])
    assert complete(spark, fine, "stations") == []
    empty = land(tmp_path / "empty", [(0, 0, page(0))])
    assert complete(spark, empty, "arcs") == []


def test_chunk_border_is_counted_once(spark, tmp_path):
    shared = arc(t_1h="2031-03-09T06:00:00+00:00")
    other = arc(t_1h="2031-03-09T07:00:00+00:00")
    root = land(tmp_path / "p", [(0, 0, page(1, shared)), (1, 0, page(2, shared, other))])
    p = read(spark, root)
    records = pages.records_of(p)
    stats = pages.fetch_stats(p, records, KEY).first()
    assert tuple(stats) == (2, 3, 2)
    assert dedup_last(records, KEY, pages.LINEAGE).count() == 2


def test_station_stats_skip_empty_pages(spark, tmp_path):
    root = land(tmp_path / "p", [(0, 0, page(1, station())), (0, 1, page(9))])
    p = read(spark, root, STATION_RECORD)
    stats = pages.fetch_stats(p, pages.records_of(p), pages.STATION_REQUIRED, "stations").first()
    assert tuple(stats) == (1, 1, 1)


def test_complete_arc_record(spark, tmp_path, utc):
    root = land(tmp_path / "p", [(0, 0, page(1, arc()))])
    out = arcs.parse_arcs(pages.records_of(read(spark, root)), utc(2026, 7, 18), "run")
    row = out.withColumn("observed_at", F.col("observed_at").cast("string")).first()
    assert row["reject_reasons"] == []
    assert row["observed_at"] == "2031-03-09 05:00:00"
    assert float(row["occupancy_rate"]) == 2.75
    assert (row["longitude"], row["latitude"]) == (-17.25, 32.625)
    assert row["geo_shape"] == '{"coordinates":[[[0,0],[0,1],[1,1],[0,0]]],"type":"Polygon"}'
    assert str(row["source_end_date"]) == "2030-06-15"


@pytest.mark.parametrize(
    "changes, reason",
    [
        ({"t_1h": "2026-07-18T00:00:00"}, "timestamp"),
        ({"q": "NaN"}, "vehicle_flow"),
        ({"q": True}, "vehicle_flow"),
        ({"k": "high"}, "occupancy_rate"),
        ({"date_debut": "yesterday"}, "source_start_date"),
        ({"geo_point_2d": {"lon": 200, "lat": 48}}, "coordinates"),
        ({"geo_point_2d": {"lon": 2}}, "coordinates"),
        ({"geo_point_2d": "here"}, "coordinates"),
        ({"geo_shape": "line"}, "geo_shape"),
    ],
)
def test_rejected_arc_records(spark, tmp_path, changes, reason):
    root = land(tmp_path / "p", [(0, 0, page(1, arc(**changes)))])
    row = arcs.parse_arcs(pages.records_of(read(spark, root)), None, "run").first()
    assert row["reject_reasons"] == [reason]


def test_null_measures_and_geometry_are_fine(spark, tmp_path):
    nulls = {"q": None, "k": "", "geo_point_2d": None, "geo_shape": None}
    root = land(tmp_path / "p", [(0, 0, page(1, arc(**nulls)))])
    row = arcs.parse_arcs(pages.records_of(read(spark, root)), None, "run").first()
    assert row["reject_reasons"] == []
    assert row["vehicle_flow"] is None and row["longitude"] is None and row["geo_shape"] is None


def test_station_record(spark, tmp_path, utc):
    hours = {"sun": "x", "mon": "y"}
    root = land(tmp_path / "p", [(0, 0, page(
        2,
        station(station_opening_hours=hours, duedate="2026-07-18T00:00:00+02:00"),
        station(stationcode="2", coordonnees_geo="nowhere"),
    ))])
    out = stations.transform_station(pages.records_of(read(spark, root, STATION_RECORD)), utc(2026, 7, 18))
    first, second = out.orderBy(F.desc("stationcode")).collect()
    assert str(first["last_reported"]) == "2026-07-17 22:00:00"
    assert first["station_opening_hours"] == '{"mon":"y","sun":"x"}'
    assert (second["lon"], second["lat"]) == (None, None)


def test_run_identity_is_required(spark, tmp_path):
    records = pages.records_of(read(spark, land(tmp_path / "p", [(0, 0, page(1, arc()))])))
    with pytest.raises(ValueError):
        arcs.parse_arcs(records, None, "")
    with pytest.raises(ValueError):
        arcs.parse_arcs(records, datetime(2026, 1, 1), "run")


# -- windows


def test_incremental_window(utc):
    now = utc(2026, 7, 18, 12)
    assert windows.incremental_window(None, now)[0] == utc(2026, 7, 18, 6)
    assert windows.incremental_window(utc(2026, 7, 18, 9), now)[0] == utc(2026, 7, 18, 7)
    assert windows.incremental_window(utc(2026, 7, 19), now)[0] == now
    summer = timezone(timedelta(hours=2))
    assert windows.incremental_window(None, datetime(2026, 7, 18, 14, tzinfo=summer))[1] == now
    with pytest.raises(ValueError):
        windows.incremental_window(None, datetime(2026, 7, 18))


def test_time_chunks(spark, utc):
    def bounds(start, end, hours=2):
        rows = windows.time_chunks(spark, start, end, hours).orderBy("chunk_no").selectExpr(
            "date_format(chunk_start, 'HH:mm') a", "date_format(chunk_end, 'HH:mm') b"
        )
        return [tuple(r) for r in rows.collect()]

    day = (2026, 7, 18)
    assert bounds(utc(*day, 0), utc(*day, 5)) == [
        ("00:00", "02:00"), ("02:00", "04:00"), ("04:00", "05:00")
    ]
    assert bounds(utc(*day, 0), utc(*day, 4)) == [("00:00", "02:00"), ("02:00", "04:00")]
    assert bounds(utc(*day, 3), utc(*day, 3)) == [("03:00", "03:00")]
    with pytest.raises(ValueError):
        windows.time_chunks(spark, utc(*day, 2), utc(*day, 1))
    with pytest.raises(ValueError):
        windows.time_chunks(spark, utc(*day, 0), utc(*day, 1), hours=0)


def test_window_filter_is_closed_on_both_sides(spark, utc):
    df = spark.sql(
        "select explode(sequence(timestamp'2026-07-17 19:00:00Z', timestamp'2026-07-17 23:00:00Z',"
        " interval 1 hour)) t"
    )
    start, end = utc(2026, 7, 17, 20), utc(2026, 7, 17, 22)
    assert df.filter(windows.in_window("t", start, end)).count() == 3
    assert df.filter(windows.in_window("t", start)).count() == 4
    with pytest.raises(ValueError):
        windows.in_window("t", end, start)
    with pytest.raises(ValueError):
        windows.in_window("t", datetime(2026, 7, 17))


# -- provider


def arc_provider():
    """Serves two arcs per hour of the window, ordered by time."""

    def serve(start, end, offset, size):
        hours = int((end - start).total_seconds() // 3600) + 1
        rows = [
            {"iu_ac": str(a), "t_1h": (start + timedelta(hours=h)).isoformat(), "q": h}
            for h in range(hours) for a in (1, 2)
        ]
        return {"total_count": len(rows), "results": rows[offset:offset + size]}

    return serve


def test_provider_chunks_are_partitions_and_land_as_lines(spark, tmp_path, utc):
    start, end = utc(2026, 7, 18, 0), utc(2026, 7, 18, 4)
    documents = provider.fetch_documents(spark, arc_provider(), start, end, page_size=4)
    assert documents.rdd.getNumPartitions() == 2
    path = str(tmp_path / "landed")
    provider.land_documents(documents, path)
    p = pages.read_pages(spark, path, ARC_RECORD, layout="lines")
    records = pages.records_of(p)
    assert pages.validate_pages(p).count() == 0
    assert tuple(pages.fetch_stats(p, records, KEY).first()) == (4, 12, 10)


def test_windows_beyond_the_api_limit_are_halved(spark, tmp_path, utc):
    documents = provider.fetch_documents(
        spark, arc_provider(), utc(2031, 3, 9, 0), utc(2031, 3, 9, 8), hours=4, max_records=4
    )
    path = str(tmp_path / "landed")
    provider.land_documents(documents, path)
    p = pages.read_pages(spark, path, ARC_RECORD, layout="lines")
    assert pages.page_totals(p).filter("highest_total > 4").count() == 0
    assert pages.page_totals(p).count() > 2
    crowded = lambda *a: {"total_count": 99, "results": []}
    chunk = '[[0, "2031-03-09T00:00:00+00:00", "2031-03-09T01:00:00+00:00"]]'
    reader = provider.PageReader({"chunks": chunk, "provider": encoded(crowded), "maxRecords": "4"})
    with pytest.raises(pages.IngestError):
        list(reader.read(reader.partitions()[0]))


def encoded(fetch):
    import base64

    from pyspark import cloudpickle

    return base64.b64encode(cloudpickle.dumps(fetch)).decode()


def test_broken_provider_page_is_reported(spark, tmp_path, utc):
    documents = provider.fetch_documents(
        spark, lambda *a: {"total_count": "x"}, utc(2026, 7, 18), utc(2026, 7, 18)
    )
    path = str(tmp_path / "landed")
    provider.land_documents(documents, path)
    p = pages.read_pages(spark, path, ARC_RECORD, layout="lines")
    assert pages.validate_pages(p).count() == 1
