"""Observation tables derived from the benchmark tables.

The engine's own feeds are not among the benchmark tables, so both raw tables
and both run logs are derived from them, row for row: arcs from ``events``,
stations from ``lineitem``, runs from ``orders``. The oracle SQL in
``oracles.py`` derives the same rows.
"""

from __future__ import annotations

from datetime import datetime, timezone
from decimal import Decimal
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, TimestampNTZType, TimestampType

from obs_engine.functions.keys import day_of, wall
from obs_engine.functions.parsing import EXACT
from obs_engine.operators.runs import all_runs, arc_runs, station_runs
from obs_engine.plans import arcs, stations
from obs_engine.schemas import ARC_RAW, ARC_RUN, STATION_RAW, STATION_RUN
from obs_engine.session import pin_utc, shuffles_dropped, work_path

# Clocks of the derived feeds: shortly after their last observation.
ARC_AS_OF = datetime(2024, 1, 31, 6, tzinfo=timezone.utc)
STATION_AS_OF = datetime(2001, 12, 1, tzinfo=timezone.utc)
RUN_AS_OF = datetime(2001, 8, 15, tzinfo=timezone.utc)

# Pages of one landed file: 100 records of some 350 bytes each make about 150 MB.
PAGES_PER_FILE = 4096


def portable(df: DataFrame) -> DataFrame:
    """Engine-neutral values: dates and times as text, exact numbers as doubles."""

    def plain(field) -> Column:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, TimestampType):
            return wall(c).cast("string").alias(field.name)
        if isinstance(field.dataType, (TimestampNTZType, DateType)):
            return c.cast("string").alias(field.name)
        if isinstance(field.dataType, DecimalType):
            return c.cast("double").alias(field.name)
        return c

    return df.select(*[plain(f) for f in df.schema.fields])


def _hours(n: Column) -> Column:
    return F.make_dt_interval(hours=n.cast("int"))


def _minutes(n: Column) -> Column:
    return F.make_dt_interval(mins=n.cast("int"))


class Inputs:
    """The derived tables of one benchmark directory, all lazy."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = pin_utc(spark), sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def keep(self, name: str) -> None:
        """Write a derived table to the shared folder; what is built on it from now on reads it there."""
        df, path = getattr(self, name), work_path(self.spark, name.replace("_", "-"))
        df.write.parquet(path)
        setattr(self, name, self.spark.read.schema(df.schema).parquet(path))

    # arcs

    @cached_property
    def arc_base(self) -> DataFrame:
        """One arc observation per event, with its ``event_id``."""
        e, user, n = self.table("events"), F.col("user_id"), F.col("event_id")
        k = F.get_json_object("props", "$.k").cast("decimal(10,0)")
        status = (
            F.when(F.col("event_type") == "click", "Fluide")
            .when(F.col("event_type") == "view", "Pré-saturé")
            .when(F.col("event_type") == "purchase", "Saturé")
            .when(F.col("event_type") == "error", "Bloqué")
            .when(n % 2 == 0, "Inconnu")
        )
        access = (
            F.when(n % 5 == 0, "Barré")
            .when(n % 5 == 1, "Invalide")
            .when(n % 5 > 2, "Ouvert")
        )
        down = F.when(user % 9 != 0, (user * 2 + 1).cast("string"))
        start = F.date_add(F.lit("2020-01-01").cast("date"), (user % 365).cast("int"))
        shape = F.concat(
            F.lit('{"coordinates":['), user % 1000, F.lit(","), user % 700,
            F.lit('],"type":"Point"}'),
        )
        flow = F.col("value").cast("decimal(18,2)").cast(EXACT)
        return e.select(
            "event_id",
            user.cast("string").alias("arc_id"),
            F.concat(F.lit("arc "), user).alias("arc_label"),
            F.col("ts").cast("timestamp").alias("observed_at"),
            F.when(n % 7 != 0, flow).alias("vehicle_flow"),
            F.when(n % 11 != 0, (k * F.lit(Decimal("1.1"))).cast(EXACT)).alias("occupancy_rate"),
            status.alias("traffic_status"),
            access.alias("arc_status"),
            (user * 2).cast("string").alias("upstream_node_id"),
            F.concat(F.lit("node "), user * 2).alias("upstream_node_label"),
            down.alias("downstream_node_id"),
            F.concat(F.lit("node "), down).alias("downstream_node_label"),
            start.alias("source_start_date"),
            F.date_add(start, 1000).alias("source_end_date"),
            F.when(user % 50 != 0, F.lit(2.0) + (user % 1000) / F.lit(1000.0)).alias("longitude"),
            F.when(user % 50 != 0, F.lit(48.0) + (user % 700) / F.lit(1000.0)).alias("latitude"),
            shape.alias("geo_shape"),
            (F.col("ts") + _hours(n % 5)).cast("timestamp").alias("ingested_at"),
            F.concat(F.lit("run-"), n % 24).alias("source_run_id"),
        )

    @cached_property
    def arc_raw(self) -> DataFrame:
        return self.arc_base.select(*ARC_RAW.fieldNames())

    @cached_property
    def arc_batch(self) -> DataFrame:
        """The next load: a tenth corrected, a tenth new, the rest re-sent as it was."""
        n = F.col("event_id")
        return self.arc_base.withColumns(
            {
                "vehicle_flow": F.when(
                    n % 10 == 0,
                    (F.coalesce("vehicle_flow", F.lit(0)) + F.lit(1)).cast(EXACT),
                ).otherwise(F.col("vehicle_flow")),
                "observed_at": F.when(
                    n % 10 == 1, F.col("observed_at") + _hours(F.lit(1))
                ).otherwise(F.col("observed_at")),
                "ingested_at": F.lit(ARC_AS_OF),
                "source_run_id": F.lit("run-late"),
            }
        ).select(*ARC_RAW.fieldNames())

    @cached_property
    def arc_staged(self) -> DataFrame:
        return arcs.stage_arcs(self.arc_raw)

    @cached_property
    def arc_fact(self) -> DataFrame:
        return arcs.arc_fact(self.arc_staged)

    @cached_property
    def arc_daily(self) -> DataFrame:
        return arcs.arc_daily(self.arc_fact)

    @cached_property
    def arc_dim(self) -> DataFrame:
        return arcs.arc_dim(self.arc_staged)

    @cached_property
    def arc_current(self) -> DataFrame:
        return arcs.arc_current(self.arc_staged, ARC_AS_OF)

    # stations

    @cached_property
    def station_raw(self) -> DataFrame:
        """One station report per order line; lines of one day and half-day collide."""
        li, supp, line = self.table("lineitem"), F.col("l_suppkey"), F.col("l_linenumber")
        bikes = F.col("l_quantity").cast("int") - 1
        capacity = (
            F.when(supp % 33 == 0, F.lit(None))
            .when(supp % 25 == 0, 0)
            .otherwise(30 + supp % 25)
            .cast("int")
        )
        reported = F.col("l_shipdate") + _hours((line % 2) * 12)
        lon = F.when(supp % 41 == 0, F.lit(200.0)).when(
            supp % 17 != 0, F.lit(2.0) + (supp % 1000) / F.lit(1000.0)
        )
        out = li.select(
            supp.cast("string").alias("stationcode"),
            F.concat(F.lit("station "), supp).alias("name"),
            F.when(supp % 20 == 0, "NON").otherwise("OUI").alias("is_installed"),
            capacity.alias("capacity"),
            (F.coalesce(capacity, F.lit(0)) - bikes).alias("num_docks_available"),
            bikes.alias("num_bikes_available"),
            F.when(F.col("l_partkey") % 13 != 0, bikes - bikes % 3).alias("mechanical"),
            (bikes % 3).alias("ebike"),
            F.when(line == 7, "NON").when(line != 6, "OUI").alias("is_renting"),
            F.when(F.col("l_returnflag") == "R", "NON").otherwise("OUI").alias("is_returning"),
            reported.alias("last_reported"),
            lon.alias("lon"),
            F.when(supp % 17 != 0, F.lit(48.0) + (supp % 700) / F.lit(1000.0)).alias("lat"),
            F.concat(F.lit("commune "), supp % 20).alias("nom_arrondissement_communes"),
            (75000 + supp % 20).cast("string").alias("code_insee_commune"),
            F.lit(None).cast("string").alias("station_opening_hours"),
            (reported + _hours(F.col("l_orderkey") % 5)).alias("ingested_at"),
        )
        return out.select(*STATION_RAW.fieldNames())

    @cached_property
    def station_staged(self) -> DataFrame:
        return stations.stage_stations(self.station_raw)

    @cached_property
    def station_fact(self) -> DataFrame:
        return stations.station_fact(self.station_staged)

    @cached_property
    def station_daily(self) -> DataFrame:
        return stations.station_daily(self.station_fact)

    @cached_property
    def station_dim(self) -> DataFrame:
        return stations.station_dim(self.station_staged)

    @cached_property
    def station_current(self) -> DataFrame:
        return stations.station_current(stations.named_stations(self.station_raw), STATION_AS_OF)

    # runs

    @cached_property
    def station_log(self) -> DataFrame:
        """One station run per order."""
        key, cust = F.col("o_orderkey"), F.col("o_custkey")
        failed = F.col("o_orderstatus") == "F"
        started = (F.col("o_orderdate") + _minutes(key % 1440)).cast("timestamp")
        millis = (cust * 37 + key) % 9000
        received = (cust % 3000).cast("int")
        inserted = F.when(failed, 0).otherwise(F.expr("(o_custkey % 3000) * (o_orderkey % 4) div 3"))
        return self.table("orders").select(
            F.concat(F.lit("run-"), key).alias("run_id"),
            F.lit("stations").alias("dag_id"),
            F.lit("load").alias("task_id"),
            started.alias("started_at"),
            F.timestamp_micros(F.unix_micros(started) + millis * 1000).alias("finished_at"),
            F.when(failed, "failed").otherwise("success").alias("status"),
            F.expr("cast((o_custkey % 3000) div 100 + 1 as int)").alias("pages_fetched"),
            received.alias("reported_total"),
            received.alias("records_received"),
            inserted.cast("int").alias("records_inserted"),
            F.when(failed, 0).otherwise(received - inserted).cast("int").alias(
                "duplicates_ignored"
            ),
            (millis.cast("decimal(12,0)") / 1000).cast("decimal(12,3)").alias("duration_seconds"),
            F.when(failed, F.concat(F.lit("timeout "), "o_orderpriority")).alias("error_message"),
            started.alias("created_at"),
        ).select(*STATION_RUN.fieldNames())

    @cached_property
    def arc_log(self) -> DataFrame:
        """One arc run per order; one in 97 leaves a record unclassified."""
        key, cust = F.col("o_orderkey"), F.col("o_custkey")
        failed = F.col("o_orderstatus") == "F"
        started = (F.col("o_orderdate") + _minutes(key % 1440 + 35)).cast("timestamp")
        millis = (cust * 53 + key) % 20000
        received = cust % 9000
        inserted, updated = F.expr("o_custkey % 9000 div 3"), F.expr("o_custkey % 9000 div 10")
        lost = F.when((key % 97 == 0) & (received > 0), 1).otherwise(0)

        def unless_failed(c: Column) -> Column:
            return F.when(failed, 0).otherwise(c).cast("int")

        return self.table("orders").select(
            F.concat(F.lit("arcs::"), key).alias("run_key"),
            F.concat(F.lit("run-"), key).alias("airflow_run_id"),
            F.lit("arcs").alias("dag_id"),
            F.lit("load").alias("task_id"),
            started.alias("started_at"),
            F.timestamp_micros(F.unix_micros(started) + millis * 1000).alias("finished_at"),
            F.when(failed, "failed").otherwise("success").alias("status"),
            (started - _hours(F.lit(6))).alias("window_start"),
            started.alias("window_end"),
            F.when(key % 10 != 0, started - _hours(F.lit(4))).alias("watermark_before"),
            F.expr("cast((o_custkey % 9000) div 100 + 1 as int)").alias("pages_fetched"),
            received.cast("int").alias("reported_total"),
            received.cast("int").alias("records_received"),
            unless_failed(inserted).alias("records_inserted"),
            unless_failed(updated).alias("records_updated"),
            unless_failed(received - inserted - updated - lost).alias("records_unchanged"),
            (millis.cast("decimal(12,0)") / 1000).cast("decimal(12,3)").alias("duration_seconds"),
            F.when(failed, F.concat(F.lit("timeout "), "o_orderpriority")).alias("error_message"),
        ).select(*ARC_RUN.fieldNames())

    @cached_property
    def station_runs(self) -> DataFrame:
        return station_runs(self.station_log)

    @cached_property
    def arc_runs(self) -> DataFrame:
        return arc_runs(self.arc_log)

    @cached_property
    def all_runs(self) -> DataFrame:
        return all_runs(self.station_runs, self.arc_runs)

    def named(self) -> dict[str, DataFrame]:
        """Every derived table under the names the checks use."""
        return {
            "raw_stations": self.station_raw,
            "stg_stations": self.station_staged,
            "dim_stations": self.station_dim,
            "fct_station_status": self.station_fact,
            "agg_station_daily": self.station_daily,
            "station_current": self.station_current,
            "raw_road_traffic": self.arc_raw,
            "stg_road_traffic": self.arc_staged,
            "dim_road_arcs": self.arc_dim,
            "fct_road_traffic": self.arc_fact,
            "agg_road_traffic_daily": self.arc_daily,
            "arc_current": self.arc_current,
            "ingestion_runs": self.station_log,
            "traffic_ingestion_runs": self.arc_log,
            "station_runs": self.station_runs,
            "arc_runs": self.arc_runs,
            "all_runs": self.all_runs,
        }

    # pages

    def arc_record(self, flow: Column) -> Column:
        """An event as a record of the arc API, with the given flow."""
        user, n = F.col("user_id"), F.col("event_id")
        clock_text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        point = F.struct((user % 90).alias("lon"), (user % 80).alias("lat"))
        shape = F.struct(
            F.lit("Point").alias("type"), F.array(user % 90, user % 80).alias("coordinates")
        )
        return F.struct(
            user.cast("string").alias("iu_ac"),
            F.concat(F.lit("arc "), user).alias("libelle"),
            F.concat(clock_text, F.lit("+00:00")).alias("t_1h"),
            F.when(n % 7 != 0, flow).alias("q"),
            F.when(n % 11 != 0, F.get_json_object("props", "$.k").cast("int")).alias("k"),
            F.col("event_type").alias("etat_trafic"),
            F.when(user % 9 != 0, user).alias("iu_nd_aval"),
            F.lit("2020-01-01T00:00:00").alias("date_debut"),
            F.when(user % 50 != 0, point).alias("geo_point_2d"),
            shape.alias("geo_shape"),
        )

    def write_station_pages(self, path: str, per_page: int = 100, compression: str | None = None) -> None:
        """Station reports as API pages in the ``lines`` layout, one chunk per month.

        Of reports of one station and instant the first order line's is served, as a page
        set holds a record once. A record's place in its month is its place among its
        station's plus the records of the stations before, so no task sorts a whole month.
        Records are made where their page is: only the columns they follow from are shuffled.
        A file holds a bounded number of pages, as one that is compressed is read by one task.
        """
        line, supp = F.col("l_linenumber"), F.col("l_suppkey")
        month, station = F.year("l_shipdate") * 12 + F.month("l_shipdate"), F.coalesce(supp, F.lit(-(1 << 63)))
        slot = Window.partitionBy("chunk", "station", "l_shipdate", line % 2).orderBy("l_orderkey", "l_linenumber")
        li = self.table("lineitem").withColumns({"chunk": month, "station": station}).where("chunk is not null")
        li = li.repartition("chunk", "station").withColumn("_r", F.row_number().over(slot)).where("_r = 1")
        own = Window.partitionBy("chunk", "station").orderBy("l_orderkey", "l_linenumber")
        upto = Window.partitionBy("chunk").orderBy("station")
        each = li.groupBy("chunk", "station").agg(F.count(F.lit(1)).alias("own"))
        starts = each.select(
            "chunk", "station", (F.sum("own").over(upto) - F.col("own")).alias("before"),
            F.sum("own").over(Window.partitionBy("chunk")).alias("total_count"),
        )
        parts = ("l_suppkey", "l_linenumber", "l_quantity", "l_shipdate")
        rows = li.select("chunk", "station", (F.row_number().over(own) - 1).alias("place"), *parts)
        rows = rows.join(starts, ["chunk", "station"]).withColumn("n", F.col("before") + F.col("place"))
        pages = rows.groupBy("chunk", "total_count", F.expr(f"n div {per_page} * {per_page}").alias("offset")).agg(
            F.sort_array(F.collect_list(F.struct("n", *parts))).alias("rs")
        )
        results = F.transform("rs", self._station_record).alias("results")
        document = F.to_json(F.struct(F.col("chunk").alias("chunk_no"), "offset", "total_count", results))
        landed = pages.select(document.alias("value"))
        with shuffles_dropped(self.spark):
            landed.write.options(maxRecordsPerFile=PAGES_PER_FILE).text(path, compression=compression)

    @staticmethod
    def _station_record(x: Column) -> Column:
        """An order line as a record of the station API."""
        supp, line, bikes = x["l_suppkey"], x["l_linenumber"], x["l_quantity"].cast("int") - 1
        capacity = F.when(supp % 33 != 0, F.when(supp % 25 == 0, 0).otherwise(30 + supp % 25)).cast("int")
        # Two notations of one instant.
        at = x["l_shipdate"].cast("timestamp_ntz") + _hours((line % 2) * 12)
        iso = "yyyy-MM-dd'T'HH:mm:ss"
        due = F.when(supp % 2 == 0, F.concat(F.date_format(at, iso), F.lit("+00:00"))).otherwise(
            F.concat(F.date_format(at + _hours(F.lit(2)), iso), F.lit("+02:00"))
        )
        return F.struct(
            supp.cast("string").alias("stationcode"), F.concat(F.lit("station "), supp).alias("name"),
            F.when(supp % 20 == 0, "NON").otherwise("OUI").alias("is_installed"), capacity.alias("capacity"),
            (F.coalesce(capacity, F.lit(0)) - bikes).alias("numdocksavailable"), bikes.alias("numbikesavailable"),
            (bikes - bikes % 3).alias("mechanical"), (bikes % 3).alias("ebike"), F.lit("OUI").alias("is_renting"),
            F.lit("OUI").alias("is_returning"), due.alias("duedate"),
            F.when(supp % 17 != 0, F.struct((2 + supp % 90 / 100).alias("lon"), (48 + supp % 80 / 100).alias("lat"))).alias("coordonnees_geo"),
            F.concat(F.lit("commune "), supp % 20).alias("nom_arrondissement_communes"),
            (75000 + supp % 20).cast("string").alias("code_insee_commune"),
        )

    def page_documents(self, per_page: int = 100) -> DataFrame:
        """The events as API pages, one chunk per day: JSON lines ``value``.

        Event ids are dense in time order, so a record's offset within its day
        is its id minus the day's first id: no window over a day is needed, and
        a page gathers at most ``per_page`` records.
        """
        n, record = F.col("event_id"), self.arc_record(F.col("value"))
        e = self.table("events").withColumn("day", day_of("ts"))
        days = e.groupBy("day").agg(
            F.min("event_id").alias("first_id"), F.count(F.lit(1)).alias("total_count")
        )
        pages = (
            e.join(days, "day")
            .withColumn("n", n - F.col("first_id"))
            .groupBy("day", "total_count", F.expr(f"n div {per_page}").alias("page"))
            .agg(
                F.min("n").alias("offset"),
                F.sort_array(F.collect_list(F.struct("n", record.alias("r")))).alias("rs"),
            )
        )
        document = F.struct(
            F.datediff("day", F.lit("2024-01-01").cast("date")).alias("chunk_no"),
            "offset",
            "total_count",
            F.transform("rs", lambda x: x["r"]).alias("results"),
        )
        return pages.select(F.to_json(document).alias("value"))
