"""Sources, document ingest, sinks and the relational meter store."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterloom.functions import scalars as S
from meterloom.operators import align
from meterloom.plans import views
from meterloom.plans.registry import query
from meterloom.plans.shared import meters, preferred, r4, series, stamp, text, unit_daily, whole
from meterloom.sources import ingest, sinks
from meterloom.sources.tables import load, scan
from meterloom.streaming import ingest as streaming

TS = "'%Y-%m-%d %H:%M:%S'"

# --- documents built from the star schema --------------------------------------------

_META = """meta AS (SELECT 'r' || p_partkey AS reading, p_brand AS energy_type,
    CASE p_partkey % 3 WHEN 0 THEN 'Wh' WHEN 1 THEN 'MWh' ELSE 'kWh' END AS unit,
    CASE p_partkey % 2 WHEN 0 THEN 'INSTANT' ELSE 'CUMULATIVE' END AS period FROM part)"""
_KILO = "CASE unit WHEN 'Wh' THEN {0} / 1000 WHEN 'MWh' THEN {0} * 1000 ELSE {0} END"


def metadata(spark, folder):
    key = F.col("p_partkey")
    return load(spark, folder, "part").select(
        F.concat(F.lit("r"), key.cast("string")).alias("reading"),
        F.col("p_brand").alias("type"),
        F.when(key % 3 == 0, "Wh").when(key % 3 == 1, "MWh").otherwise("kWh").alias("unit"),
        F.when(key % 2 == 0, "INSTANT").otherwise("CUMULATIVE").alias("period"),
    )


def billing_docs(spark, folder):
    b = views.bills(spark, folder)
    half = lambda share: (F.col("value") * share).cast("double")
    values = F.create_map(F.lit("p1"), half(0.5), F.lit("p2"), half(0.25), F.lit("p3"), half(0.25))
    return b.select(
        F.col("ini").cast("timestamp").alias("timestamp_start_bill"),
        F.col("fin").cast("timestamp").alias("timestamp_end_bill"),
        F.concat(F.lit("r"), (F.col("device") * 2).cast("string")).alias("reading"),
        F.col("device").cast("string").alias("device"),
        values.alias("values"),
        "company",
        "bill_id",
    )


def metering_docs(spark, folder):
    return views.readings(spark, folder).select(
        F.col("ts").alias("timestamp"),
        F.concat(F.lit("r"), (F.col("device") * 20).cast("string")).alias("reading"),
        F.col("device").cast("string").alias("device"),
        "value",
        F.lit("c1").alias("company"),
        "event_id",
    )


# --- scans ------------------------------------------------------------------------------


@query(
    "s01_keyed_scan",
    f"""SELECT CAST(floor(epoch(ts)) AS BIGINT) AS ts, device, value FROM readings
    WHERE ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-12'""",
)
def s01(spark, folder):
    import datetime as dt

    raw = scan(
        load(spark, folder, "events"),
        ["ts", "user_id", "value"],
        "ts",
        dt.datetime(2024, 1, 5, tzinfo=dt.timezone.utc),
        dt.datetime(2024, 1, 12, tzinfo=dt.timezone.utc),
    )
    return raw.select(S.to_epoch("ts").alias("ts"), F.col("user_id").alias("device"), "value")


@query(
    "s02_tables_that_exist",
    """SELECT device, CAST(day AS VARCHAR) AS day, value, source FROM daily WHERE source IN ('R', 'N')""",
)
def s02(spark, folder):
    path = sinks.work_path(spark, "measurements")
    d = views.daily(spark, folder).select("device", "day", "value", "source")
    sinks.write_table(d, path, ["source"], ["device"])
    schema = T.StructType(
        [
            T.StructField("device", T.LongType()),
            T.StructField("day", T.DateType()),
            T.StructField("value", T.DoubleType()),
            T.StructField("source", T.StringType()),
        ]
    )
    out = sinks.read_existing(spark, path, schema, source=["R", "N", "absent"])
    return out.select("device", text("day"), "value", "source")


@query("s03_tab_separated", "SELECT device, CAST(day AS VARCHAR) AS day, value FROM series")
def s03(spark, folder):
    path = sinks.work_path(spark, "tsv")
    rows = series(spark, folder).select("device", "day", "value")
    sinks.write_tsv(rows, path)
    return sinks.read_tsv(spark, path, rows.schema).select("device", text("day"), "value")


@query(
    "s04_document_source",
    f"""SELECT CAST(device AS VARCHAR) AS device, CAST(ini AS VARCHAR) AS ini, r4(value * 0.5) AS p1 FROM bills
    WHERE company = '1-URGENT' AND ini BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'""",
)
def s04(spark, folder):
    import datetime as dt

    path = sinks.work_path(spark, "documents")
    billing_docs(spark, folder).write.json(path)
    docs = ingest.read_documents(
        spark,
        path,
        ingest.BILLING_DOC,
        company="1-URGENT",
        time="timestamp_start_bill",
        start=dt.datetime(1996, 1, 1, tzinfo=dt.timezone.utc),
        stop=dt.datetime(1998, 12, 31, tzinfo=dt.timezone.utc),
    )
    return docs.select("device", F.to_date("timestamp_start_bill").cast("string").alias("ini"), r4(F.col("values")["p1"], "p1"))


# --- ingest --------------------------------------------------------------------------------

_BILL_GOOD = f"""WITH {_META}, b AS (SELECT *, 'r' || (device * 2) AS reading FROM bills),
  g AS (SELECT b.*, energy_type, unit FROM b JOIN meta USING (reading))"""


@query(
    "s05_ingest_billing",
    _BILL_GOOD
    + f""" SELECT bill_id, energy_type, epoch(ini)::BIGINT AS ts_ini, epoch(fin)::BIGINT AS ts_end,
      r4({_KILO.format("value * 0.5")}) AS p1, r4({_KILO.format("value")}) AS value FROM g""",
)
def s05(spark, folder):
    found = ingest.with_reading(billing_docs(spark, folder), metadata(spark, folder))
    good, _ = ingest.split_errors(found, "2024-01-01")
    out = ingest.billing_rows(good)
    return out.select("bill_id", "energy_type", "ts_ini", "ts_end", r4(F.col("values")["p1"], "p1"), r4("value"))


@query(
    "s06_ingest_metering",
    f"""WITH {_META}, d AS (SELECT *, 'r' || (device * 20) AS reading FROM readings)
    SELECT event_id, energy_type, r4(CASE WHEN period = 'INSTANT' THEN {_KILO.format("value")} END) AS value,
      r4(CASE WHEN period <> 'INSTANT' THEN {_KILO.format("value")} END) AS accumulated FROM d JOIN meta USING (reading)""",
)
def s06(spark, folder):
    found = ingest.with_reading(metering_docs(spark, folder), metadata(spark, folder))
    good, _ = ingest.split_errors(found, "2024-01-01")
    return ingest.metering_rows(good).select("event_id", "energy_type", r4("value"), r4("accumulated"))


@query(
    "s07_ingest_weather",
    """SELECT CAST(epoch(hour) AS BIGINT) AS ts, CAST(station AS VARCHAR) AS stationId, r4(temperature) AS temperature,
      wind_speed AS windSpeed, CAST(NULL AS DOUBLE) AS humidity FROM meteo_hourly""",
)
def s07(spark, folder):
    path = sinks.work_path(spark, "weather")
    docs = views.meteo_hourly(spark, folder).select(
        F.col("hour").alias("time"),
        F.col("station").cast("string").alias("stationId"),
        "temperature",
        F.col("wind_speed").alias("windSpeed"),
        F.col("ghi").alias("GHI"),
    )
    rows = ingest.weather_rows(docs)
    sinks.write_table(rows, path, cluster_by=["stationId"])
    return spark.read.parquet(path).select("ts", "stationId", r4("temperature"), "windSpeed", "humidity")


@query(
    "s08_dead_letters",
    f"""WITH {_META}, b AS (SELECT *, 'r' || (device * 2) AS reading FROM bills)
    SELECT bill_id, reading, 'unknown reading' AS error, '2024-01-01' AS detected_at FROM b
    WHERE reading NOT IN (SELECT reading FROM meta)""",
)
def s08(spark, folder):
    found = ingest.with_reading(billing_docs(spark, folder), metadata(spark, folder))
    _, bad = ingest.split_errors(found, "2024-01-01")
    return bad.select("bill_id", "reading", "error", "detected_at")


@query(
    "j15_reading_lookup",
    f"""WITH {_META}, d AS (SELECT *, 'r' || (device * 20) AS reading FROM readings)
    SELECT event_id, reading, energy_type, unit, period, energy_type IS NOT NULL AS known FROM d LEFT JOIN meta USING (reading)""",
)
def j15(spark, folder):
    found = ingest.with_reading(metering_docs(spark, folder), metadata(spark, folder))
    return found.select("event_id", "reading", "energy_type", "unit", "period", "known")


@query(
    "p13_periods_to_map",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, r4(CASE WHEN l_quantity > 25 THEN l_quantity ELSE 0 END + l_tax + l_discount) AS total,
      CAST(CASE WHEN l_quantity > 25 THEN 3 ELSE 2 END AS BIGINT) AS n_periods FROM lineitem""",
)
def p13(spark, folder):
    wide = load(spark, folder, "lineitem").select(
        "l_orderkey",
        whole("l_linenumber"),
        "l_partkey",
        "l_suppkey",
        F.when(F.col("l_quantity") > 25, F.col("l_quantity")).alias("p1"),
        F.col("l_tax").alias("p2"),
        F.col("l_discount").alias("p3"),
    )
    out = ingest.periods_to_map(wide, ["p1", "p2", "p3"])
    return out.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", r4("total"), whole(F.size("values"), "n_periods")
    )


# --- sinks ---------------------------------------------------------------------------------------


@query(
    "s09_replace_by_key",
    """SELECT device, CAST(day AS VARCHAR) AS day, value FROM preferred WHERE device IN (SELECT device FROM daily
      WHERE source = 'A' AND day < DATE '1996-06-01')
    UNION ALL SELECT device, CAST(day AS VARCHAR), value FROM series WHERE device NOT IN (SELECT device FROM daily
      WHERE source = 'A' AND day < DATE '1996-06-01')""",
)
def s09(spark, folder):
    picked = views.daily(spark, folder).filter("source = 'A' and day < date'1996-06-01'").select("device").distinct()
    new = preferred(spark, folder).join(picked, "device", "left_semi")
    return sinks.replace_by_key(series(spark, folder), new, ["device"]).select("device", text("day"), "value")


@query(
    "s09_replace_in_table",
    """SELECT device, CAST(day AS VARCHAR) AS day, CASE WHEN year(day) = 1997 AND device % 2 = 0 THEN value * 2 ELSE value END
      AS value FROM series""",
)
def s09_table(spark, folder):
    path = sinks.work_path(spark, "clean")
    rows = series(spark, folder).withColumn("year", F.year("day"))
    sinks.create_table(rows, path, ["year"])
    new = rows.filter("year = 1997 and device % 2 = 0").withColumn("value", F.col("value") * 2)
    sinks.replace_in_table(spark, path, new, ["device", "day"], ["year"])
    return sinks.read_version(spark, path, rows.schema, ["year"]).select("device", text("day"), "value")


@query(
    "s10_archive_and_delete",
    """SELECT bill_id, CASE WHEN ini < DATE '1998-01-01' THEN 'archive' ELSE 'kept' END AS part FROM bills""",
)
def s10(spark, folder):
    a, b = sinks.work_path(spark, "archive"), sinks.work_path(spark, "kept")
    sinks.archive(views.bills(spark, folder), F.col("ini") < F.lit("1998-01-01").cast("date"), a, b)
    old = spark.read.parquet(a).select("bill_id", F.lit("archive").alias("part"))
    return old.unionByName(spark.read.parquet(b).select("bill_id", F.lit("kept").alias("part")))


@query(
    "s11_overwrite_table",
    """SELECT device, CAST(day AS VARCHAR) AS day, value, 'metering' AS data_type FROM series WHERE day >= DATE '1998-01-01'""",
)
def s11(spark, folder):
    path = sinks.work_path(spark, "consumption")
    rows = series(spark, folder).withColumn("data_type", F.lit("metering"))
    sinks.write_table(rows, path, ["data_type"], ["device"])
    sinks.write_table(rows.filter("day >= date'1998-01-01'"), path, ["data_type"], ["device"])
    return spark.read.parquet(path).select("device", text("day"), "value", "data_type")


@query(
    "s13_buffered_load",
    _BILL_GOOD
    + f""" SELECT CAST(device AS VARCHAR) AS device, energy_type, epoch(ini)::BIGINT AS ts_ini, r4({_KILO.format("value")}) AS value,
      'good' AS part FROM (SELECT DISTINCT device, energy_type, ini, fin, value, unit, company FROM g)
    UNION ALL SELECT CAST(device AS VARCHAR), NULL, epoch(ini)::BIGINT, NULL, 'error' FROM (SELECT DISTINCT device, ini, fin, value, company
      FROM bills WHERE 'r' || (device * 2) NOT IN (SELECT reading FROM meta))""",
)
def s13(spark, folder):
    source, good, errors, index = (sinks.work_path(spark, n) for n in ("stream-in", "stream-good", "stream-errors", "stream-index"))
    docs = billing_docs(spark, folder).drop("bill_id")
    # A third of the documents is delivered twice, the second time with any other documents, years later or earlier.
    again = docs.filter(F.crc32("device") % 3 == 0)
    docs.unionByName(again).repartition("device", "timestamp_end_bill").write.json(source)
    stream = streaming.document_stream(spark, source, ingest.BILLING_DOC, files_per_batch=2)
    streaming.load_stream(
        stream, metadata(spark, folder), ingest.billing_rows, good, errors, sinks.work_path(spark, "stream-state"), "2024-01-01",
        index, ["device", "timestamp_start_bill", "timestamp_end_bill", "company", "values"], "timestamp_start_bill",
    )
    a = spark.read.parquet(good).select("device", "energy_type", "ts_ini", r4("value"), F.lit("good").alias("part"))
    b = spark.read.parquet(errors).select(
        "device",
        F.lit(None).cast("string").alias("energy_type"),
        S.to_epoch("timestamp_start_bill").alias("ts_ini"),
        F.lit(None).cast("double").alias("value"),
        F.lit("error").alias("part"),
    )
    return a.unionByName(b)


@query(
    "s14_lookup_table",
    "SELECT station, count(*) AS n, sum(value) AS total FROM daily JOIN units USING (device) GROUP BY station",
)
def s14(spark, folder):
    lookup = views.units(spark, folder).select("device", "station")
    out = views.daily(spark, folder).join(lookup, "device").groupBy("station")
    return out.agg(F.count("*").alias("n"), F.sum("value").alias("total"))


# --- relational meter store ----------------------------------------------------------------------


def store_readings(spark, folder):
    """Movement with its channel's unit multiplier and, where known, the meter's type."""
    item = load(spark, folder, "lineitem").select(
        "l_suppkey", "l_partkey", F.to_date("l_shipdate").alias("day"), F.col("l_quantity").alias("movement")
    )
    channel = load(spark, folder, "part").select(
        F.col("p_partkey").alias("l_partkey"), "p_brand", (F.col("p_size") / 10.0).alias("coefficient")
    )
    meter = load(spark, folder, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    kind = load(spark, folder, "nation").select(
        F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("meter_type")
    )
    out = item.join(channel, "l_partkey").join(meter, "l_suppkey").join(kind, "s_nationkey", "left")
    return out.withColumn("value", F.col("movement") * F.col("coefficient"))


_STORE = """WITH st AS (SELECT l_suppkey AS device, l_partkey AS channel, CAST(l_shipdate AS DATE) AS day, l_quantity AS movement,
    l_quantity * (p_size / 10.0) AS value, n_name AS meter_type, l_orderkey, l_linenumber FROM lineitem
    JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey
    LEFT JOIN nation ON n_nationkey = s_nationkey)"""


@query(
    "j13_unit_multiplier",
    _STORE + " SELECT device, channel, CAST(day AS VARCHAR) AS day, movement, r4(value) AS value, meter_type FROM st",
)
def j13(spark, folder):
    out = store_readings(spark, folder)
    return out.select(
        F.col("l_suppkey").alias("device"), F.col("l_partkey").alias("channel"), text("day"), "movement", r4("value"), "meter_type"
    )


@query(
    "s15_store_series",
    _STORE
    + """, d AS (SELECT device, day, sum(value) AS value FROM (SELECT DISTINCT device, channel, day, value FROM st) GROUP BY ALL)
    SELECT device, CAST(day AS VARCHAR) AS day, r4(value) AS movement, r4(sum(value) OVER (PARTITION BY device ORDER BY day
      ROWS UNBOUNDED PRECEDING)) AS integ FROM d""",
)
def s15(spark, folder):
    from meterloom.functions.ordered import running_total

    rows = store_readings(spark, folder).select("l_suppkey", "l_partkey", "day", "value").distinct()
    daily = rows.groupBy(F.col("l_suppkey").alias("device"), "day").agg(F.sum("value").alias("value"))
    out = running_total(daily, ["device"], ["day"], "value", "integ")
    return out.select("device", text("day"), r4("value", "movement"), r4("integ"))


@query(
    "s16_series_catalogue",
    """SELECT s_suppkey AS device, s_name AS name, n_name AS meter_type FROM supplier
    LEFT JOIN nation ON n_nationkey = s_nationkey""",
)
def s16(spark, folder):
    kind = load(spark, folder, "nation").select(
        F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("meter_type")
    )
    out = load(spark, folder, "supplier").join(kind, "s_nationkey", "left")
    return out.select(F.col("s_suppkey").alias("device"), F.col("s_name").alias("name"), "meter_type")


@query(
    "j14_virtual_meter",
    """WITH tree AS (SELECT n_regionkey AS parent, s_suppkey AS device, 1.0 / (1 + n_nationkey % 4) AS factor
      FROM supplier JOIN nation ON n_nationkey = s_nationkey)
    SELECT CAST(parent AS BIGINT) AS parent, CAST(day AS VARCHAR) AS day, r4(sum(value * factor)) AS value, count(*) AS n_children
    FROM series JOIN tree USING (device) GROUP BY parent, day""",
)
def j14(spark, folder):
    nation = load(spark, folder, "nation").select(
        F.col("n_nationkey").alias("s_nationkey"), "n_regionkey", (1.0 / (1 + F.col("n_nationkey") % 4)).alias("factor")
    )
    tree = load(spark, folder, "supplier").join(nation, "s_nationkey").select(
        F.col("n_regionkey").alias("parent"), F.col("s_suppkey").alias("device"), "factor"
    )
    out = align.virtual_meter(series(spark, folder), tree, "day", "value")
    return out.select(whole("parent"), text("day"), r4("value"), "n_children")


@query(
    "j05_unit_building",
    """WITH direct AS (SELECT unit, unit * 10 AS building FROM buildings WHERE unit % 3 = 0),
      rep AS (SELECT unit, unit * 10 + 1 AS building FROM buildings WHERE unit % 2 = 0),
      b AS (SELECT unit * 10 + unnest([0, 1]) AS building, use_type, area FROM buildings)
    SELECT u.unit, coalesce(d.building, r.building) AS building, use_type, area FROM buildings0 u LEFT JOIN direct d USING (unit)
      LEFT JOIN rep r USING (unit) JOIN b ON b.building = coalesce(d.building, r.building)""".replace(
        "buildings0 u", "(SELECT unit FROM buildings) u"
    ),
)
def j05(spark, folder):
    b = views.buildings(spark, folder)
    u = F.col("unit")
    direct = b.filter(u % 3 == 0).select("unit", (u * 10).alias("building"))
    reporting = b.filter(u % 2 == 0).select("unit", (u * 10 + 1).alias("building"))
    known = b.select(F.explode(F.array(u * 10, u * 10 + 1)).alias("building"), "use_type", "area")
    out = align.attach_building(b.select("unit"), direct, reporting, known)
    return out.select("unit", "building", "use_type", "area")


@query(
    "j10_common_span",
    """WITH l AS (SELECT device, day, value AS a FROM series WHERE device % 2 = 0), r AS (SELECT device - 1 AS device, day, value AS b
        FROM series WHERE device % 2 = 1), s AS (SELECT device, greatest(l0, r0) AS f, least(l1, r1) AS t FROM
        (SELECT device, min(day) l0, max(day) l1 FROM l GROUP BY device) JOIN (SELECT device, min(day) r0, max(day) r1 FROM r
        GROUP BY device) USING (device))
    SELECT device, CAST(day AS VARCHAR) AS day, a, b, CAST(f AS VARCHAR) AS span_from, CAST(t AS VARCHAR) AS span_to
    FROM l JOIN r USING (device, day) JOIN s USING (device) WHERE day BETWEEN f AND t""",
)
def j10(spark, folder):
    s = series(spark, folder)
    left = s.filter("device % 2 = 0").withColumnRenamed("value", "a")
    right = s.filter("device % 2 = 1").select((F.col("device") - 1).alias("device"), "day", F.col("value").alias("b"))
    out = align.common_span(left, right, ["device"], "day", {"left": "a", "right": "b"})
    return out.select("device", text("day"), "a", "b", text("span_from"), text("span_to"))


@query(
    "p15_usable_units",
    """SELECT unit, count(*) AS n_devices FROM units WHERE station <> 3 AND unit % 7 <> 0 GROUP BY unit""",
)
def p15(spark, folder):
    rows = views.units(spark, folder)
    docs = rows.groupBy("unit").agg(
        F.collect_list(F.when(F.col("station") != 3, F.struct("device", "multiplier"))).alias("devices"),
        F.when(F.first("unit") % 7 == 0, 0.0).otherwise(50.0).alias("area"),
        F.lit("known").alias("station"),
    )
    kept = align.usable_units(docs)
    return align.expand_devices(kept.select("unit", "devices")).groupBy("unit").agg(F.count("*").alias("n_devices"))


@query(
    "x04_job_counters",
    "SELECT device, energy, CAST(count(*) AS BIGINT) AS n FROM readings GROUP BY device, energy",
)
def x04(spark, folder):
    from pyspark.sql import Observation

    seen = views.readings(spark, folder).observe(
        Observation("raw_data"), F.count("*").alias("rows"), F.count_if(F.col("value") < 0).alias("negative")
    )
    return seen.groupBy("device", "energy").agg(F.count("*").alias("n"))
