"""Test-data adapter: shapes the driver's generated tables into the pipeline's bronze inputs.

The generated tables are not sensor data, so each bronze input is *derived* from them by a fixed
mapping that the DuckDB oracle repeats in SQL (see ``oracle_queries.py`` at the repository
root). Every row of the source table is used; nothing is sampled or capped.

Mapping (all deterministic):

* ``events`` -> live bronze (phase B): one wide row per event. ``user_id`` is the sensor,
  ``event_type`` picks the metric column, ``value`` is the metric text. The ``k`` field of
  ``props`` (0..99) injects dirty cases into chosen rows: unparsable and NaN/Infinity values,
  quoted and malformed timestamps, NaN/NULL coordinates and a lower-case live country.
* ``events`` -> archive bronze with the CSV column names (``location``, ``lat``, ``lon``). The archive copy of a reading carries twice the value, an
  ISO timestamp and a later ingestion time, so it wins the dedup unless its own value is
  invalid -- then the live copy must survive.
* ``customer`` x ``nation`` -> nested API records, two per sensor (``c_custkey div 2``) in
  ``c_custkey`` order; the market segment decides sensor type and indoor flag, one segment maps
  to a type outside the allowed list.
* ``supplier`` x ``nation`` -> a second API response (sensor ``s_suppkey * 10``) for upserts.
* ``events`` -> nested live records (empty/NULL/repeated ``value_type``, a missing ``sensor``),
  bus envelopes (JSON bodies with a numeric metric, an unknown field, some malformed bodies),
  archive listing pages and landed files, and archive CSV files with two header sets.
* ``lineitem`` -> a wide table for unpivoting and readings-shaped rows with real key copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sensorlake import config
from sensorlake.plans.registry import build_registry
from sensorlake.plans.silver import silver_devices, silver_readings

# Fixed test-data mapping (shared with the SQL oracle).
EVENT_METRIC = (("view", "P1"), ("click", "P2"), ("purchase", "temperature"),
                ("signup", "humidity"), ("error", "pressure"))
SEGMENT_TYPE = (("AUTOMOBILE", "SDS011", "0"), ("BUILDING", "SDS011", "1"),
                ("FURNITURE", "BME280", None), ("HOUSEHOLD", "BME280", "0"),
                ("MACHINERY", "DHT22", "0"))
LIVE_INGEST_DELAY = "INTERVAL 5 MINUTES"
ARCHIVE_INGEST_DELAY = "INTERVAL 1 DAY"
REGISTRY_INGESTED_AT = "2024-02-01 00:00:00"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _k() -> Column:
    return F.get_json_object("props", "$.k").try_cast("int")


def _with_k(events: DataFrame) -> tuple[DataFrame, Column]:
    """``events`` with ``k`` in a column of its own: the JSON is parsed once a row, however many
    expressions test it."""
    return events.withColumn("_k", _k()), F.col("_k")


def _num_text(c: Column, scale: int) -> Column:
    """Number as text with a fixed scale, the same in every engine."""
    return c.cast(f"decimal(18,{scale})").cast("string")


def _metric_of(event_type: Column) -> Column:
    expr = None
    for et, m in EVENT_METRIC:
        expr = F.when(event_type == et, m) if expr is None else expr.when(event_type == et, m)
    return expr


def _wide(metric: Column, text: Column, metrics=config.METRICS) -> list[Column]:
    return [F.when(metric == m, text).alias(m) for m in metrics]


def live_raw(events: DataFrame) -> DataFrame:
    """Bronze live rows (phase B schema) from ``events``."""
    events, k = _with_k(events)
    ts_text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    value_text = _value_text(k)
    timestamp = (F.when(k == 3, F.concat(F.lit('"'), ts_text, F.lit('"')))
                  .when(k == 5, F.concat(F.lit("'"), ts_text, F.lit("'")))
                  .when(k == 7, F.lit("n/a"))
                  .otherwise(ts_text))
    uid = F.col("user_id").cast("double")
    latitude = (F.when(k == 11, "NaN").when(k == 17, F.lit(None).cast("string"))
                 .otherwise(_num_text(uid / 1000 + 50, 3)))
    longitude = F.when(k == 19, "NaN").otherwise(_num_text(uid / 500 + 10, 3))
    return events.select(
        F.lit("0").alias("_source_partition"),
        F.col("event_id").cast("string").alias("_source_offset"),
        F.col("event_id").cast("string").alias("id"),
        timestamp.alias("timestamp"),
        F.col("user_id").cast("string").alias("sensor_id"),
        F.when(F.col("event_type").isin("view", "click"), "SDS011")
         .otherwise("BME280").alias("sensor_type"),
        F.expr("user_id div 2").cast("string").alias("location_id"),
        latitude.alias("latitude"),
        longitude.alias("longitude"),
        F.when(k == 23, "ua").alias("country"),
        *_wide(_metric_of(F.col("event_type")), value_text),
        F.lit(config.LIVE_SOURCE).alias("_source"),
        (F.col("ts") + F.expr(LIVE_INGEST_DELAY)).cast("timestamp").alias("_ingested_at"),
    )


def archive_raw(events: DataFrame) -> DataFrame:
    """Bronze archive rows, CSV column names, one per event."""
    events, k = _with_k(events)
    value_text = (F.when(k == 41, "unknown")
                   .when(k == 43, "NaN")
                   .otherwise(_num_text(F.col("value") * 2, 2)))
    uid = F.col("user_id").cast("double")
    return events.select(
        F.col("user_id").cast("string").alias("sensor_id"),
        F.when(F.col("event_type").isin("view", "click"), "SDS011").otherwise("BME280")
         .alias("sensor_type"),
        F.expr("user_id div 2").cast("string").alias("location"),
        _num_text(uid / 1000 + 50, 3).alias("lat"),
        F.when(k == 47, "NaN").otherwise(_num_text(uid / 500 + 10, 3)).alias("lon"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        *_wide(_metric_of(F.col("event_type")), value_text),
        F.lit(config.ARCHIVE_SOURCE).alias("_source"),
        F.concat(F.lit("archive/date="), F.to_date("ts").cast("string"), F.lit("/"),
                 F.col("user_id").cast("string"), F.lit(".csv")).alias("_source_file_name"),
        (F.col("ts") + F.expr(ARCHIVE_INGEST_DELAY)).cast("timestamp").alias("_ingested_at"),
    )


def api_records(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Nested API records (two per sensor) with their position in the API response."""
    seg = F.col("c_mktsegment")
    stype, indoor = None, None
    for name, t, ind in SEGMENT_TYPE:
        stype = F.when(seg == name, t) if stype is None else stype.when(seg == name, t)
        ind_val = F.lit(ind).cast("string")
        indoor = (F.when(seg == name, ind_val) if indoor is None
                  else indoor.when(seg == name, ind_val))
    nat = nation.select("n_nationkey", "n_name")
    return (customer.join(nat, customer.c_nationkey == nat.n_nationkey, "left")
            .select(
                F.col("c_custkey").alias("api_pos"),
                F.col("c_custkey").cast("string").alias("id"),
                F.lit(REGISTRY_INGESTED_AT).alias("timestamp"),
                F.struct(F.expr("c_custkey div 2").cast("string").alias("id"),
                         F.struct(stype.alias("name")).alias("sensor_type")).alias("sensor"),
                F.struct(F.expr("c_custkey div 4").cast("string").alias("id"),
                         _num_text(F.col("c_acctbal"), 2).alias("latitude"),
                         _num_text(F.col("c_acctbal") * 2, 2).alias("longitude"),
                         F.col("n_name").alias("country"),
                         indoor.alias("indoor")).alias("location"),
                F.array(F.struct(F.lit("P1").alias("value_type"),
                                 _num_text(F.col("c_acctbal"), 2).alias("value"))
                        ).alias("sensordatavalues")))


def write_api_files(records: DataFrame, path: str, size: int = 1_000) -> None:
    """API records as response files: JSON arrays of at most ``size`` records, a file each."""
    columns = [c for c in records.columns if c != "api_pos"]
    ranked = F.row_number().over(Window.partitionBy("_file").orderBy("api_pos"))
    files = records.withColumn("_file", F.expr(f"api_pos div {size}")).withColumn("_at", ranked)
    arrays = files.groupBy("_file").agg(F.sort_array(F.collect_list(
        F.struct("_at", F.struct(*columns).alias("r")))).alias("rows"))
    (arrays.select(F.to_json(F.transform("rows", lambda x: x["r"]),
                             {"ignoreNullFields": "false"}).alias("value"))
     .write.mode("append").option("maxRecordsPerFile", 1).text(path))


def registry_raw(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Bronze device registry built from the API records (PIP-3)."""
    recs = api_records(customer, nation)
    return build_registry(recs, config.ALLOWED_SENSOR_TYPES, position="api_pos",
                          ingested_at=F.lit(REGISTRY_INGESTED_AT).cast("timestamp"))


def bronze(spark: SparkSession, sf_dir: str) -> dict:
    events = load(spark, sf_dir, "events")
    customer = load(spark, sf_dir, "customer")
    nation = load(spark, sf_dir, "nation")
    return {"live_raw": live_raw(events), "archive_raw": archive_raw(events),
            "registry_raw": registry_raw(customer, nation)}


def silver(spark: SparkSession, sf_dir: str) -> dict:
    """Silver readings and devices over the bronze inputs."""
    b = bronze(spark, sf_dir)
    return {"readings": silver_readings(b["live_raw"], b["archive_raw"]),
            "devices": silver_devices(b["registry_raw"], b["live_raw"]),
            **b}


def _ts_text(fmt: str = "yyyy-MM-dd HH:mm:ss.SSSSSS") -> Column:
    return F.date_format("ts", fmt)


def _value_text(k: Column) -> Column:
    return (F.when(k == 13, "unknown")
             .when(k == 29, "NaN")
             .when((k == 31) & (F.col("event_type") == "error"), "Infinity")
             .otherwise(_num_text(F.col("value"), 2)))


def lineitem_readings(lineitem: DataFrame) -> DataFrame:
    """Readings-shaped rows with real key duplicates: order = sensor, line = metric,
    ship year = event time, ship date = ingestion time."""
    return lineitem.select(
        F.col("l_orderkey").cast("string").alias("sensor_id"),
        F.date_trunc("year", "l_shipdate").cast("timestamp").alias("event_ts_utc"),
        F.concat(F.lit("line-"), F.col("l_linenumber").cast("string")).alias("value_type"),
        F.col("l_extendedprice").alias("value"),
        F.col("l_partkey").cast("string").alias("location_id"),
        F.col("l_discount").alias("latitude"),
        F.col("l_tax").alias("longitude"),
        F.col("l_returnflag").alias("country"),
        F.col("l_linestatus").alias("_source"),
        F.col("l_shipdate").cast("timestamp").alias("_ingested_at"),
    )


def supplier_records(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    """A second API response (one record per supplier) used as registry updates: sensor id
    ``s_suppkey * 10`` overlaps part of the customer-built registry and adds new sensors."""
    nat = nation.select("n_nationkey", "n_name")
    return (supplier.join(nat, supplier.s_nationkey == nat.n_nationkey, "left")
            .select(
                F.col("s_suppkey").alias("api_pos"),
                F.col("s_suppkey").cast("string").alias("id"),
                F.lit(REGISTRY_INGESTED_AT).alias("timestamp"),
                F.struct((F.col("s_suppkey") * 10).cast("string").alias("id"),
                         F.struct(F.lit("SDS011").alias("name")).alias("sensor_type"))
                 .alias("sensor"),
                F.struct(F.col("s_suppkey").cast("string").alias("id"),
                         _num_text(F.col("s_acctbal"), 2).alias("latitude"),
                         _num_text(F.col("s_acctbal") * 2, 2).alias("longitude"),
                         F.lower("n_name").alias("country"),
                         F.when(F.col("s_acctbal") < 0, "1").otherwise("0").alias("indoor"))
                 .alias("location"),
                F.array().cast("array<struct<value_type:string,value:string>>")
                 .alias("sensordatavalues")))


def event_records(events: DataFrame) -> DataFrame:
    """Nested API records, one per event, with the awkward cases of a live feed: an empty and a
    NULL ``value_type``, a repeated metric (the later entry wins), a metric outside the
    configured list and a record without its ``sensor`` object."""
    events, k = _with_k(events)
    metric = _metric_of(F.col("event_type"))
    uid = F.col("user_id").cast("double")
    entry = lambda t, v: F.struct(t.alias("value_type"), v.alias("value"))
    values = F.array(
        entry(metric, _value_text(k)),
        entry(F.lit(""), F.lit("junk")),
        entry(F.lit(None).cast("string"), F.lit("x")),
        F.when(k == 37, entry(metric, _num_text(F.col("value") * 3, 2))),
        entry(F.lit("noise"), k.cast("string")),
    )
    sensor = F.when(k != 53, F.struct(
        F.col("user_id").cast("string").alias("id"),
        F.struct(F.when(F.col("event_type").isin("view", "click"), "SDS011")
                  .otherwise("BME280").alias("name")).alias("sensor_type")))
    return events.select(
        F.col("event_id").alias("api_pos"),
        F.col("event_id").cast("string").alias("id"),
        _ts_text().alias("timestamp"),
        sensor.alias("sensor"),
        F.struct(F.expr("user_id div 2").cast("string").alias("id"),
                 _num_text(uid / 1000 + 50, 3).alias("latitude"),
                 _num_text(uid / 500 + 10, 3).alias("longitude"),
                 F.when(k == 23, "ua").alias("country")).alias("location"),
        values.alias("sensordatavalues"))


def bus_envelope(events: DataFrame) -> DataFrame:
    """Message-bus records (partition, offset, value): the JSON body of each event with the
    metric as a JSON number (in hundredths), an extra field ``k`` and some malformed bodies."""
    events, k = _with_k(events)
    metric = _metric_of(F.col("event_type"))
    cents = F.round(F.col("value") * 100).cast("bigint").cast("string")
    body = F.concat(
        F.lit('{"id": "'), F.col("event_id").cast("string"),
        F.lit('", "timestamp": "'), _ts_text(),
        F.lit('", "sensor_id": "'), F.col("user_id").cast("string"),
        F.lit('", "sensor_type": "SDS011", "'), metric, F.lit('": '), cents,
        F.lit(', "k": '), k.cast("string"), F.lit("}"))
    return events.select(
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.when(k == 59, F.lit("not json {")).otherwise(body).alias("value"))


def _listing_file(csv: bool = True) -> Column:
    k = _k()
    stype = (F.when(F.col("event_type").isin("view", "click"), "SDS011")
              .when(F.col("event_type").isin("purchase", "signup"), "BME280")
              .otherwise("DHT22"))
    day = F.date_format("ts", "yyyy-MM-dd")
    named = F.concat(day, F.lit("_"), stype, F.lit("_sensor_"), F.col("user_id").cast("string"))
    if not csv:
        return F.concat(named, F.lit(".txt"))
    return F.when(k == 61, F.concat(day, F.lit("_"), stype, F.lit("_index.csv"))) \
            .otherwise(F.concat(named, F.lit(".csv")))


def archive_listings(events: DataFrame) -> DataFrame:
    """Listing-page fragments (day, pos, html), one per event, each with a CSV and a TXT link."""
    f1, f2 = _listing_file(True), _listing_file(False)
    html = F.concat(F.lit('<tr><td><a href="'), f1, F.lit('">'), f1,
                    F.lit('</a></td><td><a href="'), f2, F.lit('">notes</a></td></tr>'))
    return events.select(F.to_date("ts").alias("day"), F.col("event_id").alias("pos"),
                         html.alias("html"))


def landed_files(events: DataFrame) -> DataFrame:
    """Files already in the landing zone: some empty (to be fetched again), some complete."""
    k = _k()
    return (events.where(k.isin(67, 71))
                  .select(F.to_date("ts").alias("day"), _listing_file(True).alias("file_name"),
                          F.when(k == 67, 0).otherwise(2048).cast("bigint").alias("length"))
                  .groupBy("day", "file_name").agg(F.max("length").alias("length")))


# Archive landing files: two sensor kinds with different header order and width.
PARTICLE_COLUMNS = ("sensor_id", "sensor_type", "location", "lat", "lon", "timestamp", "P1", "P2")
CLIMATE_COLUMNS = ("sensor_id", "sensor_type", "location", "timestamp", "lat", "lon",
                   "temperature", "humidity", "pressure", "note")
# A column that particle files have from the second phase on.
LATE_COLUMN = "durP1"
LIVE_PHASE_B_FROM = "2024-01-15"


def write_archive_landing(events: DataFrame, landing: str, late: bool) -> None:
    """Write the archive rows as ``;``-separated CSV files with a header, in ``date=`` folders;
    particle and climate files have different headers and share the day folders. Climate files
    quote everything and hold separators and quotes inside a cell; particle files of the late
    phase have a column more."""
    arch = archive_raw(events).withColumn(
        "date", F.to_date(F.substring("timestamp", 1, 10)))
    noted = arch.withColumn("note", F.concat(F.lit('loc "'), "location", F.lit('"; sensor '),
                                             "sensor_id"))
    particle = [*PARTICLE_COLUMNS, *([LATE_COLUMN] if late else [])]
    files = ((arch.where(F.col("sensor_type") == "SDS011")
              .withColumn(LATE_COLUMN, F.length("timestamp").cast("string")), particle, False),
             (noted.where(F.col("sensor_type") == "BME280"), CLIMATE_COLUMNS, True))
    for part, columns, quoted in files:
        # Few files per day (AQE splits a large day over several writers), and each file stays
        # small, at most 50,000 lines: one whole file is one row when read back.
        (part.select(*columns, "date").hint("rebalance", "date").write.mode("append")
             .partitionBy("date").option("maxRecordsPerFile", 50_000).option("quoteAll", quoted)
             .option("header", True).option("sep", config.ARCHIVE_SEPARATOR).csv(landing))


def write_bus_files(events: DataFrame, bus: str, phase_b: bool) -> None:
    """Write one arrival phase of bus envelopes as JSON-lines files (the bus file double)."""
    cut = F.lit(LIVE_PHASE_B_FROM).cast("timestamp_ntz")
    part = events.where(F.col("ts") >= cut) if phase_b else events.where(F.col("ts") < cut)
    bus_envelope(part).write.mode("append").json(bus)
