"""The engine's inputs derived from the given tables: ``events``, ``customer``, ``orders``."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from machpulse.functions.fixed_values import MESSAGE_FIELDS
from machpulse.functions.time_columns import floor_second, timestamp
from machpulse.operators import datamart
from machpulse.operators.quality import flag_out_of_range, split_valid
from machpulse.plans.together import together
from machpulse.schemas import fields
from machpulse.sources.storage import stored

RUN_DATE = "2024-01-10"
AS_OF = "2024-01-31 00:00:00"
TOPIC_FILTER = "usine/capteurs/+/mesure"
DEMO_KEY = b"cle-de-demonstration"

INPUTS = {
    "events": fields(
        "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
    ),
    "customer": fields("c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"),
    "orders": fields(
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
        "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
    ),
}

_EVENT_TABLES = {"erreurs": ("error", "error", 5), "pannes": ("purchase", "comp", 4), "maintenances": ("signup", "comp", 4)}
_CODE_COLUMNS = {"erreurs": "error_id", "pannes": "failure_comp", "maintenances": "comp"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(INPUTS[name]).parquet(f"{sf_dir}/{name}.parquet")


def telemetry(spark: SparkSession, sf_dir: str, where: Column | None = None) -> DataFrame:
    """All readings, with ``event_id`` kept for tracing; ``where`` filters the source, so that the scan can use it."""
    source = table(spark, sf_dir, "events")
    timed = (source if where is None else source.filter(where)).withColumn("datetime_mes", floor_second("ts"))
    delay = F.expr("INTERVAL '1' SECOND") * (F.col("event_id") % 45)
    return timed.select(
        "event_id",
        F.col("user_id").cast("int").alias("machine_id"),
        "datetime_mes",
        (F.lit(100.0) + F.col("value")).alias("volt"),
        (F.lit(418.5) + F.col("event_id") % 40 * 9).alias("rotate"),
        (F.lit(25.0) + F.col("value")).alias("pressure"),
        (F.lit(2.0) + F.col("value") / 2).alias("vibration"),
        (F.col("datetime_mes") + delay).alias("horodatage_ingestion"),
    )


def split_telemetry(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(valid readings, quarantine table)."""
    valid, rejected = split_valid(flag_out_of_range(telemetry(spark, sf_dir)))
    return valid, rejected.withColumnRenamed("horodatage_ingestion", "horodatage_quarantaine")


def valid_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_telemetry(spark, sf_dir)[0]


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, topic, jour, value): JSON text of every reading; four in fifty are spoilt in four ways."""
    rows = telemetry(spark, sf_dir)
    kind = F.col("event_id") % 50
    stamp = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss"}
    body = F.to_json(
        F.struct(
            F.when(kind == 2, "x").otherwise(F.col("machine_id").cast("string")).alias("machine_id"),
            F.when(kind == 3, F.lit("pas-une-date"))
            .otherwise(F.translate(F.col("datetime_mes").cast("string"), " ", "T"))
            .alias("datetime_mes"),
            F.when(kind != 1, F.col("volt")).alias("volt"),
            *MESSAGE_FIELDS[3:],
        ),
        stamp,
    )
    value = F.when(kind == 0, F.expr("left(body, length(body) - 5)")).otherwise(F.col("body"))
    place = F.when(F.col("event_id") % 7 == 0, "atelier/mesure").otherwise("mesure")
    topic = F.concat(F.lit("usine/capteurs/"), F.col("machine_id").cast("string"), F.lit("/"), place)
    return rows.withColumn("body", body).select(
        "event_id", topic.alias("topic"), F.to_date("datetime_mes").alias("jour"), value.alias("value")
    )


def typed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, value): readings whose machine id and voltage come as numbers, texts, booleans and nulls in turn."""
    rows = telemetry(spark, sf_dir)
    number, volt = F.col("machine_id").cast("string"), F.col("volt").cast("string")
    machine = (
        F.when(F.col("event_id") % 8 == 0, number).when(F.col("event_id") % 8 == 1, F.concat(number, F.lit(".9")))
        .when(F.col("event_id") % 8 == 2, F.concat(F.lit('"'), number, F.lit('"'))).when(F.col("event_id") % 8 == 3, "true")
        .when(F.col("event_id") % 8 == 4, "false").when(F.col("event_id") % 8 == 5, F.concat(F.lit('"'), number, F.lit('.9"')))
        .when(F.col("event_id") % 8 == 6, "null").otherwise(F.concat(F.lit('" +'), number, F.lit(' "')))
    )
    measured = (
        F.when(F.col("event_id") % 5 == 0, volt).when(F.col("event_id") % 5 == 1, F.concat(F.lit('" '), volt, F.lit('"')))
        .when(F.col("event_id") % 5 == 2, "true").when(F.col("event_id") % 5 == 3, "NaN").otherwise('"1_0.5e1"')
    )
    value = F.concat(
        F.lit('{"machine_id":'), machine, F.lit(',"datetime_mes":"2024-01-01T00:00:00","volt":'), measured,
        F.lit(',"rotate":1,"pressure":2,"vibration":3}'),
    )
    return rows.select("event_id", value.alias("value"))


def staging_machines(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        key.cast("int").alias("machine_id"),
        F.concat(F.lit("model"), (key % 4 + 1).cast("string")).alias("model"),
        (key % 21).cast("int").alias("age"),
    )


def staging_events(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Events of one staging table at day precision, natural-key copies included."""
    event_type, prefix, codes = _EVENT_TABLES[name]
    events = table(spark, sf_dir, "events").filter(F.col("event_type") == event_type)
    return events.select(
        F.to_date("ts").cast("timestamp_ntz").alias("datetime_evt"),
        F.col("user_id").cast("int").alias("machine_id"),
        F.concat(F.lit(prefix), (F.col("event_id") % codes + 1).cast("string")).alias(_CODE_COLUMNS[name]),
    )


def all_staging_events(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: staging_events(spark, sf_dir, name) for name in _EVENT_TABLES}


def star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Dimensions and fact built from the whole staging tables.

    Fused events and dimensions are written tables, as in the daily run. The sources are scanned and
    deduplicated once, and the planner sees the dimensions' real sizes: it broadcasts a small one
    right away instead of shuffling the events first and finding out at run time.
    """
    types = datamart.event_types(spark)

    def event_side() -> tuple[DataFrame, DataFrame]:
        fused = stored(datamart.fuse_events(**all_staging_events(spark, sf_dir)), "staging-events")
        return fused, stored(datamart.build_dim_code(fused, types), "dim-code")

    def machine_side() -> DataFrame:
        return stored(datamart.build_dim_machine(staging_machines(spark, sf_dir)), "dim-machine")

    (fused, codes), machines = together(spark, event_side, machine_side)
    return {
        "types": types,
        "events": fused,
        "machines": machines,
        "codes": codes,
        "fact": datamart.build_event_fact(fused, machines, types, codes),
    }


def operators(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("OP-"), F.col("c_custkey").cast("string")).alias("matricule"),
        F.col("c_name").alias("nom"),
        F.col("c_mktsegment").alias("equipe"),
    )


def as_of(text: str = AS_OF):
    return timestamp(text)
