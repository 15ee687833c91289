"""Daily machine x day table from window trends and event counts."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from machpulse import schemas

COUNTS = {"ERREUR": "nb_erreurs", "PANNE": "nb_pannes", "MAINTENANCE": "nb_maintenances"}


def id_date_value(run_date: str) -> int:
    return int(str(run_date).replace("-", ""))


def daily_telemetry(trend: DataFrame, run_date: str) -> DataFrame:
    """Mean and maximum of the window RMS, mean of the trend, for one day.

    The trend must already be computed over the machine's history: the filter comes after the lag.
    """
    day = trend.filter(F.to_date("fenetre") == F.lit(str(run_date)).cast("date"))
    return day.groupBy("machine_id").agg(
        F.avg("rms_vibration").alias("rms_vibration_moyen"),
        F.max("rms_vibration").alias("rms_vibration_max"),
        F.avg("tendance_pression").alias("tendance_pression_moyenne"),
    )


def daily_events(fact: DataFrame, dim_machine: DataFrame, types: DataFrame, run_date: str) -> DataFrame:
    """Events of one day per machine and type.

    Counted per machine and type before the dimension joins, so these see one row per pair.
    """
    counted = (
        fact.filter(F.col("id_date") == id_date_value(run_date))
        .groupBy("id_machine", "id_type_evenement")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    named = counted.join(F.broadcast(types.select("id_type_evenement", "code_type")), "id_type_evenement").join(
        dim_machine.select("id_machine", "machine_id_nat"), "id_machine"
    )
    return named.groupBy("machine_id_nat").agg(
        *[
            F.coalesce(F.sum(F.when(F.col("code_type") == code, F.col("n"))), F.lit(0)).cast("int").alias(name)
            for code, name in COUNTS.items()
        ]
    )


def consolidate(dim_machine: DataFrame, telemetry: DataFrame, events: DataFrame, run_date: str) -> DataFrame:
    """One row per known machine, with or without data that day.

    Missing telemetry stays NULL, missing events count 0, telemetry of unknown machines drops out.
    Each side holds one row per machine, so no join key repeats.
    """
    grid = dim_machine.select("id_machine", "machine_id_nat")
    measured = telemetry.withColumnRenamed("machine_id", "machine_id_nat")
    joined = grid.join(measured, "machine_id_nat", "left").join(events, "machine_id_nat", "left")
    counts = [F.coalesce(F.col(c), F.lit(0)).cast("int").alias(c) for c in COUNTS.values()]
    return joined.select(
        F.lit(id_date_value(run_date)).alias("id_date"),
        "id_machine",
        "rms_vibration_moyen",
        "rms_vibration_max",
        "tendance_pression_moyenne",
        *counts,
    ).select(*schemas.FACT_DAY.fieldNames())
