"""The dominant reads: one machine over time, the fleet over a period, one machine's events."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from machpulse.functions.time_columns import month_of


def machine_history(telemetry: DataFrame, machine_id: int) -> DataFrame:
    return telemetry.filter(F.col("machine_id") == machine_id)


def fleet_period(telemetry: DataFrame, start: Column, end: Column) -> DataFrame:
    """Readings in [start, end); prunes month partitions when the table has them."""
    kept = telemetry.filter((F.col("datetime_mes") >= start) & (F.col("datetime_mes") < end))
    if "mois" in telemetry.columns:
        kept = kept.filter((F.col("mois") >= month_of(start)) & (F.col("mois") <= month_of(end)))
    return kept


def event_history(fact: DataFrame, dim_machine: DataFrame, machine_id: int) -> DataFrame:
    """All events of one machine, whatever their type; the consumer orders them by time."""
    machine = dim_machine.filter(F.col("machine_id_nat") == machine_id).select("id_machine")
    return fact.join(machine, "id_machine", "left_semi")
