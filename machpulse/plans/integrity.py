"""Key, domain and reference rules of the published star schema."""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from machpulse import schemas
from machpulse.operators import datamart
from machpulse.operators.constraints import Rules, check_constraints
from machpulse.plans.batch import Warehouse


def star_rules(dates: DataFrame, machines: DataFrame, codes: DataFrame, types: DataFrame) -> dict[str, Rules]:
    to_machine = ("id_machine", machines, "id_machine")
    to_date = ("id_date", dates, "id_date")
    to_type = ("id_type_evenement", types, "id_type_evenement")
    return {
        "dim_date": Rules(
            not_null=("id_date", "date_complete", "jour_semaine", "est_weekend"),
            checks={
                "trimestre": F.col("trimestre").between(1, 4),
                "mois": F.col("mois").between(1, 12),
                "jour": F.col("jour").between(1, 31),
            },
            unique=(("id_date",), ("date_complete",)),
        ),
        "dim_machine": Rules(
            not_null=("id_machine", "machine_id_nat", "model", "age", "tranche_age"),
            lengths={"model": 20, "tranche_age": 20},
            unique=(("id_machine",), ("machine_id_nat",)),
        ),
        "dim_code_evenement": Rules(
            not_null=("id_code", "code_brut"),
            lengths={"code_brut": 10, "libelle": 60},
            unique=(("id_code",), ("id_type_evenement", "code_brut")),
            foreign=(to_type,),
        ),
        "fait_evenement": Rules(
            not_null=("id_date", "datetime_evt", "id_machine", "id_type_evenement", "id_code", "source_fichier"),
            lengths={"source_fichier": 40},
            # Surrogates are hashes of the natural key: two keys with one hash show up under the second rule.
            unique=(tuple(schemas.FACT_EVENT_KEY), ("id_evenement",)),
            foreign=(to_date, to_machine, to_type, ("id_code", codes, "id_code")),
        ),
        # A day without events is missing from the event calendar and shows up here.
        "fait_telemetrie_jour": Rules(
            not_null=("id_date", "id_machine", "nb_erreurs", "nb_pannes", "nb_maintenances"),
            unique=(("id_date", "id_machine"),),
            foreign=(to_date, to_machine),
        ),
    }


def integrity_report(spark: SparkSession, warehouse: Warehouse) -> DataFrame:
    """(table, rule, violations) over the published tables."""
    names = ("dim_date", "dim_machine", "dim_code_evenement")
    tables = {name: warehouse.dimension(spark, name) for name in names}
    rules = star_rules(*tables.values(), datamart.event_types(spark))
    tables |= {"fait_evenement": warehouse.events(spark), "fait_telemetrie_jour": warehouse.days(spark)}
    reports = [
        check_constraints(tables[name], table_rules).select(
            F.lit(name).alias("table"), "rule", F.col("violations").cast("long").alias("violations")
        )
        for name, table_rules in rules.items()
    ]
    return reduce(DataFrame.unionByName, reports)
