"""Explicit schemas of every table; nothing is ever inferred."""

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

_TYPES = {
    "BIGINT": LongType(),
    "BOOLEAN": BooleanType(),
    "DATE": DateType(),
    "DOUBLE": DoubleType(),
    "INT": IntegerType(),
    "STRING": StringType(),
    "TIMESTAMP_NTZ": TimestampNTZType(),
}


def fields(text: str) -> StructType:
    """Schema from ``name TYPE, ...``; unlike the DDL parser it needs no session."""
    pairs = [part.split() for part in text.split(",")]
    return StructType([StructField(name, _TYPES[kind]) for name, kind in pairs])


TELEMETRY = fields(
    "machine_id INT, datetime_mes TIMESTAMP_NTZ, volt DOUBLE, rotate DOUBLE, pressure DOUBLE, "
    "vibration DOUBLE, horodatage_ingestion TIMESTAMP_NTZ"
)
LAKE = fields(
    "machine_id INT, datetime_mes TIMESTAMP_NTZ, volt DOUBLE, rotate DOUBLE, pressure DOUBLE, vibration DOUBLE"
)
QUARANTINE = fields(
    "machine_id INT, datetime_mes TIMESTAMP_NTZ, volt DOUBLE, rotate DOUBLE, pressure DOUBLE, "
    "vibration DOUBLE, motif STRING, horodatage_quarantaine TIMESTAMP_NTZ"
)
DEAD_LETTER = fields(
    "value STRING, malformed_reason STRING, horodatage_rejet TIMESTAMP_NTZ"
)
STATE = fields(
    "machine_id INT, fenetre TIMESTAMP_NTZ, sum_sq DOUBLE, sum_p DOUBLE, n BIGINT"
)
BATCH_COUNTS = fields(
    "valides BIGINT, quarantaine BIGINT, malformes BIGINT, horodatage TIMESTAMP_NTZ, derniere TIMESTAMP_NTZ, latence_somme BIGINT"
)
TREND = fields(
    "machine_id INT, fenetre TIMESTAMP_NTZ, rms_vibration DOUBLE, pression_moyenne DOUBLE, tendance_pression DOUBLE, version BIGINT"
)
MAXIMA = fields("fenetre TIMESTAMP_NTZ, rms_vibration DOUBLE, tendance_pression DOUBLE, version BIGINT")
EPISODE = fields("rule STRING, debut TIMESTAMP_NTZ, fin TIMESTAMP_NTZ, retire BOOLEAN, version BIGINT")

STAGING = {
    "machines": fields("machine_id INT, model STRING, age INT"),
    "erreurs": fields("datetime_evt TIMESTAMP_NTZ, machine_id INT, error_id STRING"),
    "pannes": fields("datetime_evt TIMESTAMP_NTZ, machine_id INT, failure_comp STRING"),
    "maintenances": fields("datetime_evt TIMESTAMP_NTZ, machine_id INT, comp STRING"),
}
STAGING_KEYS = {
    "machines": ["machine_id"],
    "erreurs": ["datetime_evt", "machine_id", "error_id"],
    "pannes": ["datetime_evt", "machine_id", "failure_comp"],
    "maintenances": ["datetime_evt", "machine_id", "comp"],
}

DIM_DATE = fields(
    "id_date INT, date_complete DATE, annee INT, trimestre INT, mois INT, jour INT, "
    "jour_semaine STRING, est_weekend BOOLEAN"
)
DIM_MACHINE = fields(
    "id_machine INT, machine_id_nat INT, model STRING, age INT, tranche_age STRING"
)
DIM_TYPE = fields("id_type_evenement INT, code_type STRING, libelle STRING")
DIM_CODE = fields(
    "id_code INT, id_type_evenement INT, code_brut STRING, libelle STRING"
)
DIM_OPERATOR = fields(
    "matricule_pseudonymise STRING, nom_pseudonymise STRING, equipe STRING"
)
FACT_EVENT = fields(
    "id_evenement BIGINT, id_date INT, datetime_evt TIMESTAMP_NTZ, id_machine INT, "
    "id_type_evenement INT, id_code INT, id_operateur INT, source_fichier STRING"
)
FACT_EVENT_KEY = ["id_machine", "datetime_evt", "id_type_evenement", "id_code"]
FACT_DAY = fields(
    "id_date INT, id_machine INT, rms_vibration_moyen DOUBLE, rms_vibration_max DOUBLE, "
    "tendance_pression_moyenne DOUBLE, nb_erreurs INT, nb_pannes INT, nb_maintenances INT"
)
LAST_SEEN = fields("machine_id INT, last_seen TIMESTAMP_NTZ")
