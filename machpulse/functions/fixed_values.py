"""Constants that results depend on, stated as plain tables."""

# Plausible range of each measure, bounds included, in checking order.
PLAUSIBLE_RANGES = {
    "volt": (50.0, 300.0),
    "rotate": (100.0, 750.0),
    "pressure": (30.0, 200.0),
    "vibration": (5.0, 90.0),
}

MESSAGE_FIELDS = ("machine_id", "datetime_mes", "volt", "rotate", "pressure", "vibration")
MEASURES = tuple(PLAUSIBLE_RANGES)

# Machine ids are unsigned; the upper end is that of the column's type.
MACHINE_ID_RANGE = (0, 2_147_483_647)

SILENCE_THRESHOLD = "5 minutes"
WINDOW = "1 minute"

# Early-warning rules: column of the trend table, strict threshold.
ALERT_RULES = {
    "rms_vibration": 45.0,
    "tendance_pression": 15.0,
}
ALERT_HOLD = "2 minutes"
ALERT_STEP = "1 minute"

# Panel value from which the status turns red.
RED_FROM = {
    "fraicheur_secondes": 120.0,
    "taux_erreur_pct": 5.0,
    "latence_secondes": 30.0,
}

# Upper age of each band, then the band of every older machine.
AGE_BANDS = ((5, "0-5 ans"), (10, "6-10 ans"), (15, "11-15 ans"))
OLDEST_BAND = "16-20 ans"

# ISO weekdays 1..7.
WEEKDAYS = ("lundi", "mardi", "mercredi", "jeudi", "vendredi", "samedi", "dimanche")

EVENT_TYPES = (
    (1, "ERREUR", "Alerte machine (log erreur)"),
    (2, "PANNE", "Panne non planifiée (remplacement composant)"),
    (3, "MAINTENANCE", "Maintenance planifiée (remplacement préventif)"),
)
INTERVENTION_TYPES = ("PANNE", "MAINTENANCE")

# Delivered file -> staging table and (source column, staging column) pairs.
# Machines come first because events refer to them.
STAGING_FILES = {
    "PdM_machines.csv": ("machines", (("machineID", "machine_id"), ("model", "model"), ("age", "age"))),
    "PdM_errors.csv": ("erreurs", (("datetime", "datetime_evt"), ("machineID", "machine_id"), ("errorID", "error_id"))),
    "PdM_failures.csv": ("pannes", (("datetime", "datetime_evt"), ("machineID", "machine_id"), ("failure", "failure_comp"))),
    "PdM_maint.csv": ("maintenances", (("datetime", "datetime_evt"), ("machineID", "machine_id"), ("comp", "comp"))),
}

# Staging event table -> event type, code column, file name kept for traceability.
EVENT_SOURCES = {
    "erreurs": ("ERREUR", "error_id", "PdM_errors.csv"),
    "pannes": ("PANNE", "failure_comp", "PdM_failures.csv"),
    "maintenances": ("MAINTENANCE", "comp", "PdM_maint.csv"),
}

# Micro-batch flush: message count or seconds, whichever comes first.
FLUSH_MESSAGES = 500
FLUSH_SECONDS = 10
