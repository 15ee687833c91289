"""Daily batch: landed files -> staging -> star schema -> machine x day table, published last.

Every run writes into its own ``run_id`` folders and becomes visible through one marker created after
the last write; readers only look at published runs. Event tables and the event fact hold what each
run added. Dimensions hold the rows that each run changed: of a key the newest run's row counts, and after
``FOLD_AFTER`` changing runs one writes the whole dimension again.
"""

import json
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructType

from machpulse import schemas
from machpulse.functions.fixed_values import EVENT_SOURCES, MACHINE_ID_RANGE, STAGING_FILES
from machpulse.functions.time_columns import id_date_of
from machpulse.operators import consolidation, datamart
from machpulse.operators.constraints import Rules, enforce
from machpulse.operators.telemetry import trend_of_day
from machpulse.operators.writes import insert_if_absent, upsert
from machpulse.plans.together import together
from machpulse.sources import landing, storage

SNAPSHOTS = {
    "dim_date": schemas.DIM_DATE,
    "dim_machine": schemas.DIM_MACHINE,
    "dim_code_evenement": schemas.DIM_CODE,
}
#: Tables of which a run writes the changed rows: schema and natural key.
KEYED = {
    "staging_machines": (schemas.STAGING["machines"], ("machine_id",)),
    "dim_date": (schemas.DIM_DATE, ("id_date",)),
    "dim_machine": (schemas.DIM_MACHINE, ("machine_id_nat",)),
    "dim_code_evenement": (schemas.DIM_CODE, ("id_type_evenement", "code_brut")),
}
FOLD_AFTER = 8


@dataclass(frozen=True)
class Warehouse:
    root: str

    def path(self, table: str, run_id: int) -> str:
        return f"{self.root}/{table}/run_id={run_id}"

    def published(self, spark: SparkSession) -> list[int]:
        return sorted(int(n) for n in storage.names(spark, f"{self.root}/_published") if n.isdigit())

    def publish(self, spark: SparkSession, run_id: int) -> None:
        storage.write_marker(spark, f"{self.root}/_published/{run_id}")

    def _additions(self, spark: SparkSession, table: str, schema: StructType) -> DataFrame:
        """Rows of all published runs, with ``id_date`` as partition column."""
        # A published run wrote every table: a folder that is missing is lost data, and reading it fails.
        paths = [self.path(table, r) for r in self.published(spark)]
        full = StructType([f for f in schema.fields if f.name != "id_date"]).add("run_id", LongType())
        full.add("id_date", IntegerType())
        if not paths:
            return spark.createDataFrame([], full).drop("run_id")
        return spark.read.schema(full).option("basePath", f"{self.root}/{table}").parquet(*paths).drop("run_id")

    def staging_events(self, spark: SparkSession, table: str) -> DataFrame:
        return self._additions(spark, f"staging_{table}", schemas.STAGING[table])

    def machines(self, spark: SparkSession) -> DataFrame | None:
        return self.dimension(spark, "staging_machines")

    def dimension(self, spark: SparkSession, table: str) -> DataFrame | None:
        return self.as_of_runs(spark, table, self.index(spark)["runs"].get(table, []))

    def as_of_runs(self, spark: SparkSession, table: str, runs: list[int]) -> DataFrame | None:
        """A keyed table as the given runs left it, the first of which wrote it whole."""
        if not runs:
            return None
        schema, keys = KEYED[table]
        if len(runs) == 1:
            return spark.read.schema(schema).parquet(self.path(table, runs[0]))
        full = StructType(list(schema.fields)).add("run_id", LongType())
        read = spark.read.schema(full).option("basePath", f"{self.root}/{table}").parquet(*[self.path(table, r) for r in runs])
        newest = read.groupBy(*keys).agg(F.max_by(F.struct(*[c for c in schema.names if c not in keys]), "run_id").alias("__row"))
        return newest.select(*keys, "__row.*").select(*schema.names)

    def write_changes(self, spark: SparkSession, table: str, run_id: int, whole: DataFrame, runs: list[int]) -> tuple[list[int], int]:
        """Write the rows of ``whole`` that the table of ``runs`` does not hold. Returns the runs to read and the rows written.

        A run that changes nothing leaves nothing.
        """
        held = self.as_of_runs(spark, table, runs)
        if held is None or len(runs) >= FOLD_AFTER:
            return [run_id], _write(whole, self.path(table, run_id), by_day=False)
        changed = _write(whole.select(*held.columns).subtract(held), self.path(table, run_id), by_day=False)
        if not changed:
            storage.remove(spark, self.path(table, run_id))
            return runs, 0
        return [*runs, run_id], changed

    def events(self, spark: SparkSession) -> DataFrame:
        return self._additions(spark, "fait_evenement", schemas.FACT_EVENT)

    def _index_path(self, run_id: int) -> str:
        return f"{self.root}/_index/{run_id}.json"

    def index(self, spark: SparkSession) -> dict:
        """Of the newest published run: run and row count of every day, the runs of each keyed table, the number of machines."""
        runs = self.published(spark)
        return json.loads(storage.read_text(spark, self._index_path(runs[-1]))) if runs else {"days": {}, "runs": {}, "machines": 0}

    def write_index(self, spark: SparkSession, run_id: int, id_date: int, rows: int, runs: dict[str, list[int]], machines: int) -> None:
        """The index as this run leaves it, complete, so a reader opens one file however many runs there were."""
        days = self.index(spark)["days"] | {str(id_date): {"run": run_id, "rows": rows}}
        storage.write_text(spark, self._index_path(run_id), json.dumps({"days": days, "runs": runs, "machines": machines}))

    def _day_folder(self, id_date: int | str, run_id: int) -> str:
        return f"{self.path('fait_telemetrie_jour', run_id)}/id_date={id_date}"

    def days(self, spark: SparkSession, *id_dates: int) -> DataFrame:
        """The machine x day table, or only the given days: of each day the rows of the newest published run that wrote it.

        The folders come from the index, without a call per run or day; one that is missing is lost data, and an error.
        """
        entries = self.index(spark)["days"]
        wanted = [str(d) for d in id_dates if str(d) in entries] if id_dates else list(entries)
        if not wanted:
            return spark.createDataFrame([], schemas.FACT_DAY)
        parted = StructType([f for f in schemas.FACT_DAY.fields if f.name != "id_date"])
        parted = StructType(parted.fields).add("run_id", LongType()).add("id_date", IntegerType())
        folders = [self._day_folder(day, entries[day]["run"]) for day in wanted]
        read = spark.read.schema(parted).option("basePath", f"{self.root}/fait_telemetrie_jour").parquet(*folders)
        return read.select(*schemas.FACT_DAY.names)


def staging_rules(
    table: str, machines: DataFrame | None = None, machine_ids: tuple[int, int] = MACHINE_ID_RANGE
) -> Rules:
    """Rules of one staging table. A load takes every id that the messages take; ``machine_ids`` is for reports on a narrower type."""
    if table == "machines":
        return Rules(
            not_null=("machine_id", "model", "age"),
            checks={
                "age": F.col("age").between(0, 40),
                "machine_id": F.col("machine_id").between(*machine_ids),
            },
            lengths={"model": 20},
        )
    code = EVENT_SOURCES[table][1]
    return Rules(
        not_null=("datetime_evt", "machine_id", code),
        lengths={code: 10},
        foreign=(("machine_id", machines, "machine_id"),) if machines is not None else (),
    )


def _extent(df: DataFrame) -> tuple[int, Column | None]:
    """Row count and a predicate on ``id_date`` covering every day of ``df``; one row reaches the driver."""
    day = id_date_of("datetime_evt")
    n, first, last = df.agg(F.count(F.lit(1)), F.min(day), F.max(day)).first()
    return n, None if first is None else F.col("id_date").between(first, last)


def _write(df: DataFrame, path: str, by_day: bool) -> int:
    """Write and return the number of rows, counted by the write itself."""
    counted = Observation()
    if by_day:
        df = df.hint("rebalance", "id_date").observe(counted, F.count(F.lit(1)).alias("n"))
        df.write.mode("overwrite").partitionBy("id_date").parquet(path)
    else:
        df.observe(counted, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(path)
    return counted.get["n"]


def _load_events(spark, warehouse, run_id, incoming, table, machines, on_violation) -> dict[str, int]:
    """Append what is new; the whole file goes in as one write or not at all.

    The rules are checked on the written rows: a run that breaks one is never published.
    """
    attempted, span = _extent(incoming)
    known = warehouse.staging_events(spark, table)
    if span is not None:
        known = known.filter(span)
    fresh = insert_if_absent(known, incoming, schemas.STAGING_KEYS[table])
    inserted = _write(
        fresh.withColumn("id_date", id_date_of("datetime_evt")), warehouse.path(f"staging_{table}", run_id), by_day=True
    )
    enforce(_added(spark, warehouse, run_id, table), staging_rules(table, machines), on_violation)
    return {"attempted": attempted, "inserted": inserted}


def _added(spark, warehouse, run_id, table) -> DataFrame:
    schema = StructType(list(schemas.STAGING[table].fields))
    return spark.read.schema(schema).parquet(warehouse.path(f"staging_{table}", run_id))


def run_batch(
    spark: SparkSession,
    run_date: str,
    raw_root: str,
    warehouse: Warehouse,
    state: DataFrame,
    on_violation: str = "fail",
    edges: DataFrame | None = None,
) -> dict[str, dict[str, int]]:
    """One day. ``state`` is the window state of the telemetry, ``edges`` the index of each day's first and last windows.

    Returns rows attempted and inserted per table. With the index no older window is read. A rerun adds nothing. A run that dies leaves unpublished folders, which the next run overwrites.
    """
    landing.require_landed(spark, raw_root, run_date)
    run_id = max(warehouse.published(spark), default=0) + 1
    counts: dict[str, dict[str, int]] = {}

    # Staging, machines first: events refer to them.
    (machine_file, *event_files) = STAGING_FILES
    incoming = landing.read_landed(spark, raw_root, run_date, machine_file)
    known, keys = warehouse.machines(spark), schemas.STAGING_KEYS["machines"]
    whole = insert_if_absent(None, incoming, keys) if known is None else upsert(known, incoming, keys, "nothing")
    index = warehouse.index(spark)
    runs, written = warehouse.write_changes(spark, "staging_machines", run_id, whole, index["runs"].get("staging_machines", []))
    read_from = {"staging_machines": runs}
    machines = warehouse.as_of_runs(spark, "staging_machines", runs)
    enforce(machines, staging_rules("machines"), on_violation)
    staged = written if runs == [run_id] else index["machines"] + written
    counts["machines"] = {"attempted": incoming.count(), "inserted": staged - index["machines"]}

    def load(filename: str) -> dict[str, int]:
        rows = landing.read_landed(spark, raw_root, run_date, filename)
        return _load_events(spark, warehouse, run_id, rows, STAGING_FILES[filename][0], machines, on_violation)

    tables = [STAGING_FILES[f][0] for f in event_files]
    loaded = together(spark, *[partial(load, f) for f in event_files])
    counts |= dict(zip(tables, loaded))
    added = {table: _added(spark, warehouse, run_id, table) for table in tables}

    # Star schema from what this run added; earlier runs are already in it.
    types = datamart.event_types(spark)
    events = datamart.fuse_events(**added)
    builds = {
        "dim_machine": lambda old: datamart.build_dim_machine(machines, old),
        "dim_date": lambda old: datamart.build_dim_date(*added.values(), existing=old),
        "dim_code_evenement": lambda old: datamart.build_dim_code(events, types, old),
    }

    def build(name: str) -> DataFrame:
        held = index["runs"].get(name, [])
        whole = builds[name](warehouse.as_of_runs(spark, name, held))
        read_from[name] = warehouse.write_changes(spark, name, run_id, whole, held)[0]
        return warehouse.as_of_runs(spark, name, read_from[name])

    dims = dict(zip(builds, together(spark, *[partial(build, name) for name in builds])))
    known = warehouse.events(spark)
    span = _extent(events)[1]
    if span is not None:
        known = known.filter(span)
    fact = datamart.build_event_fact(events, dims["dim_machine"], types, dims["dim_code_evenement"], known)
    counts["fait_evenement"] = {"inserted": _write(fact, warehouse.path("fait_evenement", run_id), by_day=True)}
    fact_schema = StructType([f for f in schemas.FACT_EVENT.fields if f.name != "id_date"]).add("id_date", IntegerType())
    this_run = spark.read.schema(fact_schema).parquet(warehouse.path("fait_evenement", run_id))

    # Machine x day.
    all_events = warehouse.events(spark).unionByName(this_run)
    day = consolidation.consolidate(
        dims["dim_machine"],
        consolidation.daily_telemetry(trend_of_day(state, run_date, edges), run_date),
        consolidation.daily_events(all_events, dims["dim_machine"], types, run_date),
        run_date,
    )
    id_date = consolidation.id_date_value(run_date)
    # The grid is complete for its day, so the newest published run's rows are the upsert. Until then they are not seen.
    rows = _write(day.drop("id_date"), warehouse._day_folder(id_date, run_id), by_day=False)
    counts["fait_telemetrie_jour"] = {"inserted": rows}
    warehouse.write_index(spark, run_id, id_date, rows, read_from, staged)
    warehouse.publish(spark, run_id)
    return counts
