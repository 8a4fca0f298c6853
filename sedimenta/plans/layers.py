"""The whole run: landing, bronze, silver, star, marts, export, with a log of what each write did."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sedimenta.operators.audit import EXTRACTION_DATE, stamp_bronze
from sedimenta.plans import marts, star
from sedimenta.plans.lake import Lake, Written
from sedimenta.plans.sizing import kept_shuffles, size_shuffles
from sedimenta.plans.specs import SPECS, TableSpec, select_names
from sedimenta.sources.jdbc import export_jdbc
from sedimenta.sources.landing import discover_landing, landed_path, read_landing_csv, write_landing
from sedimenta.sources.tables import (
    folder_digest,
    path_exists,
    quarantine_path,
    read_table,
    stored_rows,
    table_path,
    write_table,
)

STAGES = ("landing", "bronze", "silver", "star", "marts", "export")

LOG_SCHEMA = (
    "stage string, table string, operation string, rows long, read long, rejected long, duplicates long, "
    "unknown_keys long"
)


def load_bronze(
    spark: SparkSession, root: str, table: str, day: str, fmt: str = "parquet", multi_line: bool = False
) -> int:
    """One landing table to bronze, all columns text plus provenance; gives the rows loaded.

    Escapes are turned back only in files that ``write_landing`` made; ``multi_line`` is for others' line breaks.
    """
    path = landed_path(spark, f"{root}/landing", table, day)
    df = stamp_bronze(read_landing_csv(spark, path, multi_line=multi_line), day)
    seen = Observation()
    write_table(df.observe(seen, F.count(F.lit(1)).alias("rows")), table_path(root, "bronze", table), fmt)
    return seen.get["rows"]


def landed_tables(spark: SparkSession, root: str, day: str, tables: list[str]) -> list[str]:
    """``tables``, each of which has files for ``day``: one that has not landed is an error."""
    found = discover_landing(spark, f"{root}/landing", day, tables).select("tabela").distinct()
    names = {row["tabela"] for row in found.collect()}
    missing = [name for name in tables if name not in names]
    if missing:
        raise FileNotFoundError(f"nothing landed for {day}: {', '.join(missing)}")
    return tables


def _of_day(lake: Lake, name: str, day: str) -> None:
    """A bronze table of another day would give a mixed result: that is an error."""
    bronze = read_table(lake.spark, lake.root, "bronze", name, drop_audit=False, fmt=lake.fmt)
    other = bronze.where(~F.col(EXTRACTION_DATE).eqNullSafe(F.lit(day))).select(EXTRACTION_DATE).first()
    if other is not None:
        raise ValueError(f"bronze {name} is of {other[0]}, not of {day}")


def run_layers(
    spark: SparkSession,
    source: Callable[[str], DataFrame],
    root: str,
    day: str,
    stages: tuple[str, ...] = STAGES[:-1],
    tables: list[str] | None = None,
    objects: list[str] | None = None,
    mart_names: list[str] | None = None,
    specs: Mapping[str, TableSpec] = SPECS,
    fmt: str = "parquet",
    export: Callable[[str, DataFrame], None] | None = None,
    at_once: int = 4,
    multi_line: bool = False,
    raw: str | None = None,
    record: bool = False,
    resume: bool = False,
) -> DataFrame:
    """Runs the stages in order under ``root`` and gives the log, which is also kept in ``_run_log``.

    Only ``tables``, ``objects`` and ``mart_names`` are written; what else they are built on is read as stored, and
    is an error if it is not there or, in bronze, of another day. The session's shuffle width is put back at the end.
    Tables of a stage are independent of one another and run ``at_once`` at a time. ``export`` is
    called for each mart in the last stage (see ``jdbc_export``).

    ``multi_line``: landing files of other writers have line breaks in values. ``raw``: a quarantine column for rejected
    rows as they came. ``record``: keep for each table what it was made from. ``resume``: so too, and a table is left as it is, and noted as ``unchanged``, if neither its files nor those
    that it was made from have changed since a run that recorded it (``Ledger``); what depends on a changed table is
    made anew. Landing is not skipped, since a source has no files to compare: a run that is taken up again leaves that stage out.
    """
    stages = select_names(STAGES, stages)
    tables = select_names(specs, tables)
    objects, mart_names = select_names(star.STAR, objects), select_names(marts.MARTS, mart_names)
    lake = Lake(spark, root, lambda name: read_table(spark, root, "bronze", name, fmt=fmt), specs, fmt)
    ledger = Ledger(spark, root, record, resume) if fmt == "parquet" else Ledger(spark, root, False, False)
    log: list[tuple] = []

    def side_by_side(work, names):
        with ThreadPoolExecutor(max_workers=at_once) as pool:
            return list(pool.map(work, names))

    def note(stage, done: Written, operation="overwrite"):
        log.append(
            (stage, done.table, operation, done.rows, done.read, done.rejected, done.duplicates, done.unknown_keys)
        )

    def run(stage, names, work, outputs, inputs):
        """``work`` for each table that is not as it was left; the log keeps the tables' order."""

        def one(name):
            made = outputs(name)
            if ledger.unchanged(stage, name, made, inputs(name)):
                return Written(stage, name, stored_rows(spark, made[0])), "unchanged"
            done = work(name)
            ledger.keep(stage, name, made, inputs(name))
            return done, "overwrite"

        for done, operation in side_by_side(one, names):
            note(stage, done, operation)
            if operation == "unchanged" and stage != "bronze":
                lake.written.setdefault(done.table, done)

    def gold(name):
        return [table_path(root, lake.layer(name), name)]

    def made_from(sources):
        return lambda name: [path for source in sources[name] for path in gold(source)]

    try:
        with kept_shuffles(spark):
            if "landing" in stages:
                for name, rows in zip(tables, side_by_side(lambda n: _land(source(n), root, n, day), tables)):
                    note("landing", Written("landing", name, rows))
            if "bronze" in stages:
                run(
                    "bronze",
                    landed_tables(spark, root, day, tables),
                    lambda n: Written("bronze", n, load_bronze(spark, root, n, day, fmt, multi_line)),
                    lambda n: [table_path(root, "bronze", n)],
                    lambda n: [landed_path(spark, f"{root}/landing", n, day)],
                )
            if "silver" in stages:
                for name in tables:
                    _of_day(lake, name, day)
                size_shuffles(spark, f"{root}/bronze")
                run(
                    "silver",
                    tables,
                    lambda n: lake.write_quarantine(n, raw),
                    lambda n: [table_path(root, "silver", n), quarantine_path(root, n)],
                    lambda n: [table_path(root, "bronze", n)],
                )
            if "star" in stages:
                silver, others = star.needed(objects)
                _reuse(lake, [n for n in silver if "silver" not in stages or n not in tables])
                _reuse(lake, [n for n in others if n not in objects])
                size_shuffles(spark, f"{root}/silver")
                for group in (star.DIMENSIONS, ("fato_transmissoes",), [n for n in star.FACTS if n != "fato_transmissoes"]):
                    run("star", [n for n in objects if n in group], lake.build, gold, made_from(star.INPUTS))
            if "marts" in stages:
                inputs = [n for m in mart_names for n in marts.INPUTS[m]]
                _reuse(lake, [n for n in inputs if "star" not in stages or n not in objects])
                run("marts", mart_names, lake.build, gold, made_from(marts.INPUTS))
            if "export" in stages:
                if export is None:
                    raise ValueError("the export stage needs an export target")
                for name in mart_names:
                    export(name, read_table(spark, root, "gold", name, fmt=fmt))
                    # From the stored mart's footers: a target need not read all rows, or any, by itself.
                    note("export", Written("export", name, stored_rows(spark, table_path(root, "gold", name), fmt)), "truncate")
    finally:
        # What was done before a failure is on record too.
        run_log = spark.createDataFrame(log, LOG_SCHEMA).withColumn("run_at", F.current_timestamp())
        run_log.coalesce(1).write.mode("append").parquet(f"{root}/_run_log")
    return run_log


class Ledger:
    """What each table was made from, by its files and those of its inputs, so that a run can be taken up again.

    An entry is written once its table is whole, and taken for true only if the listing of inputs and outputs gives what
    it says.
    """

    def __init__(self, spark: SparkSession, root: str, record: bool, resume: bool):
        self.spark, self.folder, self.record, self.resume = spark, f"{root}/_ledger", record or resume, resume

    def _entry(self, stage: str, table: str) -> str:
        return f"{self.folder}/{stage}__{table}"

    def _digests(self, outputs: list[str], inputs: list[str]) -> tuple[str | None, str | None]:
        return folder_digest(self.spark, *outputs), folder_digest(self.spark, *inputs)

    def unchanged(self, stage: str, table: str, outputs: list[str], inputs: list[str]) -> bool:
        path = self._entry(stage, table)
        if not self.resume or not path_exists(self.spark, f"{path}/_SUCCESS"):
            return False
        found = self._digests(outputs, inputs)
        return None not in found and found == tuple(self.spark.read.schema("outputs string, inputs string").json(path).first())

    def keep(self, stage: str, table: str, outputs: list[str], inputs: list[str]) -> None:
        if not self.record:
            return
        entry = self.spark.createDataFrame([self._digests(outputs, inputs)], "outputs string, inputs string")
        entry.coalesce(1).write.mode("overwrite").json(self._entry(stage, table))


def _land(df: DataFrame, root: str, name: str, day: str) -> int:
    """Writes one table's landing files; gives the rows written."""
    seen = Observation()
    write_landing(df.observe(seen, F.count(F.lit(1)).alias("rows")), f"{root}/landing", name, day)
    return seen.get["rows"]


def _reuse(lake: Lake, names: list[str]) -> None:
    """What a run was not asked to write is taken as it is stored."""
    for name in names:
        if name not in lake.written:
            layer = lake.layer(name)
            rows = stored_rows(lake.spark, table_path(lake.root, layer, name), lake.fmt)
            lake.written[name] = Written(layer, name, rows)


def jdbc_export(url: str, schema: str, **options: str) -> Callable[[str, DataFrame], None]:
    """An export target: each mart replaces the rows of ``schema.<mart>``."""
    return lambda name, df: export_jdbc(df, url, f"{schema}.{name}", **options)


def export_marts(
    spark: SparkSession, root: str, url: str, schema: str, names: list[str] | None = None, fmt: str = "parquet", **options: str
) -> None:
    target = jdbc_export(url, schema, **options)
    for name in select_names(marts.MARTS, names):
        target(name, read_table(spark, root, "gold", name, fmt=fmt))
