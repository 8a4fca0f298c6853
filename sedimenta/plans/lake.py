"""Stored layers, built table by table the first time they are asked for."""

from __future__ import annotations

import hashlib
import re
import tempfile
import threading
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sedimenta.operators.audit import EXTRACTION_DATE, stamp
from sedimenta.operators.dimensional import has_unknown_key
from sedimenta.operators.quality import (
    any_broken,
    clean_rows,
    deduplicate,
    evaluate_quality,
    standardize,
)
from sedimenta.plans import marts, star
from sedimenta.plans.specs import SPECS, TableSpec
from sedimenta.sources.tables import delete_path, quarantine_path, read_table, table_path, write_table

# Column by which judged rows are kept apart while a table is refined: 1 is rejected.
REJECTED = "_rejeitada"
# Of stored silver, star and mart tables; what a run reads only once keeps the session's, which takes less time.
COMPRESSION = "zstd"


@dataclass(frozen=True)
class Written:
    """What one write did; the counts come with the write, not from another pass."""

    layer: str
    table: str
    rows: int
    read: int | None = None
    rejected: int | None = None
    duplicates: int | None = None
    unknown_keys: int | None = None


class Lake(Mapping):
    """Silver, star and mart tables under one folder, by name.

    ``bronze`` gives a table's unrefined rows: bronze text or a typed source. A table is written
    once and read from storage by everything built on it, so no plan grows past one layer and a
    lost executor costs at most the tasks of one write. The source is taken as unchanging; a new
    load goes to a new folder.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        bronze: Callable[[str], DataFrame],
        specs: Mapping[str, TableSpec] = SPECS,
        fmt: str = "parquet",
    ):
        self.spark, self.root, self.bronze, self.specs, self.fmt = spark, root, bronze, specs, fmt
        self.written: dict[str, Written] = {}
        self._locks = {name: threading.RLock() for name in self}
        self._judged: dict[str, DataFrame] = {}
        self._once: dict[str, object] = {}
        self._once_lock = threading.Lock()

    def __iter__(self):
        return iter([*self.specs, *star.STAR, *marts.MARTS])

    def __len__(self):
        return len(list(iter(self)))

    def layer(self, name: str) -> str:
        if name in self.specs:
            return "silver"
        if name in star.STAR or name in marts.MARTS:
            return "gold"
        raise KeyError(name)

    def __getitem__(self, name: str) -> DataFrame:
        layer = self.layer(name)
        self.build(name)
        return read_table(self.spark, self.root, layer, name, fmt=self.fmt)

    @property
    def rows(self) -> dict[str, int]:
        """Counted rows of the tables stored so far."""
        return {name: done.rows for name, done in self.written.items()}

    def build(self, name: str) -> Written:
        """Writes the table unless this session has done so, and what it is built on before it."""
        self.layer(name)
        with self._locks[name]:
            if name not in self.written:
                if name in self.specs:
                    self.written[name] = self._write_silver(name)
                elif name in star.STAR:
                    df = star.STAR[name](self._inputs(star.INPUTS[name]), self.rows)
                    self.written[name] = self._write_gold(name, df, audit_keys=name in star.FACTS)
                else:
                    df = marts.MARTS[name](self._inputs(marts.INPUTS[name]))
                    self.written[name] = self._write_gold(name, df)
            return self.written[name]

    def build_all(self, names: Sequence[str], at_once: int = 4) -> list[Written]:
        """Builds independent tables side by side."""
        with ThreadPoolExecutor(max_workers=at_once) as pool:
            return list(pool.map(self.build, names))

    def _inputs(self, names: Sequence[str]) -> dict[str, DataFrame]:
        self.build_all(names)
        return {name: self[name] for name in names}

    def once(self, label: str, work: Callable[[str], object]):
        """``work`` on a folder of its own under the lake's; later calls get the first call's result."""
        with self._once_lock:
            lock = self._locks.setdefault(label, threading.RLock())
        with lock:
            if label not in self._once:
                self._once[label] = work(f"{self.root}/{label}")
            return self._once[label]

    def write_quarantine(self, name: str, raw: str | None = None) -> Written:
        """Silver table and quarantine (rejected rows with their reasons) from one parse, with the table's full counts.

        The unrefined rows are read, parsed and judged once, and written apart by verdict; both tables are made from
        that. The counts are taken in the task that writes the rows, so a task run twice counts once. ``raw`` names a
        column of the quarantine for the row as it came, as JSON. A silver table that this session has written before is
        left as it is.
        """
        spec, path = self.specs[name], table_path(self.root, "silver", f"_judged/{name}")
        typed = self._typed(name, raw)
        broken = any_broken(spec)
        judged = typed.withColumn(REJECTED, broken.cast("int"))
        if raw:
            judged = judged.withColumn(raw, F.when(broken, F.col(raw)))
        seen = Observation()
        counted = judged.observe(seen, F.count(F.lit(1)).alias("read"), F.count_if(F.col(REJECTED) == 1).alias("rejected"))
        write_table(counted, path, partition_by=(REJECTED,))
        stored = self.spark.read.schema(judged.schema).parquet(path)
        try:
            self._judged[name] = stored.where(F.col(REJECTED) == 0).drop(REJECTED, *([raw] if raw else []))
            silver = self.build(name)
            rejected = evaluate_quality(stored.where(F.col(REJECTED) == 1).drop(REJECTED), spec)
            write_table(stamp(rejected, "silver"), quarantine_path(self.root, name), self.fmt)
        finally:
            del self._judged[name]
            delete_path(self.spark, path)
        read, count = seen.get["read"], seen.get["rejected"]
        return Written("silver", name, silver.rows, read, count, read - count - silver.rows)

    def _typed(self, name: str, raw: str | None = None) -> DataFrame:
        rows, keep = self.bronze(name), [EXTRACTION_DATE]
        if raw:
            rows, keep = rows.withColumn(raw, F.to_json(F.struct(*self.specs[name].columns))), [*keep, raw]
        return standardize(rows, self.specs[name], keep=tuple(keep))

    def _write_silver(self, name: str) -> Written:
        clean = self._judged.get(name)
        if clean is None:
            clean = clean_rows(self._typed(name), self.specs[name])
        unique = deduplicate(clean, self.specs[name])
        rows = self._write(stamp(unique, "silver"), "silver", name, F.count(F.lit(1)).alias("rows"))["rows"]
        return Written("silver", name, rows)

    def _write_gold(self, name: str, df: DataFrame, audit_keys: bool = False) -> Written:
        counts = [F.count(F.lit(1)).alias("rows")]
        if audit_keys:
            counts.append(F.count_if(has_unknown_key(df)).alias("unknown"))
        seen = self._write(stamp(df, "gold"), "gold", name, *counts)
        return Written("gold", name, seen["rows"], unknown_keys=seen.get("unknown"))

    def _write(self, df: DataFrame, layer: str, name: str, *counts) -> dict:
        seen = Observation()
        write_table(df.observe(seen, *counts), table_path(self.root, layer, name), self.fmt, compression=COMPRESSION)
        return seen.get


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as ``spark.checkpoint.dir`` names it.

    Where none is set, one process (master ``local``) gets a temporary folder; on a cluster that is an error, since
    each executor would write to a disk of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return tempfile.mkdtemp(prefix="sedimenta-")


_lakes: dict[tuple[str, str], Lake] = {}
_lakes_lock = threading.Lock()


def session_lake(spark: SparkSession, label: str, bronze: Callable[[str], DataFrame], specs) -> Lake:
    """One lake per application and data folder, in the session's shared folder."""
    application = spark.sparkContext.applicationId
    with _lakes_lock:
        key = (application, label)
        if key not in _lakes:
            folder = f"sedimenta-{application}-{hashlib.sha256(label.encode()).hexdigest()}"
            _lakes[key] = Lake(spark, f"{shared_folder(spark)}/{folder}", bronze, specs)
        return _lakes[key]
