"""Stored tiers: Parquet folders or catalog tables, published run by run."""

from __future__ import annotations

import tempfile
from collections.abc import Mapping
from datetime import datetime, timezone
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_local_roots: dict[str, str] = {}


def work_root(spark: SparkSession) -> str:
    """Shared folder for tables a job writes on its way.

    Taken from ``spark.checkpoint.dir``. A local session without the setting
    gets a folder of its own; on a cluster the setting is required, because a
    machine-local folder cannot be read by other executors.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        app = spark.sparkContext.applicationId
        if app not in _local_roots:
            _local_roots[app] = tempfile.mkdtemp(prefix="clinicmart-")
        base = _local_roots[app]
    return f"{base.rstrip('/')}/clinicmart-{spark.sparkContext.applicationId}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder and what is in it, in whatever file system it is; a missing one is fine."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


class TierStore:
    """Named tables below one folder, or in one database of the catalog.

    Tables are written in runs. A run writes beside what is there, may read its own tables
    back and check them, and is published by one row appended to the manifest, which says where each
    table is. Readers ask the manifest, so they see all tables of a run or none, and a run
    that fails leaves the tables before it readable. One run is published at a time.

    In a database each table of a run is a table of its own, and a view has the plain name, for
    SQL. Views, and copies of documents under their plain names, follow the manifest one after another.

    Reading a table back gives Spark its true size, which is what lets the
    planner choose between broadcast and shuffle joins without hints.
    """

    MANIFEST = "manifest"
    RUNS = "runs"

    def __init__(self, spark: SparkSession, root: str | None = None, database: str | None = None):
        if (root is None) == (database is None):
            raise ValueError("give either a folder or a database")
        self.spark = spark
        self.root = root.rstrip("/") if root else None
        self.database = database

    def run(self) -> Run:
        """A run, not yet visible to readers."""
        return Run(self)

    def write(self, name: str, df: DataFrame) -> DataFrame:
        """Replace one table and return it as read back."""
        return self.write_all({name: df})[name]

    def write_all(self, tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
        """Replace tables, all at once; they are written in the given order."""
        run = self.run()
        written = {name: run.write(name, df) for name, df in tables.items()}
        run.publish()
        return written

    def read(self, name: str) -> DataFrame:
        return self.read_all([name])[name]

    def read_all(self, names: list[str]) -> dict[str, DataFrame]:
        """Tables of one state of the store."""
        places = self.published()
        return {name: self._open(places.get(name) or self._plain(name)) for name in names}

    def has(self, name: str) -> bool:
        """Whether a run has published the table."""
        return name in self.published()

    def write_document(self, name: str, df: DataFrame) -> None:
        """Store a small summary as JSON, in the folder or in the location of the database."""
        _write_document(df, f"{self.folder}/{name}")

    def read_document(self, name: str) -> DataFrame:
        """A summary that a run has published, or that was stored by itself."""
        return self.spark.read.json(self.published().get(name) or f"{self.folder}/{name}")

    @property
    def folder(self) -> str:
        """The folder of the store; of a database, its location."""
        if self.root:
            return self.root
        return self.spark.catalog.getDatabase(self.database).locationUri.rstrip("/")

    def published(self) -> dict[str, str]:
        """Table or document -> place, as the last published run left them."""
        last = self._history(1)
        return dict(last[0].places) if last else {}

    def prune(self, keep: int = 1) -> None:
        """Remove the tables of runs that none of the last ``keep`` states refers to.

        Readers of older states lose their tables, and so do runs that are not published yet.
        """
        states = self._history()
        used = {place for state in states[:keep] for place in state.places.values()}
        for place in {p for state in states[keep:] for p in state.places.values()} - used:
            if place.startswith(f"{self.database}."):
                self.spark.sql(f"DROP TABLE IF EXISTS {place}")
            else:
                remove_folder(self.spark, place)

    def _history(self, limit: int | None = None) -> list:
        """States, the last one first: a short row for each run."""
        try:
            rows = self.spark.read.schema(_MANIFEST).json(f"{self.folder}/{self.MANIFEST}")
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return []
            raise
        rows = rows.orderBy(F.col("version").desc(), F.col("run").desc())
        return (rows if limit is None else rows.limit(limit)).collect()

    def _plain(self, name: str) -> str:
        return f"{self.root}/{name}" if self.root else f"{self.database}.{name}"

    def _open(self, place: str) -> DataFrame:
        return self.spark.read.parquet(place) if self.root else self.spark.table(place)


_MANIFEST = "version bigint, run string, places map<string,string>"


def _write_document(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


class Run:
    """Tables written together. ``read`` gives those of the run, else the published ones."""

    def __init__(self, store: TierStore):
        self.store = store
        self.name = f"{datetime.now(timezone.utc):%Y%m%d%H%M%S}_{uuid4().hex[:12]}"
        self.places: dict[str, str] = {}
        self._documents: dict[str, DataFrame] = {}

    def write(self, name: str, df: DataFrame) -> DataFrame:
        """Write a table of the run and return it as read back."""
        store = self.store
        writer = df.write.format("parquet")
        if store.root:
            place = f"{store.root}/{store.RUNS}/{self.name}/{name}"
            writer.save(place)
        else:
            place = f"{store.database}.{name}__{self.name}"
            writer.saveAsTable(place)
        self.places[name] = place
        return store._open(place)

    def write_all(self, tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
        return {name: self.write(name, df) for name, df in tables.items()}

    def write_document(self, name: str, df: DataFrame) -> None:
        """Store a small summary as JSON, published with the tables."""
        place = f"{self.store.folder}/{self.store.RUNS}/{self.name}/{name}"
        _write_document(df, place)
        self.places[name] = place
        self._documents[name] = df

    def read(self, name: str) -> DataFrame:
        return self.store._open(self.places[name]) if name in self.places else self.store.read(name)

    def publish(self) -> None:
        """Make the run visible: one file with one row, appended in one step."""
        store = self.store
        last = store._history(1)
        version, places = (last[0].version + 1, dict(last[0].places)) if last else (1, {})
        row = [(version, self.name, {**places, **self.places})]
        state = store.spark.createDataFrame(row, _MANIFEST).coalesce(1)
        state.write.mode("append").json(f"{store.folder}/{store.MANIFEST}")
        for name, df in self._documents.items():
            store.write_document(name, df)
        if store.database:
            for name, place in self.places.items():
                if place.startswith(f"{store.database}."):
                    store.spark.sql(f"CREATE OR REPLACE VIEW {store.database}.{name} AS SELECT * FROM {place}")
