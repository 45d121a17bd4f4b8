"""The station table as a versioned one: unique station keys and ids whoever else is writing."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from gapweave.operators.stations import assign_station_id, dedupe_first, new_stations
from gapweave.schemas import STATION
from gapweave.sources.versions import Files, Version, VersionedTable


@dataclass(frozen=True)
class Prepared:
    """New stations, written with their ids but not committed, and the version that they are new to."""

    base: Version
    folder: str
    count: int


class StationTable:
    """Stations that are inserted if their key isn't there yet.

    Ids come from a counter in the version, so they are unique, without gaps and never given twice. Each commit
    is checked against the version it was made from: if another writer committed meanwhile, the upsert starts
    again from what is there then, so a key that both bring is inserted once.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType = STATION, key: str = "wban"):
        self.table, self.key = VersionedTable(spark, path, schema), key

    def read(self) -> DataFrame:
        return self.table.read()

    def of_batch(self, files: Files, name: str) -> DataFrame:
        """The stations of the version that the file ``name`` tells; where there is none yet, it will tell the latest."""
        files.put_if_absent(name, self.table.text_of(self.table.latest()))
        return self.table.read(self.table.from_text(files.text(name)))

    def prepare(self, candidates: DataFrame, order: Column | str) -> Prepared:
        base = self.table.latest()
        fresh = new_stations(dedupe_first(candidates, self.key, order), self.table.read(base), self.key)
        columns = [c for c in self.table.schema.names if c != "station_id"]
        rows = assign_station_id(fresh.select(*columns), self.key, after=base.properties.get("last_id", 0))
        folder = self.table.write(rows)
        return Prepared(base, folder, self.table.written(folder).count())

    def commit(self, prepared: Prepared) -> bool:
        """Whether the prepared stations are in the table now; if not, they have to be prepared again."""
        if not prepared.count:  # none new to the version that was read, so none new to later ones
            self.table.files.delete(prepared.folder)
            return True
        last = prepared.base.properties.get("last_id", 0) + prepared.count
        if self.table.commit(prepared.base, prepared.folder, last_id=last):
            return True
        self.table.files.delete(prepared.folder)
        return False

    def upsert(self, candidates: DataFrame, order: Column | str, attempts: int = 20) -> int:
        """Insert the first candidate of each new key; returns how many there were."""
        for _ in range(attempts):
            prepared = self.prepare(candidates, order)
            if self.commit(prepared):
                return prepared.count
        raise RuntimeError(f"{attempts} attempts to write {self.table.path} met another writer's commit")
