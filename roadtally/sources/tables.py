"""Tables in a folder that are appended to and updated whole or not at all.

Rows lie in ``data/<partition>=<value>/lot=<batch>``.  A small file in
``manifests``, one for each version, lists the lots that make up the table; a
table is what the last whole manifest says.  A batch first writes its lots,
which nobody reads yet, and then its manifest, which takes them in and leaves
out those that it replaces.  A job that dies before that changes nothing, and a
batch that a manifest already counts does nothing when it is run again.  Two
batches that started from one version cannot both write the next one.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..operators.checks import watch
from ..scratch import delete
from .writers import update


class Conflict(RuntimeError):
    """Another batch wrote the version that this one was about to write."""


class Refused(ValueError):
    """A delivery breaks rules: how many rows each of them."""

    def __init__(self, broken: dict[str, int]):
        super().__init__(", ".join(f"{name}: {n}" for name, n in broken.items()))
        self.broken = broken


@dataclass
class Manifest:
    version: int
    lots: dict[str, list[str]]  # folder of a partition -> its lots
    batches: list[str]
    schema: dict | None


@dataclass
class Table:
    """A table of Parquet files below ``path``, partitioned by one column."""

    spark: SparkSession
    path: str
    partition: str = "annee"

    def _folder(self, name: str):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return place, place.getFileSystem(self.spark._jsc.sc().hadoopConfiguration())

    def manifest(self) -> Manifest:
        """The last whole one; a file that was cut off while it was written doesn't count."""
        place, fs = self._folder("manifests")
        found = sorted((f.getPath().getName() for f in fs.listStatus(place)), reverse=True) if fs.exists(place) else []
        for name in found:
            text = self.spark.read.text(f"{self.path}/manifests/{name}", wholetext=True).first()
            try:
                return Manifest(**json.loads(text[0] if text else ""))
            except ValueError:
                continue
        return Manifest(0, {}, [], None)

    def _commit(self, m: Manifest) -> None:
        """Create the file of the next version, which must not exist; versions that were cut off are passed over."""
        place, fs = self._folder("manifests")
        taken = [int(f.getPath().getName().removesuffix(".json")) for f in fs.listStatus(place)] if fs.exists(place) else []
        if self.manifest().version != m.version:
            raise Conflict(f"version {m.version} of {self.path} is no longer the last")
        m = Manifest(max([m.version, *taken]) + 1, m.lots, m.batches, m.schema)
        target, fs = self._folder(f"manifests/{m.version:09d}.json")
        try:
            out = fs.create(target, False)
        except Exception as error:
            raise Conflict(f"version {m.version} of {self.path} exists") from error
        out.write(bytearray(json.dumps(m.__dict__).encode()))
        out.close()

    def _read(self, m: Manifest, folders: list[str]) -> DataFrame:
        """Rows of some partitions, with the columns in their order."""
        whole = StructType.fromJson(m.schema)
        paths = [f"{self.path}/data/{f}/lot={lot}" for f in folders for lot in m.lots[f]]
        if not paths:
            return self.spark.createDataFrame([], whole)
        found = self.spark.read.schema(StructType([*whole.fields, StructField("lot", StringType())])).option("basePath", f"{self.path}/data").parquet(*paths)
        return found.select(*whole.fieldNames())

    def read(self) -> DataFrame:
        m = self.manifest()
        if m.schema is None:
            raise FileNotFoundError(f"no table at {self.path}")
        return self._read(m, sorted(m.lots))

    def _write(self, df: DataFrame, batch: str) -> list[str]:
        """Write a lot and return the folders of the partitions that it has rows in.  What a dead run left of the batch goes first."""
        place, fs = self._folder("data")
        old = [f.getPath().getName() for f in fs.listStatus(place)] if fs.exists(place) else []
        for f in old:
            delete(self.spark, f"{self.path}/data/{f}/lot={batch}")
        df.withColumn("lot", F.lit(batch)).write.mode("append").partitionBy(self.partition, "lot").parquet(f"{self.path}/data")
        here = [f.getPath().getName() for f in fs.listStatus(place)] if fs.exists(place) else []
        return [f for f in here if "=" in f and fs.exists(self._folder(f"data/{f}/lot={batch}")[0])]

    def append(self, df: DataFrame, batch: str | None = None, rules: dict[str, Column] | None = None) -> None:
        """Add rows.  ``batch`` names the delivery: the same name is taken in once.

        ``rules`` are conditions that no row may meet.  The job that writes counts
        them, and a delivery that breaks one is refused as a whole.
        """
        m, batch = self.manifest(), batch or uuid.uuid4().hex
        if batch in m.batches:
            return
        if m.schema is not None:
            df = df.select(*[f["name"] for f in m.schema["fields"]])
        schema = m.schema or json.loads(df.schema.json())
        lots = dict(m.lots)
        rows, seen = watch(df, rules) if rules else (df, None)
        folders = self._write(rows, batch)
        broken = {name: n for name, n in seen.get.items() if n} if seen else {}
        if broken:
            raise Refused(broken)
        for folder in folders:
            lots[folder] = [*lots.get(folder, []), batch]
        self._commit(Manifest(m.version, lots, [*m.batches, batch], schema))

    def merge(self, values: DataFrame, key: list[str], cols: list[str], only_when: Column | None = None, insert: bool = False, batch: str | None = None) -> None:
        """Set ``cols`` of the rows with a key of ``values`` (one row for a key); ``insert`` adds rows whose key is new.

        Only partitions with such a row are read and written again.  Where
        ``values`` has the partition column, it is part of the key.
        """
        m, batch = self.manifest(), batch or uuid.uuid4().hex
        if batch in m.batches:
            return
        table = self._read(m, sorted(m.lots))
        key = [*dict.fromkeys([*key, *([self.partition] if self.partition in values.columns else [])])]
        hit = table.join(values.select(*key).distinct(), key, "left_semi").select(self.partition).distinct()
        years = [r[0] for r in hit.collect()]  # one value for each touched partition
        touched = [f for f in m.lots if _value(f, self.partition) in {None if y is None else str(y) for y in years}]
        rows = update(self._read(m, touched), values, key, cols, only_when)
        lots = {f: ls for f, ls in m.lots.items() if f not in touched}
        for folder in self._write(rows, batch) if touched else []:
            lots[folder] = [*lots.get(folder, []), batch]
        if insert:
            fresh = values.join(table.select(*key).distinct(), key, "left_anti")
            names = [f["name"] for f in m.schema["fields"]]
            fresh = fresh.select(*[F.col(c) if c in fresh.columns else F.lit(None).alias(c) for c in names])
            for folder in self._write(fresh.to(table.schema), batch + "-new"):
                lots[folder] = [*lots.get(folder, []), batch + "-new"]
        self._commit(Manifest(m.version, lots, [*m.batches, batch], m.schema))

    def clean(self) -> None:
        """Remove lots that the table doesn't consist of; not while a batch is running."""
        m = self.manifest()
        place, fs = self._folder("data")
        for f in fs.listStatus(place) if fs.exists(place) else []:
            folder = f.getPath().getName()
            for lot in fs.listStatus(f.getPath()) if f.isDirectory() else []:
                if lot.getPath().getName().removeprefix("lot=") not in m.lots.get(folder, []):
                    fs.delete(lot.getPath(), True)


def _value(folder: str, partition: str) -> str | None:
    """Value of a partition from its folder's name."""
    text = folder.removeprefix(f"{partition}=")
    return None if text == "__HIVE_DEFAULT_PARTITION__" else text
