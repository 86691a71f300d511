"""Versioned artefact tables with atomic commits.

A store is a folder of the shared file system::

    data/c=<commit>/n=<name>/[_part=<part>/]...   what one commit wrote, never changed
    commits/v=<number>/                           one small file: all parts of a version

A commit writes its data first and then the manifest of the new version, in
one file.  A version counts once the manifest's job has ended, so a reader sees
the old version or the new one, and a failed write leaves the old one.  A commit
takes over the parts that it does not touch; a rerun under the same run name
replaces what that run wrote before, so writing twice reads as once.  Names are
tables (with columns of their own) or fitted MLlib pipelines.

One writer at a time: two writers that commit at the same moment would take the
same version number, and the second one fails.  The manifest has one row for
each part, so parts are days, buckets or batches, not keys.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

_MANIFEST = "name string, part string, c string, run string, kind string, schema string, info string"


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.exists(p)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path``; none if it does not exist."""
    fs, p = _path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()) if fs.exists(p) else []


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _path(spark, path)
    fs.delete(p, True)


class VersionedStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # -- versions ---------------------------------------------------------
    def _numbers(self) -> list[int]:
        return [int(f[2:]) for f in folders(self.spark, f"{self.root}/commits") if f.startswith("v=")]

    def versions(self) -> list[int]:
        """Complete versions, oldest first."""
        return [v for v in self._numbers() if exists(self.spark, f"{self.root}/commits/v={v:020d}/_SUCCESS")]

    def manifest(self, version: int | None = None) -> list[dict]:
        """Rows of a version's manifest, the newest by default; empty before the first commit."""
        known = self.versions()
        if not known:
            return []
        v = known[-1] if version is None else version
        if v not in known:
            raise ValueError(f"no version {v} in {self.root}")
        rows = self.spark.read.schema(_MANIFEST).json(f"{self.root}/commits/v={v:020d}").collect()
        return [r.asDict() for r in rows]

    def info(self, name: str, version: int | None = None) -> dict:
        """Metadata that the last commit of ``name`` carried."""
        own = [r for r in self.manifest(version) if r["name"] == name]
        return json.loads(max(own, key=lambda r: r["c"])["info"]) if own else {}

    # -- writing ----------------------------------------------------------
    def commit(self, items: Mapping[str, DataFrame | PipelineModel], run: str | None = None, part_by: str | None = None,
               parts: Iterable[str] = (), info: dict | None = None) -> int:
        """Writes ``items`` and then the manifest; returns the new version.

        Without ``part_by`` each item replaces its name as a whole.  With it,
        the distinct values of that column (as text) are parts: those in the
        data, those in ``parts`` (they may have become empty) and those that
        ``run`` wrote before are replaced, all others stay."""
        numbers = self._numbers()
        version = numbers[-1] + 1 if numbers else 0
        c = f"{version:020d}-{uuid.uuid4().hex}"           # later commits sort later
        run = run or c
        new = []
        for name, item in items.items():
            base = dict(name=name, c=c, run=run, info=json.dumps(info or {}))
            path = f"{self.root}/data/c={c}/n={name}"
            if isinstance(item, PipelineModel):
                item.write().save(path)
                new.append(dict(base, part="", kind="pipeline", schema=""))
            elif part_by is None:
                item.write.parquet(path)
                new.append(dict(base, part="", kind="table", schema=item.schema.json()))
            else:
                item.withColumn("_part", F.col(part_by).cast("string")).write.partitionBy("_part").parquet(path)
                schema = StructType([*item.schema.fields, StructField("_part", StringType())])
                found = self.spark.read.schema(schema).parquet(path).select("_part").distinct().collect()
                new += [dict(base, part=r["_part"], kind="table", schema=item.schema.json()) for r in found]
        gone = {(r["name"], r["part"]) for r in new} | {(name, p) for name in items for p in map(str, parts)}
        kept = [r for r in self.manifest() if (r["name"], r["part"]) not in gone
                and not (r["name"] in items and (part_by is None or r["run"] == run))]
        if not any(r["name"] in items for r in new) and part_by is not None:
            # A table whose parts are all gone keeps its columns.
            new += [dict(name=name, c=c, run=run, info=json.dumps(info or {}), part=None, kind="table", schema=item.schema.json())
                    for name, item in items.items() if not any(r["name"] == name for r in kept)]
        self._publish(version, kept + new)
        return version

    def _publish(self, version: int, rows: list[dict]) -> None:
        out = self.spark.createDataFrame([tuple(r[f.split()[0]] for f in _MANIFEST.split(", ")) for r in rows], _MANIFEST)
        out.coalesce(1).write.mode("errorifexists").json(f"{self.root}/commits/v={version:020d}")

    # -- reading ----------------------------------------------------------
    def parts(self, name: str = "table", version: int | None = None) -> list[str]:
        return sorted(r["part"] for r in self.manifest(version) if r["name"] == name and r["part"] is not None)

    def read(self, name: str = "table", version: int | None = None, parts: Iterable[str] | None = None) -> DataFrame:
        """The table ``name`` of a version; with ``parts`` only those, and no
        file of the others is read.  Columns are those of the last commit."""
        own = [r for r in self.manifest(version) if r["name"] == name and r["kind"] == "table"]
        if not own:
            raise ValueError(f"no table {name} in {self.root}")
        schema = StructType.fromJson(json.loads(max(own, key=lambda r: r["c"])["schema"]))
        wanted = None if parts is None else set(map(str, parts))
        own = [r for r in own if r["part"] is not None and (wanted is None or r["part"] in wanted)]
        if not own:
            return self.spark.createDataFrame([], schema)
        if all(r["part"] == "" for r in own):
            return self.spark.read.schema(schema).parquet(*[f"{self.root}/data/c={r['c']}/n={name}" for r in own])
        by_commit: dict[str, list[str]] = {}
        for r in own:
            by_commit.setdefault(r["c"], []).append(r["part"])
        keys = StructType([*schema.fields, *[StructField(k, StringType()) for k in ("c", "n", "_part")]])
        d = (self.spark.read.schema(keys).option("basePath", f"{self.root}/data")
             .parquet(*[f"{self.root}/data/c={c}/n={name}" for c in by_commit]))
        live = F.lit(False)
        for c, names in by_commit.items():
            live = live | ((F.col("c") == c) & F.col("_part").isin(names))
        return d.where(live).select(*schema.names)

    def load_pipeline(self, name: str, version: int | None = None) -> PipelineModel:
        own = [r for r in self.manifest(version) if r["name"] == name and r["kind"] == "pipeline"]
        if not own:
            raise ValueError(f"no pipeline {name} in {self.root}")
        return PipelineModel.load(f"{self.root}/data/c={own[0]['c']}/n={name}")

    # -- room -------------------------------------------------------------
    def vacuum(self, keep: int = 10) -> None:
        """Deletes manifests beyond the newest ``keep`` and data that none of
        those left names, that of failed commits included."""
        old = self.versions()[:-keep] if keep else []
        for v in old:
            delete(self.spark, f"{self.root}/commits/v={v:020d}")
        used = {r["c"] for v in self.versions() for r in self.manifest(v)}
        for f in folders(self.spark, f"{self.root}/data"):
            if f.removeprefix("c=") not in used:
                delete(self.spark, f"{self.root}/data/{f}")


def append_epochs(df: DataFrame, path: str, epoch: str = "epoch", keep: int | None = 100) -> None:
    """Adds the rows of ``df`` to the folders of their epochs and
    drops whole epochs beyond the newest ``keep``, so that what is stored stays
    bounded.  An epoch that comes again replaces its rows; one that is older
    than all that is kept goes again."""
    df.write.partitionBy(epoch).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    if keep is not None:
        retain_epochs(df.sparkSession, path, keep, epoch)


def retain_epochs(spark: SparkSession, path: str, keep: int = 100, epoch: str = "epoch") -> None:
    have = sorted(int(f.split("=", 1)[1]) for f in folders(spark, path) if f.startswith(f"{epoch}="))
    for e in have[:-keep] if keep else have:
        delete(spark, f"{path}/{epoch}={e}")
