"""A store of runs: stages written as Parquet in a shared folder, resumed after a failure, never computed twice."""

from __future__ import annotations

import hashlib
import json
import re
import tempfile
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A new path below spark.checkpoint.dir; a temporary folder in local mode where that is unset, an error on a cluster."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="spark-runs-")
    return f"{base.rstrip('/')}/run-{uuid.uuid4().hex}"


def version_of(df: DataFrame) -> str:
    """A hash of the files that a table reads (paths, sizes, times of change), its columns, and its plan's text without running numbers.

    Files that change give another version. Tables made from rows in memory differ by their plan's text alone: name a
    version of them where their rows may change.
    """
    spark, digest = df.sparkSession, hashlib.sha256(df.schema.json().encode())
    plan = df._jdf.queryExecution().analyzed().toString()
    digest.update(re.sub(r"#\d+L?|plan_id=\d+", "", plan).encode())
    conf = spark._jsc.hadoopConfiguration()
    for file in sorted(df.inputFiles()):
        path = spark._jvm.org.apache.hadoop.fs.Path(file)
        status = path.getFileSystem(conf).getFileStatus(path)
        digest.update(f"{file}:{status.getLen()}:{status.getModificationTime()}".encode())
    return digest.hexdigest()[:32]


@dataclass
class RunStore:
    """Stages below `root`. A stage's folder is named by its fingerprint: of its name, its parameters and its inputs' versions.

    A stage whose manifest is there is read; else it is computed, written, and its manifest is written last, so that a
    stage that a lost driver left half written is written anew. Runs with other parameters or inputs get folders of their own
    and share the stages that are alike. `made` lists what this store computed, `reused` what it read.
    """

    spark: SparkSession
    root: str
    made: list[str] = field(default_factory=list)
    reused: list[str] = field(default_factory=list)
    versions: dict[str, str] = field(default_factory=dict)

    def _path(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where, where.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def input(self, name: str, table: DataFrame, version: str | None = None) -> DataFrame:
        """Register an input; `version` replaces the hash of its files and plan."""
        self.versions[name] = version or version_of(table)
        return table

    def stage(self, name: str, make: Callable[[], DataFrame], inputs: list[str], **parameters) -> DataFrame:
        """The stage's table, read from the store. `inputs` are names of inputs or of earlier stages."""
        known = {"name": name, "parameters": json.loads(json.dumps(parameters, default=str, sort_keys=True)), "inputs": {i: self.versions[i] for i in inputs}}
        self.versions[name] = version = hashlib.sha256(json.dumps(known, sort_keys=True).encode()).hexdigest()[:32]
        data, manifest = f"{self.root}/{name}-{version}", f"{self.root}/_manifests/{name}-{version}"
        where, fs = self._path(f"{manifest}/_SUCCESS")
        if fs.exists(where):
            self.reused.append(name)
        else:
            df = make()
            df.write.mode("overwrite").parquet(data)
            entry = [(name, version, json.dumps(known["parameters"], sort_keys=True), json.dumps(known["inputs"], sort_keys=True), df.schema.json())]
            self.spark.createDataFrame(entry, "stage string, version string, parameters string, inputs string, columns string").coalesce(1).write.mode("overwrite").json(manifest)
            self.made.append(name)
        return self.spark.read.parquet(data)

    def manifest(self) -> DataFrame:
        """(stage, version, parameters, inputs, columns) of all complete stages."""
        return self.spark.read.schema("stage string, version string, parameters string, inputs string, columns string").json(f"{self.root}/_manifests/*")

    def delete(self, stage: str | None = None) -> None:
        """Delete a stage in all its versions, manifests first, or the whole store."""
        where, fs = self._path(self.root if stage is None else f"{self.root}/_manifests/{stage}-*")
        if stage is None:
            fs.delete(where, True)
            return
        for pattern in (f"{self.root}/_manifests/{stage}-*", f"{self.root}/{stage}-*"):
            for status in fs.globStatus(self._path(pattern)[0]) or []:
                fs.delete(status.getPath(), True)

