"""Stored stages: tables, fitted models and their feature lists, found again as long as inputs, settings and code are the same.

A stage lives in a folder named by a fingerprint of the input files (path, length, time of change), of the settings and of this
package's own code. The folder's `done` table is written last, so a broken write is not taken for a result and is done anew.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import lru_cache
from hashlib import sha256
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from sensorloom.session import scratch_dir, shared_dir
from sensorloom.sources import io


@lru_cache(maxsize=1)
def code_digest() -> str:
    """Of the package's modules beside the corpus operators."""
    root = Path(__file__).resolve().parents[1]
    digest = sha256()
    for path in sorted(root.rglob("*.py")):
        if path.relative_to(root).parts[0] != "llm":
            digest.update(path.read_bytes())
    return digest.hexdigest()


def files_digest(spark: SparkSession, folder: str, names: tuple[str, ...]) -> str:
    """Of the files of the tables `names`; their contents are not read, and one row comes back."""
    listed = None
    for name in names:
        reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
        part = reader.load(f"{folder}/{name}.parquet").select("path", "length", "modificationTime")
        listed = part if listed is None else listed.unionByName(part)
    row = listed.agg(F.count("*"), F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)"))).first()
    return sha256(repr(tuple(map(str, row))).encode()).hexdigest()


class Store:
    """Stages over the tables `names` of `folder`."""

    def __init__(self, spark: SparkSession, folder: str, names: tuple[str, ...], **settings):
        self.spark = spark
        parts = [files_digest(spark, folder, names), code_digest(), json.dumps(settings, sort_keys=True, default=str)]
        self.folder = f"{shared_dir(spark)}/store-{sha256(' '.join(parts).encode()).hexdigest()[:24]}"

    def _done(self, name: str) -> dict | None:
        try:
            row = self.spark.read.schema("at string, note string").json(f"{self.folder}/{name}/done").first()
        except AnalysisException:
            return None
        return None if row is None else {"at": row.at, "note": json.loads(row.note)}

    def _finish(self, name: str, at: str, note) -> None:
        row = self.spark.createDataFrame([(at, json.dumps(note))], "at string, note string")
        row.coalesce(1).write.mode("overwrite").json(f"{self.folder}/{name}/done")

    def table(self, name: str, make: Callable[[], tuple[DataFrame, object]]) -> tuple[DataFrame, object]:
        """A table and a note on it (its feature list, say); `make` runs if there is none yet."""
        done = self._done(name)
        if done is None:
            df, note = make()
            at = f"{scratch_dir(self.spark)}/{name}"  # two writers at once do not meet
            io.write_table(df, at)
            self._finish(name, at, note)
            return io.read_table(self.spark, at), note
        return io.read_table(self.spark, done["at"]), done["note"]

    def model(self, name: str, make: Callable[[], PipelineModel]) -> PipelineModel:
        """A fitted pipeline; its first stage holds the feature order."""
        done = self._done(name)
        if done is None:
            at = f"{scratch_dir(self.spark)}/{name}"
            make().write().overwrite().save(at)
            self._finish(name, at, None)
            return PipelineModel.load(at)
        return PipelineModel.load(done["at"])
