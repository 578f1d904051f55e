"""The collection catalog: one small JSON record per committed version.

A record names the files that make up the collection at that version; the
newest record of each name is its state. A commit creates the next version's
file and fails when another job was first.
"""

from __future__ import annotations

import json
import time
import uuid
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RECORD = """
    index_name string, version long, dropped boolean, index_type string, is_trained boolean,
    metric string, embedding_model string, dimension int, element string, pq_dim int, pq_bits int,
    n_lists int, n_probes int, reach int, density double, n_at_train long, sealed boolean, key_salt string, key_fingerprint string,
    folder string, seq long, segments array<struct<name: string, seq: long, n: long, lo: string, hi: string, gone: array<int>>>,
    removals array<struct<name: string, seq: long, n: long>>, centroids string, codebooks string,
    metadata_columns map<string, string>, retrain_multiplier double, min_train_rows long,
    training string, applied map<string, long>
"""


KEPT_VERSIONS = 20      # records of a collection that stay; only the newest counts


class VersionConflict(RuntimeError):
    """Another job committed this version first; read again and retry."""


class Catalog:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.folder = f"{self.root}/_catalog"

    # -- files ------------------------------------------------------------

    def _path(self, path: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)

    def _files(self):
        return self._path(self.root).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, path: str) -> list[str]:
        files, folder = self._files(), self._path(path)
        if not files.exists(folder):
            return []
        return [status.getPath().getName() for status in files.listStatus(folder)]

    def ages(self, path: str) -> list[tuple[str, float]]:
        """(name, seconds since last change) of the entries of a folder."""
        files, folder = self._files(), self._path(path)
        if not files.exists(folder):
            return []
        now = time.time()
        return [(s.getPath().getName(), now - s.getModificationTime() / 1000.0) for s in files.listStatus(folder)]

    def remove(self, path: str) -> None:
        """Drop a folder of this catalog's own data."""
        if not path.startswith(self.root + "/"):
            raise ValueError("not a path of this catalog")
        self._files().delete(self._path(path), True)

    # -- records ----------------------------------------------------------

    def _record_folder(self, name: str) -> str:
        return f"{self.folder}/{quote(name, safe='')}"

    def state(self, name: str) -> dict | None:
        """The newest record of a collection; None when it does not exist."""
        for version in reversed(self._versions(name)):
            stream = self._files().open(self._path(f"{self._record_folder(name)}/{version}"))
            try:
                text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
            try:
                return json.loads(text)
            except ValueError:          # half a record, as a crash of a foreign writer leaves it
                continue
        return None

    def _versions(self, name: str) -> list[str]:
        return sorted(n for n in self._names(self._record_folder(name)) if n.endswith(".json"))

    def live(self, name: str) -> dict | None:
        state = self.state(name)
        return None if state is None or state.get("dropped") else state

    def commit(self, state: dict) -> dict:
        """Publish ``state`` as the version after the one it was read at.

        The record is written aside and renamed without overwriting, so readers
        see all of it or none of it. That needs a store whose rename is atomic
        (HDFS and other file systems; not a bare object store).
        """
        state = dict(state, version=state["version"] + 1)
        folder = self._record_folder(state["index_name"])
        aside, final = (self._path(f"{folder}/{n}") for n in (f"{uuid.uuid4().hex}.tmp", f"{state['version']:012d}.json"))
        files, hadoop = self._files(), self.spark.sparkContext._jvm.org.apache.hadoop.fs
        if files.exists(final):
            raise VersionConflict(state["index_name"])
        stream = files.create(aside, False)
        stream.write(bytearray(json.dumps(state).encode("utf-8")))
        stream.close()
        rename = getattr(hadoop, "Options$Rename")
        options = self.spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.NONE
        try:
            hadoop.FileContext.getFileContext(final.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration()).rename(aside, final, options)
        except Exception as error:
            files.delete(aside, False)
            if files.exists(final):
                raise VersionConflict(state["index_name"]) from error
            raise
        for name in self._versions(state["index_name"])[:-KEPT_VERSIONS]:
            files.delete(self._path(f"{folder}/{name}"), False)
        return state

    def table(self) -> DataFrame:
        """The newest record of every collection that exists, as a DataFrame."""
        if not self._names(self.folder):
            return self.spark.createDataFrame([], RECORD)
        records = self.spark.read.schema(RECORD).json(f"{self.folder}/*/*.json")
        newest = Window.partitionBy("index_name").orderBy(F.desc("version"))
        ranked = records.where(F.col("index_name").isNotNull()).withColumn("_rn", F.row_number().over(newest)).where(F.col("_rn") == 1)
        return ranked.where(~F.coalesce("dropped", F.lit(False))).drop("_rn")
