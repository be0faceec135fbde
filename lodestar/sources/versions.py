"""Tables that are replaced as wholes.

A version is a folder of its own, written first; a manifest (a small JSON
file with the folder, the schema, the number of rows and a fingerprint of the
inputs) is put in place last, by a rename that does not overwrite.  Readers
take the manifest with the highest number, so they see a whole version or the
one before, and one that is being read is not touched.  The rows are counted
by an observation of the write, not by another scan.
"""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def fingerprint(spark: SparkSession, *paths: str) -> str:
    """Names, sizes and times of all files under ``paths`` as one hash; a missing path counts as empty."""
    found = []
    for path in paths:
        fs, p = _fs(spark, path)
        if not fs.exists(p):
            continue
        files = fs.listFiles(p, True)
        while files.hasNext():
            f = files.next()
            found.append(f"{f.getPath().toString()}|{f.getLen()}|{f.getModificationTime()}")
    return hashlib.md5("\n".join(sorted(found)).encode()).hexdigest()


class VersionedTable:
    """The versions of one table under ``root``, a folder on shared storage."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def versions(self) -> list[int]:
        fs, p = _fs(self.spark, f"{self.root}/manifest")
        if not fs.exists(p):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(p)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def manifest(self, version: int | None = None) -> dict | None:
        """The manifest of a version, by default of the last one; None for a table that was never written."""
        known = self.versions()
        if not known:
            return None
        row = self.spark.read.text(f"{self.root}/manifest/{(known[-1] if version is None else version):08d}.json", wholetext=True).first()
        return json.loads(row[0])

    def read(self, version: int | None = None) -> DataFrame | None:
        entry = self.manifest(version)
        if entry is None:
            return None
        return self.spark.read.schema(T.StructType.fromJson(entry["schema"])).parquet(f"{self.root}/{entry['folder']}")

    def __len__(self) -> int:
        entry = self.manifest()
        return entry["rows"] if entry else 0

    def publish(self, df: DataFrame, inputs: str = "", partition_by: str | None = None) -> int:
        """Write ``df`` as the next version and switch to it; returns its number."""
        folder = f"data-{uuid.uuid4().hex}"
        counted = Observation()
        out = df.observe(counted, F.count(F.lit(1)).alias("rows"))
        w = out.write
        if partition_by:
            w = w.partitionBy(partition_by)
        w.parquet(f"{self.root}/{folder}")
        fields = [f for f in df.schema.fields if f.name != partition_by] + [f for f in df.schema.fields if f.name == partition_by]
        entry = {"folder": folder, "schema": T.StructType(fields).jsonValue(), "rows": counted.get["rows"], "inputs": inputs}
        fs, draft = _fs(self.spark, f"{self.root}/draft-{folder}.json")
        stream = fs.create(draft, False)
        stream.write(bytearray(json.dumps(entry).encode()))
        stream.close()
        fs.mkdirs(_fs(self.spark, f"{self.root}/manifest")[1])
        while True:  # another writer may have taken the number
            version = max(self.versions(), default=0) + 1
            target = _fs(self.spark, f"{self.root}/manifest/{version:08d}.json")[1]
            if not fs.exists(target) and fs.rename(draft, target):
                return version

    def current(self, inputs: str, build, partition_by: str | None = None) -> DataFrame:
        """The last version if it was built from the same ``inputs``, else a new one from ``build()``."""
        entry = self.manifest()
        if entry is None or entry["inputs"] != inputs:
            self.publish(build(), inputs, partition_by)
        return self.read()

    def forget(self, keep: int = 2) -> list[int]:
        """Remove all but the last ``keep`` versions, manifests first; returns the numbers removed."""
        gone = self.versions()[:-keep] if keep else self.versions()
        for version in gone:
            entry = self.manifest(version)
            fs, p = _fs(self.spark, f"{self.root}/manifest/{version:08d}.json")
            fs.delete(p, False)
            fs.delete(_fs(self.spark, f"{self.root}/{entry['folder']}")[1], True)
        return gone
