"""A knowledge base on shared storage that is upserted bucket by bucket.

Rows lie in buckets by a hash of their key, each bucket in the folder of the round that wrote it last.  A manifest per
round names the folder of every bucket.  A round rewrites only the buckets that incoming rows touch, into a folder of its
own, and then writes its manifest; a manifest counts once its `_SUCCESS` marker is there.  A round that fails leaves
files that no manifest names, and two rounds at a time cannot both write the next manifest.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .kb import upsert

BUCKETS = 64
_MANIFEST = "bucket int, folder string"


class KbStore:
    """Rows of one schema, one per key, under `path`."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, key: str = "id", version: str = "version", buckets: int = BUCKETS):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.key, self.version, self.buckets = key, version, buckets

    def _fs(self):
        jvm = self.spark._jvm
        return jvm.org.apache.hadoop.fs.Path(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path

    def rounds(self) -> list[int]:
        """Numbers of the rounds that are complete, ascending."""
        fs, path = self._fs()
        root = path(f"{self.path}/manifests")
        if not fs.exists(root):
            return []
        names = [status.getPath().getName() for status in fs.listStatus(root)]
        return sorted(int(n) for n in names if n.isdigit() and fs.exists(path(f"{self.path}/manifests/{n}/_SUCCESS")))

    def manifest(self) -> dict[int, str]:
        """Folder of every bucket that holds rows; at most `buckets` lines."""
        done = self.rounds()
        if not done:
            return {}
        lines = self.spark.read.schema(_MANIFEST).json(f"{self.path}/manifests/{done[-1]}").collect()
        return {line["bucket"]: line["folder"] for line in lines}

    def _rows(self, folders: dict[int, str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        files = [f"{self.path}/data/{folder}/bucket={bucket}" for bucket, folder in sorted(folders.items())]
        return self.spark.read.schema(self.schema).parquet(*files)

    def read(self) -> DataFrame:
        return self._rows(self.manifest())

    def upsert(self, incoming: DataFrame) -> int:
        """Put rows in, the highest version per key winning (of equal ones the incoming); gives the number of the round.

        Rows without a key share one, NULL.  Without incoming rows there is no round.
        """
        fs, path = self._fs()
        placed = incoming.select(*self.schema.names).withColumn("bucket", F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int"))
        touched = [r["bucket"] for r in placed.select("bucket").distinct().collect()]  # at most `buckets`
        done, folders = self.rounds(), self.manifest()
        if not touched:
            return done[-1] if done else 0
        number = done[-1] + 1 if done else 1
        current = self._rows({b: f for b, f in folders.items() if b in touched})
        merged = upsert(current, incoming.select(*self.schema.names), self.key, self.version)
        bucket = F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")
        # The folder of a round that failed is not used again.
        data, tries = path(f"{self.path}/data"), 0
        taken = {s.getPath().getName() for s in fs.listStatus(data)} if fs.exists(data) else set()
        while f"{number}-{tries}" in taken:
            tries += 1
        folder = f"{number}-{tries}"
        merged.withColumn("bucket", bucket).repartition(self.buckets, "bucket").write.partitionBy("bucket").parquet(f"{self.path}/data/{folder}")
        lines = sorted({**folders, **{b: folder for b in touched}}.items())
        named = self.spark.createDataFrame(lines, StructType.fromDDL(_MANIFEST))
        target = f"{self.path}/manifests/{number}"
        # A manifest without its marker is left over from a round that failed.
        unfinished = fs.exists(path(target)) and not fs.exists(path(f"{target}/_SUCCESS"))
        named.coalesce(1).write.mode("overwrite" if unfinished else "errorifexists").json(target)
        return number
