"""Keyed, idempotent writes: merging rows, commands as JSON and their routing."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

#: Key columns of each target table.
KEYS = {
    "object": ["oid"], "detection": ["candid", "oid"], "forced_photometry": ["pid", "oid"], "non_detection": ["oid", "fid", "mjd"], "magstats": ["oid", "fid"], "feature": ["oid", "name", "fid", "version"],
    "probability": ["oid", "class_name", "classifier_name", "classifier_version"], "xmatch": ["oid", "catid"], "score": ["oid", "detector_name", "detector_version", "category_name"], "reference": ["oid", "rfid"],
}


def last_write_wins(cmds: DataFrame, keys: list[str], order: str) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.col(order).desc())
    return cmds.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")


def one_a_key(df: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """One row of each key: the last in ``order``; without it, or where it ties, the greatest of the other columns."""
    rest = [c for c in df.columns if c not in keys and c != order and df.schema[c].dataType.typeName() not in ("map", "variant")]
    by = [F.col(c).desc_nulls_last() for c in ([order] if order else []) + rest]
    w = Window.partitionBy(*keys).orderBy(*(by or [F.lit(0)]))
    return df.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")


def upsert(target: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """New rows replace stored ones of the same key; of new rows with one key the greatest counts."""
    new = one_a_key(new, keys)
    return target.join(new.select(*keys), keys, "left_anti").unionByName(new, allowMissingColumns=True)


def insert_ignore(target: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is stored already are ignored."""
    return target.unionByName(one_a_key(new, keys).join(target.select(*keys), keys, "left_anti"), allowMissingColumns=True)


def update_columns(target: DataFrame, new: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Set only ``columns``, and only where the new value is not null; unknown keys are ignored."""
    side = one_a_key(new.select(*keys, *columns), keys).select(*keys, *(F.col(c).alias(f"__{c}") for c in columns))
    return target.join(side, keys, "left").withColumns({c: F.coalesce(f"__{c}", c) for c in columns}).select(*target.columns)


def command_rows(df: DataFrame, collection: str, kind: str, criteria: list[str], data: list[str], **options) -> DataFrame:
    """JSON commands: {collection, type, criteria, data, options}."""
    opts = F.struct(*(F.lit(v).alias(k) for k, v in options.items())) if options else F.lit(None).cast("string")
    body = F.struct(F.lit(collection).alias("collection"), F.lit(kind).alias("type"), F.struct(*criteria).alias("criteria"), F.struct(*data).alias("data"), opts.alias("options"))
    return df.select(F.to_json(body).alias("payload"))


COMMAND = "collection string, type string, criteria map<string,string>, data map<string,string>, options struct<upsert: boolean, set_on_insert: boolean>"


def parse_commands(df: DataFrame) -> DataFrame:
    """Parsed commands with ``kind`` and ``valid``; a command needs type, data and collection."""
    c = df.withColumn("cmd", F.from_json("payload", COMMAND))
    valid = F.col("cmd.type").isNotNull() & F.col("cmd.data").isNotNull() & F.col("cmd.collection").isNotNull() & kind_of().isNotNull()
    return c.withColumn("kind", kind_of()).withColumn("valid", F.coalesce(valid, F.lit(False)))


def kind_of() -> Column:
    """Command kind by type and collection; null where unknown."""
    t, c = F.col("cmd.type"), F.col("cmd.collection")
    return (
        F.when((t == "insert") & (c == "object"), "insert_object").when((t == "insert") & (c == "detection"), "upsert_detections").when((t == "update") & (c == "detection"), "upsert_detections")
        .when((t == "update") & (c == "forced_photometry"), "upsert_forced").when((t == "update") & (c == "non_detection"), "upsert_non_detections").when((t == "update_features"), "upsert_features")
        .when((t == "update_probabilities"), "upsert_probabilities").when((t == "update") & (c == "object") & F.col("cmd.data").getItem("xmatch").isNotNull(), "upsert_xmatch")
        .when((t == "upsert") & (c == "magstats"), "upsert_object_stats").when((t == "update") & (c == "object"), "update_object_from_stats").when((t == "insert") & (c == "score"), "upsert_score")
    )


class KeyedTable:
    """A Parquet table in ``buckets`` partitions by a hash of ``by`` (the keys, or some of them).

    A merge reads and rewrites only the partitions that its rows fall in. They are written to a folder of their own;
    then a manifest, which names the folder of each partition, is put in place by one rename. A merge stopped before
    that leaves the table as it was, and its folder is never read. The manifest before the last stays, with its folders, for
    readers under way; older ones go. One writer at a time. ``schema`` is that of a table never written.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], by: list[str] | None = None, buckets: int = 64, schema: StructType | str | None = None):
        self.spark, self.path, self.keys, self.by, self.buckets = spark, path.rstrip("/"), keys, by or keys, buckets
        self.schema = spark.createDataFrame([], schema).schema if schema else None

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.by), F.lit(self.buckets)).cast("int")

    def touched(self, rows: DataFrame) -> list[int]:
        """The partitions that rows with the columns ``by`` fall in; at most ``buckets``."""
        return sorted(r["b"] for r in rows.select(self._bucket().alias("b")).distinct().collect())

    # --- manifests

    def _files(self):
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        at = lambda name="": hadoop.Path(f"{self.path}/{name}" if name else self.path)
        return at, at().getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _versions(self) -> list[int]:
        at, files = self._files()
        if not files.exists(at()):
            return []
        names = [x.getPath().getName() for x in files.listStatus(at())]
        return sorted(int(n.removeprefix("manifest-")) for n in names if n.startswith("manifest-") and n[9:].isdigit())

    def _manifest(self, version: int) -> dict:
        at, files = self._files()
        stream = files.open(at(f"manifest-{version}"))
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _current(self) -> dict:
        versions = self._versions()
        return self._manifest(versions[-1]) if versions else {"schema": None, "folders": {}}

    def _commit(self, schema: StructType, folders: dict[str, str]) -> None:
        at, files = self._files()
        versions = self._versions()
        new = (versions[-1] if versions else 0) + 1
        beside = f".{uuid.uuid4().hex}"
        stream = files.create(at(beside))
        stream.write(bytearray(json.dumps({"schema": schema.jsonValue(), "folders": folders}).encode()))
        stream.close()
        if not files.rename(at(beside), at(f"manifest-{new}")):
            raise RuntimeError(f"{self.path}: manifest {new} exists; is there a second writer?")
        kept = {f"{v}/bucket={b}" for m in [{"folders": folders}, *(self._manifest(x) for x in versions[-1:])] for b, v in m["folders"].items()}
        for old in versions[:-1]:
            for b, v in self._manifest(old)["folders"].items():
                if f"{v}/bucket={b}" not in kept:
                    files.delete(at(f"{v}/bucket={b}"), True)
            files.delete(at(f"manifest-{old}"), False)

    def stored_schema(self) -> StructType | None:
        m = self._current()
        return StructType.fromJson(m["schema"]) if m["schema"] else self.schema

    # --- rows

    def read(self, like: DataFrame | None = None, only: list[int] | None = None) -> DataFrame | None:
        """The table, or only the partitions that rows ``like`` these (with the columns ``by``) fall in, or those named;
        before the first merge an empty table of ``schema``, or null without one."""
        m = self._current()
        only = self.touched(like) if like is not None else only
        schema = self.stored_schema()
        paths = [f"{self.path}/{v}/bucket={b}" for b, v in m["folders"].items() if only is None or int(b) in only]
        if schema is None:
            return None
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def replace(self, rows: DataFrame, touched: list[int]) -> None:
        """Put ``rows``, which are all rows of the partitions ``touched``, in their place."""
        if not touched:
            return
        m, folder = self._current(), f"v-{uuid.uuid4().hex}"
        schema = StructType([StructField(f.name, f.dataType) for f in rows.schema])  # nullable, as files are
        rows.withColumn("bucket", self._bucket()).repartition("bucket").write.partitionBy("bucket").parquet(f"{self.path}/{folder}")
        at, files = self._files()
        written = [b for b in touched if files.exists(at(f"{folder}/bucket={b}"))]
        folders = {b: v for b, v in m["folders"].items() if int(b) not in touched} | {str(b): folder for b in written}
        self._commit(schema, folders)

    def merge(self, new: DataFrame, mode: str = "upsert", order: str | None = None) -> None:
        new = one_a_key(new, self.keys, order)
        touched = self.touched(new)
        old = self.read(only=touched)
        if old is not None:
            new = (upsert if mode == "upsert" else insert_ignore)(old, new, self.keys)
        self.replace(new, touched)
