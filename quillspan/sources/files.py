"""Reading and writing of the documents: JSON, CSV, text and payload files, manifests, and snapshots in one step."""

from __future__ import annotations

import hashlib
import json
import uuid
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import path_stem
from . import schemas

_CORRUPT = "_corrupt"


def read_documents(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """One row per JSON document, with file (its name) and corrupt (the text of one that can't be read, else null)."""
    df = spark.read.schema(f"{schema}, {_CORRUPT} string").option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _CORRUPT).json(path)
    return df.withColumn("file", F.col("_metadata.file_name")).withColumnRenamed(_CORRUPT, "corrupt")


def readable(df: DataFrame) -> DataFrame:
    return df.where("corrupt is null").drop("corrupt")


def read_spec(spark: SparkSession, path: str) -> DataFrame:
    return readable(read_documents(spark, path, schemas.SPEC)).drop("file")


def read_epochs(spark: SparkSession, path: str) -> DataFrame:
    """Epoch specs epoch_<n>.json under a folder, by number."""
    df = readable(read_documents(spark, f"{path}/epoch_*.json", schemas.SPEC))
    n = F.regexp_extract("file", r"^epoch_(\d+)\.json$", 1).try_cast("int")
    return df.withColumn("epoch", F.coalesce("epoch", n)).drop("file").orderBy("epoch")


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """Results <key>.result.json under a folder; unreadable ones and tests are passed over. The key is the file's name."""
    df = readable(read_documents(spark, f"{path}/*.result.json", schemas.RESULT))
    return df.withColumn("key", F.regexp_replace("file", r"\.result\.json$", "")).where("mode is distinct from 'test'").drop("file")


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    df = readable(read_documents(spark, f"{path}/batch-*.json", schemas.BATCH))
    return df.withColumn("batch_id", F.coalesce("batch_id", path_stem(F.col("file")))).drop("file")


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    df = readable(read_documents(spark, f"{path}/*.json", schemas.SHARD))
    return df.withColumn("worker", F.coalesce("worker", path_stem(F.col("file")))).drop("file")


def read_entries(spark: SparkSession, path: str) -> DataFrame:
    """Queue entries of a document {"schema": 3, "chunks": {key: entry}}; another schema marker gives no entries."""
    fields = schemas.ENTRY.removeprefix("key string, ").replace(" ", ":").replace(",:", ",")
    df = readable(read_documents(spark, path, f"schema int, chunks map<string,struct<{fields}>>"))
    return df.where("schema = 3").select(F.explode("chunks").alias("key", "e")).select("key", "e.*")


def read_plan(spark: SparkSession, path: str) -> DataFrame:
    """pid, tier, priority, ordinal0, candidates, items of a plan document."""
    return readable(read_documents(spark, path, schemas.PLAN)).select(F.explode("packages").alias("p")).select("p.*")


def read_coverage(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The pids that are done, and pid, through, dirty of partial ones. Both forms of partial are read: a number, or an object."""
    df = readable(read_documents(spark, path, "done array<string>, partial map<string,string>"))
    done = df.select(F.explode("done").alias("pid"))
    p = df.select(F.explode("partial").alias("pid", "v"))
    rec = F.from_json("v", "through bigint, dirty array<array<bigint>>")
    plain = F.col("v").try_cast("long")
    return done, p.select("pid", F.coalesce(plain, rec["through"]).alias("through"), F.when(plain.isNull(), rec["dirty"]).alias("dirty"))


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """path, length, content and sha256 of files as they are."""
    return spark.read.format("binaryFile").load(path).select("path", "length", "content", F.sha2("content", 256).alias("sha256"))


def sha256_file(spark: SparkSession, path: str) -> str:
    return read_payloads(spark, path).select("sha256").first()[0]


def list_keys(spark: SparkSession, path: str, ending: str) -> DataFrame:
    """key of the files of a folder with an ending, from their names alone."""
    names = spark.read.format("binaryFile").option("pathGlobFilter", f"*{ending}").load(path).select(F.substring_index("path", "/", -1).alias("n"))
    return names.select(F.expr(f"substring(n, 1, length(n) - {len(ending)})").alias("key"))


def read_maps_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.MAPS_CSV).option("header", True).option("enforceSchema", True).csv(path)


def read_urls(spark: SparkSession, path: str) -> DataFrame:
    """The URLs of a document {"urls": [...]} or of a plain array."""
    text = spark.read.option("wholetext", True).text(path)
    listed = F.coalesce(F.from_json("value", "urls array<string>")["urls"], F.from_json("value", "array<string>"))
    return text.select(F.explode(listed).alias("url"))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """hash, name of lines 'hash  name'."""
    return spark.read.text(path).select(F.split("value", r"\s+", 2).alias("p")).where("size(p) = 2 and p[0] <> ''").select(F.col("p")[0].alias("hash"), F.col("p")[1].alias("name"))


def updated_manifest(old: DataFrame, new: DataFrame) -> DataFrame:
    """old with the entries of new put in or in place, by name."""
    return old.join(new.select("name", F.col("hash").alias("__h")), "name", "full").select(F.coalesce("__h", "hash").alias("hash"), "name").orderBy("name")


def write_manifest(df: DataFrame, path: str) -> None:
    df.orderBy("name").select(F.concat_ws("  ", "hash", "name").alias("value")).write.mode("overwrite").text(path)


def write_chunk_dump(candidates: DataFrame, path: str) -> None:
    """Lines 'ordinal map ts tier', by ordinal over the files."""
    ordered = candidates.repartitionByRange("ordinal").sortWithinPartitions("ordinal")
    ordered.select(F.concat_ws(" ", F.col("ordinal").cast("string"), "map_id", F.col("ts_ms").cast("string"), "tier").alias("value")).write.mode("overwrite").text(path)


def write_documents(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    w = df.write.mode("overwrite")
    (w.partitionBy(*partition_by) if partition_by else w).json(path)


def verification_report(verdicts: DataFrame) -> DataFrame:
    """One row: verified_count and the verdicts. verdicts: url and the fields of a verdict, for the few found URLs."""
    ok = F.coalesce(F.col("zip_ok") & F.col("zip_crc_ok") & ~F.col("html_rejected"), F.lit(False))
    return verdicts.agg(F.count_if(ok).alias("verified_count"), F.array_sort(F.collect_list(F.struct("url", *[c for c in verdicts.columns if c != "url"]))).alias("results"))


def canonical_json(document: Any) -> str:
    """Compact JSON with sorted keys; keys that begin with _ are left out, at any depth."""

    def clean(x: Any) -> Any:
        if isinstance(x, dict):
            return {k: clean(v) for k, v in x.items() if not str(k).startswith("_")}
        return [clean(v) for v in x] if isinstance(x, (list, tuple)) else x

    return json.dumps(clean(document), sort_keys=True, separators=(",", ":"))


def canonical_hash(document: Any) -> str:
    """Equal documents have equal hashes; what only tells when one was made (created_utc) doesn't count."""
    if isinstance(document, dict):
        document = {k: v for k, v in document.items() if k != "created_utc"}
    return hashlib.sha256(canonical_json(document).encode()).hexdigest()


def write_epoch_file(spark: SparkSession, path: str, document: Any) -> str:
    """Writes an epoch's specification, indented by one and with a newline at its end; the hash of its bytes."""
    data = (json.dumps(document, indent=1) + "\n").encode()
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = at.getFileSystem(spark._jsc.hadoopConfiguration()).create(at, True)
    try:
        stream.write(data)
    finally:
        stream.close()
    return hashlib.sha256(data).hexdigest()


def load_json(spark: SparkSession, path: str, default: Any = None) -> Any:
    """A small document, or the default if it isn't there or can't be read."""
    try:
        rows = spark.read.option("wholetext", True).text(path).head(1)
        return json.loads(rows[0][0]) if rows else default
    except Exception:
        return default


class Snapshots:
    """Many tables that change in one step, in any store: each commit is a folder, and the newest with a marker counts.

    A commit names the tables it writes and those it drops; all others stay as they were. A commit that finds that
    another one came first is refused, so that its maker can read anew and try again.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _marker(self, version: int) -> str:
        return f"{self.root}/_commits/{version:012d}.json"

    def version(self) -> int:
        at = self._path(f"{self.root}/_commits")
        names = [f.getPath().getName() for f in self._fs.listStatus(at)] if self._fs.exists(at) else []
        return max((int(n[:12]) for n in names if n.endswith(".json") and n[:12].isdigit()), default=0)

    def tables(self, version: int | None = None) -> dict[str, str]:
        version = self.version() if version is None else version
        return self.load(version) if version else {}

    def load(self, version: int) -> dict[str, str]:
        stream = self._fs.open(self._path(self._marker(version)))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def read(self, name: str, version: int | None = None) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{self.tables(version)[name]}")

    def commit(self, tables: dict[str, DataFrame | None], expected: int | None = None) -> int:
        """Writes the tables (None drops one) as the version after `expected`; ValueError if that exists by now."""
        base = self.version() if expected is None else expected
        state, tag = dict(self.tables(base)), uuid.uuid4().hex
        for name, df in tables.items():
            if df is None:
                state.pop(name, None)
            else:
                state[name] = f"data/{name}-{tag}"
                df.write.parquet(f"{self.root}/{state[name]}")
        try:
            out = self._fs.create(self._path(self._marker(base + 1)), False)  # fails if another commit made it
        except Exception as e:
            raise ValueError(f"version {base + 1} exists: read anew and try again") from e
        try:
            out.write(json.dumps(state, sort_keys=True).encode())
        finally:
            out.close()
        return base + 1


def status_report(status: dict[str, Any]) -> str:
    """A status as a Markdown page of nested lists, keys in order."""
    lines = [f"# {status.get('title', 'Status')}", ""]

    def put(x: Any, depth: int) -> None:
        for k in sorted(x):
            v = x[k]
            if isinstance(v, dict):
                lines.append(f"{'  ' * depth}- **{k}**")
                put(v, depth + 1)
            else:
                lines.append(f"{'  ' * depth}- {k}: {v}")

    put({k: v for k, v in status.items() if k != "title"}, 0)
    return "\n".join(lines) + "\n"
