"""Small helpers that the operators share: column picking, bounded labelled samples, span digests."""

from __future__ import annotations

import hashlib
import os
import tempfile
import zipfile
from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ship_code(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once per Spark context (wherever the driver imported it from)."""
    sc = spark.sparkContext
    if getattr(sc, "_gridledger_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    # the driver's own copy, which Spark serves to executors while the session lasts and the process removes at its end
    folder = tempfile.TemporaryDirectory(prefix="gridledger-code-")
    path = os.path.join(folder.name, "gridledger_package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for at, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(at, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    sc.addPyFile(path)
    sc._gridledger_code = folder
    sc._gridledger_shipped = True


def id_text(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone: other columns, whatever their names, stay out of an operator's way."""
    ship_code(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def crc_bucket(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus`` (NULL ids give NULL)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """True where the fold of the id is ``remainder``; NULL ids are never held out."""
    return F.coalesce(crc_bucket(doc_id, modulus) == remainder, F.lit(False))


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read from there."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Else the shuffle files of a finished write stay on the executors' disks until the driver happens to collect its garbage.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table of its own in the shared folder, so that later reads take only the columns they need.

    The write's shuffle files are deleted when it is done.
    """
    return written_parts([df], label)


def written_parts(parts: Iterable[DataFrame], label: str) -> DataFrame:
    """The rows of frames of one schema as one table, as ``written``; each is written, and its shuffle files go, before the next."""
    path = schema = None
    for df in parts:
        spark = df.sparkSession
        path, schema = path or scratch_path(spark, label), schema or df.schema
        before = spark.conf.get(FREE_SHUFFLES, None)
        spark.conf.set(FREE_SHUFFLES, "true")
        try:
            df.write.mode("append").parquet(path)
        finally:
            spark.conf.unset(FREE_SHUFFLES) if before is None else spark.conf.set(FREE_SHUFFLES, before)
    out = spark.read.schema(schema).parquet(path)
    out._written_to = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete the tables of ``written`` frames that nothing will read any more (others are left alone)."""
    for frame in frames:
        path = getattr(frame, "_written_to", None)
        if path is not None:
            sc = frame.sparkSession.sparkContext
            at = sc._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)


def labelled_sample(docs: DataFrame, labels: DataFrame, max_rows: int) -> DataFrame:
    """At most ``max_rows`` labelled documents, chosen by a hash of the id (the documented bound of a classifier's fit).

    The ids are chosen first, from the narrow label table; text is read only for those. Labels that disagree on one id
    are reduced to the largest value of each column; rows with a NULL id are left out.
    """
    value_columns = [c for c in labels.columns if c != "doc_id"]
    wanted = (labels.where(F.col("doc_id").isNotNull())
              .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
              .agg(*[F.max(c).alias(c) for c in value_columns])
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows))
    # the wanted side has max_rows narrow rows at most: a proven bound
    texts = id_text(docs).join(F.broadcast(wanted), "doc_id")
    return texts.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *value_columns)


def sample_documents(docs: DataFrame, max_rows: int) -> DataFrame:
    """At most ``max_rows`` documents by a hash of the id: the documented, bounded sample of an unlabelled fit."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id")).where(F.col("doc_id").isNotNull())
    wanted = narrow.groupBy("doc_id").agg(F.lit(1)).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows).select("doc_id")
    return id_text(docs).join(F.broadcast(wanted), "doc_id")


def span_digest(spans: Iterable[tuple[str, int, int]], kinds: dict[str, int]) -> str:
    """``kind:start:end`` by start, then by the listed order of kinds, joined by commas."""
    ordered = sorted(spans, key=lambda s: (s[1], kinds[s[0]], s[2]))
    return ",".join(f"{k}:{a}:{b}" for k, a, b in ordered)


def sha256_hex(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def slices(n: int, size: int, overlap: int) -> Iterator[tuple[int, int]]:
    """Overlapping ranges of ``size`` that cover ``range(n)``; neighbours share ``overlap`` positions."""
    start = 0
    while start < n:
        yield start, min(n, start + size)
        if start + size >= n:
            return
        start += size - overlap
