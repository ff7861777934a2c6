"""Source files of any size as chunks of bytes, and the raw zone that keeps them under their content's hash.

A file is read once, by executors, and becomes rows ``(source_path, chunk_no, bytes)``. Files up to ``CHUNK_BYTES`` are
one chunk each, read whole. Larger ones are read as lines, split over tasks, and put together again into chunks: a line
belongs to the chunk that its first byte falls into (``floor(offset / CHUNK_BYTES)``), so the cut does not depend on how
the file was split for reading, and every chunk starts at a line's start. The pieces are checked to add up to the file's
length, byte for byte (a last line without a line feed and a byte-order mark are put back as they were).

A file's hash is the SHA-256 of its bytes if it is one chunk, and else the SHA-256 of its chunks' hashes in order. The
raw zone holds each content once, whatever the names it came under, and nothing in it is ever overwritten:

    raw/<dataset>/_batch_seq=<n>/_attempt=<k>/   content_sha, chunk_no, n_chunks, chunk_sha, bytes
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.hashing import content_sha
from .files import FILE_NAME, FILE_PATH, _file_name

CHUNK_BYTES = 8 * 1024 * 1024
_READ_OPTIONS = {"ignoreMissingFiles": "true", "ignoreCorruptFiles": "true"}


# ---- what is there


def list_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """One row per requested path: ``requested, source_path, source_file, length, modified_at`` (NULL length: not there).

    The requested names of a folder are looked up as alternatives of one pattern, ``NAMES_AT_ONCE`` at a time, without
    reading any content, and left-joined to the request: an absent file, or a whole absent folder, is a row and not an
    error. A path with a wildcard stands for the files it matches. Empty files are not listed by Spark and count as
    absent.
    """
    globs = [p for p in paths if any(c in p for c in "*?[{")]
    plain = sorted(set(paths) - set(globs))
    asked = []
    roots: dict[str, str] = {}
    for p in plain:
        folder, _, name = p.rstrip("/").rpartition("/")
        if folder not in roots:
            roots[folder] = _qualified(spark, folder or ".").rstrip("/")
        asked.append((p, f"{roots[folder]}/{name}"))
    columns = [F.col("path").alias(FILE_PATH), F.col("length"), F.col("modificationTime").alias("modified_at")]

    def listing(where: list[str]) -> DataFrame:
        return spark.read.format("binaryFile").options(**_READ_OPTIONS).load(where).select(*columns)

    there = _patterns(spark, [full for _, full in asked])
    none = spark.createDataFrame([], f"{FILE_PATH} string, length bigint, modified_at timestamp")
    wanted = spark.createDataFrame(asked, f"requested string, {FILE_PATH} string")
    found = wanted.join(listing(there) if there else none, FILE_PATH, "left")
    for g in globs:
        rows = listing([g]).withColumn("requested", F.lit(g)) if _matches(spark, g) else spark.createDataFrame(
            [(g, None, None, g)], f"{FILE_PATH} string, length bigint, modified_at timestamp, requested string")
        found = found.unionByName(rows)
    return found.select("requested", FILE_PATH, _file_name(F.col(FILE_PATH)).alias(FILE_NAME), "length", "modified_at")


NAMES_AT_ONCE = 500


def _patterns(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """Patterns that match the files that exist among ``paths``; none of them matches nothing."""
    folders: dict[str, list[str]] = {}
    for p in paths:
        folder, _, name = p.rpartition("/")
        folders.setdefault(folder, []).append(name)
    found = []
    for folder, names in folders.items():
        for i in range(0, len(names), NAMES_AT_ONCE):
            some = _escaped(names[i:i + NAMES_AT_ONCE])
            found.append(f"{_escaped([folder])[0]}/" + (some[0] if len(some) == 1 else f"{{{','.join(some)}}}"))
    return [p for p in found if _matches(spark, p)]


def _qualified(spark: SparkSession, folder: str) -> str:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(at).toString()


def _matches(spark: SparkSession, pattern: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(at)
    return found is not None and len(found) > 0


# ---- chunks


def _whole(spark: SparkSession, paths: Sequence[str], chunk_bytes: int) -> DataFrame:
    raw = spark.read.format("binaryFile").options(**_READ_OPTIONS).load(list(paths)).filter(F.col("length") <= chunk_bytes)
    return raw.select(F.col("path").alias(FILE_PATH), F.lit(0).cast("bigint").alias("chunk_no"), F.col("content").alias("bytes"))


def _in_lines(spark: SparkSession, paths: Sequence[str], chunk_bytes: int) -> DataFrame:
    text = spark.read.options(**_READ_OPTIONS).option("lineSep", "\n").text(list(paths))
    # the metadata path is URL-encoded, the listing's is not; a plus sign stands for itself
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    lines = text.select(path.alias(FILE_PATH), F.col("_metadata.file_block_start").alias("_blk"), F.col("_metadata.file_size").alias("_size"),
                        F.monotonically_increasing_id().alias("_id"), F.col("value").alias("_line"),
                        (F.octet_length("value") + 1).cast("bigint").alias("_n"))
    # a split's first line starts where the lines of the splits before it end
    per_split = lines.groupBy(FILE_PATH, "_blk").agg(F.sum("_n").alias("_split"), F.max("_size").alias("_size"))
    whole = Window.partitionBy(FILE_PATH)
    starts = per_split.select(FILE_PATH, "_blk", (F.sum("_split").over(whole.orderBy("_blk")) - F.col("_split")).alias("_from"),
                              (F.col("_size") - F.sum("_split").over(whole)).alias("_off"))
    at = F.sum("_n").over(Window.partitionBy(FILE_PATH, "_blk").orderBy("_id")) - F.col("_n")
    placed = (lines.withColumn("_at", at).join(starts, [FILE_PATH, "_blk"])
              .select(FILE_PATH, "_off", "_line", (F.col("_from") + F.col("_at")).alias("_at")))
    chunks = (placed.withColumn("chunk_no", F.floor(F.col("_at") / chunk_bytes))
              .groupBy(FILE_PATH, "chunk_no")
              .agg(F.array_sort(F.collect_list(F.struct("_at", "_line"))).alias("_lines"), F.max("_off").alias("_off")))
    # what the lines leave of the file's length: no line feed at the end (-1), a byte-order mark that reading took off (+3)
    last = F.col("chunk_no") == F.max("chunk_no").over(Window.partitionBy(FILE_PATH))
    no_end, mark = F.col("_off").isin(-1, 2), F.col("_off").isin(2, 3)
    joined = F.array_join(F.transform("_lines", lambda x: x["_line"]), "\n")
    body = F.concat(F.when(mark & (F.col("chunk_no") == 0), F.lit("\ufeff")).otherwise(F.lit("")), joined,
                    F.when(last & no_end, F.lit("")).otherwise(F.lit("\n")))
    # any other remainder is no plain file of lines (compressed, or changed while it was read)
    return chunks.select(FILE_PATH, "chunk_no", body.cast("binary").alias("bytes"),
                         F.col("_off").isin(-1, 0, 2, 3).alias("_sound")).filter("_sound").drop("_sound")


def read_chunks(spark: SparkSession, present: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``source_path, chunk_no, bytes`` of listed files; one that cannot be read (or vanished) has no rows."""
    sizes = present.filter(F.col("length").isNotNull()).select(FILE_PATH, (F.col("length") <= chunk_bytes).alias("small")).distinct()
    # the driver hands the paths to Spark's readers, which hold every file's status there anyway
    found = sizes.collect()
    small, large = [r[0] for r in found if r["small"]], [r[0] for r in found if not r["small"]]
    # looked up once more: a file that has vanished since it was listed is no error
    small, large = _patterns(spark, small), _patterns(spark, large)
    out = spark.createDataFrame([], f"{FILE_PATH} string, chunk_no bigint, bytes binary")
    if small:
        out = _whole(spark, small, chunk_bytes)
    if large:
        lines = _in_lines(spark, large, chunk_bytes)
        out = out.unionByName(lines) if small else lines
    return out


def _escaped(paths: Sequence[str]) -> list[str]:
    """Paths whose own wildcard characters are taken as they are."""
    return ["".join(f"\\{c}" if c in "*?[]{},\\" else c for c in p) for p in paths]


def tree_hash(shas: Column) -> Column:
    """A content's hash from its chunks' hashes in order."""
    return F.when(F.size(shas) == 1, shas[0]).otherwise(F.sha2(F.array_join(shas, "").cast("binary"), 256))


def _ordered(column: str) -> Column:
    return F.transform(F.array_sort(F.collect_list(F.struct("chunk_no", column))), lambda x: x[column])


def fingerprints(chunks: DataFrame) -> DataFrame:
    """``source_path, content_sha, n_chunks, n_bytes, valid_text``: one row per file, its bytes not among them."""
    each = chunks.select(FILE_PATH, "chunk_no", content_sha(F.col("bytes")).alias("_sha"), F.octet_length("bytes").alias("_n"),
                         F.is_valid_utf8(F.col("bytes").cast("string")).alias("_valid"))
    return each.groupBy(FILE_PATH).agg(tree_hash(_ordered("_sha")).alias("content_sha"), F.count(F.lit(1)).alias("n_chunks"),
                                       F.sum("_n").alias("n_bytes"), F.min("_valid").alias("valid_text"))


# ---- the zone


def rows_to_keep(chunks: DataFrame, new: DataFrame) -> DataFrame:
    """Raw zone rows of the contents in ``new`` (``source_path, content_sha, n_chunks``; one path per content)."""
    return chunks.join(new, FILE_PATH).select("content_sha", "chunk_no", "n_chunks", content_sha(F.col("bytes")).alias("chunk_sha"), "bytes")


def stored_contents(zone: DataFrame) -> DataFrame:
    """Where each content is: ``content_sha, _batch_seq, _attempt`` (two writers at once may both have kept it: the first)."""
    return (zone.groupBy("content_sha").agg(F.min(F.struct("_batch_seq", "_attempt")).alias("_w"))
                .select("content_sha", "_w._batch_seq", "_w._attempt"))


def damaged(zone: DataFrame) -> DataFrame:
    """Contents of the zone whose bytes do not give their hash any more (changed or missing chunks)."""
    each = zone.select("content_sha", "_batch_seq", "_attempt", "chunk_no", "n_chunks", F.sha2("bytes", 256).alias("_sha"))
    held = each.groupBy("content_sha", "_batch_seq", "_attempt").agg(tree_hash(_ordered("_sha")).alias("_found"), F.count(F.lit(1)).alias("_n"),
                                                                    F.max("n_chunks").alias("_wanted"))
    return held.filter((F.col("_found") != F.col("content_sha")) | (F.col("_n") != F.col("_wanted"))).select("content_sha")


def document_texts(chunks: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Files as one text each (a JSON document is parsed whole): ``keep`` columns and ``text``."""
    text = chunks.select(*keep, "n_chunks", "chunk_no", F.col("bytes").cast("string").alias("text"))
    small = text.filter(F.col("n_chunks") == 1).select(*keep, "text")
    large = text.filter(F.col("n_chunks") > 1).groupBy(*keep).agg(F.array_join(_ordered("text"), "").alias("text"))
    return small.unionByName(large).withColumn("text", F.regexp_replace("text", "^\ufeff", ""))
