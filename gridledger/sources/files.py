"""File sources: headered CSV with per-file header checks, JSON documents, raw bytes.

All reads use explicit all-STRING schemas (never inference); typing happens
afterwards with ``try_cast`` so malformed values become quarantined rows,
not job failures.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import content_sha
from ..functions.rules import null_tokens_to_null
from ..operators.contracts import Contract, column_set_reason
from ..session import scratch_path

FILE_PATH = "source_path"
FILE_NAME = "source_file"
LINE_ORDER = "line_order"


def string_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def _file_name(path_col) -> F.Column:
    return F.regexp_extract(path_col, r"([^/]+)$", 1)


# Fixed value: a header of more fields than this is not taken for a header.
CSV_MAX_FIELDS = 20480


def csv_fields(line: Column, escape: str = '"') -> Column:
    """All fields of one CSV line, however many it has.

    A field that starts with a quote runs to the quote that closes it: separators in it are its own, a doubled quote
    is one quote; with ``escape="\\\\"`` (the dialect that Spark writes) a backslash before a quote or a backslash stands
    for the character after it too. A quote inside a field that does not start with one is a character like others.
    Lines without a quote (nearly all) are split at the separators alone.
    """
    if escape not in ('"', "\\"):
        raise ValueError("a quote is escaped by a quote or a backslash")

    def swap(x: Column, pairs: Sequence[tuple[str, str]]) -> Column:
        for a, b in pairs:
            x = F.replace(x, F.lit(a), F.lit(b))
        return x

    # escaped characters stand aside while quotes are counted; a mark character in the data is escaped itself
    marks = [] if escape == '"' else [("\x02", "\x02b"), ("\\\\", "\x02c"), ('\\"', "\x02d")]
    back = [("\x02d", '"'), ("\x02c", "\\"), ("\x02b", "\x02")] if marks else []

    def join(acc: Column, piece: Column) -> Column:
        cur = F.when(acc["open"], F.concat(acc["cur"], F.lit(","), piece)).otherwise(piece)
        quotes = F.length(cur) - F.length(F.replace(cur, F.lit('"'), F.lit("")))
        still = cur.startswith('"') & (quotes % 2 == 1)
        return F.struct(F.when(still, acc["fields"]).otherwise(F.concat(acc["fields"], F.array(cur))).alias("fields"),
                        still.alias("open"), F.when(still, cur).otherwise(F.lit("")).alias("cur"))

    start = F.struct(F.array().cast("array<string>").alias("fields"), F.lit(False).alias("open"), F.lit("").alias("cur"))
    joined = F.aggregate(F.split(swap(line, marks), ",", -1), start, join,
                         lambda acc: F.when(acc["open"], F.concat(acc["fields"], F.array(acc["cur"]))).otherwise(acc["fields"]))

    def bare(x: Column) -> Column:
        inner = F.when(x.endswith('"') & (F.length(x) > 1), F.substring(x, F.lit(2), F.length(x) - 2)).otherwise(F.substring(x, F.lit(2), F.length(x)))
        return swap(F.when(x.startswith('"'), F.replace(inner, F.lit('""'), F.lit('"'))).otherwise(x), back)

    return F.when(F.contains(line, F.lit('"')), F.transform(joined, bare)).otherwise(F.split(line, ",", -1))


def _header(fields: Column, contract: Contract) -> tuple[Column, Column]:
    """Column names by position and, for a header that the contract refuses, the reason."""
    names = F.transform(fields, lambda x: F.trim(F.regexp_replace(x, "^\ufeff", "")))
    known = F.filter(names, lambda x: x != "")
    error = F.when(F.size(fields) > CSV_MAX_FIELDS, F.lit(f"header of more than {CSV_MAX_FIELDS} fields")) \
             .otherwise(column_set_reason(known, contract))
    return names, error


def _by_name(fields: Column, header: Column, contract: Contract) -> list[Column]:
    """The contract's columns of a line, found by their position in the file's header; a short line's are NULL."""
    cols = []
    for c in list(contract.columns) + list(contract.optional):
        pos = F.array_position(header, c).cast("int")
        cols.append(null_tokens_to_null(F.when(pos > 0, F.get(fields, pos - 1))).alias(c))
    return cols


def scan_checked_csv(spark: SparkSession, paths: Sequence[str], contract: Contract,
                     escape: str = '"') -> tuple[DataFrame, DataFrame, DataFrame]:
    """Header-check and scan headered CSV files of any size and width: ``(rows, file_status, scan)``.

    Files are read as lines, so that a large one is split over tasks. Each file's header is its first line -- the
    ``min_by`` over scan order among rows of the file's first split, a map-side-combined aggregate -- and is
    checked against the contract (missing columns; extra ones when strict). Lines are parsed into as many fields as
    they have and mapped to contract columns *by header position*, so files may order their columns differently;
    rows of failing files are dropped, blank lines are skipped, a line that repeats its file's header word for word is
    no data either, and ``line_order`` orders a file's rows as its lines.

    The headers are written once to the shared folder, one row per file. A map of at most ``HEADER_MAP_FILES``
    headers goes along with the plan, so that no line is shuffled to meet its header; beyond that the headers are
    joined. ``scan`` is the frame of lines.
    """
    lines = (spark.read.option("lineSep", "\n").text(list(paths))
             .select(F.regexp_replace("value", "\r$", "").alias("_line"), F.col("_metadata.file_path").alias(FILE_PATH),
                     F.col("_metadata.file_block_start").alias("_blk"), F.monotonically_increasing_id().alias("_id")))
    first = lines.filter(F.col("_blk") == 0).groupBy(FILE_PATH).agg(F.min_by("_line", "_id").alias("_first"), F.min("_id").alias("_hid"))
    names, error = _header(csv_fields(F.col("_first"), escape), contract)
    path = scratch_path(spark, "csv-headers")
    first.select(FILE_PATH, names.alias("header"), error.alias("header_error"), F.col("_first").alias("header_line")).write.parquet(path)
    status = spark.read.parquet(path)
    good = status.filter(F.col("header_error").isNull()).select(FILE_PATH, "header", "header_line")
    body = _with_header(lines.filter(F.trim("_line") != ""), good).filter(F.col("_line") != F.col("header_line"))
    rows = (body.withColumn("_fields", csv_fields(F.col("_line"), escape))
                .select(*_by_name(F.col("_fields"), F.col("header"), contract), F.col(FILE_PATH),
                        _file_name(F.col(FILE_PATH)).alias(FILE_NAME),
                        F.struct(F.col("_blk").alias("block"), F.col("_id").alias("pos")).alias(LINE_ORDER)))
    return rows, status.drop("header_line"), lines


# Fixed value: most headers that a plan carries as literals.
HEADER_MAP_FILES = 1000


def _with_header(lines: DataFrame, headers: DataFrame) -> DataFrame:
    """``lines`` of the files in ``headers``, with the other columns of ``headers`` (arrays of text or text)."""
    names = [c for c in headers.columns if c != FILE_PATH]
    found = headers.limit(HEADER_MAP_FILES + 1).collect()
    if len(found) > HEADER_MAP_FILES:
        return lines.join(headers, FILE_PATH)
    # files of one batch mostly have the same header: one literal per distinct header
    by_header: dict[tuple, list[str]] = {}
    for r in found:
        by_header.setdefault(tuple(tuple(v) if isinstance(v, list) else v for v in (r[n] for n in names)), []).append(r[FILE_PATH])
    kinds = {f.name: f.dataType for f in headers.schema.fields}
    out = lines.filter(F.col(FILE_PATH).isin([p for ps in by_header.values() for p in ps]) if found else F.lit(False))
    for i, name in enumerate(names):
        value = F.lit(None).cast(kinds[name])
        for key, paths in by_header.items():
            literal = F.array(*[F.lit(v) for v in key[i]]) if isinstance(key[i], tuple) else F.lit(key[i])
            value = literal if len(by_header) == 1 else F.when(F.col(FILE_PATH).isin(paths), literal).otherwise(value)
        out = out.withColumn(name, value)
    return out


def scan_json(spark: SparkSession, paths: Sequence[str], schema: T.StructType,
              multiline: bool = True) -> DataFrame:
    """One JSON document per file (``multiLine``) or JSON lines, with a fixed schema.

    Fields missing from a document are NULL; unknown fields are ignored.
    """
    df = (spark.read.schema(schema).option("multiLine", multiline).option("mode", "PERMISSIVE")
               .json(list(paths)))
    return df.select("*", F.col("_metadata.file_path").alias(FILE_PATH),
                     _file_name(F.col("_metadata.file_path")).alias(FILE_NAME))


def explode_documents(df: DataFrame, array_col: str, parent_cols: Sequence[str],
                      position_col: str | None = None) -> DataFrame:
    """One row per array element, parent columns repeated; NULL or empty arrays give no rows.

    With ``position_col`` the element's index is kept (document order, used as
    the keep-last order of readings inside one file).
    """
    parents = list(parent_cols)
    if position_col:
        flat = df.select(*parents, F.posexplode(array_col).alias(position_col, "_elem"))
        return flat.select(*parents, position_col, "_elem.*")
    return df.select(*parents, F.explode(array_col).alias("_elem")).select(*parents, "_elem.*")


def read_snapshot(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, str]:
    """Read an exported JSON snapshot, tolerating a missing or corrupt file.

    Returns ``(rows, status)`` with status ``ok``, ``export_not_available``
    (missing) or ``export_corrupt`` (any record that does not parse: no part of
    such a snapshot is answered).
    """
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(jpath):
        return spark.createDataFrame([], schema), "export_not_available"
    with_corrupt = T.StructType(list(schema.fields) + [T.StructField("_corrupt_record", T.StringType(), True)])
    df = (spark.read.schema(with_corrupt).option("mode", "PERMISSIVE")
               .option("columnNameOfCorruptRecord", "_corrupt_record").json(path))
    good = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    # one aggregate decides the status; a parsed column is referenced alongside the
    # corrupt-record column because Spark refuses queries on that column alone
    stats = df.agg(F.count_if(F.col("_corrupt_record").isNull()).alias("good"),
                   F.count(F.lit(1)).alias("n"),
                   F.count(F.col(schema.fields[0].name)).alias("_parsed")).first()
    if stats["good"] < stats["n"]:
        return spark.createDataFrame([], schema), "export_corrupt"
    return good, "ok"


def oversized_files(spark: SparkSession, paths: Sequence[str], max_bytes: int) -> DataFrame:
    """Files above a document limit, listed without reading their content.

    ``binaryFile`` pushes the ``length`` filter down and reads no bytes when
    ``content`` is not selected.
    """
    df = spark.read.format("binaryFile").load(list(paths))
    return df.filter(F.col("length") > F.lit(int(max_bytes))).select(
        F.col("path").alias(FILE_PATH), _file_name(F.col("path")).alias(FILE_NAME), F.col("length"))


def read_raw(spark: SparkSession, paths: Sequence[str], max_bytes: int | None = None) -> DataFrame:
    """One row per file with its whole bytes, for small source documents.

    ``(source_path, source_file, content_sha, length, modified_at, content)``. Files above
    ``max_bytes`` (if given) are skipped without being read (see ``oversized_files``). Ingest lands
    files of any size in pieces: ``sources.raw_zone``.
    """
    df = spark.read.format("binaryFile").load(list(paths))
    if max_bytes is not None:
        df = df.filter(F.col("length") <= F.lit(int(max_bytes)))
    return df.select(F.col("path").alias(FILE_PATH), _file_name(F.col("path")).alias(FILE_NAME),
                     content_sha(F.col("content")).alias("content_sha"), F.col("length"),
                     F.col("modificationTime").alias("modified_at"), F.col("content"))


def content_text(col: str = "content") -> Column:
    """File bytes as text without a leading byte-order mark (bytes that are not UTF-8 stay as they are)."""
    return F.regexp_replace(F.col(col).cast("string"), "^\ufeff", "")


def csv_from_content(raw: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    """Parse headered CSV documents held whole as bytes: ``(rows, file_status)``; see ``csv_from_chunks``."""
    whole = raw.withColumn("chunk_no", F.lit(0).cast("bigint")).withColumn("n_chunks", F.lit(1).cast("bigint"))
    return csv_from_chunks(whole.withColumnRenamed("content", "bytes"), contract, any_large=False)


def csv_from_chunks(chunks: DataFrame, contract: Contract, any_large: bool = True) -> tuple[DataFrame, DataFrame]:
    """Parse headered CSV documents held as chunks that start at line starts: ``(rows, file_status)``.

    The first line of a file's first chunk is its header, checked against the contract; a failing file yields no
    rows and a ``header_error``. A file of one chunk finds its header in its own row; the chunks of larger files get
    it through ``_with_header``, so no chunk is shuffled. Data lines are parsed into as many fields as they have and
    mapped by header position. ``line_order`` ascends with the lines of a file; in a file of one chunk it is the line
    number. Blank lines are skipped; quoted fields spanning lines are not supported (the source format has none).
    ``any_large=False`` tells that every file is one chunk.
    """
    extra = [c for c in ("_file_order",) if c in chunks.columns]
    text = content_text("bytes")
    first_line = F.regexp_replace(F.substring_index(text, "\n", 1), "\r$", "")
    names, error = _header(csv_fields(first_line), contract)
    headed = chunks.filter(F.col("chunk_no") == 0)
    file_status = headed.select(FILE_PATH, names.alias("header"), error.alias("header_error"))
    keep = [FILE_PATH, FILE_NAME, *extra, "chunk_no", "bytes"]
    single = (chunks.filter(F.col("n_chunks") == 1).select(*keep, names.alias("header"), error.alias("_error"))
                    .filter(F.col("_error").isNull()).drop("_error"))
    pieces = single
    if any_large:
        large = (headed.filter(F.col("n_chunks") > 1).select(FILE_PATH, names.alias("header"), error.alias("header_error"))
                       .filter(F.col("header_error").isNull()).drop("header_error"))
        split = _with_header(chunks.filter(F.col("n_chunks") > 1).select(*keep), large)
        pieces = single.unionByName(split.select(*single.columns))
    lines = F.split(text, "\r?\n", -1)
    body = (pieces.select(FILE_PATH, FILE_NAME, *extra, "header", "chunk_no", F.posexplode(lines).alias("_pos", "_line"))
                  .filter(((F.col("_pos") > 0) | (F.col("chunk_no") > 0)) & (F.trim(F.col("_line")) != "")))
    order = F.shiftleft(F.col("chunk_no").cast("bigint"), 32) + F.col("_pos") + 1
    rows = body.withColumn("_fields", csv_fields(F.col("_line"))).select(
        *_by_name(F.col("_fields"), F.col("header"), contract), FILE_PATH, FILE_NAME, *extra, order.cast("bigint").alias(LINE_ORDER))
    return rows, file_status


CORRUPT = "_corrupt_document"


def json_documents(raw: DataFrame, schema: T.StructType, text: Column | None = None) -> DataFrame:
    """Parse one JSON document per row: its path, name, order, ``_doc`` and, where it does not parse, its text.

    A document is malformed (``_corrupt_document`` holds its text) if it is not one JSON object, is cut short or
    empty, or has a value that the schema's type cannot hold, such as text where an array of readings belongs.
    Missing fields are NULL, unknown fields ignored.
    """
    text = content_text() if text is None else text
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType(), True)])
    doc = F.from_json(text, with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    keep = [c for c in (FILE_PATH, FILE_NAME, "_file_order") if c in raw.columns]
    parsed = raw.select(*keep, text.alias("_text"), doc.alias("_doc"))
    corrupt = F.when(F.col("_doc").isNull() | F.col(f"_doc.{CORRUPT}").isNotNull(), F.coalesce(F.col("_text"), F.lit("")))
    return parsed.select(*keep, F.col("_doc").dropFields(CORRUPT).alias("_doc"), corrupt.alias(CORRUPT))


def json_from_content(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """The fields of well-formed JSON documents held as bytes, one row per document (see ``json_documents``)."""
    docs = json_documents(raw, schema)
    keep = [c for c in docs.columns if c not in ("_doc", CORRUPT)]
    return docs.filter(F.col(CORRUPT).isNull()).select(*keep, "_doc.*")
