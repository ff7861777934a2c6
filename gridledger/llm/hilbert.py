"""Sharding by a Hilbert curve over metadata: rows close in several dimensions share a shard, so that a reader who filters
on any of them opens few files.

Every dimension (a column or expression; by default language, source and size) is quantised to ``2^BITS`` steps at its own
quantiles, which are taken over all rows. The steps of a row are its cell in a grid, and the cell's number along the
Hilbert curve is the row's place. Rows are ordered by that number and the order is cut into runs: ``rows`` cuts where the
counts differ by one at most, ``bytes`` where the sizes come nearest to equal. ``write`` stores the runs as folders and
``shard_ranges`` keeps the least and greatest value of every dimension per shard, which ``shards_for`` prunes by.

All of it is DataFrame functions. No task holds a whole cell: within its cell a row's place comes from buckets of a hash
of the row (their number grows with the table), bucket totals are summed in two levels, and rows that repeat are counted
before they are shuffled, so neither a source nor a group of copies that holds a third of the table meets in one task.
The grid has ``2^(BITS * dimensions)`` cells at most, whatever the table: the one window over all cells is bounded.

Defined cases: a NULL text has no bytes (size 1, crc32 0); a NULL in a dimension is its lowest step; rows that repeat get
a place each; NULL ids are ids like others; an empty table gives no rows; of extra columns only the dimensions are read.
Equal rows of one table always get the same set of places.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

SHARDS = 8
BITS = 5                       # steps of a dimension: 2^BITS
DIMENSIONS = ("lang", "source", "size")
BUCKET_ROWS = 50_000           # rows of a hash bucket, on average
ACCURACY = 10_000              # of the quantiles: an error of one in so many ranks


# ---- the curve


def curve_tables(dims: int) -> tuple[list[int], list[int]]:
    """Digit and next state of the curve by ``state * 2^dims + cell``: a state is an entry corner and a direction.

    The rule: a level's cell is reflected by the entry corner and rotated by the direction, its rank in the reflected Gray
    code is the digit, and the corner and direction of the sub-cube with that digit make the next state.
    """
    size = 1 << dims
    gray = [i ^ (i >> 1) for i in range(size)]
    rank = {g: i for i, g in enumerate(gray)}

    def rotl(x: int, k: int) -> int:
        k %= dims
        return ((x << k) | (x >> (dims - k))) & (size - 1)

    def entry(i: int) -> int:
        return 0 if i == 0 else gray[2 * ((i - 1) // 2)]

    def axis(i: int) -> int:
        if i == 0:
            return 0
        x = i if i % 2 else i - 1
        return ((x + 1) & -(x + 1)).bit_length() - 1      # trailing ones of x

    digits, states = [], []
    for corner in range(size):
        for direction in range(dims):
            for cell in range(size):
                turned = rotl(cell ^ corner, dims - (direction + 1) % dims)
                digit = rank[turned]
                new_corner = corner ^ rotl(entry(digit), direction + 1)
                new_direction = (direction + axis(digit) + 1) % dims
                digits.append(digit)
                states.append(new_corner * dims + new_direction)
    return digits, states


def curve_index(steps: Sequence[Column], bits: int = BITS) -> Column:
    """Place on the Hilbert curve of a cell given by one step number (0 to ``2^bits`` - 1) per dimension."""
    dims = len(steps)
    if not 1 <= dims <= 4 or not 1 <= bits * dims <= 48:
        raise ValueError("one to four dimensions, 48 bits in all")
    digits, states = curve_tables(dims)
    digit_table, state_table = (F.array(*[F.lit(v) for v in t]) for t in (digits, states))
    # the levels' cells, the highest bits first: one bit of every dimension
    cells = F.array(*[reduce(lambda a, b: a.bitwiseOR(b),
                             [F.shiftleft(F.shiftright(s.cast("int"), level).bitwiseAND(F.lit(1)), d) for d, s in enumerate(steps)])
                      for level in range(bits - 1, -1, -1)])

    def step(at: Column, cell: Column) -> Column:
        i = at["state"] * F.lit(1 << dims) + cell
        return F.struct((at["index"] * F.lit(1 << dims) + F.get(digit_table, i)).cast("long").alias("index"),
                        F.get(state_table, i).alias("state"))

    start = F.struct(F.lit(0).cast("long").alias("index"), F.lit(0).alias("state"))
    return F.aggregate(cells, start, step)["index"]


# ---- dimensions


def order_key(column: Column, kind: T.DataType) -> Column:
    """A number that orders as the column does: texts by their first seven bytes, others by their value as a double."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        head = F.rpad(F.hex(F.substring(column.cast("binary"), 1, 7)), 14, "0")
        return F.conv(head, 16, 10).cast("double")
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(column.cast("timestamp")).cast("double")
    return column.cast("double")


def _size_and_crc() -> tuple[Column, Column]:
    raw = F.coalesce(F.col("text").cast("string").cast("binary"), F.lit(b""))
    return (F.octet_length(raw) + 1).cast("long"), F.crc32(raw)


def keyed_rows(docs: DataFrame, dimensions: Sequence[str] = DIMENSIONS, whole: bool = False) -> DataFrame:
    """``doc_id, size, text_crc32`` and, as ``d0, d1, ...``, the order keys of the dimensions that the table has.

    With ``whole`` the row itself comes along as the struct ``row``.
    """
    size, crc = _size_and_crc()
    kinds = {f.name: f.dataType for f in docs.schema.fields}
    keys = [order_key(size, T.LongType()) if d == "size" else order_key(F.col(f"`{d}`"), kinds[d])
            for d in dimensions if d == "size" or d in kinds]
    row = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if whole else []
    return docs.select(*row, F.col("doc_id").cast("long").alias("doc_id"), size.alias("size"), crc.alias("text_crc32"),
                       *[k.alias(f"d{i}") for i, k in enumerate(keys)])


def quantiles(keyed: DataFrame, bits: int = BITS) -> list[list[float]]:
    """Per dimension, the distinct values that part all rows into ``2^bits`` steps (so many numbers reach the driver)."""
    names = [c for c in keyed.columns if c[0] == "d" and c[1:].isdigit()]
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    found = keyed.agg(*[F.percentile_approx(n, shares, ACCURACY).alias(n) for n in names]).first()
    return [sorted(set(found[n] or [])) for n in names]


def curve_place(cuts: Sequence[Sequence[float]], bits: int = BITS) -> Column:
    """Place on the curve of a ``keyed_rows`` row."""
    steps = []
    for i, limits in enumerate(cuts):
        value = F.col(f"d{i}")
        if not limits:
            steps.append(F.lit(0))
            continue
        below = F.size(F.filter(F.array(*[F.lit(float(v)) for v in limits]), lambda v, value=value: v <= value))
        steps.append(F.when(value.isNull(), F.lit(0)).otherwise(below))
    return curve_index(steps, bits)


# ---- runs


KEY = ("doc_id", "size", "text_crc32")


def _places(keyed: DataFrame, cuts: Sequence[Sequence[float]], bits: int) -> tuple[DataFrame, int, int]:
    """Distinct rows in curve order with the rows and bytes before them, and the totals of both."""
    key = list(KEY)
    total = keyed.count()
    buckets = max(1, -(-total // BUCKET_ROWS))
    row = keyed.select(curve_place(cuts, bits).alias("h"), F.pmod(F.xxhash64(*key), F.lit(buckets)).alias("bucket"), *key)
    # repeated rows are one row with a count from here on
    once = common.written(row.groupBy("h", "bucket", *key).agg(F.count(F.lit(1)).alias("copies")), "hilbert-places")
    weights = [F.sum("copies").alias("rows"), F.sum(F.col("copies") * F.col("size")).alias("bytes")]
    by_bucket = once.groupBy("h", "bucket").agg(*weights)
    by_cell = by_bucket.groupBy("h").agg(F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"))

    def before(over) -> list[Column]:
        return [(F.sum(c).over(over) - F.col(c)).alias(f"{c}_before") for c in ("rows", "bytes")]

    # one row per cell of the grid at most: the grid's size does not grow with the table
    cells = by_cell.select("h", *before(Window.partitionBy(F.lit(0)).orderBy("h")))
    in_cell = by_bucket.select("h", "bucket", *before(Window.partitionBy("h").orderBy("bucket")))
    starts = (in_cell.join(cells.select("h", F.col("rows_before").alias("r0"), F.col("bytes_before").alias("b0")), "h")
              .select("h", "bucket", (F.col("r0") + F.col("rows_before")).alias("r0"),
                      (F.col("b0") + F.col("bytes_before")).alias("b0")))
    own = once.withColumn("rows", F.col("copies")).withColumn("bytes", F.col("copies") * F.col("size"))
    ranked = own.select("h", "bucket", *key, "copies", *before(Window.partitionBy("h", "bucket").orderBy(*key)))
    out = ranked.join(starts, ["h", "bucket"]).select(
        "h", *key, "copies", (F.col("r0") + F.col("rows_before")).alias("rank"), (F.col("b0") + F.col("bytes_before")).alias("at"))
    size = by_cell.agg(F.sum("bytes")).first()[0] or 0
    return out, total, int(size)


def assign(docs: DataFrame, shards: int = SHARDS, law: str = "rows", dimensions: Sequence[str] = DIMENSIONS,
           bits: int = BITS) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard, curve_index`` of every row.

    ``rows``: counts differ by one at most. ``bytes``: a row belongs to the shard in whose equal share of all bytes its
    middle lies, so a shard's size is within one row's size of the share.
    """
    if law not in ("rows", "bytes"):
        raise ValueError(f"unknown law {law}")
    keyed = common.written(keyed_rows(docs, dimensions), "hilbert-rows")
    return _assign(keyed, quantiles(keyed, bits), shards, law, bits).select(
        *KEY, "law", "shard", "slot", "grown_shard", F.col("h").alias("curve_index"))


def _assign(keyed: DataFrame, cuts: Sequence[Sequence[float]], shards: int, law: str, bits: int) -> DataFrame:
    found, total, size = _places(keyed, cuts, bits)
    each = found.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy"))
    rank = (F.col("rank") + F.col("copy")).alias("rank")
    if law == "rows":
        n = F.lit(max(total, 1)).cast("long")
        each = each.select("*", rank.alias("place")).withColumn(
            "shard", F.expr(f"({shards}L * (place + 1) - 1) div {max(total, 1)}L").cast("int"))
        each = each.withColumn("slot", F.col("place") - F.expr(f"(shard * {max(total, 1)}L) div {shards}L"))
    else:
        # a middle is counted in half bytes to stay in whole numbers
        each = each.select("*", rank.alias("place"), (2 * (F.col("at") + F.col("copy") * F.col("size")) + F.col("size")).alias("middle"))
        each = each.withColumn("shard", F.least(F.lit(shards - 1), F.expr(f"(middle * {shards}L) div {2 * max(size, 1)}L")).cast("int"))
        # one row per shard
        first = each.groupBy("shard").agg(F.min("place").alias("first"))
        each = each.join(F.broadcast(first), "shard").withColumn("slot", F.col("place") - F.col("first"))
    return each.select(*KEY, "h", "copy", F.lit(law).alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
                       F.lit(None).cast("int").alias("grown_shard"))


# ---- files and pruning


def write(docs: DataFrame, path: str, shards: int = SHARDS, law: str = "rows", dimensions: Sequence[str] = DIMENSIONS,
          bits: int = BITS) -> DataFrame:
    """The documents with all their columns as ``path/shard=<n>``, in curve order; returns the shards' ranges.

    Rows of one key are numbered to tell them apart: within the task that read them, then over the tasks, so that a row
    that repeats without bound is never numbered by one task. A table with a column ``shard`` gets folders ``shard_=<n>``.
    """
    if law not in ("rows", "bytes"):
        raise ValueError(f"unknown law {law}")
    tagged = keyed_rows(docs, dimensions, whole=True).withColumn("part", F.spark_partition_id())
    tagged = common.written(tagged.withColumn("nr", F.monotonically_increasing_id()), "hilbert-documents")
    cuts = quantiles(tagged, bits)
    # everything that places a row: equal rows are numbered from 0 within their group
    group = ["h", *KEY]
    rows = tagged.select("row", curve_place(cuts, bits).alias("h"), *KEY, "part", "nr")
    per_part = rows.groupBy(*group, "part").agg(F.count(F.lit(1)).alias("n"))
    first = per_part.select(*group, "part", (F.sum("n").over(Window.partitionBy(*group).orderBy("part")) - F.col("n")).alias("first"))
    rows = rows.withColumn("nth", F.row_number().over(Window.partitionBy(*group, "part").orderBy("nr")) - 1)

    def same(a: DataFrame, b: DataFrame, names: Sequence[str]) -> Column:
        return reduce(lambda x, y: x & y, [a[n].eqNullSafe(b[n]) for n in names])

    rows = rows.join(first, same(rows, first, [*group, "part"])).select(
        "row", *[rows[g] for g in group], (F.col("first") + F.col("nth")).alias("copy"))
    places = _assign(tagged, cuts, shards, law, bits)
    folder = "shard"
    while folder in docs.columns:
        folder += "_"
    out = rows.join(places, same(rows, places, [*group, "copy"])).select(
        F.struct("shard", "slot").alias("place"), "row")
    # a shard's rows spread over tasks by slot range, each sorted: its files are consecutive pieces of its run
    (out.repartitionByRange("place").sortWithinPartitions("place").select("row.*", F.col("place.shard").alias(folder))
        .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(folder).parquet(path))
    return shard_ranges(docs.sparkSession.read.parquet(path), dimensions, folder)


def shard_ranges(stored: DataFrame, dimensions: Sequence[str] = DIMENSIONS, folder: str = "shard") -> DataFrame:
    """Least and greatest value of every dimension per shard, the rows, and whether a dimension has NULLs there."""
    size, _ = _size_and_crc()
    measures = []
    for d in dimensions:
        if d != "size" and d not in stored.columns:
            continue
        c = size if d == "size" else F.col(f"`{d}`")
        measures += [F.min(c).alias(f"{d}_min"), F.max(c).alias(f"{d}_max"), F.max(c.isNull()).alias(f"{d}_nulls")]
    return stored.groupBy(F.col(folder).alias("shard")).agg(F.count(F.lit(1)).alias("rows"), *measures)


def shards_for(ranges: DataFrame, wanted: dict[str, tuple]) -> DataFrame:
    """Shards that may hold a row within all ``wanted`` ranges (dimension -> least and greatest value, both inclusive)."""
    may = [(F.col(f"{d}_min") <= F.lit(high)) & (F.col(f"{d}_max") >= F.lit(low)) for d, (low, high) in wanted.items()]
    return ranges.where(reduce(lambda a, b: a & b, may, F.lit(True))).select("shard")
