"""Document fingerprints: SimHash over weighted word pairs, with DataFrame functions alone.

A text's terms are its adjacent pairs of words (split at white space; a single word pairs with itself), each weighing
its number of characters, so that frequent function words count little. A term's 64-bit hash votes with its weight for
or against each bit; bits with more votes for than against are set. Votes are sums: two bits share a 64-bit sum, 32 bits
apart, so 32 sums per text hold all of them (exact for texts of up to 2**31 characters).

``neighbours`` finds all fingerprints within a Hamming radius: a fingerprint is cut into blocks, every table is keyed by
a choice of ``blocks - radius`` of them, and two fingerprints within the radius must agree on all key blocks in at
least one table. Equal fingerprints are one entry each, so copies never meet pairwise.

Defined cases: NULL text is empty; a text without words has fingerprint 0; repeated rows have equal fingerprints; the
next document is the next row by (doc_id, text), NULL ids first, and the first row follows the last; an empty table
gives no rows.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

BITS = 64
RADIUS = 3
BLOCKS = 6                     # of 10 or 11 bits; 20 tables at radius 3, each keyed by 3 blocks
ROWS_PER_RANGE = 500           # documents that one range of ids holds, on average
MAX_RANGES = 1 << 16
PAIR_MASK = 0x0000000100000001


def add_fingerprints(frame: DataFrame, keys: list[str], text: str) -> DataFrame:
    """``keys`` (which tell rows apart) with the 64-bit ``fingerprint`` of the text column."""
    words = frame.select(*keys, F.filter(F.split(F.coalesce(text, F.lit("")), r"\s+"), lambda w: w != "").alias("__w"))
    size = F.size("__w")
    follower = F.when(size == 1, F.col("__w")).otherwise(F.slice("__w", 2, F.greatest(size, F.lit(1))))
    pairs = words.select(*keys, F.explode_outer(F.arrays_zip(F.col("__w").alias("a"), follower.alias("b"))).alias("__t"))
    first, second = F.col("__t.a"), F.col("__t.b")
    # the last word has no follower and so no term of its own, but in texts of one word
    voted = pairs.select(*keys, F.when(second.isNotNull(), F.xxhash64(first, second)).alias("__h"),
                         F.when(second.isNotNull(), F.length(first) + F.length(second)).cast("long").alias("__n"))
    lanes = [F.coalesce(F.sum(F.shiftrightunsigned("__h", j).bitwiseAND(F.lit(PAIR_MASK)) * F.col("__n")), F.lit(0)).alias(f"__v{j}")
             for j in range(32)]
    votes = voted.groupBy(*keys).agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("__all"), *lanes)
    low = [F.when(2 * F.col(f"__v{j}").bitwiseAND(F.lit(0xFFFFFFFF)) > F.col("__all"), F.lit(1 << j)).otherwise(F.lit(0)) for j in range(32)]
    high = [F.when(2 * F.shiftrightunsigned(f"__v{j}", 32) > F.col("__all"), F.lit(1 << j)).otherwise(F.lit(0)) for j in range(32)]
    together = lambda bits: reduce(lambda x, y: x + y, [b.cast("long") for b in bits])  # noqa: E731  distinct bits: a sum is an OR
    return votes.select(*keys, F.shiftleft(together(high), 32).bitwiseOR(together(low)).alias("fingerprint"))


def likeness(a: Column, b: Column) -> Column:
    """1 minus the share of differing bits."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def hex16(fingerprint: Column) -> Column:
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")


def id_ranges(frame: DataFrame, key: str) -> list[int]:
    """Values of ``key`` that cut the rows into ranges of about ``ROWS_PER_RANGE``; their number is bounded."""
    n = frame.count()
    ranges = max(1, min(MAX_RANGES, n // ROWS_PER_RANGE))
    at = [(i + 1) / ranges for i in range(ranges - 1)]
    cuts = frame.agg(F.min(key).alias("low"), (F.percentile_approx(key, at, 100 * ranges) if at else F.lit(None)).alias("cuts")).first()
    return [] if cuts["low"] is None else sorted({cuts["low"], *(cuts["cuts"] or [])})


def range_number(key: Column, cuts: list[int]) -> Column:
    """Number of the last cut that is not above ``key``; looked up in two steps of square-root size."""
    step = max(1, int(len(cuts) ** 0.5))
    heads = F.array(*[F.lit(c) for c in cuts[::step]])
    groups = F.array(*[F.array(*[F.lit(c) for c in cuts[i:i + step]]) for i in range(0, len(cuts), step)])
    group = F.greatest(F.size(F.filter(heads, lambda c: c <= key)) - 1, F.lit(0))
    inside = F.greatest(F.size(F.filter(F.get(groups, group), lambda c: c <= key)) - 1, F.lit(0))
    return (group * step + inside).cast("int")


def with_next(docs: DataFrame) -> DataFrame:
    """Every row with the next one's text: ``r`` (range), ``n`` (row in it), ``guest``, ``doc_id``, ``text``, ``next_text``.

    Rows are dealt by ranges of ids, so the text is shuffled once. The rows at the head of a range are also sent, as
    guests, to the end of the range before (the first range's to the last one), where they are next documents only.
    """
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"),
                        F.coalesce("doc_id", F.lit(-(1 << 63))).alias("k"))
    cuts = id_ranges(keyed.select("k"), "k") or [0]
    number = range_number(F.col("k"), cuts)
    is_head = F.element_at(F.array(*[F.lit(c) for c in cuts]), number + 1) == F.col("k")
    home = F.struct(number.alias("r"), F.lit(False).alias("guest"))
    visit = F.struct(F.pmod(number - 1, F.lit(len(cuts))).cast("int").alias("r"), F.lit(True).alias("guest"))
    dealt = keyed.select("doc_id", "text", "k", F.inline(F.when(is_head, F.array(home, visit)).otherwise(F.array(home))))
    order = Window.partitionBy("r").orderBy("guest", "k", "text")
    return dealt.select("r", F.row_number().over(order).alias("n"), "guest", "doc_id", "text",
                        F.lead("text").over(order).alias("next_text"))


def compare_edited(docs: DataFrame) -> DataFrame:
    """The contract's row per document: its fingerprint, its edited text's, and its likeness to that and the next one's."""
    rows = with_next(common.id_text(docs)).withColumn("n_chars", F.length("text").cast("long"))
    kept = F.expr("substring(text, 1, cast(n_chars - n_chars div 2 as int))")
    edited = F.concat(kept, F.expr("substring(next_text, 1, cast(n_chars div 2 as int))"))
    own = F.struct(F.lit(0).alias("kind"), F.col("text").alias("body"))
    other = F.struct(F.lit(1).alias("kind"), edited.alias("body"))
    bodies = rows.select("r", "n", "guest", "doc_id", "n_chars",
                         F.inline(F.when(F.col("guest"), F.array(own)).otherwise(F.array(own, other))))
    keys = ["r", "n", "guest", "doc_id", "n_chars", "kind", "sha"]
    prints = add_fingerprints(bodies.withColumn("sha", F.when(F.col("kind") == 1, F.sha2("body", 256))), keys, "body")
    own_print = F.max(F.when(F.col("kind") == 0, F.col("fingerprint")))
    edited_print = F.max(F.when(F.col("kind") == 1, F.col("fingerprint")))
    one = prints.groupBy("r", "n", "guest", "doc_id", "n_chars").agg(
        F.max("sha").alias("edited_sha256"), own_print.alias("f"), edited_print.alias("e"))
    follows = F.lead("f").over(Window.partitionBy("r").orderBy("n"))
    return one.withColumn("g", follows).where(~F.col("guest")).select(
        "doc_id", "n_chars", "edited_sha256", "f", "e", likeness(F.col("f"), F.col("e")).alias("near_edited"),
        likeness(F.col("f"), F.col("g")).alias("near_next"))


def block_masks(radius: int, blocks: int = BLOCKS) -> list[int]:
    """One mask per table: the bits of ``blocks - radius`` blocks, for every choice of these blocks."""
    bounds = [BITS * i // blocks for i in range(blocks + 1)]
    block = [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(bounds, bounds[1:], strict=False)]
    masks = [sum(chosen) for chosen in combinations(block, blocks - radius)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def neighbours(queries: DataFrame, fingerprints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """All pairs ``(fingerprint, near, distance)`` of a query and another, different fingerprint within ``radius`` bits.

    Both inputs have a ``fingerprint`` column; equal values are one entry. Every table joins on its masked bits alone,
    hashed with the table's number; agreeing in no table would take more than ``radius`` differing blocks.
    """
    masks = block_masks(radius, blocks)

    def tables(frame: DataFrame, name: str) -> DataFrame:
        keys = F.array(*[F.xxhash64(F.lit(i), F.col("fingerprint").bitwiseAND(F.lit(m))) for i, m in enumerate(masks)])
        return frame.select("fingerprint").distinct().select(F.col("fingerprint").alias(name), F.explode(keys).alias("key"))

    distance = F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("near")))
    met = tables(queries, "fingerprint").join(tables(fingerprints, "near"), "key")
    return met.where((F.col("fingerprint") != F.col("near")) & (distance <= radius)) \
              .select("fingerprint", "near", distance.alias("distance")).distinct()


def fingerprint_documents(docs: DataFrame, every: int = 20, radius: int = RADIUS) -> DataFrame:
    """``compare_edited`` with fingerprints in hex, and ``n_near``: how many other fingerprints lie within the radius.

    Queries of that search are the documents whose id is divisible by ``every``; other rows have NULL there.
    """
    rows = common.written(compare_edited(docs), "fingerprints")
    asked = F.col("doc_id") % every == 0
    found = neighbours(rows.where(asked).select(F.col("f").alias("fingerprint")), rows.select(F.col("f").alias("fingerprint")), radius)
    counts = found.groupBy("fingerprint").agg(F.count("*").alias("n_found")).withColumnRenamed("fingerprint", "f")
    return rows.join(counts, "f", "left").select(
        "doc_id", "n_chars", "edited_sha256", hex16(F.col("f")).alias("fingerprint"), hex16(F.col("e")).alias("edited_fingerprint"),
        "near_edited", "near_next", F.when(asked, F.coalesce("n_found", F.lit(0))).alias("n_near"))
