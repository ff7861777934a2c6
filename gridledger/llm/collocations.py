"""Collocations: phrases of two and three words that occur together more often than their parts let expect.

1. Every task turns its texts into blocks: per language, the words' numbers within the block in text order, and the block's
   words with their counts. Words of the whole table are added up from the blocks; those in ``MIN_COUNT`` places or more
   are numbered. No rarer word can be part of a candidate, so this loses none.
2. Each block gets the numbers of its own words (a join on the block, nothing is broadcast) and counts its phrases in
   counting quotient filters, one per range of permuted keys. A phrase in a billion places is one entry of each block.
3. The filters of a range meet in one task, whose size is set by the number of ranges, and are merged in order.
4. Candidates find the counts of their parts, the cut that scores lowest, and longer candidates that hold them, by joins.
5. Each language's best come in two steps, within hashed parts of the language and then over them.

Words are cut as bytes: A-Z are lower-cased, ``.,;:!?`` and line breaks end a piece, spaces and tabs end a word.

Defined cases: a NULL language is ``und``, a NULL text is empty; texts without words and empty tables give no rows; rows
that repeat count each time; other columns are not read. A word may hold any other character, control characters included.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common
from .quotient_filter import QuotientFilter, Shape, build, merge

MIN_COUNT = 10
CONTAINED_PERCENT = 50         # a candidate falls if a longer one that holds it has this share of its places
TOP = 2000
SCALE = 1_000_000
BLOCK_WORDS = 3_000_000        # word places of a task's blocks before they are sent on
RANGE_ENTRIES = 3_000_000      # most phrase places of a range, on average
BUCKET_WORDS = 50_000          # words of a numbering bucket, on average
PARTS = 64                     # hashed parts of a language in the first step of its ranking

# Bytes that end a piece become line feeds, tabs spaces, capitals small letters.
_TABLE = bytes(10 if chr(c) in ".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))


def words_of(text: str) -> list[bytes]:
    """The words of a text in order; a line feed stands where a piece ends."""
    raw = text.encode("utf-8", "surrogatepass").translate(_TABLE)
    return [w for w in raw.replace(b"\n", b" \n ").split(b" ") if w]


# ---- blocks


def blocks(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``block, lang, n, words, counts, places``: per block, its words and the places of a language's texts as their numbers.

    Number 0 is an edge between pieces or texts; word ``i`` of ``words`` has number ``i + 1``.
    """
    common.ship_code(docs.sparkSession)
    frame = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, number, held, total = TaskContext.get().partitionId(), 0, {}, 0

        def send() -> pd.DataFrame:
            rows = []
            for lang, (numbers, places) in held.items():
                order = np.concatenate(places)
                words = list(numbers)[1:]
                counts = np.bincount(order, minlength=len(words) + 1)[1:]
                rows.append((f"{part}-{number}-{len(rows)}", lang, int(counts.sum()), words, counts.astype(np.int64), order.tobytes()))
            return pd.DataFrame(rows, columns=["block", "lang", "n", "words", "counts", "places"])

        for pdf in batches:
            for lang, text in zip(pdf["lang"], pdf["text"], strict=True):
                if pd.isna(text) or not text:
                    continue
                numbers, places = held.setdefault(lang, ({b"\n": 0}, []))
                found = words_of(text)
                found.append(b"\n")
                places.append(np.array([numbers.setdefault(w, len(numbers)) for w in found], np.int32))
                total += len(found)
                if total >= block_words:
                    yield send()
                    number, held, total = number + 1, {}, 0
        if held:
            yield send()

    schema = "block string, lang string, n long, words array<binary>, counts array<long>, places binary"
    return common.written(frame.mapInPandas(run, schema), "phrase-blocks")


def vocabulary(cut: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """``lang, word, f, id`` of the words in ``min_count`` places or more; ids are from 1 and nearly dense."""
    each = cut.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("w"))
    found = each.groupBy("lang", F.col("w.words").cast("string").alias("word")).agg(F.sum("w.counts").alias("f")).where(F.col("f") >= min_count)
    found = common.written(found, "phrase-words")
    buckets = max(1, -(-found.count() // BUCKET_WORDS))
    # distinct words spread evenly over the buckets, however often each occurs
    bucket = F.pmod(F.xxhash64("lang", "word"), F.lit(buckets))
    nth = F.row_number().over(Window.partitionBy("bucket").orderBy("lang", "word"))
    numbered = found.withColumn("bucket", bucket).withColumn("id", (nth - 1).cast("long") * buckets + F.col("bucket") + 1)
    return common.written(numbered.select("lang", "word", "f", "id"), "phrase-vocabulary")


# ---- phrases


def phrase_filters(cut: DataFrame, words: DataFrame, shape: Shape) -> DataFrame:
    """``range, filter`` of every block: its phrases of two and three numbered words, counted."""
    own = (cut.select(F.col("block").alias("of_block"), "lang", F.posexplode("words").alias("at", "word"))
           .withColumn("word", F.col("word").cast("string"))
           .join(words.select("lang", "word", "id"), ["lang", "word"]).select("of_block", "at", "id"))

    def count(block: pd.DataFrame, numbered: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for places in block["places"]:
            order = np.frombuffer(places, np.int32)
            ids = np.zeros(int(order.max(initial=0)) + 1, np.int64)
            ids[numbered["at"].to_numpy() + 1] = numbered["id"].to_numpy()
            x = ids[order]
            two = (x[:-1] > 0) & (x[1:] > 0)
            three = two[:-1] & two[1:]
            pairs, triples = np.flatnonzero(two), np.flatnonzero(three)
            w1 = np.concatenate([x[pairs], x[triples]])
            w2 = np.concatenate([x[pairs + 1], x[triples + 1]])
            w3 = np.concatenate([np.zeros(len(pairs), np.int64), x[triples + 2]])
            rows += [(f.range_no, f.to_bytes()) for f in build(shape, w1, w2, w3)]
        return pd.DataFrame(rows, columns=["range", "filter"]).astype({"range": "int32", "filter": object})

    return cut.select("block", "places").groupBy("block").cogroup(own.groupBy("of_block")).applyInPandas(count, "range int, filter binary")


def merged_filters(filters: DataFrame) -> DataFrame:
    """One filter per range: ``range, filter``."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        one = merge(QuotientFilter.from_bytes(x) for x in rows["filter"])
        return pd.DataFrame({"range": [one.range_no], "filter": [one.to_bytes()]}).astype({"range": "int32"})

    return filters.groupBy("range").applyInPandas(run, "range int, filter binary")


def phrase_counts(filters: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """``w1, w2, w3, f`` of the phrases with ``min_count`` places or more over all filters (``w3`` 0: two words)."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        one = merge(QuotientFilter.from_bytes(x) for x in rows["filter"])
        found = one.entries()
        kept = found.count >= min_count
        ids = one.shape.unpack(*one.shape.restore(found.high[kept], found.low[kept]))
        return pd.DataFrame({**{f"w{i + 1}": w.astype(np.int64) for i, w in enumerate(ids)}, "f": found.count[kept].astype(np.int64)})

    return filters.groupBy("range").applyInPandas(run, "w1 long, w2 long, w3 long, f long")


# ---- scores


def cut_score(a: Column, left: Column, right: Column) -> Column:
    """``floor(SCALE * a * a / (l * r))`` in whole decimals of 38 digits; a value beyond them is an error, not a wrong score."""
    a2 = a.cast("decimal(16,0)") * a.cast("decimal(16,0)")
    return F.call_function("div", a2 * F.lit(SCALE).cast("decimal(7,0)"), left.cast("decimal(18,0)") * right.cast("decimal(18,0)"))


def candidates(grams: DataFrame, words: DataFrame, contained_percent: int = CONTAINED_PERCENT) -> DataFrame:
    """``lang, phrase, a, l, r, score`` of the phrases that no longer candidate stands for."""
    def word(i: int) -> DataFrame:
        return words.select(F.col("id").alias(f"w{i}"), F.col("word").alias(f"word{i}"), F.col("f").alias(f"f{i}"), *(["lang"] if i == 1 else []))

    pairs = grams.where("w3 = 0").select("w1", "w2", F.col("f").alias("a"))
    triples = grams.where("w3 > 0").select("w1", "w2", "w3", F.col("f").alias("a"))
    held = (triples.select("w1", "w2", "a").union(triples.select("w2", "w3", "a"))
            .groupBy("w1", "w2").agg(F.max("a").alias("longer")))
    kept = pairs.join(held, ["w1", "w2"], "left").where(
        F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * contained_percent)).drop("longer")
    two = kept.join(word(1), "w1").join(word(2), "w2").select(
        "lang", F.concat_ws(" ", "word1", "word2").alias("phrase"), "a", F.col("f1").alias("l"), F.col("f2").alias("r"),
        cut_score(F.col("a"), F.col("f1"), F.col("f2")).alias("score"))
    front = pairs.select("w1", "w2", F.col("a").alias("front"))
    back = pairs.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("back"))
    three = (triples.join(front, ["w1", "w2"]).join(back, ["w2", "w3"]).join(word(1), "w1").join(word(2), "w2").join(word(3), "w3")
             .withColumn("s1", cut_score(F.col("a"), F.col("f1"), F.col("back")))
             .withColumn("s2", cut_score(F.col("a"), F.col("front"), F.col("f3"))))
    second = F.col("s2") < F.col("s1")
    three = three.select(
        "lang", F.concat_ws(" ", "word1", "word2", "word3").alias("phrase"), "a",
        F.when(second, F.col("front")).otherwise(F.col("f1")).alias("l"),
        F.when(second, F.col("f3")).otherwise(F.col("back")).alias("r"), F.least("s1", "s2").alias("score"))
    return two.unionByName(three)


def top_phrases(found: DataFrame, top: int = TOP) -> DataFrame:
    """Each language's first ``top`` by score, then places, then the phrase's bytes; ``rank`` from 1."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    # a language's best are among the best of its hashed parts
    first = (found.withColumn("part", part).withColumn("nr", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
             .where(F.col("nr") <= top).drop("part", "nr"))
    return first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)


def mine(docs: DataFrame, min_count: int = MIN_COUNT, contained_percent: int = CONTAINED_PERCENT, top: int = TOP,
         block_words: int = BLOCK_WORDS, range_entries: int = RANGE_ENTRIES) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of each language's best phrases."""
    cut = blocks(docs, block_words)
    totals = cut.groupBy("lang").agg(F.sum("n").alias("n"))
    words = vocabulary(cut, min_count)
    largest = words.agg(F.max("id")).first()[0] or 1
    places = cut.agg(F.sum("n")).first()[0] or 0
    width = int(largest).bit_length()
    shape = Shape(width, min((3 * width + 1) // 2, max(0, (2 * int(places) // range_entries).bit_length())))
    grams = common.written(phrase_counts(phrase_filters(cut, words, shape), min_count), "phrase-counts")
    best = top_phrases(candidates(grams, words, contained_percent), top)
    # a language is one row, and its phrases at most ``top``
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


SQL = f"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
s AS (SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM p),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM s GROUP BY lang),
f1 AS (SELECT lang, x AS phrase, count(*) AS f FROM (SELECT lang, unnest(w) AS x FROM s) GROUP BY ALL),
g2 AS (SELECT lang, unnest(list_transform(range(1, len(w)), lambda i: {{'x': w[i], 'y': w[i + 1]}})) AS g FROM s),
f2 AS (SELECT lang, g.x AS x, g.y AS y, count(*) AS f FROM g2 GROUP BY ALL HAVING count(*) >= {MIN_COUNT}),
g3 AS (SELECT lang, unnest(list_transform(range(1, len(w) - 1), lambda i: {{'x': w[i], 'y': w[i + 1], 'z': w[i + 2]}})) AS g FROM s),
f3 AS (SELECT lang, g.x AS x, g.y AS y, g.z AS z, count(*) AS f FROM g3 GROUP BY ALL HAVING count(*) >= {MIN_COUNT}),
held AS (SELECT lang, x, y, max(f) AS f FROM (SELECT lang, x, y, f FROM f3 UNION ALL SELECT lang, y, z, f FROM f3) GROUP BY ALL),
two AS (
  SELECT c.lang, c.x || ' ' || c.y AS phrase, c.f AS a, l.f AS l, r.f AS r,
         {SCALE}::HUGEINT * c.f * c.f // (l.f::HUGEINT * r.f) AS score
  FROM f2 c JOIN f1 l ON l.lang = c.lang AND l.phrase = c.x JOIN f1 r ON r.lang = c.lang AND r.phrase = c.y
  LEFT JOIN held h ON h.lang = c.lang AND h.x = c.x AND h.y = c.y
  WHERE h.f IS NULL OR 100 * h.f < {CONTAINED_PERCENT} * c.f),
three_cuts AS (
  SELECT c.lang, c.x || ' ' || c.y || ' ' || c.z AS phrase, c.f AS a, l1.f AS l1, r1.f AS r1, l2.f AS l2, r2.f AS r2,
         {SCALE}::HUGEINT * c.f * c.f // (l1.f::HUGEINT * r1.f) AS s1, {SCALE}::HUGEINT * c.f * c.f // (l2.f::HUGEINT * r2.f) AS s2
  FROM f3 c JOIN f1 l1 ON l1.lang = c.lang AND l1.phrase = c.x JOIN f2 r1 ON r1.lang = c.lang AND r1.x = c.y AND r1.y = c.z
  JOIN f2 l2 ON l2.lang = c.lang AND l2.x = c.x AND l2.y = c.y JOIN f1 r2 ON r2.lang = c.lang AND r2.phrase = c.z),
scored AS (
  SELECT lang, phrase, a, l, r, score FROM two
  UNION ALL
  SELECT lang, phrase, a, CASE WHEN s2 < s1 THEN l2 ELSE l1 END, CASE WHEN s2 < s1 THEN r2 ELSE r1 END, least(s1, s2) FROM three_cuts),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM scored)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
       n.n AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN n USING (lang) WHERE rank <= {TOP}"""
