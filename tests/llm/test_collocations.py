"""Counting quotient filters and collocation mining against plain counting."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gridledger.llm import collocations
from gridledger.llm.quotient_filter import QuotientFilter, Shape, build, merge


@settings(max_examples=80, deadline=None)
@given(st.integers(1, 31), st.integers(0, 4), st.lists(st.tuples(*[st.integers(0, 2 ** 31 - 1)] * 3), min_size=1, max_size=60), st.integers(1, 600))
def test_filters_are_lossless(width, range_bits, phrases, times):
    shape = Shape(width, min(range_bits, (3 * width + 1) // 2))
    phrases = [tuple(w % (1 << width) for w in p) for p in phrases]
    repeated = phrases + [phrases[0]] * times

    def columns(rows):
        return [np.array([r[i] for r in rows], np.int64) for i in range(3)]

    high, low = shape.pack(*columns(phrases))
    assert [tuple(int(v) for v in t) for t in zip(*shape.unpack(high, low))] == phrases
    back = shape.restore(*shape.permute(high, low))
    assert (back[0] == high).all() and (back[1] == low).all()
    half = len(repeated) // 2
    parts = defaultdict(list)
    for rows in (repeated[:half], repeated[half:]):
        for f in build(shape, *columns(rows)):
            parts[f.range_no].append(QuotientFilter.from_bytes(f.to_bytes()))
    got = Counter()
    for held in parts.values():
        one = merge(held)
        e = one.entries()
        key = [(int(a), int(b)) for a, b in zip(e.high, e.low)]
        assert key == sorted(set(key))
        ids = list(zip(*(w.tolist() for w in shape.unpack(*shape.restore(e.high, e.low)))))
        got.update(dict(zip(ids, e.count.tolist())))
        assert all(one.count(*p) == n for p, n in zip(ids, e.count.tolist()))
    assert got == Counter(repeated)


def by_hand(rows, min_count, percent, top):
    n, f = Counter(), defaultdict(Counter)
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(lower)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= min_count}
        scored = []
        for p, a in found.items():
            longer = [b for q, b in found.items() if len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))] \
                if len(p) == 2 else []
            if any(100 * b >= percent * a for b in longer):
                continue
            score, k = min((1000000 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (s, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


@pytest.mark.parametrize("options", [{}, {"block_words": 3000, "range_entries": 2000, "min_count": 3, "top": 40, "contained_percent": 70}])
def test_phrases_equal_plain_counts(docs, options):
    rows = [(r.lang, r.text) for r in docs.collect()]
    got = sorted(tuple(r) for r in collocations.mine(docs, **options).collect())
    assert got == by_hand(rows, options.get("min_count", 10), options.get("contained_percent", 50), options.get("top", 2000))
    assert len(got) > 50


def test_odd_texts(spark, odd, empty):
    assert collocations.mine(empty).count() == 0
    texts = [(None, "Ab\x01 b c, ab\x01 b c"), ("x", "a b a b A B"), ("x", "É é É é"), (None, None), ("x", ""), ("y", "...\n\n;"),
             ("x", "\x0b a  b\t\tc \x0c a b c \x1f b"), (None, "ab b c AB B C"), ("x", "日 本 日 本 日 本")]
    frame = spark.createDataFrame(texts * 2, "lang string, text string")
    got = sorted(tuple(r) for r in collocations.mine(frame.repartition(3), min_count=2).collect())
    assert got == by_hand(texts * 2, 2, 50, 2000) and got
    rows = [(r.lang, r.text) for r in odd.collect()]
    got = sorted(tuple(r) for r in collocations.mine(odd, block_words=500).collect())
    assert got == by_hand(rows, 10, 50, 2000) and got


def test_scores_stay_exact_past_64_bits(spark):
    values = [(10 ** 13 + 7, 3 * 10 ** 13 + 1, 10 ** 13 + 9), (10, 10, 10), (2 ** 40, 2 ** 41, 2 ** 42)]
    frame = spark.createDataFrame(values, "a long, l long, r long")
    from pyspark.sql import functions as F
    got = [r[0] for r in frame.select(collocations.cut_score(F.col("a"), F.col("l"), F.col("r"))).collect()]
    assert got == [1000000 * a * a // (x * y) for a, x, y in values]
