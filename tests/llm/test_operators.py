"""Every operator over the small tables against brute force, and over odd and empty rows."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from gridledger.llm import decontaminate, language, near_dedup, packing, pii, quality, secrets, simhash, token_counts, toxicity, wordhash
from gridledger.llm.common import table

from .conftest import SF


@pytest.fixture(scope="module")
def tagger(empty):
    return pii.fit(empty, epochs=2)


def test_pieces_pack_gaplessly(docs, odd, empty):
    for frame in (docs, odd):
        rows = packing.pack(frame).toPandas().sort_values(["sequence_id", "offset"])
        ends = rows.groupby("sequence_id")["length"].cumsum()
        assert (ends - rows["length"] == rows["offset"]).all() and ends.max() <= packing.LENGTH
        assert (rows["piece"] == 0).sum() == frame.count()
    assert rows["sequence_id"].nunique() <= -(-rows["length"].sum() // packing.LENGTH) + 1
    assert packing.pack(empty).count() == 0


def test_no_more_sequences_than_best_fit_decreasing(docs):
    from bisect import bisect_left, insort

    for frame in (docs, docs.sparkSession.read.parquet("/root/testdata/sf0.01/documents.parquet")):
        sizes = [r[0] for r in packing.pieces(frame).select("length").collect()]
        free = []                     # what is left in each bin, full ones included
        for size in sorted(sizes, reverse=True):
            at = bisect_left(free, size)
            insort(free, (free.pop(at) if at < len(free) else packing.LENGTH) - size)
        plan = packing.plan_bins(dict(Counter(sizes)))
        assert -(-sum(sizes) // packing.LENGTH) <= plan.bins <= len(free)


def test_fingerprints(docs, odd, empty):
    rows = simhash.fingerprint_documents(docs).toPandas().sort_values("doc_id").reset_index(drop=True)
    texts = docs.toPandas().sort_values("doc_id")["text"].tolist()
    for i, t in enumerate(texts):
        half, after = len(t) // 2, texts[(i + 1) % len(texts)]
        assert rows["edited_sha256"][i] == hashlib.sha256((t[:len(t) - half] + after[:half]).encode()).hexdigest()
    assert rows.assign(t=texts).groupby("t")["fingerprint"].nunique().max() == 1
    values = np.array([int(v, 16) for v in rows["fingerprint"].unique()], dtype=np.uint64)
    for r in rows[rows["n_near"].notna()].itertuples():
        near = np.bitwise_count(values ^ np.uint64(int(r.fingerprint, 16))) <= simhash.RADIUS
        assert near.sum() - 1 == r.n_near
    plan = simhash.compare_edited(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange hashpartitioning") == 1
    assert simhash.fingerprint_documents(odd).count() == odd.count() and simhash.fingerprint_documents(empty).count() == 0


def test_block_tables_find_every_neighbour(spark):
    rng = np.random.default_rng(0)
    base = rng.integers(-2**63, 2**63 - 1, 40)
    values = {int(v) for v in base} | {int(v ^ sum(1 << int(b) if b < 63 else -2**63 for b in rng.choice(64, k, replace=False)))
                                       for v in base for k in (1, 2, 3, 4)}
    frame = spark.createDataFrame([(v,) for v in values], "fingerprint long")
    got = {(r[0], r[1]) for r in simhash.neighbours(frame, frame).collect()}
    assert got == {(a, b) for a in values for b in values if a != b and ((a ^ b) & (2**64 - 1)).bit_count() <= simhash.RADIUS}


def test_contained_items_are_found(spark, docs, odd, empty):
    items = table(spark, SF, "benchmark")
    got = {(r.doc_id, r.item_id) for r in decontaminate.containment_pairs(docs, items).collect()}
    cut = {r.item_id: wordhash.words(r.text) for r in items.collect()}
    want = set()
    for r in docs.collect():
        w = wordhash.words(r.text)
        for k, v in cut.items():
            n, found = decontaminate.contained(v, w)
            if n and found >= decontaminate.CONTAINMENT * n:
                want.add((r.doc_id, k))
    assert got == want and want
    own = odd.selectExpr("doc_id as item_id", "text")
    assert {(3, 3), (4, 5)} <= {(r.doc_id, r.item_id) for r in decontaminate.containment_pairs(odd, own).collect()}
    assert decontaminate.clean_documents(odd, own.where("item_id = 3")).count() == odd.count() - 2
    assert decontaminate.containment_pairs(empty, items).count() == 0 and decontaminate.clean_documents(docs, own.limit(0)).count() == docs.count()


def test_near_copies_share_a_class(spark, odd, empty):
    base = [f"w{i}" for i in range(120)]
    near = [[*base[:i], "x", *base[i + 1:]] for i in (10, 50, 90)]
    other = [f"v{i}" for i in range(120)]
    texts = [base, base, *near, other, [*base[:60], *other[60:]]]
    frame = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = {r.doc_id: r for r in near_dedup.classes(frame).collect()}
    assert {rows[i].class_id for i in range(5)} == {0} and rows[5].class_id == 5 and rows[6].class_id == 6
    assert [i for i, r in rows.items() if r.kept and i < 5] == [0] and rows[3].class_size == 5
    assert sorted(r.doc_id for r in near_dedup.one_per_class(frame).collect()) == [0, 5, 6]
    kept = near_dedup.one_per_class(odd)
    assert kept.columns == odd.columns and kept.count() == 6
    assert near_dedup.classes(empty).count() == 0


def test_language_held_out(docs, odd, empty):
    rows = language.predict(docs).toPandas().merge(docs.select("doc_id", "lang").toPandas(), on="doc_id")
    held = rows[rows["held_out"]]
    assert (held["lang"] == held["lang_pred"]).mean() > 0.95 and rows["score"].between(0, 1).all()
    assert {r.lang_pred for r in language.predict(odd).where("doc_id in (1, 2, 7)").collect()} == {"und"}
    assert language.predict(empty).count() == 0


def test_quality_held_out(docs, labels, odd, empty):
    rows = quality.score(docs, labels).toPandas().merge(labels.toPandas(), on="doc_id")
    held = rows[rows["held_out"]]
    assert ((held["score"] >= 0.3).astype(int) == held["quality"]).mean() > 0.75
    assert quality.score(odd, labels).count() == odd.count() and quality.score(empty, labels).count() == 0


def test_toxicity_and_spans_on_odd_rows(docs, labels, odd, empty, tagger):
    scored = toxicity.score_documents(docs, labels).toPandas().merge(labels.toPandas(), on="doc_id")
    assert (scored["rejected"] == (scored["toxic"] == 1)).mean() > 0.85
    assert toxicity.clean_documents(odd, labels).columns == odd.columns and toxicity.score_documents(empty, labels).count() == 0
    model = secrets.fit(empty)
    for frame, scan in ((odd, secrets.scan(odd, model)), (odd, pii.scan(odd, tagger))):
        rows = scan.collect()
        assert len(rows) == frame.count()
        assert all(r.base_sha256 == hashlib.sha256(b"").hexdigest() for r in rows)
    assert secrets.scan(empty, model).count() == 0 and pii.scan(empty, tagger).count() == 0


def test_secrets_fit_on_batches_without_strings(spark):
    rows = [(1, "plain words alone here"), (2, ""), (3, None), (4, "token: Zx81qPw0"), (5, "a b")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for part in (frame.where("doc_id = 1"), frame.where("doc_id = 2"), frame.where("doc_id = 3"), frame.repartition(5)):
        out = {r.doc_id: r for r in secrets.scan(part).collect()}
        assert len(out) == part.count()
        assert all(r.spans == ("assign:0:15" if i == 4 else "") for i, r in out.items())


def test_secret_base_digests_equal_plain_patterns(docs):
    def spans(text):
        found = [("assign", m.start(), m.end()) for m in re.finditer(
            r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A)
            if len(m[1]) >= 6]
        found += [("access", m.start(), m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        found += [("hex", m.start(), m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
        order = ["assign", "access", "hex"]
        return sorted(found, key=lambda s: (s[1], order.index(s[0])))

    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in secrets.scan(docs).collect():
        want = spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in want).encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == x for k, *_ in want) for x in ("assign", "access", "hex")]
        assert {f"{k}:{a}:{b}" for k, a, b in want} <= set(r.spans.split(",")) | {""}


def test_token_counts(docs, odd, empty):
    counter = token_counts.PrefixCounter.of(token_counts.model_path())
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in token_counts.count_documents(docs).collect():
        assert r.n_tokens == len(counter.model.encode(texts[r.doc_id])) and r.n_bytes == len(texts[r.doc_id].encode())
        assert len(counter.model.encode(texts[r.doc_id][:r.fit_chars])) <= token_counts.LIMIT
    assert token_counts.count_documents(odd).count() == odd.count() and token_counts.count_documents(empty).count() == 0
    asked = token_counts.tokens_within(token_counts.prefix_tables(docs), [10]).collect()
    assert all(len(counter.model.encode(texts[r.doc_id][:r.chars])) <= 10 for r in asked)


def test_pipeline_stages(spark, docs, empty):
    now, seen = docs, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.written(stage(spark, now, SF), f"test-{name}")
        if name != "packing":
            assert out.columns == docs.columns
        seen.append(out.count())
        before, now = now, out
    assert seen[0] > seen[1] > seen[2] > seen[3] == seen[4]
    assert before.select("doc_id").distinct().count() == now.select("doc_id").distinct().count()
    digits = Counter(c for r in before.collect() for k, a, b in pii.base_spans(r.text) for c in k)
    assert not digits
