"""The operators' numpy and pure-Python parts against brute force."""

import random
import zlib

import numpy as np
import pytest

from gridledger.llm import bilstm_crf, decontaminate, language, near_dedup, packing, pii, secrets, token_counts, toxicity, wordhash
from gridledger.llm.alignment import banded_distance, trimmed


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j + 1] + 1, new[j] + 1, row[j] + (x != y)))
        row = new
    return row[-1]


def test_banded_distance_is_levenshtein_within_the_band():
    r = random.Random(0)
    for _ in range(4000):
        a, b = ([r.randrange(4) for _ in range(r.randint(0, 12))] for _ in range(2))
        band, d = r.randint(0, 14), levenshtein(a, b)
        assert banded_distance(a, b, band) == (d if d <= band else band + 1)
        x, y = trimmed(np.array(a, dtype=int), np.array(b, dtype=int))
        assert levenshtein(list(x), list(y)) == d


def test_word_hashes_match_words_also_across_blocks(monkeypatch):
    text = "The cat, the CAT_1; naïve été 日本 x" * 50
    whole = wordhash.text_hashes(text)
    names = wordhash.words(text)
    assert len(whole) == len(names) and len(set(whole.tolist())) == len(set(names))
    monkeypatch.setattr(wordhash, "BLOCK_BYTES", 64)
    assert (wordhash.text_hashes(text) == whole).all()
    assert len(wordhash.text_hashes(None)) == 0 and len(wordhash.shingle_hashes(whole[:3], 5)) == 1


def test_edges_of_base_secret_patterns():
    found = secrets.base_spans("secret=token: abcdef12 API_KEY = 'abcdef' AKIA" + "A" * 15 + " AKIA" + "B" * 16 + " " + "a1" * 12)
    assert [k for k, _, _ in found] == ["assign", "access", "hex"]
    model = secrets.train(*map(secrets.pair_counts, secrets.generated_tokens()))
    assert model.is_secret("ghp_aB3dE5fG7hI9jK1lM3nO5pQ7rS9tU1vW3xY")
    assert not model.is_secret("get_user_name_by_id_2") and not model.is_secret("1234567890123456")


def test_edges_of_base_pii_patterns():
    kinds = lambda t: [(k, t[a:b]) for k, a, b in pii.base_spans(t)]
    assert kinds("x a@b.c@d.e y") == [("email", "a@b.c")]
    assert kinds("1.2.3.4.5.6.7.8 256.1.1.1 007.0.0.1") == [("ip", "1.2.3.4"), ("ip", "5.6.7.8"), ("ip", "007.0.0.1")]
    assert kinds("4111 1111 1111 1111, 4111 1111 1111 1112") == [("card", "4111 1111 1111 1111")]
    assert kinds("+1 (555) 123-4567 +1 2") == [("phone", "+1 (555) 123-4567")]
    assert pii.redact_text("x a@b.c y", pii.base_spans("x a@b.c y")) == "x [EMAIL] y"


def test_tagger_gradients_and_windows():
    rng = np.random.default_rng(0)
    t = bilstm_crf.Tagger(6, 4, 3, 1)
    x, y = rng.integers(0, 6, (2, 5)), rng.integers(0, 4, (2, 5))
    grads = t.loss_and_grads(x, y)[1]
    for k, p in t.p.items():
        at = tuple(int(rng.integers(0, s)) for s in p.shape)
        old, e = p[at], 1e-5
        p[at] = old + e
        up = t.loss_and_grads(x, y)[0]
        p[at] = old - e
        down = t.loss_and_grads(x, y)[0]
        p[at] = old
        assert abs((up - down) / 2 / e - grads[k][at]) < 1e-6
    text = "a" * 300 + "5" + "b" * 200
    starts = pii.window_starts(text)
    assert starts and all(s <= 300 < s + pii.WINDOW for s in starts) and len(starts) >= 2


def test_minimum_bin_slack_finds_the_fullest_bin():
    r = random.Random(1)
    for _ in range(200):
        counts = {r.randint(1, 20): r.randint(1, 3) for _ in range(r.randint(1, 5))}
        sums = {0}
        for length, n in counts.items():
            sums = {s + k * length for s in sums for k in range(n + 1) if s + k * length <= 20}
        assert sum(a * b for a, b in packing.fullest(sorted(counts), counts, 20)) == max(sums)
        plan = packing.plan_bins(counts, 20)
        assert plan.bins >= -(-sum(a * b for a, b in counts.items()) // 20)


def test_encoder_gives_the_ids_of_the_library():
    tokenizers = pytest.importorskip("tokenizers")
    path = packing.tokenizer_path()
    library, ours, r = tokenizers.Tokenizer.from_file(path), packing.Encoder.of(path), random.Random(2)
    parts = [*"ab 1.\n\t'ñ  é世 !<|>", "<|endoftext|>", "'re ", "  ", "\r\n", "\x85"]
    for _ in range(2000):
        t = "".join(r.choices(parts, k=r.randint(0, 14)))
        assert np.frombuffer(ours.ids(t), dtype="<u4").tolist() == library.encode(t, add_special_tokens=False).ids


def test_prefix_counts_are_the_library_counts():
    counter, r = token_counts.PrefixCounter.of(token_counts.model_path()), random.Random(3)
    parts = [*"abcdeth in 1.2\n\t'ñ é世!<|>▁²", "the", "ing", "<s>", "</s>", "<0x0A>", "    ", "\x00", "😀", "ﬁ"]
    for _ in range(800):
        t = "".join(r.choices(parts, k=r.randint(0, 16)))
        assert counter.prefix_counts(t).tolist() == [len(counter.model.encode(t[:i])) for i in range(len(t) + 1)]
        for budget in (0, 3, 100):
            n = counter.fits(t, budget)
            assert len(counter.model.encode(t[:n])) <= budget


def test_cross_parsing_counts_greedy_phrases():
    r = random.Random(4)
    train = {"a": "".join(r.choices("abc ", k=200)), "b": "".join(r.choices("abd ", k=200))}
    parser = language.CrossParser(train)

    def greedy(source, text):
        i = n = 0
        while i < len(text):
            j = i + 1
            while j < len(text) and text[i:j + 1] in source:
                j += 1
            i, n = j, n + 1
        return n

    for _ in range(200):
        t = "".join(r.choices("abcdx ", k=r.randint(1, 60)))
        assert parser.phrases([t])[0].tolist() == [greedy(train["a"], t), greedy(train["b"], t)]
    assert parser.predict([None, "", "12 !"]) == [("und", 0.0)] * 3


def test_sketches_keep_order_and_occurrences():
    w = wordhash.text_hashes(" ".join(f"w{i}" for i in range(400)))
    assert (near_dedup.sketch(w) == near_dedup.sketch(w.copy())).all()
    assert (near_dedup.sketch(w) != near_dedup.sketch(np.concatenate([w[200:], w[:200]]))).mean() > 0.3
    same = wordhash.text_hashes("again " * 40)
    assert len(set(near_dedup.labelled_kmers(same).tolist())) == 36
    assert len(near_dedup.sketch(w[:0])) == 0 and len(near_dedup.sketch(w[:2])) == near_dedup.SKETCHES


def test_near_copies_meet_in_a_bucket():
    """Recall of the buckets by band of edit similarity, over pairs that alignment says are similar."""
    rng = np.random.default_rng(8)
    word = lambda: int(rng.integers(1, 2**60))
    for n, floor in ((6, 1.0), (10, 1.0), (14, 1.0), (20, 0.9), (60, 0.95), (300, 0.95)):
        for low in (0.8, 0.85, 0.9):
            met = []
            for _ in range(60):
                a = [word() for _ in range(n)]
                b = list(a)
                for _ in range(near_dedup.most_edits(n, low)):
                    kind, at = rng.integers(3), int(rng.integers(len(b)))
                    b[at:at + (kind < 2)] = [word()] if kind else []
                x, y = np.array(a, dtype=np.uint64), np.array(b, dtype=np.uint64)
                if near_dedup.linked(x, y, near_dedup.SIMILARITY):
                    assert near_dedup.share_enough(x, y, near_dedup.SIMILARITY)
                    met.append(bool(np.intersect1d(near_dedup.bucket_keys(x), near_dedup.bucket_keys(y)).size))
            assert len(met) > 40 and np.mean(met) >= floor, (n, low, np.mean(met))


def test_needed_minima_keep_recall():
    r = np.random.default_rng(5)
    item = r.integers(0, 2**63, 60).astype(np.uint64)
    for _ in range(300):
        m = decontaminate.minima(item, decontaminate.permutations_of(decontaminate.size_partition(60)))
        doc = r.choice(item, 48, replace=False)
        assert np.isin(m, doc).sum() >= decontaminate.needed(len(m))


def test_chain_feeds_earlier_categories_to_later_ones():
    r = random.Random(6)
    texts = [" ".join(r.choices(["red", "blue", "green", "grey"], k=12)) + (" vile" if i % 4 == 0 else "") + (" foul" if i % 8 == 0 else "")
             for i in range(400)]
    rows = [toxicity.text_features(t) for t in texts]
    y = {"worst": np.array([i % 8 == 0 for i in range(400)]), "toxic": np.array([i % 4 == 0 for i in range(400)])}
    chain = toxicity.fit(rows, y, np.array([zlib.crc32(str(i).encode()) % 4 for i in range(400)]))
    p = chain.predict(["red blue vile foul", "red vile", "green", None])
    assert len(chain.weights[1]) == len(chain.weights[0]) + 1
    assert (p[:, 1] >= 0.5).tolist() == [True, True, False, False] and p[0, 0] > 0.5 > p[1, 0]
