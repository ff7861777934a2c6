"""Tokenizer alignment: merge path against all pairs, blocks against one table, the whole query against brute force."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from gridledger.llm import mergepath
from gridledger.llm.packing import tokenizer_path


def brute(a, b):
    """Overlaps of all pairs of ranges, and the groups between shared ends."""
    starts_a, starts_b = [0, *a[:-1]], [0, *b[:-1]]
    links = [(i, j) for i in range(len(a)) for j in range(len(b)) if starts_a[i] < b[j] and starts_b[j] < a[i]]
    shared = sorted(set(a) & set(b))
    return links, [sum(s < e for s in shared) for e in a], [sum(s < e for s in shared) for e in b], len(shared)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=25), st.lists(st.integers(1, 40), max_size=25), st.integers(1, 9))
def test_pieces_give_all_overlaps(xs, ys, work):
    top = max([0, *xs, *ys]) + 1
    a, b = sorted({*xs, top}), sorted({*ys, top})
    got = mergepath.align(np.array(a), np.array(b), work)
    links, group_a, group_b, groups = brute(a, b)
    assert list(zip(got.a.tolist(), got.b.tolist())) == links
    assert got.group_a.tolist() == group_a and got.group_b.tolist() == group_b and got.groups == groups
    pieces = mergepath.path_pieces(np.array(a), np.array(b), work)
    assert all(k - i + m - j == work for i, k, j, m in pieces[:-1])                    # equal work


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 2 ** 62), max_size=30))
def test_varints_round_trip(values):
    data, ends = mergepath.varints(np.array(values, dtype=np.int64))
    assert mergepath.from_varints(data).tolist() == values and len(ends) == len(values)


def by_hand(rows):
    """The contract, token by token, with the libraries themselves."""
    spec = Tokenizer.from_file(tokenizer_path(mergepath.TOKENIZER_A))
    spec.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(mergepath.TOKENIZER_B))
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    to_byte = {chr(c): c for c in visible} | {chr(256 + i): c for i, c in enumerate(c for c in range(256) if c not in visible)}

    def bytes_b(i):
        p = model.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode()

    docs = []
    for doc_id, text in rows:
        if not text:
            docs.append((doc_id, None))
            continue
        a = spec.encode(" " + text, add_special_tokens=False).ids
        b = model.encode(text)
        raw_a = [bytes(to_byte[c] for c in spec.id_to_token(i)) for i in a]
        raw_b = [bytes_b(i) for i in b]
        if b"".join(raw_a) != (" " + text).encode() or b"".join(raw_b) != (" " + text).encode():
            docs.append((doc_id, None))
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in raw_a]).tolist(), np.cumsum([len(x) for x in raw_b]).tolist()
        links, group_a, group_b, groups = [], [], [], 0
        i = j = 0
        while i < len(a) and j < len(b):
            links.append((a[i], b[j]))
            x, y = ends_a[i], ends_b[j]
            if x <= y:
                group_a.append(groups)
                i += 1
            if y <= x:
                group_b.append(groups)
                j += 1
            groups += x == y
        parts = [",".join(str(v) for v, g in zip(a, group_a) if g == k) + "|" + ",".join(str(v) for v, g in zip(b, group_b) if g == k)
                 for k in range(groups)] if len(a) < 400 else None
        docs.append((doc_id, len(a), len(b), groups, links, None if parts is None else hashlib.sha256(";".join(parts).encode()).hexdigest()))
    held = Counter(p for d in docs if d[1] is not None for p in set(d[4]))
    top = defaultdict(int)
    for (x, _), n in held.items():
        top[x] = max(top[x], n)
    out = []
    for d in docs:
        if d[1] is None:
            out.append((d[0], 0, 0, 0, 0, 0, 0, ""))
        else:
            out.append((*d[:4], len(d[4]), sum(held[p] == top[p[0]] for p in d[4]), sum(held[p] for p in d[4]), d[5]))
    return out


@pytest.mark.parametrize("options", [{}, {"work": 50, "block_links": 5000}])
def test_query_equals_brute_force(docs, options):
    want = {r[0]: r for r in by_hand([(r.doc_id, r.text) for r in docs.collect()])}
    got = mergepath.align_documents(docs, **options).collect()
    assert len(got) == len(want) and sum(r.n_links > 0 for r in got) > 150
    for r in got:
        row = tuple(r)
        w = want[r.doc_id]
        assert row[:7] == w[:7] and (w[7] is None or row[7] == w[7])


def test_odd_rows(spark, odd, empty):
    assert mergepath.align_documents(empty).count() == 0
    rows = [(r.doc_id, r.text) for r in odd.collect() if r.doc_id not in (4, 5)]
    frame = odd.where("doc_id is null or doc_id not in (4, 5)")
    got = [tuple(r) for r in mergepath.align_documents(frame.repartition(3)).collect()]
    assert sorted(got, key=str) == sorted(by_hand(rows), key=str)
    special = spark.createDataFrame([(1, "a <|endoftext|> <s> b c  d \x01 ▁ e"), (2, " lead"), (3, "tab\tend\n\n"), (4, "日本語 🙂")],
                                    "doc_id long, text string")
    got = [tuple(r) for r in mergepath.align_documents(special).collect()]
    assert sorted(got, key=str) == sorted(by_hand([tuple(r) for r in special.collect()]), key=str)
    long = mergepath.align_documents(odd.where("doc_id in (4, 5)"), work=1000).collect()
    assert len({tuple(r)[1:] for r in long}) == 1 and long[0].n_links > 20_000
