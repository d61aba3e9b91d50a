"""Suffix order, byte-string and word-window removal against plain versions."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from saferow.llm import induced, suffixarray, suffixtree
from saferow.llm.induced import suffix_order
from saferow.llm.suffixtree import prefix_groups, subtree

from llm_data import EDGES, EMPTY


def plain_order(x):
    order = sorted(range(len(x)), key=lambda i: x[i:])
    common = [0]
    for i, j in zip(order, order[1:]):
        k = 0
        while k < len(x) - max(i, j) and x[i + k] == x[j + k]:
            k += 1
        common.append(k)
    return order, common


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=60), st.sampled_from([0, 8, 1000]), st.sampled_from([100, 1 << 20]))
def test_induced_order_and_prefixes(x, short, memory):
    order, common = suffix_order(np.array(x), 10 ** 6, memory, short)
    assert (order.tolist(), common.tolist()) == plain_order(x)


def test_induced_order_with_large_alphabet_and_spill():
    x = np.random.default_rng(2).integers(0, 700, 4000)
    order, common = suffix_order(x, 10 ** 6, 1000, 300)
    assert (order.tolist(), common.tolist()) == plain_order(x.tolist())


def test_the_names_of_a_shard_take_no_scans_of_their_own(monkeypatch):
    """A shard is put in order by one scan up and one down; its names, a third as many, by rank doubling."""
    scanned, scan = [], induced._scan
    monkeypatch.setattr(induced, "_scan", lambda text, *rest: scanned.append(len(text)) or scan(text, *rest))
    x = np.random.default_rng(3).integers(0, 30, suffixarray.SHARD_BYTES)
    order, common = suffix_order(x, suffixarray.LENGTH)
    assert scanned == [len(x) + 1] * 2
    at = np.arange(0, len(x) - 1, 997)
    for i, j, k in zip(order[at].tolist(), order[at + 1].tolist(), common[at + 1].tolist()):
        a, b = x[i:i + 40].tolist(), x[j:j + 40].tolist()
        assert a < b and a[:k] == b[:k] and a[k:k + 1] != b[k:k + 1]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=6, max_size=80), st.integers(1, 20), st.integers(1, 50))
def test_subtrees(x, limit, read):
    text, depth = np.array(x), 5
    seen = []
    for group in prefix_groups(text, np.arange(len(x) - depth + 1), depth, limit):
        order, common = subtree(text, group, depth, read)
        words = [tuple(x[i:i + depth]) for i in order]
        assert words == sorted(words)
        for a, b, c in zip(words, words[1:], common[1:]):
            assert c == next((k for k in range(depth) if a[k] != b[k]), depth)
        seen += order.tolist()
    assert sorted(seen) == list(range(len(x) - depth + 1))


def plain_bytes(texts, size):
    seen, raw = defaultdict(int), [(t or "").encode() for t in texts]
    for x in raw:
        for i in range(len(x) - size + 1):
            seen[x[i:i + size]] += 1
    out = []
    for x in raw:
        gone = bytearray(len(x))
        for i in range(len(x) - size + 1):
            if seen[x[i:i + size]] > 1:
                gone[i:i + size] = b"\1" * size
        runs = len(re.findall(b"\1+", bytes(gone)))
        out.append((len(x), sum(gone), runs, hashlib.sha256(bytes(c for c, g in zip(x, gone) if not g)).hexdigest()))
    return out


def plain_words(rows, size):
    least, split = {}, [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    ids = [float("inf") if i is None else i for i, _ in rows]
    for d, w in zip(ids, split):
        for i in range(len(w) - size + 1):
            k = tuple(w[i:i + size])
            least[k] = min(least.get(k, d), d)
    out = []
    for d, w in zip(ids, split):
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if least[tuple(w[i:i + size])] < d:
                gone[i:i + size] = [True] * size
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def made_texts(seed):
    """Random words of few kinds with shared passages at many places, copies and runs."""
    rng = np.random.default_rng(seed)
    vocab = ["é", "b", "cc", "dé", "e", "ff", "the", "of"]
    passage = [" ".join(rng.choice(vocab, 40)) for _ in range(3)]
    texts = []
    for _ in range(60):
        part = [" ".join(rng.choice(vocab, int(rng.integers(0, 25)))), passage[int(rng.integers(3))][int(rng.integers(20)):],
                " ".join(rng.choice(vocab, int(rng.integers(0, 25))))]
        texts.append(" ".join(part))
    return [*texts, texts[0], texts[0], "aa " * 60, "aa " * 60 + "b", "", None]


@pytest.mark.parametrize("options", [{}, {"max_group": 3, "shard_bytes": 2000}])
def test_byte_strings(frame, options):
    texts = made_texts(1)
    docs = frame([*((i, t) for i, t in enumerate(texts))])
    got = suffixarray.deduplicate(docs, 24, 8, **options).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in got] == plain_bytes(texts, 24)


@pytest.mark.parametrize("options", [{}, {"max_group": 3, "shard_bytes": 2000, "group_suffixes": 20}])
def test_word_windows(frame, options):
    rows = list(enumerate(made_texts(2)))
    rows += [(5, rows[7][1]), (None, rows[9][1]), (70, rows[3][1]), (70, rows[3][1])]
    got = suffixtree.deduplicate(frame(rows), 8, 3, **options).collect()
    want = Counter((r[0], *w) for r, w in zip(rows, plain_words(rows, 8)))
    assert Counter(tuple(r) for r in got) == want


def test_edges(frame):
    for module, size, k in ((suffixarray, 24, 8), (suffixtree, 6, 2)):
        assert module.deduplicate(frame(EMPTY), size, k).count() == 0
        got = module.deduplicate(frame(EDGES), size, k).collect()
        plain = plain_bytes([r[1] for r in EDGES], size) if module is suffixarray else \
            plain_words([r[:2] for r in EDGES], size)
        assert Counter(tuple(r) for r in got) == Counter((r[0], *w) for r, w in zip(EDGES, plain))


def test_long_texts_are_cut_without_loss(frame, monkeypatch):
    from saferow.llm import anchors

    monkeypatch.setattr(anchors, "PIECE", 100)
    texts = made_texts(3)
    at, off = np.concatenate([[0], np.cumsum([len((t or "").encode()) for t in texts])]), None
    raw = np.frombuffer("".join(t or "" for t in texts).encode(), np.uint8)
    from saferow.llm.common import BYTE_KEY

    whole = anchors.stretches(BYTE_KEY[raw], at, 24, 8)
    windows = {(int(r), int(s) + j) for r, s, n in zip(*whole[:3]) for j in range(n)}
    cut = set()
    for base, off, place in anchors.pieces(at, 23, 100):
        got = anchors.stretches(BYTE_KEY[raw[base:base + int(off[-1] - off[0])]], off - off[0], 24, 8)
        cut |= {(int(place[r, 0]), int(place[r, 1] + s) + j) for r, s, n in zip(*got[:3]) for j in range(n)}
    assert cut == windows


@pytest.mark.parametrize("module, size, k, plain", [(suffixarray, 24, 8, plain_bytes), (suffixtree, 8, 3, plain_words)])
def test_no_group_stays_large(frame, monkeypatch, module, size, k, plain):
    """One passage inside many documents with other surroundings: its windows are equal, its stretches are not."""
    rng, real, seen = np.random.default_rng(5), module.divided, []
    passage = " ".join(f"p{i}" for i in range(30))
    texts = [" ".join([*map(str, rng.integers(10 ** 6, size=9)), passage, *map(str, rng.integers(10 ** 6, size=9))])
             for _ in range(40)]
    rows = [*enumerate(texts), (7, texts[30] + " z"), (7, "y " + texts[31]), (None, "x " + passage + " x")]

    def watched(*args):
        out = real(*args)
        seen.append(out[0] if isinstance(out, tuple) else out)
        return out

    monkeypatch.setattr(module, "divided", watched)
    got = module.deduplicate(frame(rows), size, k, max_group=4).collect()
    if plain is plain_bytes:
        want = Counter((i, *w) for (i, _), w in zip(rows, plain([t for _, t in rows], size)))
    else:
        want = Counter((i, *w) for (i, _), w in zip(rows, plain(rows, size)))
    assert Counter(tuple(r) for r in got) == want
    assert max(r["count"] for r in seen[0].groupBy("anchor").count().collect()) <= 4
