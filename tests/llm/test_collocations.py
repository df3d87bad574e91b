import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pytest

from ringwatch.llm import collocations as C
from ringwatch.llm import wordblocks as B


def plain(rows, least=10, top=2000, inside=50):
    """Phrases by dictionaries, from (lang, text) rows."""
    out = []
    for lang in {x[0] or "und" for x in rows}:
        f, n = Counter(), 0
        for own, text in rows:
            if (own or "und") != lang:
                continue
            low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
            for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
                w = re.findall(r"[^\x20\x09]+", piece)
                n += len(w)
                f.update(tuple(w[i:i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        ranked = []
        for p, a in found.items():
            if any(len(q) > len(p) and 100 * b >= inside * a and p in (q[:2], q[1:]) for q, b in found.items()):
                continue
            cuts = [(1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            ranked.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, n, -s) for i, (s, a, p, left, right) in enumerate(sorted(ranked)[:top])]
    return sorted(out)


def corpus(seed, texts=60):
    r = random.Random(seed)
    vocabulary = ["New", "york", "city", "the", "of", "a", "été", "日本", "B52", "x\x1cy", " "]
    rows = []
    for i in range(texts):
        words = [r.choice(vocabulary) + r.choice(["", "", "", "", ".", ",", "\n", "!", " \t"]) for _ in range(r.randint(0, 120))]
        words[::7] = ["New York City"] * len(words[::7])
        rows.append((r.choice(["en", "de", None, "und"]), " ".join(words)))
    return rows + [("en", None), ("fr", ""), (None, " .,\t"), ("xx", "alone"), ("en", "z" * 300 + " " + "q" * 70_000)] + rows[:3] * 2


def frame(spark, rows, partitions=3):
    made = [(i, lang, text, i, "x" if i % 2 else None, i) for i, (lang, text) in enumerate(rows)]
    return spark.createDataFrame(made, "doc_id long, lang string, text string, id1 long, word string, rank long").repartition(partitions)


def got(df, **how):
    return sorted(tuple(r) for r in C.collocations(df, **how).collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_phrases_equal_the_definition(spark, seed):
    rows = corpus(seed)
    assert got(frame(spark, rows)) == plain(rows)


def test_blocks_buckets_and_waves_change_nothing(spark, monkeypatch):
    rows = corpus(3)
    monkeypatch.setattr(B, "BLOCK_WORDS", 300)
    monkeypatch.setattr(B, "BUCKET_WORDS", 6)
    monkeypatch.setattr(B, "BUCKET_PHRASES", 400)
    monkeypatch.setattr(C, "SLICE", 7)
    want = plain(rows, least=4, top=11, inside=80)
    assert want and got(frame(spark, rows, 5), least=4, top=11, inside=80, wave_phrases=9) == want


def test_nothing_frequent_and_empty_table(spark):
    assert got(frame(spark, [("en", "a b c"), (None, None)])) == []
    assert got(frame(spark, [("en", "a b")]).limit(0)) == []


def test_trie_accepts_its_phrases_alone():
    r = np.random.default_rng(5)
    for size, top, n in ((2, 9, 40), (3, 70_000, 30_000), (2, 300, 20_000), (2, 5, 1)):
        words = np.unique(1 + (top * r.random((n, size)) ** 3).astype(np.int64), axis=0)
        trie = C.Trie(words)
        assert len(set(trie.leaf.tolist())) == len(words) and trie.base.max() + 255 < len(trie.check)
        text = np.concatenate([words[r.permutation(len(words))[:200]].ravel(), r.integers(0, top + 5, 4000)])
        at, state = trie.accepted(trie.codes(text))
        place = {tuple(w): s for w, s in zip(words.tolist(), trie.leaf.tolist())}
        want = {i: place[p] for i in range(len(text) - size + 1) if (p := tuple(text[i:i + size].tolist())) in place}
        assert dict(zip(at.tolist(), state.tolist())) == want


def test_packing():
    r = np.random.default_rng(1)
    for top in (1, 2, 255, 256, 70_000, 1 << 62):
        v = r.integers(0, top, 100)
        assert (B.unpack(B.pack(v), 100) == v).all()
    assert len(B.unpack(B.pack(np.zeros(0, np.int64)))) == 0


@pytest.mark.parametrize("size", [2, 3])
def test_trie_takes_few_bytes_per_phrase(size):
    """The driver builds a trie of millions of phrases: few states and bytes for each, whatever their words."""
    r = np.random.default_rng(7)
    words = np.unique(1 + (400_000 * r.random((200_000, size)) ** 2).astype(np.int64), axis=0)
    tracemalloc.start()
    trie = C.Trie(words)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200 * len(words)
    assert len(trie.check) < 8 * len(words) and (trie.check >= 0).sum() <= 2 * len(words)
    near = words.copy()
    near[:, -1] += 1  # a unique prefix ends the path early; the rest of the phrase must still be the text's
    known = set(map(tuple, words.tolist()))
    at, state = trie.accepted(trie.codes(near.ravel()))
    aligned = {int(p) // size for p in at if p % size == 0}
    assert aligned == {i for i, p in enumerate(near.tolist()) if tuple(p) in known}


def test_marks_of_pairs_are_the_bits_of_their_hashes(spark, monkeypatch):
    monkeypatch.setattr(C, "MARKED", 7)
    a = np.unique(np.random.default_rng(3).integers(1, 1 << 40, 500).astype(np.uint64))
    rows = [(k, len(x), bytearray(B.pack(np.diff(x, prepend=np.uint64(0)))), bytearray(b"\0")) for k, x in enumerate(np.array_split(a, 3))]
    keys = spark.createDataFrame(rows[::-1], C._KEYS_DDL)
    assert [x[2:] for x in C.waves(keys, 400)] == [([0, 1], [167, 167]), ([2], [166])]  # whatever the order of the rows
    marks = C.pair_marks(keys, 300)
    bits = len(marks) * 8
    want = np.zeros(bits, bool)
    want[(B.mixed(a) % np.uint64(bits)).astype(np.int64)] = True
    assert (np.unpackbits(marks, bitorder="little").astype(bool) == want).all()
