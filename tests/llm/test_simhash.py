import random

import numpy as np
import xxhash

from ringwatch.llm import simhash as S
from tests.llm.fixtures import corner, docs, prose  # noqa: F401


def plain(text, k=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words, word = [], ""
    for c in low + " ":
        if c in " \t\n\x0b\x0c\r":
            if word:
                words.append(word)
            word = ""
        else:
            word += c
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] if len(words) >= k else [" ".join(words)]
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(fps):
    fps = sorted(set(fps))
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[i + 1:]:
            if bin(a ^ b).count("1") <= 4:
                root[find(b)] = find(a)
    return {f: find(f) for f in fps}


def test_fingerprint_follows_the_definition():
    for t in ["", " \n", "a", "A b", "a b c d", "Ä É x y z A", prose(3, 200), "x " * 50, "no break \x1c here", "日本 語 a b c"]:
        assert S.fingerprint(t) == plain(t), t
    assert S.fingerprint(prose(4, 9), 3) == plain(prose(4, 9), 3)


def test_ball():
    assert S.ball_size(64, 2) == 2081 == len(S._masks(64, 2)) == len(set(S._masks(64, 2).tolist()))


def test_links_find_every_pair_at_every_prefix_width(spark, monkeypatch):
    r = random.Random(7)
    base = [r.getrandbits(64) for _ in range(60)]
    fps = set(base)
    for b in base[:40]:
        x = b
        for _ in range(r.randint(1, 6)):
            for bit in r.sample(range(64), r.randint(1, 5)):
                x ^= 1 << bit
            fps.add(x)
    fps |= {0, 1, (1 << 64) - 1, 1 << 63, 0b11111}
    want = groups(fps)
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    for bits in (0, 3, 7):
        monkeypatch.setattr(S, "prefix_bits", lambda n, half, bits=bits: bits)
        tree = {r.node: r.root for r in S.components(S.written(S.links(df, len(fps)), "t")).collect()}
        got = {}
        for f in fps:
            signed = f - (1 << 64) if f >> 63 else f
            got.setdefault(tree.get(signed, signed), set()).add(f)
        assert sorted(map(sorted, got.values())) == sorted(
            sorted(f for f in fps if want[f] == g) for g in set(want.values()))


def test_longer_prefixes_spell_each_variant_once(spark):
    """Growing a prefix deals its variants out: the same set, none twice."""
    r = np.random.default_rng(5)
    fps = [int(x) for x in r.integers(-(1 << 63), 1 << 63, 12)]
    rows = spark.createDataFrame([(f, 0, 0) for f in fps], "fp long, flips int, prefix long")

    def variants(rows, bits):
        out = []
        for x in rows.collect():
            low = (x.fp % (1 << 64)) & ((1 << 64 - bits) - 1)
            out += [(x.fp, ((x.prefix % (1 << 64)) << 64 - bits) | (low ^ int(m))) for m in S._masks(64 - bits, 2 - x.flips)]
        return sorted(out)

    want = variants(rows, 0)
    assert len(want) == 12 * 2081
    bits = 0
    for step in (3, 4, 4, 49, 4):
        rows, bits = S.deeper(rows, bits, step, 2), bits + step
        assert variants(rows, bits) == want
    assert bits == 64


def test_crowded_prefixes_down_to_single_variants(spark, monkeypatch):
    """So low a bound that prefixes grow to all 64 bits: the links are still those of all pairs."""
    monkeypatch.setattr(S, "PREFIX_VARIANTS", 2)
    monkeypatch.setattr(S, "MAX_PREFIX_BITS", 4)
    monkeypatch.setattr(S, "DEEPER_BITS", 20)
    r = np.random.default_rng(6)
    centre = int(r.integers(0, 1 << 63))
    fps = {centre ^ sum(1 << int(b) for b in r.integers(0, 63, r.integers(0, 6))) for _ in range(60)}
    fps |= {int(x) for x in r.integers(0, 1 << 63, 20)}
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    tree = {r.node: r.root for r in S.components(S.written(S.links(df, len(fps)), "t")).collect()}
    label = groups(fps)
    parts = {}
    for f in fps:
        parts.setdefault(label[f], set()).add(f)
    found = {}
    for f in fps:
        found.setdefault(tree.get(f, f), set()).add(f)
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, parts.values()))


def test_crowded_prefixes_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(S, "PREFIX_VARIANTS", 3000)
    monkeypatch.setattr(S, "MAX_PREFIX_BITS", 2)
    fps = list(range(1, 60))
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    tree = {r.node: r.root for r in S.components(S.written(S.links(df, len(fps)), "t")).collect()}
    assert set(tree) == set(fps) and len(set(tree.values())) == 1


def test_chain_of_links_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(100, 160)] + [(7, 9)], "a long, b long")
    tree = {r.node: r.root for r in S.components(edges).collect()}
    assert {tree[i] for i in range(100, 161)} == {100} and tree[9] == tree[7] == 7


def test_documents(corner):
    df, pairs = corner
    rows = S.simhash_components(df).collect()
    assert len(rows) == len(pairs)
    fp = {r.fingerprint for r in rows}
    assert fp == {f"{plain(t or ''):016x}" for _, t in pairs if len(t or "") < 10_000} | {f"{S.fingerprint(t):016x}" for _, t in pairs if len(t or "") >= 10_000}
    label = groups(int(f, 16) for f in fp)
    least = {}
    for r in rows:
        if r.doc_id is not None:
            k = label[int(r.fingerprint, 16)]
            least[k] = min(least.get(k, r.doc_id), r.doc_id)
    assert all(r.component_id == least.get(label[int(r.fingerprint, 16)]) for r in rows)


def test_drop_keeps_one_of_each_group(corner, docs):
    df, _ = corner
    out = S.drop_near_copies(df)
    assert out.columns == df.columns
    ids = [r.doc_id for r in out.collect()]
    assert ids.count(-3) == 1 and 5 not in ids and 6 not in ids and 1 in ids and 2 not in ids and ids.count(None) == 1  # the null text is a copy of 1
    assert [r.doc_id for r in S.drop_near_copies(docs([(5, "a b c d e"), (5, "a b c d e")])).collect()] == [5]
    assert S.drop_near_copies(docs([])).count() == 0 and S.simhash_components(docs([])).count() == 0


def test_repeated_and_null_ids_lose_no_document(docs):
    """One row per component, though ids repeat over components or are missing."""
    a, z, y = prose(61, 90), prose(62, 90), prose(63, 90)
    rows = [(7, a), (7, z), (8, a), (9, z + " tail"), (None, y), (None, y), (None, a), (7, z)]
    got = sorted((str(r.doc_id), r.text) for r in S.drop_near_copies(docs(rows)).collect())
    assert got == sorted([("7", a), ("7", z), ("None", y)])
