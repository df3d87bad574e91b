import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from ringwatch.llm import periodic_runs as P
from tests.llm.fixtures import corner, docs, prose  # noqa: F401


def plain_runs(w, least=12):
    """(start, length, period) by the definition: every lag, every stretch, smallest periods only."""
    out = []
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            if length >= max(least, 2 * q) and not any(w[i:i + length - p] == w[i + p:i + length] for p in range(1, q)):
                out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_report(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = plain_runs(words)
    gone = {i for s, x, q in found for i in range(s + q, s + x)}
    top = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None,) * 3
    sha = [hashlib.sha256(t.encode()).hexdigest() for t in (
        "".join(f"{s},{x},{q}\n" for s, x, q in found), " ".join(w for i, w in enumerate(words) if i not in gone))]
    return (doc_id, len(found), *top, 1000 * top[1] // top[2] if found else None, *sha)


def some_words(r):
    k, n = r.choice([1, 2, 2, 3, 4, 8, 50]), r.randint(0, 150)
    w = [str(r.randrange(k)) for _ in range(n)]
    for _ in range(r.randint(0, 4) if n > 5 else 0):
        a = r.randrange(n)
        p = r.randint(1, max(1, (n - a) // 2))
        for i in range(a, min(n, a + r.randint(p, max(p, n - a)))):
            w[i] = w[a + (i - a) % p]
    return w


@pytest.mark.parametrize("rounds", [64, 0, 1])
def test_runs_equal_the_definition(monkeypatch, rounds):
    monkeypatch.setattr(P, "SPLITS", rounds)
    r = random.Random(rounds)
    for _ in range(25):
        texts = [some_words(r) for _ in range(20)]
        for words, (start, length, period) in zip(texts, P.batch_runs(texts)):
            assert list(zip(start.tolist(), length.tolist(), period.tolist())) == plain_runs(words), words


def test_splitting_keeps_only_what_may_repeat():
    words = "a b c d e f g h i j k l x a b c d e f g h i j k l".split()
    code = np.array([words.index(w) for w in words])
    assert len(P.split(code, np.zeros(len(code), np.int64))[0]) == 0  # x splits; in either part all words are rare
    double = ["u", "v", "w"] * 6
    code = np.array([["u", "v", "w", "y"].index(w) for w in ["y", *double]])
    assert P.split(code, np.zeros(len(code), np.int64))[0].tolist() == list(range(1, 19))


def test_long_texts_of_few_words():
    """Lags of any size, in texts where splitting helps nothing."""
    r = random.Random(9)
    half = [str(r.randrange(300)) for _ in range(40_000)]
    (start, length, period), = P.batch_runs([half + half])
    assert (start.tolist(), length.tolist(), period.tolist()) == ([0], [80_000], [40_000])
    (start, length, period), = P.batch_runs([["a"] * 300_000])
    assert (start.tolist(), length.tolist(), period.tolist()) == ([0], [300_000], [1])
    (start, length, period), = P.batch_runs([(["a"] * 999 + ["b"]) * 50])
    assert len(start) == 51 and sorted(period.tolist())[-1] == 1000


def test_report(spark, corner):
    df, pairs = corner
    got = [tuple(r) for r in P.run_report(df).collect()]
    want = [plain_report(i, t) for i, t in pairs if len(t or "") < 20_000]
    assert len(got) == len(pairs)
    assert sorted(map(str, (g for g in got if g[0] not in (4, 9)))) == sorted(map(str, want))


def test_report_on_planted_repeats(spark, docs):
    ids = [i for i in range(4000) if zlib.crc32(str(i).encode()) % 10 == 0][:40]
    pairs = [(i, prose(i, 1 + 7 * k)) for k, i in enumerate(ids)] + [(ids[0], "one two"), (ids[1], "")]
    got = [tuple(r) for r in P.run_report(docs(pairs)).collect()]
    assert sorted(map(str, got)) == sorted(str(plain_report(*p)) for p in pairs)
    assert sum(g[1] > 0 for g in got) > 25  # the shortest texts have room for no run


def test_texts_come_back_without_repeats(spark, docs):
    verse = "so we go round and round again my friend till the morning breaks at last"
    df = docs([(1, f"start {verse} {verse} {verse} end"), (2, verse), (3, None)])
    rows = {r.doc_id: r for r in P.periodic_runs(df).collect()}
    assert rows[1].collapsed == f"start {verse} end" and rows[1].periods == [15] and rows[1].starts == [1]
    assert rows[2].collapsed == verse and rows[3].collapsed == "" and rows[3].lengths == []


def test_empty_table(docs):
    assert P.run_report(docs([])).count() == 0 and P.periodic_runs(docs([])).count() == 0
