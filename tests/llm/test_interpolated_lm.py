import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from ringwatch.llm import interpolated_lm as M
from ringwatch.llm import wordblocks as B
from tests.llm.fixtures import corner, docs, prose  # noqa: F401


def words_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low) + ["</end>\n"]


def fold_of(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7


def plain_model(pairs):
    """{(doc_id, text): row} by dictionaries: counts, deleted folds, expectation maximisation, scores."""
    texts = [(i, fold_of(i), words_of(t)) for i, t in pairs]
    uni, bi = defaultdict(Counter), defaultdict(Counter)
    for _, f, w in texts:
        uni[f].update(w)
        bi[f].update(zip(["</end>\n"] + w, w))
    folds = [f for f in uni if f != 2]
    c1, c2 = sum((uni[f] for f in folds), Counter()), sum((bi[f] for f in folds), Counter())
    N, V = sum(c1.values()), len(c1)
    cells = defaultdict(lambda: [0, 0.0, 0.0])
    for f in folds:
        rest = N - sum(uni[f].values())
        for (v, w), n in bi[f].items():
            pair, context, word = c2[v, w] - bi[f][v, w], c1[v] - uni[f][v], c1[w] - uni[f][w]
            l2 = math.log2(pair / context) if pair else None
            l1 = math.log2(word / rest) if word else None
            bucket = context.bit_length()
            cell = cells[bucket, None if l2 is None else math.floor(l2 * 16 + 1e-9), None if l1 is None else math.floor(l1 * 16 + 1e-9)]
            cell[0] += n
            cell[1] += n * (l2 or 0)
            cell[2] += n * (l1 or 0)
    lam, before = {}, None
    for b in range(66):
        rows = [(n, 2 ** (s2 / n) if q2 is not None else 0, 2 ** (s1 / n) if q1 is not None else 0)
                for (k, q2, q1), (n, s2, s1) in cells.items() if k == b]
        use = [float(b > 0), 1.0, 1.0]
        x = [u / sum(use) for u in use]
        if not rows and b > 1:
            x = lam[b - 1]
        total = sum(r[0] for r in rows)
        for _ in range(200 if rows else 0):
            new = [0.0] * 3
            for n, e2, e1 in rows:
                parts = [x[0] * e2, x[1] * e1, x[2] / (V + 1)]
                for k in range(3):
                    new[k] += n / total * parts[k] / sum(parts)
            moved = max(abs(p - q) for p, q in zip(new, x))
            x = new
            if moved < 1e-9:
                break
        if rows:
            x = [p + 1e-6 * u for p, u in zip(x, use)]
            x = [p / sum(x) for p in x]
        lam[b] = x
    out = []
    for i, f, w in texts:
        base = sum(math.log10((c1[x] + 1) / (N + V + 1)) for x in w)
        score = 0.0
        for v, x in zip(["</end>\n"] + w, w):
            l2, l1, l0 = lam[c1[v].bit_length()]
            score += math.log10(l2 * c2[v, x] / max(c1[v], 1) + l1 * c1[x] / max(N, 1) + l0 / (V + 1)) if N else 0.0
        out.append((i, f == 2, len(w), sum(c1[x] > 0 for x in w), N, base, score))
    return out


def key(row):
    return (str(row[0]), row[2], row[3], round(row[5], 6))


def compare(df, pairs):
    got = sorted((tuple(r) for r in M.scores(df).collect()), key=key)
    want = sorted(plain_model(pairs), key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert g[5] == pytest.approx(w[5], rel=1e-12, abs=1e-12) and g[6] == pytest.approx(w[6], rel=1e-5, abs=1e-9), (g, w)
    return got


def test_scores_equal_the_plain_model(spark, docs, monkeypatch):
    r = random.Random(4)
    pairs = [(i, " ".join(f"{'Ab'[i % 2]}{min(int(r.expovariate(0.2)), 40)}" for _ in range(r.randint(0, 120)))) for i in range(150)]
    whole = compare(docs(pairs), pairs)
    monkeypatch.setattr(B, "BLOCK_WORDS", 200)
    monkeypatch.setattr(B, "BUCKET_PHRASES", 300)
    monkeypatch.setattr(B, "BUCKET_WORDS", 50)
    parts = compare(docs(pairs, 7), pairs)  # neither blocks nor buckets nor partitions change a score
    assert [g[6] for g in whole] == pytest.approx([g[6] for g in parts], rel=1e-9)


def test_corner_rows(spark, corner):
    df, pairs = corner
    compare(df, pairs)


def test_nothing_to_learn_from(spark, docs):
    only = [i for i in range(60) if fold_of(i) == 2][:4]
    got = M.scores(docs([(i, "a b c") for i in only])).collect()
    assert len(got) == 4 and all(r.held_out and r.train_tokens == 0 and r.n_known == 0 and r.score == r.base_score == 0 for r in got)
    assert M.scores(docs([])).count() == 0


def test_held_out_texts_of_the_same_kind_score_above_the_base(spark, docs):
    pairs = [(i, prose(i % 12, 90)) for i in range(140)]
    rows = M.scores(docs(pairs)).collect()
    held = [r for r in rows if r.held_out]
    assert held and sum(r.score for r in held) > 0.8 * sum(r.base_score for r in held)


def test_weights_are_those_of_the_likelihood():
    """A grid over the simplex finds no better weights."""
    r = np.random.default_rng(3)
    cells = np.column_stack([np.full(60, 5), r.integers(1, 50, 60), r.uniform(0, 0.2, 60) * (r.random(60) > 0.4), r.uniform(0, 0.01, 60)])
    lam = M.fit_weights(cells, 1e-4)[5]

    def value(x):
        return (cells[:, 1] * np.log(cells[:, 2] * x[0] + cells[:, 3] * x[1] + 1e-4 * x[2])).sum()

    grid = [(a / 50, b / 50, 1 - a / 50 - b / 50) for a in range(50) for b in range(50 - a)]
    assert value(lam) > max(value(g) for g in grid if min(g) > 0) - 1e-3
    assert (M.fit_weights(np.zeros((0, 4)), 0.1).sum(axis=1) > 0.999).all()


def test_memory_of_a_block_is_a_few_arrays_of_its_tokens(spark, docs, monkeypatch, tmp_path):
    """A worker's peak on one block, by tracemalloc; with tables (fold, pair) a token took up to 380 bytes."""
    from pyspark.sql.pandas.group_ops import PandasCogroupedOps

    frame, note = type(spark.range(1)), str(tmp_path)
    each, both = frame.mapInArrow, PandasCogroupedOps.applyInArrow

    def peak(f, name):
        import os
        import tracemalloc
        import uuid

        tracemalloc.start()
        out = list(f())
        with open(os.path.join(note, uuid.uuid4().hex), "w") as at:
            at.write(f"{tracemalloc.get_traced_memory()[1]} {name}")
        tracemalloc.stop()
        return out

    monkeypatch.setattr(frame, "mapInArrow", lambda self, f, ddl: each(self, lambda batches: iter(peak(lambda: f(batches), f.__qualname__)), ddl))
    monkeypatch.setattr(PandasCogroupedOps, "applyInArrow",
                        lambda self, f, ddl: both(self, lambda x, y: peak(lambda: [f(x, y)], f.__qualname__)[0], ddl))
    r = np.random.default_rng(5)
    pairs = [(i, " ".join(map(str, r.integers(0, 50_000, 2500)))) for i in range(200)]
    M.scores(docs(pairs, 1)).write.format("noop").mode("overwrite").save()
    peaks = {name: int(n) / 500_000 for n, name in (p.read_text().split(" ", 1) for p in tmp_path.iterdir())}
    assert len(peaks) >= 6 and max(peaks.values()) < 130, peaks


def test_blocks_end_soon_after_their_words_are_enough(spark, docs, monkeypatch):
    """A batch of long texts makes several blocks, not one."""
    monkeypatch.setattr(B, "BLOCK_WORDS", 1 << 16)
    df = docs([(i, "a b " * 10_000) for i in range(100)], 1).selectExpr("doc_id AS key", "'' AS grp", "text")
    sizes = [r.tokens for r in B.blocks(df).select("tokens").collect()]
    assert sum(sizes) == 2_000_000 and max(sizes) < 700_000
