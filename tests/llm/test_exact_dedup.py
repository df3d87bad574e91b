import hashlib

import numpy as np

from ringwatch.llm import exact_dedup as E
from tests.llm.fixtures import corner, docs, prose  # noqa: F401


def brute(pairs):
    groups = {}
    for i, t in pairs:
        groups.setdefault(t or "", []).append(i)
    return {hashlib.sha256(t.encode()).hexdigest(): (max((x for x in g if x is not None), default=None), len(g))
            for t, g in groups.items()}


def test_perfect_hash_is_minimal_and_checks_bytes():
    r = np.random.default_rng(1)
    keys = np.unique(r.integers(0, 256, (5000, 32), dtype=np.uint8), axis=0)
    sizes, bits, left, slot = E.mph_build(keys)
    assert sorted(slot) == list(range(len(keys)))
    assert (E.mph_lookup(keys, sizes, bits, left) == slot).all()
    slots = keys[np.argsort(slot)]
    other = r.integers(0, 256, (2000, 32), dtype=np.uint8)
    at = E.mph_lookup(other, sizes, bits, left)
    assert not (slots[at[at >= 0]] == other[at >= 0]).all(axis=1).any()


def test_leftover_keys_are_found(monkeypatch):
    monkeypatch.setattr(E, "LEVELS", 1)
    keys = np.random.default_rng(2).integers(0, 256, (300, 32), dtype=np.uint8)
    sizes, bits, left, slot = E.mph_build(keys)
    assert len(left) and (E.mph_lookup(keys, sizes, bits, left) == slot).all()


def test_corner_cases(corner):
    df, pairs = corner
    want = brute(pairs)
    rows = E.exact_dedup(df).collect()
    assert len(rows) == len(pairs)
    for r in rows:
        assert (r.keep_id, r.group_size) == want[r.text_sha256]
    kept = [r.text_sha256 for r in rows if r.kept]
    assert sorted(kept) == sorted(want)  # exactly one row of each text, repeated rows included


def test_any_split_of_history_gives_the_same_groups(corner):
    df, pairs = corner
    for until in (-10, 5, 1000):
        got = {(r.text_sha256, r.keep_id, r.group_size) for r in E.exact_dedup(df, until).collect()}
        assert got == {(h, *v) for h, v in brute(pairs).items()}


def test_members_and_nonmembers(docs):
    rows = {r.doc_id: r for r in E.exact_dedup(docs([(1, "a"), (2, "b"), (11, "a"), (12, "c")]), 5).collect()}
    assert rows[11].in_history and rows[1].in_history and rows[2].in_history and not rows[12].in_history
    assert rows[1].keep_id == 11 and not rows[1].kept


def test_empty_table(docs):
    assert E.exact_dedup(docs([])).count() == 0
    assert E.drop_exact_copies(docs([])).count() == 0


def test_drop_keeps_columns_and_one_row_each(corner):
    df, pairs = corner
    out = E.drop_exact_copies(df)
    assert out.columns == df.columns
    texts = [r.text or "" for r in out.collect()]
    assert sorted(texts) == sorted({t or "" for _, t in pairs})


def test_one_text_holds_most_rows(docs):
    pairs = [(i, "same") for i in range(400)] + [(1000 + i, f"t{i}") for i in range(50)]
    rows = E.exact_dedup(docs(pairs)).collect()
    assert sum(r.kept for r in rows) == 51 and {r.keep_id for r in rows if r.group_size == 400} == {399}
