import numpy as np
import pytest

from ringwatch.llm import merge_dropout as M
from tests.llm.fixtures import corner, docs, prose  # noqa: F401

TEXTS = ["", " ", "  a  b ", "\n\n  x", "日本語 ▁ text▁", "▁", "▁▁ a", "<s> </s> <0x41> <unk>", "naïve 😀 café", "a\tb", "\x00\x01", "x² x².y 1/2",
         prose(1, 200), "w" * 3000, "don't stop-gap it's 3.14 e.g. (a)[b]{c}"]


@pytest.fixture(scope="module")
def pieces():
    return M.Pieces()


def test_no_dropout_equals_the_library(pieces):
    enc = M.DropoutEncoder(pieces, dropout=0.0)
    for t in TEXTS:
        if M.SPACE not in t:
            assert enc.encode(t, "k").tolist() == pieces.library.encode(t), t


@pytest.mark.parametrize("dropout", [0.0, 0.1, 0.5, 1.0])
def test_round_trip(pieces, dropout):
    enc = M.DropoutEncoder(pieces, dropout=dropout)
    for t in TEXTS:
        ids = enc.encode(t, "doc")
        assert (pieces.decode(ids) if len(ids) else "") == t


def test_seed_and_document_vary_the_segmentation(pieces):
    t = prose(2, 300)
    a, b = M.DropoutEncoder(pieces, seed=1), M.DropoutEncoder(pieces, seed=2)
    assert a.encode(t, "1").tolist() == M.DropoutEncoder(pieces, seed=1).encode(t, "1").tolist()
    assert a.encode(t, "1").tolist() != a.encode(t, "2").tolist()
    assert a.encode(t, "1").tolist() != b.encode(t, "1").tolist()
    none = len(M.DropoutEncoder(pieces, dropout=0.0).encode(t, "1"))
    assert none < len(a.encode(t, "1")) < len(M.DropoutEncoder(pieces, dropout=0.5).encode(t, "1"))


def test_skips_come_at_the_asked_rate():
    limit = int(0.3 * 2**64)
    rate = np.mean([M.skips(99, p, r, limit) for p in range(40) for r in range(0, 30_000, 100)])
    assert abs(rate - 0.3) < 0.02


def test_list_and_queue_agendas_agree(pieces):
    limit = int(0.2 * 2**64)
    for w in prose(3, 400).split() + ["▁▁▁word", "aaaaaaaa", "日本", "...!!"]:
        for key in (None, 5, 1 << 63):
            assert pieces._short(w, key, limit) == pieces._long(w, key, limit)


def test_agendas_of_many_words_agree_with_one_by_one(pieces):
    words = sorted({*prose(3, 400).split(), "▁▁▁word", "aaaaaaaa", "日本", "...!!", "x", "a" * 40, "😀", "é" * 9, "\x00\x01", "²."})
    keys = np.arange(len(words), dtype=np.uint64) * np.uint64(0x123456789ABCDEF)
    for limit in (0, int(0.1 * 2**64), int(0.5 * 2**64), 2**64):
        want = [np.array(pieces.segment(w, int(k), limit), "<u4").tobytes() for w, k in zip(words, keys)]
        assert pieces.segment_many(words, keys, limit) == want
    assert pieces.segment_many(words, None, 0) == [np.array(pieces.segment(w, None, 0), "<u4").tobytes() for w in words]


def test_full_tables_start_anew(pieces, monkeypatch):
    monkeypatch.setattr(M, "GENERATION", 5)
    t = prose(4, 100)
    assert M.DropoutEncoder(pieces, seed=3).encode(t, "d").tolist() == M.DropoutEncoder(pieces, seed=3).encode(t, "d").tolist()


def test_each_occurrence_draws_its_own_skips(pieces, monkeypatch):
    text = " ".join(["international the"] * 1000)
    enc = M.DropoutEncoder(pieces, dropout=0.3)
    words = enc._words(text)
    keys = enc._keys(len(words), "d")
    own = [pieces.segment(w, int(k), enc.limit) for w, k in zip(words, keys)]
    for tree in (0, M.TREE):  # with and without trees: the same as every occurrence's own agenda
        monkeypatch.setattr(M, "TREE", tree)
        assert M.DropoutEncoder(pieces, dropout=0.3).encode(text, "d").tolist() == [i for ids in own for i in ids]
    kinds = [{tuple(ids) for w, ids in zip(words, own) if w == word} for word in set(words)]
    assert min(map(len, kinds)) > 3 and max(map(len, kinds)) > 50
    word = words[0]
    for merge in pieces._agendas([word], np.array([len(word)]), len(word), None, 0)[2].tolist():  # each merge is skipped at the asked rate
        assert abs(np.mean([M.skips(int(k), merge >> 32, merge & 0xFFFFFFFF, enc.limit) for k in keys[::2]]) - 0.3) < 0.07


def test_corner_cases(corner, docs):
    import hashlib
    df, pairs = corner
    rows = M.round_trip(df).collect()
    want = sorted((i is not None, i or 0, hashlib.sha256((t or "").encode()).hexdigest()) for i, t in pairs)
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.decoded_sha256) for r in rows) == want
    assert all((r.n_pieces == 0) == (r.decoded_sha256 == hashlib.sha256(b"").hexdigest()) for r in rows)
    assert M.round_trip(docs([])).count() == 0
    two = sorted((str(r.doc_id), r.n_pieces, r.ids_crc32, hashlib.sha256(r.text.encode()).hexdigest()) for r in M.decode(M.encode(df)).collect())
    assert two == sorted((str(r.doc_id), r.n_pieces, r.ids_crc32, r.decoded_sha256) for r in rows)
