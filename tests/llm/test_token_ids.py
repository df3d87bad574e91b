import random
import zlib

import numpy as np
import pytest

from ringwatch.llm import token_ids as K
from ringwatch.llm.encoding import encoder
from tests.llm.fixtures import corner, docs, prose  # noqa: F401

TEXTS = ["", " ", "\n\n  a", "I'm you'll IT'S 12ab  \t x", "naïve café × ÷ ß ÿ", "日本語 text", "a\xa0b", "x <|endoftext|> y", "''s'S 'tis", "a_b__c 1_2",
         "\x1cq", "ＡＢ İ Σς", "µ ª ² ¼", "  lead trail  ", "x" * 300, "0" * 50, "!?.,;:'\"()[]{}", prose(1, 300)]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_equal_the_library(name):
    r = random.Random(3)
    letters = "ab AB'stmdrelv 019 .,!é×÷ßÀ\n\t_-|<>&"
    enc = encoder(name)
    for t in TEXTS + ["".join(r.choice(letters) for _ in range(r.randint(0, 60))) for _ in range(800)]:
        assert np.frombuffer(enc.ids(t), "<u4").tolist() == enc.tokenizer.encode(t, add_special_tokens=False).ids, t


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_strings_of_added_tokens_keep_their_ids(name):
    import public_tokenizers
    from tokenizers import Tokenizer

    library, enc = Tokenizer.from_file(public_tokenizers.path(name)), encoder(name)
    for t in TEXTS + ["one <|endoftext|> two", "<|endoftext|>", "<|startoftext|>a<|endoftext|><|endoftext|>", "日本<|endoftext|>", "<|ENDOFTEXT|> <|endof"]:
        assert np.frombuffer(enc.ids(t), "<u4").tolist() == library.encode(t, add_special_tokens=False).ids, t
    assert len(np.frombuffer(enc.ids("<|endoftext|>"), "<u4")) == 1


def test_codes_round_trip():
    r = np.random.default_rng(1)
    for n in (0, 1, 3, 4, 5, 1000):
        v = (r.integers(0, 2**32, n, dtype=np.uint64) >> r.integers(0, 32, n, dtype=np.uint64)).astype(np.uint32)
        control, data = K.encode_values(v)
        assert len(control) == -(-n // 4) and (K.decode_values(control, data, n) == v).all()
    edge = np.array([0, 255, 256, 65535, 65536, 2**24 - 1, 2**24, 2**32 - 1], np.uint32)
    control, data = K.encode_values(edge)
    assert len(data) == 1 + 1 + 2 + 2 + 3 + 3 + 4 + 4 and (K.decode_values(control, data, 8) == edge).all()


def test_blocks_hold_null_ids():
    ids, counts, ranks = K.decode_block(K.encode_block([None, 4, -2], [1, 0, 2], np.array([7, 8, 300], np.uint32)))
    assert ids.tolist() == [K.NULL_ID, 4, -2] and counts.tolist() == [1, 0, 2] and ranks.tolist() == [7, 8, 300]


def want(pairs):
    enc = encoder(K.TOKENIZER).tokenizer
    rows, at = [], 0
    for i, t in sorted(pairs, key=lambda p: (p[0] is not None, p[0] or 0)):
        ids = np.array(enc.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        rows.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return rows


def test_files_round_trip(docs):
    pairs = [(i * 7 % 101, prose(i, i % 90)) for i in range(101)] + [(500, None), (501, "日本 ▁"), (None, "no id")]
    rows = sorted(K.token_files(docs(pairs), block_tokens=100).collect(), key=lambda r: r.start)
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in rows] == want(pairs)
    assert len({(r.shard, r.block) for r in rows}) > 5


def test_corner_cases(corner, docs):
    df, pairs = corner
    rows = sorted(K.token_files(df).collect(), key=lambda r: r.start)
    plain = want(pairs)
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in rows) == sorted(
        (i is not None, i or 0, n, c) for i, _, n, c in plain)
    assert [r.doc_id for r in rows] == [x[0] for x in plain]
    assert all(a.start + a.n_tokens == b.start for a, b in zip(rows, rows[1:]))
    assert K.token_files(docs([])).count() == 0


def test_ranks_are_by_frequency(spark, docs):
    folder = K.write_token_files(docs([(1, "a a a a b"), (2, "a b")]), K.scratch(spark, "t"))
    ranks = [r.token for r in spark.read.parquet(f"{folder}/ranks").orderBy("rank").collect()]
    ids = [t for x in ("a a a a b", "a b") for t in np.frombuffer(encoder(K.TOKENIZER).ids(x), "<u4").tolist()] + [2, 2]
    assert ranks == sorted(set(ids), key=lambda t: (-ids.count(t), t))
