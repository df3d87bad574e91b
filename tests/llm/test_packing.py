import zlib
from collections import defaultdict

import numpy as np

from ringwatch.llm import packing as P
from ringwatch.llm.encoding import encoder
from tests.llm.fixtures import corner, docs, prose  # noqa: F401


def test_assign_fills_the_cheapest_and_cuts_only_when_it_must():
    r = np.random.default_rng(1)
    lengths = r.integers(1, 2048, 400)
    placed = P.assign(lengths)
    used, pieces = defaultdict(list), defaultdict(list)
    for item, start, length, seq, offset in placed:
        used[seq].append((offset, length))
        pieces[item].append((start, length))
    assert len(used) == -(-int(lengths.sum()) // 2048)
    for spans in used.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 2048
    for item, spans in pieces.items():
        assert sum(n for _, n in spans) == lengths[item]
    assert sum(len(p) > 1 for p in pieces.values()) < len(used)
    spent = [sum(P.cost(n) for _, n in s) for s in used.values()]
    assert max(spent) < 1.6 * np.median(spent)


def test_padding_rule():
    assert [P.padded(n) for n in (1, 2, 3, 1024, 1025, 2048)] == [1, 2, 2048, 1024, 2048, 2048]


def check(rows, pairs):
    enc = encoder(P.TOKENIZER).tokenizer
    want = defaultdict(list)
    for i, t in pairs:
        ids = np.array(enc.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        want[i].append(ids)
    by_seq, total = defaultdict(list), defaultdict(int)
    for r in rows:
        by_seq[r.sequence_id].append((r.offset, r.length))
        total[r.doc_id] += r.length
        assert r.length >= 1 and zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
        assert any(r.doc_tokens == len(x) and x[r.start:r.start + r.length].tobytes() == r.ids for x in want[r.doc_id])
    assert total == {i: sum(map(len, x)) for i, x in want.items()}
    for spans in by_seq.values():
        at = 0
        for offset, n in sorted(spans):
            assert offset == at
            at += n
        assert at <= P.CAPACITY


def test_corner_cases(corner, docs):
    df, pairs = corner
    check(P.pack(df).collect(), pairs)
    assert P.pack(docs([])).count() == 0


def test_several_groups_pad_little(docs, monkeypatch):
    monkeypatch.setattr(P, "GROUP_DOCS", 100)
    pairs = [(i, prose(i, 20 + i % 300)) for i in range(400)]
    rows = P.pack(docs(pairs)).collect()
    check(rows, pairs)
    seqs = {r.sequence_id: (r.sequence_tokens, r.padded_tokens) for r in rows}
    assert len({s >> 32 for s in seqs}) == 4
    assert sum(p - t for t, p in seqs.values()) < 4 * P.CAPACITY


def test_result_is_the_same_each_time(docs):
    df = docs([(i, prose(i, 50)) for i in range(60)]).persist()
    key = lambda: sorted((r.doc_id, r.start, r.sequence_id, r.offset) for r in P.pack(df).collect())
    assert key() == key()


def test_long_documents_stay_out_of_groups(docs):
    """Documents of many sequences: groups hold short pieces only, bundles of full ones are bounded, ids are unique."""
    pairs = [(i, prose(i, 9000 if i % 7 == 0 else 40)) for i in range(30)] + [(7, prose(7, 9000)), (None, prose(5, 5000))]
    df = docs(pairs).repartition(3)
    check(P.pack(df, bundle=3).collect(), pairs)
    pieces = P.id_and_text(df, "doc_id", "text").mapInArrow(
        lambda b: P._pieces(b, 2, P.CAPACITY, P.TOKENIZER, P.END_ID, True, 3), P.ddl(P.PIECES)).collect()
    by_part = defaultdict(list)
    for r in pieces:
        by_part[r.part].append(r.length)
    assert all((p < 0) == (n == P.CAPACITY) for p, all_n in by_part.items() for n in all_n)
    assert max(len(n) for p, n in by_part.items() if p < 0) == 3
