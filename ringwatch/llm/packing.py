"""Cost-balanced packing of documents into fixed-length training sequences.

A piece of L tokens costs L + L*L / capacity: linear layers plus attention
within the piece. Documents longer than a sequence give full sequences; what is
left over (under one sequence each) is packed in groups of documents: pieces go
in descending order to the cheapest sequence with enough room, and a piece that
fits nowhere is cut at the largest room left. A group opens exactly as many
sequences as its tokens need, so its padding is below one sequence. A group holds
less than one sequence of each of its documents, however long they are: full
sequences stay out of it and pass in bundles of at most 256.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringwatch.llm.common import arrow, id_and_text, part_of, session
from ringwatch.llm.encoding import encoder

CAPACITY = 2048
TOKENIZER = "word_bpe_49k.json"
END_ID = 1
#: Documents of one packing group, on average.
GROUP_DOCS = 1024
#: Full sequences of one bundle, at most. Bundles are numbered within the task that cut them.
BUNDLE = 256
BUNDLES_PER_TASK = 1 << 32
#: Sequence ids from here on are full sequences.
FULL_IDS = 1 << 62

PIECES = pa.schema([("part", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                    ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("ids", pa.binary())])
PACKED = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
                    ("sequence_tokens", pa.int64()), ("padded_tokens", pa.int64()), ("ids", pa.binary())])


def ddl(schema: pa.Schema) -> str:
    names = {pa.int64(): "long", pa.int32(): "int", pa.binary(): "binary", pa.string(): "string", pa.bool_(): "boolean",
             pa.float64(): "double"}
    return ", ".join(f"`{f.name}` {names[f.type]}" for f in schema)


def cost(length, capacity: int = CAPACITY):
    """Linear plus quadratic (attention) cost of one piece, in token units."""
    return length + length * length / capacity


def padded(tokens: int, capacity: int = CAPACITY) -> int:
    """Length a sequence of ``tokens`` is stored at: its own if that is a power of two, else the capacity."""
    return tokens if tokens & (tokens - 1) == 0 else capacity


def assign(lengths: np.ndarray, capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """(item, start in item, length, sequence, offset) for items shorter than a sequence."""
    n = max(1, -(-int(lengths.sum()) // capacity))
    room, spent = np.full(n, capacity, np.int64), np.zeros(n)
    out = []

    def put(item, start, length, at):
        out.append((item, start, length, at, int(capacity - room[at])))
        room[at] -= length
        spent[at] += cost(length, capacity)

    for item in np.argsort(-lengths, kind="stable").tolist():
        start, left = 0, int(lengths[item])
        while left:
            open_cost = np.where(room >= left, spent, np.inf)
            at = int(open_cost.argmin())
            if open_cost[at] == np.inf:  # fits nowhere whole: fill the largest room
                at = int(room.argmax())
            take = min(left, int(room[at]))
            put(item, start, take, at)
            start, left = start + take, left - take
    return out


def _pieces(batches: Iterator[pa.RecordBatch], parts: int, capacity: int, name: str, end_id: int,
            keep_ids: bool, bundle: int) -> Iterator[pa.RecordBatch]:
    enc, end = encoder(name), np.array([end_id], "<u4").tobytes()
    turn, fulls = TaskContext.get().partitionId() * 7919, 0
    first = -1 - TaskContext.get().partitionId() * BUNDLES_PER_TASK  # bundles count down from here
    width = 4 * capacity
    for batch in batches:
        out: dict[str, list] = {n: [] for n in PIECES.names}
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            ids = enc.ids(text) + end
            turn += 1
            for at in range(0, len(ids), width):
                piece = ids[at:at + width]
                full = len(piece) == width
                group = turn % parts
                if full:
                    group, fulls = first - fulls // bundle, fulls + 1
                for n, v in zip(PIECES.names, (group, doc_id, at // 4, len(piece) // 4, zlib.crc32(piece),
                                               len(ids) // 4, piece if keep_ids or not full else None)):
                    out[n].append(v)
        yield arrow(PIECES, **out)


def _pack(t: pa.Table, capacity: int, keep_ids: bool, bundle: int) -> pa.Table:
    part, doc = t["part"][0].as_py(), t["doc_id"].to_pylist()
    start, length, crc, tokens = (t[c].to_numpy() for c in ("start", "length", "ids_crc32", "doc_tokens"))
    ids = t["ids"].to_pylist()
    rows: list[tuple] = []
    # Ties in length go by id and content, so the order of arrival does not matter.
    order = sorted(range(len(doc)), key=lambda i: (doc[i] is not None, doc[i] or 0, start[i], crc[i]))
    if part < 0:  # a bundle of full sequences; their ids lie above those of the groups
        base = FULL_IDS + (-1 - part) * bundle
        rows = [(doc[i], start[i], capacity, crc[i], tokens[i], base + k, 0, ids[i]) for k, i in enumerate(order)]
    else:
        for item, at, take, seq, offset in assign(length[order], capacity):
            i = order[item]
            piece = ids[i][4 * at:4 * (at + take)]
            rows.append((doc[i], start[i] + at, take, zlib.crc32(piece), tokens[i], (part << 32) + seq, offset,
                         piece if keep_ids else None))
    totals: dict[int, int] = {}
    for r in rows:
        totals[r[5]] = totals.get(r[5], 0) + int(r[2])
    full_rows = [(*r[:7], totals[r[5]], padded(totals[r[5]], capacity), r[7] if keep_ids else None) for r in rows]
    return pa.Table.from_arrays([pa.array([r[k] for r in full_rows], f.type) for k, f in enumerate(PACKED)], schema=PACKED)


def pack(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER, end_id: int = END_ID,
         id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = True, bundle: int = BUNDLE) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset,
    sequence_tokens, padded_tokens and the ids (little-endian unsigned 32-bit).

    Every document, null and empty texts too, ends with ``end_id`` and so has a
    piece. Rows are dealt to packing groups in turn, whatever their ids or
    texts, so repeated rows and ties make no large group. A very long text adds bundles of full
    sequences and one short piece to a group. Extra columns are left out. An empty table gives
    an empty result.
    """
    session(docs.sparkSession)
    parts = part_of(docs.count(), GROUP_DOCS)
    pieces = id_and_text(docs, id_col, text_col).mapInArrow(
        lambda b: _pieces(b, parts, capacity, tokenizer, end_id, keep_ids, bundle), ddl(PIECES))
    return pieces.groupBy("part").applyInArrow(lambda t: _pack(t, capacity, keep_ids, bundle), ddl(PACKED))
