"""Words of whole texts as numbers, in blocks, and counts of words and phrases over all blocks.

A block holds the words of some documents of one group (a language, a fold): its
distinct words once, and one code per word. Counting goes by exchange: a block sends
each distinct word or phrase once, with its count there, to the bucket that the
word's hash names; the bucket adds up and answers every block. No key comes more than
once per block, so the commonest word costs a bucket no more rows than there are
blocks, and the number of buckets follows the number of words. Rows carry arrays,
packed by byte planes, not single words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringwatch.llm.common import part_of, written

#: Words of a block, at least, unless its task ends; words, phrases and bytes of words of one bucket, on average.
BLOCK_WORDS, BUCKET_WORDS, BUCKET_PHRASES, BUCKET_BYTES = 1 << 20, 1 << 19, 1 << 20, 1 << 25
#: Text added to a block at a time, so that it ends soon after its words are enough.
PIECE_BYTES = 1 << 20
BLANKS = b" \t\n\x0b\x0c\r"
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)

BLOCKS = pa.schema([("block", pa.int64()), ("grp", pa.string()), ("docs", pa.int64()), ("tokens", pa.int64()),
                    ("kinds", pa.int64()), ("word_bytes", pa.int64()), ("ids", pa.binary()),
                    ("words", pa.binary()), ("codes", pa.binary())])
BLOCKS_DDL = ("block long, grp string, docs long, tokens long, kinds long, word_bytes long, ids binary, "
              "words binary, codes binary")
SENT_WORDS = pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("grp", pa.string()), ("words", pa.binary()),
                        ("counts", pa.binary())])
SENT_WORDS_DDL = "bucket long, block long, grp string, words binary, counts binary"
WORDS_BACK = pa.schema([("block", pa.int64()), ("bucket", pa.int64()), ("grp", pa.string()), ("n", pa.int64()),
                        ("top", pa.int64()), ("ids", pa.binary()), ("totals", pa.binary()), ("own", pa.binary()), ("words", pa.binary())])
WORDS_BACK_DDL = "block long, bucket long, grp string, n long, top long, ids binary, totals binary, own binary, words binary"
SENT_PHRASES = pa.schema([("bucket", pa.int64()), ("block", pa.int64()),
                          ("a", pa.binary()), ("b", pa.binary()), ("counts", pa.binary())])
SENT_PHRASES_DDL = "bucket long, block long, a binary, b binary, counts binary"
_ZSTD = pa.Codec("zstd", 1)


def squeezed(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + _ZSTD.compress(data, asbytes=True)


def spread(data: bytes) -> bytes:
    return _ZSTD.decompress(data[8:], int.from_bytes(data[:8], "little"), asbytes=True)


def pack(values: np.ndarray) -> bytes:
    """Non-negative integers as byte planes, lowest first, compressed; planes that are all zero at the top are left out."""
    v = np.ascontiguousarray(values, "<u8").ravel()
    planes = (int(v.max()).bit_length() + 7) // 8 if len(v) else 0
    return bytes([planes]) + squeezed(v.view(np.uint8).reshape(-1, 8)[:, :planes].T.tobytes()) if planes else b"\0"


def unpack(data: bytes, n: int | None = None) -> np.ndarray:
    """The integers of ``pack``; ``n`` is their number, needed only where all may be zero."""
    planes = data[0]
    if not planes:
        return np.zeros(n or 0, np.int64)
    got = np.frombuffer(spread(data[1:]), np.uint8).reshape(planes, -1)
    out = np.zeros((got.shape[1], 8), np.uint8)
    out[:, :planes] = got.T
    return out.view("<i8").ravel()


def pack_counts(counts: np.ndarray) -> bytes:
    """A table (fold, key) of counts, nearly all zero: its cells in the order of the keys, as fold (and whether the key
    is a new one) and count less one. Every key has a cell; up to 127 folds."""
    if len(counts) == 1:
        return pack(counts)
    fold_last = np.ascontiguousarray(counts.T)
    key, fold = np.nonzero(fold_last)
    return pack_cells(np.append(True, key[1:] != key[:-1])[:len(key)], fold, fold_last[key, fold])


def pack_cells(new: np.ndarray, fold: np.ndarray, count: np.ndarray) -> bytes:
    """``pack_counts`` of cells listed by key: whether each is its key's first, its fold and its count."""
    marks = squeezed((fold.astype(np.uint8) | (new.astype(np.uint8) << 7)).tobytes())
    return len(marks).to_bytes(8, "little") + marks + pack(count - 1)


def unpack_cells(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What ``pack_cells`` was given."""
    size = int.from_bytes(data[:8], "little")
    marks = np.frombuffer(spread(data[8:8 + size]), np.uint8)
    return marks >> 7 == 1, marks & 127, unpack(data[8 + size:], len(marks)) + 1


def unpack_counts(data: bytes, folds: int, n: int) -> np.ndarray:
    if folds == 1:
        return unpack(data, n)[None]
    new, fold, count = unpack_cells(data)
    out = np.zeros((folds, n), np.int64)
    out[fold, np.cumsum(new) - 1] = count
    return out


def cells(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(keys, folds) of the cells that are not zero, by key."""
    return np.nonzero(np.ascontiguousarray(counts.T))


def pack_words(words: pa.Array) -> bytes:
    """Words (large binary) as one value: lengths, then bytes."""
    words = pa.concat_arrays([words])
    lengths = pack(np.diff(np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1])) if len(words) else b"\0"
    flat = b"".join(words.to_pylist())
    return len(words).to_bytes(8, "little") + len(lengths).to_bytes(8, "little") + lengths + squeezed(flat)


def unpack_words(data: bytes) -> pa.Array:
    n, cut_at = int.from_bytes(data[:8], "little"), 16 + int.from_bytes(data[8:16], "little")
    offsets = np.append(0, np.cumsum(unpack(data[16:cut_at], n)))
    return pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(spread(data[cut_at:]))])


def word_hashes(words: pa.Array) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(w) for w in words.to_pylist()], np.uint64)


def mixed(a: np.ndarray, b: np.ndarray | None = None) -> np.ndarray:
    """A 64-bit hash of each key (a, b)."""
    x = a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    if b is not None:
        x ^= b.astype(np.uint64) + np.uint64(0x7F4A7C15) + (x << np.uint64(6))
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def cut(texts: pa.Array, blanks: bytes = BLANKS, breaks: bytes = b"", lower: bool = True):
    """(codes, vocabulary, ends, stops) of the words of all texts, null as empty: a code per word, the
    distinct words in UTF-8, the number of words before each text's end, and the same for each break byte."""
    kind = texts.type
    texts = texts.fill_null("") if texts.null_count else texts
    wide = pa.types.is_large_string(kind) or pa.types.is_large_binary(kind)
    _, at, data = texts.buffers()
    at = np.frombuffer(at, np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None else np.zeros(0, np.uint8)
    at = (at - at[0]).astype(np.int64)
    table = np.zeros(256, np.uint8)
    table[list(blanks)] = 1
    table[list(breaks)] = 2
    sort = table[data]
    inside = sort == 0
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    before[at[:-1][at[:-1] < len(data)]] = False
    starts = np.flatnonzero(inside & ~before)
    kept = (_LOWER[data] if lower else data)[inside]
    offsets = np.append(np.cumsum(inside, dtype=np.int64)[starts] - 1, len(kept))
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(kept)])
    coded = words.dictionary_encode()
    stops = np.searchsorted(starts, np.flatnonzero(sort == 2)) if breaks else np.zeros(0, np.int64)
    return (coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary,
            np.searchsorted(starts, at[1:]), stops)


def _block(number: int, grp: str, parts: list) -> pa.RecordBatch:
    """One block of (codes, vocabulary, ids, words) parts: their vocabularies become one, the commonest words first."""
    joined = pa.concat_arrays([v for _, v, _, _ in parts]).dictionary_encode()
    new = joined.indices.to_numpy(zero_copy_only=False)
    codes, at = [], 0
    for c, v, _, _ in parts:
        codes.append(np.append(new[at:at + len(v)], -1)[c])
        at += len(v)
    codes = np.concatenate(codes)
    words = joined.dictionary
    order = np.argsort(-word_counts(codes, len(words)), kind="stable")
    rank = np.full(len(words) + 1, -1)
    rank[order] = np.arange(len(words))
    n = sum(w for *_, w in parts)
    return pa.RecordBatch.from_arrays(
        [pa.array([number]), pa.array([grp], pa.string()), pa.array([sum(len(i) for _, _, i, _ in parts)]), pa.array([n]),
         pa.array([len(words)]), pa.array([words.nbytes]), pa.array([b"".join(i.tobytes() for _, _, i, _ in parts)], pa.binary()),
         pa.array([pack_words(words.take(pa.array(order)))], pa.binary()), pa.array([pack(rank[codes] + 1)], pa.binary())],
        schema=BLOCKS)


def pieces(batch: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    """The rows of ``batch`` in slices with about ``most`` bytes of text, or one row with more."""
    length = pa.compute.fill_null(pa.compute.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(length, dtype=np.int64) // most
    at = np.append(np.flatnonzero(np.diff(part, prepend=-1)), len(part))
    for x, y in zip(at.tolist(), at[1:].tolist()):
        yield batch.slice(x, y - x)


def blocks(docs: DataFrame, breaks: bytes = b"", blanks: bytes = BLANKS, path: str | None = None) -> DataFrame:
    """The blocks of ``docs`` (key long, group name grp, text), written once. ``block_codes`` gives the places
    of its texts' words in ``words``, with -1 after every text and, where ``breaks`` are given, at breaks; ``ids`` are
    the keys, as 64-bit numbers, in the order of the texts. A text is never cut; a block has one text at least."""
    least, most = BLOCK_WORDS, PIECE_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[str, list] = {}
        held: dict[str, int] = {}
        number = TaskContext.get().partitionId() << 24
        for batch in (piece for whole in batches for piece in pieces(whole, most)):
            names = np.array(batch.column("grp").to_pylist(), object)
            for name in sorted(set(names)):
                rows = pa.array(np.flatnonzero(names == name))
                part = batch.take(rows)
                codes, words, ends, stops = cut(part.column("text"), blanks, breaks)
                n = len(codes)
                if len(stops):  # a break right at a text's start, end or another break says nothing new
                    stops = np.setdiff1d(stops, np.append(ends, 0))
                codes = np.insert(codes, np.sort(np.concatenate([ends, stops]), kind="stable"), -1)
                ids = part.column("key").to_numpy(zero_copy_only=False).astype("<i8")
                waiting.setdefault(name, []).append((codes, words, ids, n))
                held[name] = held.get(name, 0) + n
                while held[name] >= least or sum(held.values()) >= 8 * least:
                    full = max(held, key=held.get)
                    yield _block(number, full, waiting.pop(full))
                    held[full] = 0
                    number += 1
        for name in sorted(waiting):
            yield _block(number, name, waiting[name])
            number += 1

    return written(docs.mapInArrow(run, BLOCKS_DDL), "blocks", path=path)


def block_codes(data: bytes) -> np.ndarray:
    return unpack(data) - 1


def word_counts(codes: np.ndarray, kinds: int) -> np.ndarray:
    return np.bincount(codes[codes >= 0], minlength=kinds)


def _spans(to: np.ndarray):
    """(names, places of each) of the buckets in ``to``; places keep their order."""
    order = np.argsort(to, kind="stable")
    names, first = np.unique(to[order], return_index=True)
    return names.astype(np.int64), [order[x:y] for x, y in zip(first, np.append(first[1:], len(order)))]


def word_table(made: DataFrame, scoped: bool, counted: Callable[[dict], np.ndarray] | None = None, folds: int = 1,
               learnt: list[int] | None = None, least: int = 0, keep_words: bool = False,
               path: str | None = None, tidy: bool = False) -> tuple[DataFrame, int]:
    """Exchange of words, written once (``path`` and ``tidy`` as in ``written``), and its number of buckets.

    ``counted`` gives a block's counts as a table (fold, word), by default all in one fold. One row per (block, bucket)
    answers the words that the block sent there, in its order: numbers, totals over the folds ``learnt`` (all by
    default) and, with several folds, the fold's total for each cell of the message. ``scoped``: a word
    counts per group, else over all. Words with ``least`` occurrences or more in those folds have numbers from 1 on, others 0. Rows with block -1 sum up a bucket (and group): the greatest number
    (``top``), how many words have a count in those folds (``n``), and with ``keep_words`` the numbered words,
    their numbers and totals."""
    size = made.agg(F.sum("kinds"), F.sum("word_bytes")).first()
    buckets = max(part_of(size[0] or 0, BUCKET_WORDS), part_of(size[1] or 0, BUCKET_BYTES))
    use = list(range(folds)) if learnt is None else learnt

    def send(batches):
        for batch in batches:
            for row in rows_of(batch):
                words = unpack_words(row["words"])
                if not len(words):
                    continue
                counts = counted(row) if counted else word_counts(block_codes(row["codes"]), len(words))[None]
                names, spans = _spans(word_hashes(words) % np.uint64(buckets))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names), pa.array([row["block"]] * len(names), pa.int64()), pa.array([row["grp"]] * len(names), pa.string()),
                     pa.array([pack_words(words.take(pa.array(x))) for x in spans], pa.binary()),
                     pa.array([pack_counts(counts[:, x]) for x in spans], pa.binary())], schema=SENT_WORDS)

    def settle(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        lists = [unpack_words(w) for w in table.column("words").to_pylist()]
        coded = pa.concat_arrays(lists).dictionary_encode()
        code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        each = np.array([len(x) for x in lists])
        grps = table.column("grp").to_pylist()
        known = sorted(set(grps)) if scoped else [None]
        place = {g: k for k, g in enumerate(known)}
        key = code * len(known) + (np.repeat([place[x] for x in grps], each) if scoped else 0)
        counts = np.concatenate([unpack_counts(c, folds, k) for c, k in zip(table.column("counts").to_pylist(), each)], axis=1)
        size = len(coded.dictionary) * len(known)
        total = np.stack([np.bincount(key, f, size).astype(np.int64) for f in counts])
        seen = total[use].sum(axis=0)
        numbered = np.flatnonzero((seen >= least) & (total.any(axis=0)))
        number = np.zeros(size, np.int64)
        number[numbered] = np.arange(len(numbered)) * buckets + bucket + 1
        at = np.append(0, np.cumsum(each))
        rows = []
        for r, block in enumerate(table.column("block").to_pylist()):
            mine = key[at[r]:at[r + 1]]
            k, f = cells(counts[:, at[r]:at[r + 1]]) if folds > 1 else (mine[:0], mine[:0])
            rows.append((block, bucket, grps[r], int(each[r]), 0, pack(number[mine]), pack(seen[mine]), pack(total[f, mine[k]]), None))
        for k, name in enumerate(known):
            mine = numbered[numbered % len(known) == k] if keep_words else numbered[:0]
            rows.append((-1, bucket, name, int((seen[k::len(known)] > 0).sum()), int(number.max(initial=0)), pack(number[mine]),
                         pack(seen[mine]), b"\0", pack_words(coded.dictionary.take(pa.array(mine // len(known))))))
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows), WORDS_BACK)], schema=WORDS_BACK)

    sent = made.select("block", "grp", "kinds", "ids", "words", "codes").mapInArrow(send, SENT_WORDS_DDL)
    return written(sent.groupBy("bucket").applyInArrow(settle, WORDS_BACK_DDL), "words", path=path, tidy=tidy), buckets


def rows_of(batch: pa.RecordBatch | pa.Table) -> Iterator[dict]:
    for i in range(batch.num_rows):
        yield {f: batch.column(f)[i].as_py() for f in batch.schema.names}


def in_block_order(to: np.ndarray, back: pa.Table, column: str, counts: np.ndarray | None = None) -> np.ndarray:
    """The answers to one block, put back into the order of its keys, whose buckets are ``to``; with ``counts``, the
    answers for their cells, as a table like it."""
    out = np.zeros(len(to) if counts is None else counts.shape, np.int64)
    if back.num_rows:
        names, spans = _spans(to)
        answers = dict(zip(back.column("bucket").to_pylist(), back.column(column).to_pylist()))
        for name, x in zip(names.tolist(), spans):
            if counts is None:
                out[x] = unpack(answers[name], len(x))
            else:
                k, f = cells(counts[:, x])
                out[f, x[k]] = unpack(answers[name], len(k))
    return out


def phrases(a: np.ndarray, b: np.ndarray | None = None):
    """(distinct a, distinct b, counts, place of each given key among them), sorted by (a, b)."""
    if b is None:
        a, back, counts = np.unique(a, return_inverse=True, return_counts=True)
        return a, None, counts, back
    order = np.lexsort((b, a))
    x, y = a[order], b[order]
    new = np.append(True, (x[1:] != x[:-1]) | (y[1:] != y[:-1])) if len(x) else np.zeros(0, bool)
    place = np.empty(len(x), np.int64)
    place[order] = np.cumsum(new) - 1
    return x[new], y[new], np.bincount(place, minlength=int(new.sum())), place


def sent_phrases(block: int, a: np.ndarray, b: np.ndarray | None, counts: np.ndarray, buckets: int,
                 to: np.ndarray | None = None) -> pa.RecordBatch:
    """A block's distinct phrases (sorted by (a, b)) as one row per bucket, by hash or as ``to`` says; ``a`` as
    differences, counts as (fold, phrase)."""
    names, spans = _spans(mixed(a, b) % np.uint64(buckets) if to is None else to)
    counts = np.atleast_2d(counts)
    return pa.RecordBatch.from_arrays(
        [pa.array(names), pa.array([block] * len(names), pa.int64()),
         pa.array([pack(np.diff(a[s].astype(np.uint64), prepend=np.uint64(0))) for s in spans], pa.binary()),
         pa.array([b"\0" if b is None else pack(b[s]) for s in spans], pa.binary()),
         pa.array([pack_counts(counts[:, s]) for s in spans], pa.binary())], schema=SENT_PHRASES)


def received(table: pa.Table, two: bool = False, folds: int = 1):
    """(a, b, counts (fold, phrase), phrases per message) of the messages to one bucket; no ``a`` is zero."""
    a = [np.cumsum(unpack(x).view(np.uint64), dtype=np.uint64) for x in table.column("a").to_pylist()]
    n = [len(x) for x in a]
    b = [unpack(x, k) for x, k in zip(table.column("b").to_pylist(), n)] if two else None
    counts = [unpack_counts(x, folds, k) for x, k in zip(table.column("counts").to_pylist(), n)]
    return np.concatenate(a), np.concatenate(b) if two else None, np.concatenate(counts, axis=1), np.array(n)
