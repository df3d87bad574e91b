"""Maximal periodic runs of words, by recursive frequency splitting and lag scans.

A run is a stretch of words with smallest period q and ``max(12, 2q)`` words or more that
no neighbouring word extends. Each of its words comes at least twice in it, so a word
that comes once within a segment is in no run there: such words split the segment, and
so on within the parts, until nothing splits; parts too short for a run go. All texts
of a batch are split together, one sort per round.

The lag scan then looks, in the segments left, for stretches equal to themselves q words
later. Lags below 8 are compared directly. For lags from K to 2K - 1 (K a power of two)
a run holds a whole aligned block of K / 2 words that comes again q words later, so the
blocks' next places within reach (sorted numbers of all spans of K / 2 words) name
every lag that can be one; stretches of blocks are then extended to both sides, by
halves. A lag that is a multiple of a shorter run's period there is no smallest
period and is dropped. The work is n log n for a text of n words with few
repeats in reach, whatever the lags.

Defined cases: a null text and a text without words have no run; very long texts are never
cut (about 8 bytes per remaining word and power of two are held); after 64 rounds of splitting the
scan takes the segments as they are, with the same result; repeated rows are reported
each; of equally long runs the one that starts first, then that of the smaller period,
is shown; an empty table gives no rows; further columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringwatch.llm.common import arrow, id_and_text, session

MIN_WORDS = 12
#: Lags below this are compared directly; rounds of splitting, at most.
DIRECT, SPLITS = 8, 64
_WORDS = re.compile(r"[^\x20\x09-\x0D]+").findall
REPORT = pa.schema([("doc_id", pa.int64()), ("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                    ("period", pa.int64()), ("exponent_milli", pa.int64()), ("runs_sha256", pa.string()),
                    ("collapsed_sha256", pa.string())])
REPORT_DDL = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
              "runs_sha256 string, collapsed_sha256 string")
TEXTS_DDL = "doc_id long, starts array<long>, lengths array<long>, periods array<long>, collapsed string"
_TEXTS = pa.schema([("doc_id", pa.int64()), ("starts", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())),
                    ("periods", pa.list_(pa.int64())), ("collapsed", pa.string())])


def split(code: np.ndarray, text: np.ndarray, min_words: int = MIN_WORDS):
    """(places, segment of each) that remain once words too rare within their segment have split it, again and again.

    ``code`` are the words of all texts one after another, ``text`` the text of each."""
    at, seg = np.arange(len(code)), text.astype(np.int64)
    done_at, done_seg, fresh = [], [], 0
    for _ in range(SPLITS):
        if not len(at):
            break
        key = seg * (int(code.max()) + 1) + code[at]
        _, back, n = np.unique(key, return_inverse=True, return_counts=True)
        often = n[back] > 1
        # segments without a rare word are stable
        rare = np.zeros(int(seg.max()) + 1, bool)
        rare[seg[~often]] = True
        stable = ~rare[seg]
        done_at.append(at[stable])
        done_seg.append(seg[stable])
        at, seg = at[~stable & often], seg[~stable & often]
        new = np.append(True, (np.diff(at) != 1) | (np.diff(seg) != 0))[:len(at)]
        part = np.cumsum(new) - 1
        large = np.bincount(part)[part] >= min_words if len(part) else np.zeros(0, bool)
        fresh = max([fresh, *(int(s.max()) + 1 for s in done_seg if len(s))])
        at, part = at[large], part[large]
        seg = fresh + (np.unique(part, return_inverse=True)[1] if len(part) else part)
    at, seg = np.concatenate([*done_at, at]).astype(np.int64), np.concatenate([*done_seg, seg]).astype(np.int64)
    order = np.argsort(at, kind="stable")
    at, seg = at[order], seg[order]
    if not len(at):
        return at, seg
    # stable segments of whole texts may still be shorter than a run
    large = np.bincount(np.unique(seg, return_inverse=True)[1])[np.unique(seg, return_inverse=True)[1]] >= min_words
    return at[large], seg[large]


def _covered(found: list[tuple[np.ndarray, np.ndarray]], size: int) -> np.ndarray:
    """For each place, the greatest end of a run that starts there or before."""
    reach = np.zeros(size + 1, np.int64)
    for start, end in found:
        np.maximum.at(reach, start, end)
    return np.maximum.accumulate(reach)


def scan(word: np.ndarray, min_words: int = MIN_WORDS):
    """(starts, lengths, periods) of all runs in ``word``; words that must join no run are negative and distinct."""
    n = len(word)
    starts, lengths, periods = [], [], []
    reach = np.zeros(n + 1, np.int64)

    def keep(lo, hi, q, reach):
        """Runs of the stretches [lo, hi) that equal those q later, unless a shorter period covers them."""
        long = hi - lo >= np.maximum(q, min_words - q)
        lo, end, q = lo[long], (hi + q)[long], q[long]
        new = reach[lo] < end
        starts.append(lo[new])
        lengths.append((end - lo)[new])
        periods.append(q[new])
        return lo[new], end[new]

    for q in range(1, min(DIRECT, n)):
        same = np.concatenate([[False], word[:-q] == word[q:], [False]])
        edge = np.flatnonzero(same[1:] != same[:-1])
        lo, hi = edge[0::2], edge[1::2]
        reach = np.maximum(reach, _covered([keep(lo, hi, np.full(len(lo), q), reach)], n))
    # numbers of all spans of 1, 2, 4, ... words; past the end each place is its own
    ranks, width = [np.unique(word, return_inverse=True)[1].astype(np.int32)], 1
    K = DIRECT
    while 2 * K <= n:
        half = K // 2
        while width < half:
            last = ranks[-1].astype(np.int64)
            key = last[:len(last) - width] * (int(last.max()) + 1) + last[width:]
            ranks.append(np.unique(key, return_inverse=True)[1].astype(np.int32))
            width *= 2
        rank = ranks[-1].astype(np.int64)
        m = len(rank)
        order = np.argsort(rank, kind="stable")
        sorted_key = rank[order] * n + order
        block = np.arange(0, m, half)
        block = block[reach[block] < np.minimum(block + 2 * K + half, n)]  # else one shorter period spans all in reach
        lo = np.searchsorted(sorted_key, rank[block] * n + np.minimum(block + K, n))
        hi = np.searchsorted(sorted_key, rank[block] * n + np.minimum(block + 2 * K, n))
        each = hi - lo
        own = np.repeat(block, each)
        to = order[np.repeat(lo - np.append(0, np.cumsum(each)[:-1]), each) + np.arange(each.sum())] if len(block) else own
        q = to - own
        plain = _covered([(s, s + x) for s, x, p in zip(starts, lengths, periods) if len(p) and p.max() <= half], n) if starts else reach
        open_ = plain[own] < to + half
        own, q = own[open_], q[open_]
        order = np.lexsort((own, q))
        own, q = own[order], q[order]
        head = np.append(True, (np.diff(q) != 0) | (np.diff(own) != half))[:len(own)]
        lo = own[head]
        hi = own[np.append(head[1:], True)[:len(own)]] + half
        q = q[head]
        for step in range(len(ranks) - 1, -1, -1):  # extend by less than a block to either side
            size, r = 1 << step, ranks[step]
            for _ in range(2 if step == len(ranks) - 1 else 1):
                ok = lo >= size
                ok[ok] = r[lo[ok] - size] == r[lo[ok] - size + q[ok]]
                lo = lo - size * ok
                ok = hi + q + size <= n
                ok[ok] = r[hi[ok]] == r[hi[ok] + q[ok]]
                hi = hi + size * ok
        if len(lo):
            distinct = np.unique(np.column_stack([lo, hi, q]), axis=0)
            reach = np.maximum(reach, _covered([keep(distinct[:, 0], distinct[:, 1], distinct[:, 2], reach)], n))
        K *= 2
    if not starts:
        return (np.zeros(0, np.int64),) * 3
    starts, lengths, periods = map(np.concatenate, (starts, lengths, periods))
    order = np.lexsort((periods, starts))
    return starts[order], lengths[order], periods[order]


def batch_runs(texts: list[list[str]], min_words: int = MIN_WORDS):
    """For each list of words (starts, lengths, periods) of its runs, by start, then period."""
    first = np.append(0, np.cumsum([len(t) for t in texts])).astype(np.int64)
    known: dict[str, int] = {}
    code = np.fromiter((known.setdefault(w, len(known)) for t in texts for w in t), np.int64, first[-1])
    at, seg = split(code, np.repeat(np.arange(len(texts)), np.diff(first)), min_words)
    if not len(at):
        return [(np.zeros(0, np.int64),) * 3] * len(texts)
    # a separator between segments, equal to nothing
    gap = np.flatnonzero(np.diff(seg) != 0) + 1
    word = np.insert(code[at], gap, -np.arange(1, len(gap) + 1))
    place = np.insert(at, gap, -1)
    start, length, period = scan(word, min_words)
    where = place[start]
    owner = np.searchsorted(first, where, "right") - 1
    cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
    return [(where[x:y] - first[k], length[x:y], period[x:y]) for k, (x, y) in enumerate(zip(cuts, cuts[1:]))]


def collapsed(words: list[str], start: np.ndarray, length: np.ndarray, period: np.ndarray) -> str:
    """The words without each run's repeats after its first period, joined by single spaces."""
    if not len(start):
        return " ".join(words)
    drop = np.zeros(len(words) + 1, np.int64)
    np.add.at(drop, start + period, 1)
    np.add.at(drop, start + length, -1)
    return " ".join([w for w, d in zip(words, np.cumsum(drop)) if not d])


def planted(doc_id: int | None, words: list[str]) -> list[str]:
    """Words of a text whose id's crc32 is a multiple of 10, with a repeat of known place and period written
    over its end; those of other texts as they are (a null id counts as the empty string)."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * (-(-(n - a) // p)))[:n - a]


def _pieces(batch: pa.RecordBatch, most: int = 1 << 21):
    """(ids, words) of a batch's texts, some two million characters at a time, or one text."""
    ids, lists, held = [], [], 0
    for i, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
        ids.append(i)
        lists.append(_WORDS(text))
        held += len(text)
        if held >= most:
            yield ids, lists
            ids, lists, held = [], [], 0
    if ids:
        yield ids, lists


def periodic_runs(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its runs (starts, lengths and periods, in words) and the text without their repeats."""
    session(docs.sparkSession)

    def run(batches):
        for batch in batches:
            for ids, lists in _pieces(batch):
                found = batch_runs(lists, min_words)
                yield arrow(_TEXTS, doc_id=ids, starts=[f[0] for f in found], lengths=[f[1] for f in found], periods=[f[2] for f in found],
                            collapsed=[collapsed(w, *f) for w, f in zip(lists, found)])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, TEXTS_DDL)


def run_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document on the runs of its text, repeats written in by ``planted``: their number, the longest one,
    and digests of the list of runs and of the text without their repeats."""
    session(docs.sparkSession)

    def sha(text: str) -> str:
        return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()

    def run(batches):
        for batch in batches:
            for ids, lists in _pieces(batch):
                lists = [planted(i, words) for i, words in zip(ids, lists)]
                rows = []
                for i, words, (start, length, period) in zip(ids, lists, batch_runs(lists)):
                    top = (None,) * 4
                    if len(start):
                        k = np.lexsort((period, start, -length))[0]
                        top = int(start[k]), int(length[k]), int(period[k]), int(1000 * length[k] // period[k])
                    listed = "".join(f"{s},{x},{q}\n" for s, x, q in zip(start.tolist(), length.tolist(), period.tolist()))
                    rows.append((i, len(start), *top, sha(listed), sha(collapsed(words, start, length, period))))
                yield arrow(REPORT, **dict(zip(REPORT.names, zip(*rows))))

    return id_and_text(docs, id_col, text_col).mapInArrow(run, REPORT_DDL)
