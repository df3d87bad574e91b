"""Language-model scores by deleted interpolation of a bigram model.

The probability of a word after another is a mixture of three maximum-likelihood
estimates, of the pair, of the word and of any word alike; the mixture's weights depend
on how often the context was seen (a bucket per power of two). The training texts fall
into folds by the crc32 of their doc_id. For the weights every fold is held out in turn:
its pairs are predicted by the counts of the others, which are the counts of all less
the fold's own, and expectation maximisation over all held-out pairs finds the weights.
The score then uses the counts of all training texts.

All counts come from whole training texts, by exchange between blocks and buckets
(``wordblocks``): a block sends its distinct words, then its distinct pairs, and gets the
totals and its own fold's counts back, so no table of counts is ever broadcast. Words
are compared as strings, pairs by a 56-bit hash of their words' hashes (of n different pairs
about n^2 / 2^57 share one, and then their counts). The expectation step needs, per held-out pair, only its two estimates; the
pairs are summed up in cells (bucket, estimates to a sixteenth of a power of two, with
their mean logarithm), a bounded table whatever the corpus, on which the driver runs
the iterations. A task works on one block at a time, on its sorted (pair, fold) cells, and
on a slice of them where several values per cell are needed; blocks end soon after
BLOCK_WORDS words, so a worker's memory follows neither the corpus nor a batch of long texts.

Defined cases: a null text is empty; an empty text is the end token alone; a null doc_id
counts as the empty string for its fold and comes back null; repeated rows count and are
scored each; very long texts are never cut (a block holds one whole text at least);
without training texts every score is 0; an empty table gives no rows; ties cannot arise;
further columns, whatever their names, are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringwatch.llm import wordblocks as B
from ringwatch.llm.common import arrow, discard, part_of, scratch, session, written

#: Texts with crc32(doc_id) mod FOLDS = TEST_FOLD are never learnt from.
FOLDS, TEST_FOLD = 7, 2
#: Stands for a null doc_id inside (that long itself would come back null).
NULL_ID = -(1 << 63)
#: Cells of one power of two; rounds of expectation maximisation, at most; change that ends it.
STEPS, ROUNDS, CLOSE = 16, 200, 1e-9

_BLOCK = pa.schema([("block", pa.int64()), ("kinds", pa.int64()), ("ids", pa.binary()), ("codes", pa.binary()),
                    ("c1", pa.binary()), ("own1", pa.binary()), ("c2", pa.binary()), ("own2", pa.binary())])
_BLOCK_DDL = "block long, kinds long, ids binary, codes binary, c1 binary, own1 binary, c2 binary, own2 binary"
_SENT_DDL = "bucket long, block long, keys binary, cells binary"
_BACK_DDL = "block long, bucket long, totals binary, own binary"
_CELLS_DDL = "bucket long, q2 long, q1 long, weight long, log2 double, log1 double"
#: Pairs worked on at a time; cells that a task holds between two sums, and keeps after one.
SOME, HELD = 1 << 17, 1 << 19
#: Places of a cell's estimate: 0 for none, else its logarithm above 2^-63, in steps.
GRID = 64 * STEPS
SCORES = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                    ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
SCORES_DDL = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


TRAIN = [f for f in range(FOLDS) if f != TEST_FOLD]


def bucket_of(context: np.ndarray) -> np.ndarray:
    """Bucket of a context's count: 0 if never seen, else 1 + the whole part of its binary logarithm."""
    return np.frexp(context.astype(np.float64))[1]


def folds_of(ids: np.ndarray) -> np.ndarray:
    return np.array([zlib.crc32(b"" if i == NULL_ID else str(i).encode()) % FOLDS for i in ids.tolist()], np.int64)


def tokens_of(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token, ends, fold of each text) of a block's texts: places in its words, ``kinds`` for the end."""
    token = B.block_codes(row["codes"])
    ends = np.flatnonzero(token < 0)
    token[ends] = row["kinds"]
    return token, ends, folds_of(np.frombuffer(row["ids"], "<i8"))


def lengths_of(ends: np.ndarray) -> np.ndarray:
    return np.diff(ends, prepend=-1)


def pairs_at(token: np.ndarray, size: int) -> np.ndarray:
    """context * size + token of each place; a text's first context is the end."""
    pair = np.empty(len(token), np.int64)
    pair[0] = size - 1
    pair[1:] = token[:-1]
    pair *= size
    pair += token
    return pair


def firsts(values: np.ndarray) -> np.ndarray:
    """Places of the first of each run of equal values."""
    return np.flatnonzero(np.append(True, values[1:] != values[:-1]))


class Pairs:
    """A block's distinct pairs by (context, token), and their cells (pair, fold) by pair and fold.

    A pair has few cells, so they are sorted and listed, never laid out as a table (fold, pair)."""

    def __init__(self, row: dict):
        token, ends, fold = tokens_of(row)
        size = row["kinds"] + 1
        cell = pairs_at(token, size)
        del token
        cell *= FOLDS
        cell += np.repeat(fold.astype(np.int8), lengths_of(ends))
        cell.sort()
        at = firsts(cell)
        self.count = np.diff(at, append=len(cell))  # of each cell
        cell = cell[at]
        self.fold = (cell % FOLDS).astype(np.int8)  # of each cell
        cell //= FOLDS
        self.first = firsts(cell)  # cell of each pair
        pair = cell[self.first]
        self.token, self.context = (pair % size).astype(np.int32), (pair // size).astype(np.int32)

    def __len__(self) -> int:
        return len(self.first)

    def cells_each(self) -> np.ndarray:
        return np.diff(self.first, append=len(self.fold))

    def by_key(self, hashes: np.ndarray, buckets: int):
        """(keys in order, their pairs, names of their buckets, edges of these in the keys)."""
        keys = pair_keys(hashes, self.token, self.context)
        order = np.argsort(keys)
        keys = keys[order]
        to = buckets_of(keys, buckets)
        at = firsts(to)
        return keys, order, to[at].astype(np.int64), np.append(at, len(keys))

    def cells_by(self, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(cells of the pairs in ``order``, edges of these pairs among them)."""
        each = self.cells_each()[order]
        edge = np.append(0, np.cumsum(each))
        cell = np.repeat(self.first[order] - edge[:-1], each)
        cell += np.arange(len(cell))
        return cell, edge


def fit_weights(cells: np.ndarray, uniform: float) -> np.ndarray:
    """Weights (pair, word, any) per bucket by expectation maximisation.

    ``cells`` has columns bucket, weight, pair estimate, word estimate. Bucket 0 has no pair estimate; a
    bucket without held-out pairs takes the weights of the one below. Every weight that may apply
    stays above zero, so that no token is impossible."""
    out = np.zeros((66, 3))
    for b in range(len(out)):
        mine = cells[cells[:, 0] == b]
        use = np.array([b > 0, 1.0, 1.0])
        lam = out[b - 1] if b > 1 else use / use.sum()
        if len(mine):
            weight = mine[:, 1] / mine[:, 1].sum()
            part = np.column_stack([mine[:, 2], mine[:, 3], np.full(len(mine), uniform)])
            lam = use / use.sum()
            for _ in range(ROUNDS):
                share = part * lam
                new = weight @ (share / share.sum(axis=1, keepdims=True))
                moved, lam = np.abs(new - lam).max(), new
                if moved < CLOSE:
                    break
            lam = (lam + 1e-6 * use) / (lam + 1e-6 * use).sum()
        out[b] = lam
    return out


def own_words(row: dict) -> np.ndarray:
    """Counts (fold, word) of a block's words."""
    token, ends, fold = tokens_of(row)
    size = row["kinds"] + 1
    token += np.repeat(fold * size, lengths_of(ends))
    return np.bincount(token, minlength=FOLDS * size).reshape(FOLDS, size)[:, :-1]


def pair_keys(hashes: np.ndarray, token: np.ndarray, context: np.ndarray) -> np.ndarray:
    """56-bit keys of pairs, from the hashes of the block's words; the end has its own. No key is zero."""
    own = np.append(hashes, np.uint64(0x632BE59BD9B4E019))
    return np.maximum(B.mixed(own[context], own[token]) >> np.uint64(8), np.uint64(1))


def buckets_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Equal ranges of the keys, so that those of one bucket differ in fewer bits."""
    return keys // np.uint64(-(-(1 << 56) // buckets))


def counted_blocks(docs: DataFrame, id_col: str, text_col: str):
    """(blocks with the counts of their words and pairs, totals): training tokens ``N``, different ones ``V``, and
    texts and tokens per fold."""
    rows = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NULL_ID)).alias("key"), F.lit("").alias("grp"),
                       F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    spark = docs.sparkSession
    blocks_at, words_at, pairs_at = (scratch(spark, x) for x in ("blocks", "words", "pairs"))
    made = B.blocks(rows, path=blocks_at)

    def measure(batches):
        for batch in batches:
            for row in B.rows_of(batch):
                _, ends, fold = tokens_of(row)
                tokens = np.bincount(fold, lengths_of(ends), FOLDS).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(FOLDS)), pa.array(tokens),
                                                  pa.array(np.bincount(fold, minlength=FOLDS))], names=["fold", "tokens", "texts"])

    sizes = {r.fold: r for r in made.select("ids", "codes", "kinds").mapInArrow(measure, "fold long, tokens long, texts long")
             .groupBy("fold").agg(F.sum("tokens").alias("tokens"), F.sum("texts").alias("texts")).collect()}
    tokens = np.array([sizes[f].tokens if sizes else 0 for f in range(FOLDS)], np.int64)
    texts = np.array([sizes[f].texts if sizes else 0 for f in range(FOLDS)], np.int64)
    table, word_buckets = B.word_table(made, False, own_words, FOLDS, TRAIN, least=1, path=words_at, tidy=True)
    found = table.where("block < 0").agg(F.sum("n")).first()[0] or 0
    totals = {"N": int(tokens[TRAIN].sum()), "V": found + int(texts[TRAIN].sum() > 0), "tokens": tokens, "texts": texts}
    pair_buckets = part_of(int(tokens.sum()), B.BUCKET_PHRASES)

    def send(batches):
        for batch in batches:
            for row in B.rows_of(batch):
                own = Pairs(row)
                keys, order, names, at = own.by_key(B.word_hashes(B.unpack_words(row["words"])), pair_buckets)
                cell, edge = own.cells_by(order)
                new = np.zeros(len(cell), bool)
                new[edge[:-1]] = True
                fold, count = own.fold[cell], own.count[cell]
                del own, order, cell
                sent = [(B.pack(np.diff(keys[x:y], prepend=np.uint64(0))), B.pack_cells(new[s:t], fold[s:t], count[s:t]))
                        for x, y, s, t in zip(at, at[1:], edge[at], edge[at[1:]])]
                yield pa.RecordBatch.from_arrays([pa.array(names), pa.array([row["block"]] * len(names), pa.int64()),
                                                  *(pa.array(x, pa.binary()) for x in zip(*sent))], names=["bucket", "block", "keys", "cells"])

    def settle(sent: pa.Table) -> pa.Table:
        keys = [np.cumsum(B.unpack(x).view(np.uint64), dtype=np.uint64) for x in sent.column("keys").to_pylist()]
        at = np.append(0, np.cumsum([len(x) for x in keys]))
        distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
        kinds = len(distinct)
        del keys, distinct
        new, fold, count = map(np.concatenate, zip(*map(B.unpack_cells, sent.column("cells").to_pylist())))
        cell = place[np.cumsum(new) - 1] * FOLDS + fold
        edge = np.append(np.flatnonzero(new), len(new))[at]
        of_fold = np.bincount(cell, count, FOLDS * kinds)  # whole numbers
        del new, fold, count
        own = of_fold[cell].astype(np.int64)
        of_fold = of_fold.reshape(-1, FOLDS)
        total = sum(of_fold[:, f] for f in TRAIN).astype(np.int64)[place]
        return pa.table([sent.column("block"), sent.column("bucket"),
                         pa.array([B.pack(total[x:y]) for x, y in zip(at, at[1:])], pa.binary()),
                         pa.array([B.pack(own[x:y]) for x, y in zip(edge, edge[1:])], pa.binary())],
                        names=["block", "bucket", "totals", "own"])

    def of_words(row: dict, hashes: np.ndarray, answers: pa.Table) -> list[bytes]:
        tally, to = own_words(row), hashes % np.uint64(word_buckets)
        k, f = B.cells(tally)
        return [B.pack(B.in_block_order(to, answers, "totals")), B.pack(B.in_block_order(to, answers, "own", tally)[f, k])]

    def of_pairs(row: dict, hashes: np.ndarray, answers: pa.Table) -> list[bytes]:
        own = Pairs(row)
        _, order, names, at = own.by_key(hashes, pair_buckets)
        cell, edge = own.cells_by(order)
        out = []
        for column, to, edges in (("totals", order, at), ("own", cell, edge[at])):
            of = dict(zip(answers.column("bucket").to_pylist(), answers.column(column).to_pylist()))
            got = np.empty(len(to), np.int64)
            for name, x, y in zip(names.tolist(), edges, edges[1:]):
                got[to[x:y]] = B.unpack(of[name], y - x)
            out.append(B.pack(got))
        return out

    def join(block: pa.Table, back: pa.Table) -> pa.Table:
        row = next(B.rows_of(block))
        hashes = B.word_hashes(B.unpack_words(row["words"]))
        by_word, by_pair = (back.filter(pa.compute.equal(back.column("pair"), k)) for k in (False, True))
        out = of_words(row, hashes, by_word) + of_pairs(row, hashes, by_pair)
        return pa.table([*(block.column(c) for c in ("block", "kinds", "ids", "codes")), *(pa.array([x], pa.binary()) for x in out)], schema=_BLOCK)

    pairs = made.select("block", "kinds", "ids", "words", "codes").mapInArrow(send, _SENT_DDL).groupBy("bucket").applyInArrow(settle, _BACK_DDL)
    pairs = written(pairs, "pairs", path=pairs_at, tidy=True)  # the sent pairs go before the blocks are shuffled
    answers = (table.where("block >= 0").select("block", "bucket", "totals", "own", F.lit(False).alias("pair"))
               .unionByName(pairs.withColumn("pair", F.lit(True))))
    whole = made.select("block", "kinds", "ids", "words", "codes")
    counted = written(whole.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(join, _BLOCK_DDL), "counted", tidy=True)
    for path in (blocks_at, words_at, pairs_at):
        discard(spark, path)
    return counted, totals


def word_totals(row: dict, totals: dict) -> np.ndarray:
    """Training counts of a block's words, and of the end."""
    return np.append(B.unpack(row["c1"], row["kinds"]), totals["texts"][TRAIN].sum())


def summed(key: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """(distinct keys, sums of each of the values)."""
    distinct, place = np.unique(key, return_inverse=True)
    return distinct, *(np.bincount(place, v) for v in values)


def held_out_cells(blocks: DataFrame, totals: dict) -> np.ndarray:
    """Cells of all held-out pairs of the training folds: bucket, weight, pair estimate, word estimate."""
    rest = totals["N"] - totals["tokens"]

    def cells(row: dict):
        """The cells of a block, summed up for some of its pairs at a time."""
        own = Pairs(row)
        all1, all2, own2 = word_totals(row, totals), B.unpack(row["c2"], len(own)), B.unpack(row["own2"], len(own.fold))
        k, f = B.cells(own_words(row))
        of_fold = np.zeros((FOLDS, len(all1)), np.int64)
        of_fold[f, k] = B.unpack(row["own1"], len(k))
        of_fold[:, -1] = totals["texts"]
        del k, f
        each = own.cells_each()
        for x in range(0, len(own), SOME):
            part = slice(x, x + SOME)
            cell = slice(own.first[x], own.first[x] + each[part].sum())
            at = np.repeat(np.arange(x, min(x + SOME, len(own))), each[part])
            learnt = own.fold[cell] != TEST_FOLD
            at, fold, n = at[learnt], own.fold[cell][learnt], own.count[cell][learnt]
            token, context = own.token[at], own.context[at]
            pair = all2[at] - own2[cell][learnt]
            before, word = all1[context] - of_fold[fold, context], all1[token] - of_fold[fold, token]
            with np.errstate(divide="ignore", invalid="ignore"):
                log2 = np.where(pair > 0, np.log2(pair) - np.log2(before), 0.0)
                log1 = np.where(word > 0, np.log2(word) - np.log2(rest)[fold], 0.0)
            q2 = np.where(pair > 0, np.floor(log2 * STEPS + 1e-9) + GRID - 1, 0).astype(np.int32)
            q1 = np.where(word > 0, np.floor(log1 * STEPS + 1e-9) + GRID - 1, 0).astype(np.int32)
            yield summed((bucket_of(before).astype(np.int32) * GRID + q2) * GRID + q1, n, n * log2, n * log1)

    def sent(cell, weight, log2, log1):
        return pa.RecordBatch.from_arrays(
            [pa.array(x.astype(np.int64)) for x in (cell // GRID // GRID, cell // GRID % GRID, cell % GRID, weight)]
            + [pa.array(log2), pa.array(log1)], names=["bucket", "q2", "q1", "weight", "log2", "log1"])

    def run(batches):
        held, waiting = [], 0
        for batch in batches:
            for row in B.rows_of(batch):
                for got in cells(row):
                    held.append(got)
                    waiting += len(got[0])
                    if waiting > HELD:
                        held, waiting = [summed(*map(np.concatenate, zip(*held)))], 0
                        if len(held[0][0]) > HELD:
                            yield sent(*held.pop())
        if held:
            yield sent(*summed(*map(np.concatenate, zip(*held))))

    found = (blocks.mapInArrow(run, _CELLS_DDL).groupBy("bucket", "q2", "q1")
             .agg(F.sum("weight").alias("weight"), F.sum("log2").alias("log2"), F.sum("log1").alias("log1")).toArrow())
    bucket, q2, q1, weight, log2, log1 = (found.column(c).to_numpy() for c in found.schema.names)
    order = np.lexsort((q1, q2, bucket))
    out = np.column_stack([bucket, weight, np.where(q2 > 0, 2.0 ** (log2 / weight), 0.0), np.where(q1 > 0, 2.0 ** (log1 / weight), 0.0)])
    return out[order]


def scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score (add-one unigrams) and
    score, the model's log10 probability of the text with its end."""
    session(docs.sparkSession)
    blocks, totals = counted_blocks(docs, id_col, text_col)
    N, V = totals["N"], totals["V"]
    uniform = 1.0 / (V + 1)
    weights = fit_weights(held_out_cells(blocks, totals), uniform)

    def log_p(c1: np.ndarray, c2: np.ndarray, context: np.ndarray, token: np.ndarray) -> np.ndarray:
        lam = weights[bucket_of(c1[context])]
        return np.log10(lam[:, 0] * (c2 / np.maximum(c1[context], 1)) + lam[:, 1] * (c1[token] / N) + lam[:, 2] * uniform)

    def run(batches):
        for batch in batches:
            for row in B.rows_of(batch):
                token, ends, fold = tokens_of(row)
                c1, size, starts = word_totals(row, totals), row["kinds"] + 1, np.append(0, ends[:-1] + 1)
                known = np.add.reduceat((c1 > 0)[token].astype(np.int64), starts)
                base = np.add.reduceat(np.log10((c1 + 1) / (N + V + 1))[token], starts)
                pair, place = np.unique(pairs_at(token, size), return_inverse=True)
                del token
                c2, value = B.unpack(row["c2"], len(pair)), np.zeros(len(pair))
                for x in range(0, len(pair) if N else 0, SOME):
                    part = slice(x, x + SOME)
                    value[part] = log_p(c1, c2[part], pair[part] // size, pair[part] % size)
                del pair, c2
                ids = np.frombuffer(row["ids"], "<i8")
                yield arrow(SCORES, doc_id=pa.array(ids, mask=ids == NULL_ID), held_out=fold == TEST_FOLD,
                            n_tokens=lengths_of(ends), n_known=known, train_tokens=[N] * len(ids), base_score=base,
                            score=np.add.reduceat(value[place], starts))

    return blocks.mapInArrow(run, SCORES_DDL)
