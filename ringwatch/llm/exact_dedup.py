"""Exact deduplication against a minimal perfect hash of historical digests.

The history is the set of distinct text digests already ingested. It is split
into buckets by digest; each bucket gets its own minimal perfect hash (levels
of bit arrays: a key settles at the first level where its position is free of
collisions, its slot is the rank of that bit), and slot ``i`` holds the full
32-byte digest, the winner's locator (doc_id, row number) and the group size.
An arriving digest is looked up by one rank computation and a comparison of all
32 bytes, so a nonmember that lands on a slot is never taken for a repeat.
Arriving rows are grouped by digest before the lookup (map-side combine), which
keeps a text that holds a third of all rows down to one row per task.
Digests that are not in the history form groups of their own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringwatch.llm.common import id_and_text, part_of, session, written

#: Distinct digests of one bucket, on average: a few hundred KB of slots.
BUCKET_DIGESTS = 1024
#: Bits per key at each level, and levels before the (exact) leftover list.
GAMMA, LEVELS = 2.0, 24

INDEX_SCHEMA = "bucket long, sizes binary, bits binary, left binary, digests binary, ids binary, rows binary, counts binary"
GROUP_SCHEMA = pa.schema([("digest", pa.binary()), ("keep_id", pa.int64()), ("keep_row", pa.int64()),
                          ("group_size", pa.int64()), ("member", pa.bool_())])


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, row, digest): SHA-256 of the whole text's UTF-8 bytes, null as empty.
    ``row`` numbers rows so that repeated (doc_id, text) rows still have one winner."""
    return id_and_text(docs, id_col, text_col).select(
        "doc_id", F.monotonically_increasing_id().alias("row"), F.unhex(F.sha2("text", 256)).alias("digest"))


def _words(d: np.ndarray) -> np.ndarray:
    return np.frombuffer(d.tobytes(), dtype="<u8").reshape(-1, 4)


def _spots(words: np.ndarray, level: int, size: int) -> np.ndarray:
    """Position of each digest at a level: digest words mixed with the level's odd constant."""
    x = words[:, level % 4] ^ (words[:, (level + 1) % 4] * np.uint64(2 * level + 3))
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    return (x % np.uint64(size)).astype(np.int64)


def mph_build(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(level sizes, all levels' bits, keys left over, slot of each key) for distinct 32-byte keys (n x 32 uint8)."""
    words = _words(keys)
    n = len(keys)
    todo, slot = np.arange(n), np.full(n, -1, np.int64)
    sizes, bits, used = [], [], 0
    for level in range(LEVELS):
        if not len(todo):
            break
        size = max(8, int(GAMMA * len(todo)))
        at = _spots(words[todo], level, size)
        alone = np.bincount(at, minlength=size) == 1
        rank = np.cumsum(alone) - 1 + used
        ok = alone[at]
        slot[todo[ok]] = rank[at[ok]]
        used += int(alone.sum())
        sizes.append(size)
        bits.append(alone)
        todo = todo[~ok]
    slot[todo] = used + np.arange(len(todo))
    return (np.array(sizes, np.int64), np.concatenate(bits) if bits else np.zeros(0, bool), keys[todo], slot)


def mph_lookup(keys: np.ndarray, sizes: np.ndarray, bits: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Slot of each key, -1 where no slot can hold it. The slot's digest must still be compared."""
    words = _words(keys)
    rank = np.cumsum(bits) - 1
    slot, todo, start = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
    for level, size in enumerate(sizes.tolist()):
        at = start + _spots(words[todo], level, size)
        hit = bits[at]
        slot[todo[hit]] = rank[at[hit]]
        todo, start = todo[~hit], start + size
    if len(left) and len(todo):
        first = int(bits.sum())
        where = {k.tobytes(): first + i for i, k in enumerate(left)}
        slot[todo] = [where.get(keys[i].tobytes(), -1) for i in todo]
    return slot


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, 32)


def _build(t: pa.Table) -> pa.Table:
    keys = _matrix(t["digest"])
    sizes, bits, left, slot = mph_build(keys)
    order = np.argsort(slot)
    ids = t["keep_id"].fill_null(-(2**63)).to_numpy()
    out = {"bucket": [t["bucket"][0].as_py()], "sizes": [sizes.tobytes()], "bits": [np.packbits(bits).tobytes()],
           "left": [left.tobytes()], "digests": [keys[order].tobytes()], "ids": [ids[order].tobytes()],
           "rows": [t["keep_row"].to_numpy()[order].tobytes()], "counts": [t["n"].to_numpy()[order].tobytes()]}
    return pa.table(out)


def _grouped(rows: DataFrame, buckets: int) -> DataFrame:
    """One row per digest: the winner (largest doc_id, then last row) and the number of rows."""
    return (rows.groupBy("digest").agg(F.max(F.struct("doc_id", "row")).alias("w"), F.count(F.lit(1)).alias("n"))
            .select("digest", F.col("w.doc_id").alias("keep_id"), F.col("w.row").alias("keep_row"), "n",
                    F.pmod(F.xxhash64("digest"), F.lit(buckets)).alias("bucket")))


def build_history(rows: DataFrame, buckets: int) -> DataFrame:
    """The history index: one row per bucket with its hash levels and slot arrays."""
    return _grouped(rows, buckets).groupBy("bucket").applyInArrow(_build, INDEX_SCHEMA)


def _lookup(new: pa.Table, index: pa.Table) -> pa.Table:
    """Groups of one bucket: every historical slot, merged with its arriving repeats, and the nonmembers."""
    none = -(2**63)
    keys = _matrix(new["digest"]) if new.num_rows else np.zeros((0, 32), np.uint8)
    ids, rows, n = (new[c].fill_null(none).to_numpy() if new.num_rows else np.zeros(0, np.int64)
                    for c in ("keep_id", "keep_row", "n"))
    if index.num_rows:
        get = lambda c, kind: np.frombuffer(index[c][0].as_py(), kind)
        sizes = get("sizes", np.int64)
        bits = np.unpackbits(get("bits", np.uint8), count=int(sizes.sum())).astype(bool)
        slots = get("digests", np.uint8).reshape(-1, 32)
        h_ids, h_rows, h_n = (get(c, np.int64).copy() for c in ("ids", "rows", "counts"))
        slot = mph_lookup(keys, sizes, bits, get("left", np.uint8).reshape(-1, 32))
        member = slot >= 0
        member[member] = (slots[slot[member]] == keys[member]).all(axis=1)
        at = slot[member]
        newer = (ids[member] > h_ids[at]) | ((ids[member] == h_ids[at]) & (rows[member] > h_rows[at]))
        h_n[at] += n[member]
        h_ids[at[newer]], h_rows[at[newer]] = ids[member][newer], rows[member][newer]
        keys = np.concatenate([slots, keys[~member]])
        ids, rows, n = (np.concatenate([h, x[~member]]) for h, x in ((h_ids, ids), (h_rows, rows), (h_n, n)))
        known = np.arange(len(keys)) < len(slots)
    else:
        known = np.zeros(len(keys), bool)
    digest = [k.tobytes() for k in keys]
    return pa.Table.from_arrays([pa.array(digest, pa.binary()), pa.array(ids, mask=ids == none), pa.array(rows),
                                 pa.array(n), pa.array(known)], schema=GROUP_SCHEMA)


def merge_with_history(arriving: DataFrame, index: DataFrame, buckets: int) -> DataFrame:
    """Distinct-digest groups (digest, keep_id, keep_row, group_size, member) of history and arrivals together."""
    new = _grouped(arriving, buckets)
    return (new.groupBy("bucket").cogroup(index.groupBy("bucket"))
            .applyInArrow(_lookup, "digest binary, keep_id long, keep_row long, group_size long, member boolean"))


def exact_dedup(docs: DataFrame, history_until: int | None = None, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, in_history.

    Rows with doc_id up to ``history_until`` (default: the approximate median)
    are the historical batch, the others arrive later; the split changes the
    work, never the result. Of equal texts the row with the largest doc_id
    stays; null ids rank lowest, and of rows that repeat id and text exactly one
    stays. A null text is an empty one. An empty table gives an empty result.
    """
    session(docs.sparkSession)
    rows = written(digests(docs, id_col, text_col), "digests")
    total = rows.count()
    if history_until is None:
        history_until = rows.agg(F.percentile_approx("doc_id", 0.5)).first()[0]
    buckets = part_of(total, BUCKET_DIGESTS)
    old = F.coalesce(F.col("doc_id") <= F.lit(history_until), F.lit(False)) if history_until is not None else F.lit(False)
    index = written(build_history(rows.where(old), buckets), "digest-history")
    groups = written(merge_with_history(rows.where(~old), index, buckets), "digest-groups")
    # The row side may hold a third of all rows under one digest: adaptive execution splits that partition.
    return (rows.join(groups, "digest")
            .select("doc_id", "keep_id", "group_size",
                    (F.col("row") == F.col("keep_row")).alias("kept"),
                    F.lower(F.hex("digest")).alias("text_sha256"), F.col("member").alias("in_history")))


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each set of equal texts, all its columns kept."""
    verdict = written(exact_dedup(docs, None, id_col, text_col), "exact-verdict")
    winners = verdict.where("kept").select(F.col("keep_id").alias("_w_id"), F.unhex("text_sha256").alias("_w_digest"))
    # Rows that repeat both id and text: one stays. Only those few pass a second grouping.
    many = written(verdict.where(F.col("doc_id").eqNullSafe(F.col("keep_id"))).groupBy("text_sha256").count()
                   .where("count > 1").select(F.unhex("text_sha256").alias("_many")), "repeated-rows")
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                      F.col(f"`{id_col}`").cast("long").alias("_id"),
                      F.unhex(F.sha2(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), 256)).alias("_digest"))
    hit = row.join(winners, F.col("_id").eqNullSafe(F.col("_w_id")) & (F.col("_digest") == F.col("_w_digest")), "left_semi")
    single = hit.join(many, F.col("_digest") == F.col("_many"), "left_anti").select("_row")
    repeated = (hit.join(many, F.col("_digest") == F.col("_many"), "left_semi")
                .groupBy("_digest").agg(F.first("_row").alias("_row")).select("_row"))
    return single.unionByName(repeated).select("_row.*")
