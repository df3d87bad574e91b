"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two 64-bit fingerprints at distance 4 or less share a value within distance 2
of both. So every distinct fingerprint stands for its ball of 2,081 variants
(all masks of at most two bits), and fingerprints that share a variant are the
candidates. The shuffle is on the variants' leading bits: a fingerprint goes
once to each prefix that its variants have (1 + b + b(b-1)/2 rows for b bits),
and the variants below that prefix are spelled out inside the task, sorted and
matched. Colliding pairs are deduplicated and verified on the full distance.

All fingerprints that share a variant are within distance 4 of each other, so
neighbours in the sorted run are linked and a run of any length costs one link
per member, never all pairs. Each task hands on a spanning forest of its links;
components follow by label propagation on those links, cut by written tables.
A prefix that collects far more variants than the rest (a large group of near
copies) gets further leading bits until each part is small, so every variant is
spelled out in one task only. That ends: at all 64 bits a prefix is one
variant, which at most 2,081 distinct fingerprints have.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringwatch.llm.common import arrow, id_and_text, session, written

SHINGLE_WORDS = 4
MAX_DISTANCE = 4
SEED = 42
#: Variants that a prefix is meant to gather, on average; with over four times as many it gets further bits.
PREFIX_VARIANTS = 1 << 20
MAX_PREFIX_BITS = 32
#: Bits by which a crowded prefix grows at a time.
DEEPER_BITS = 4

FP_SCHEMA = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])
LINK_SCHEMA = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def fingerprint(text: str, words_each: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit SimHash: a bit is 1 if set in over half of the shingles' XXH64; 0 without words."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes.lower: A-Z only; splits at \x20, \x09-\x0d
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    count = max(1, n - words_each + 1)
    if n > words_each:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])[:count].tolist()
        ends = ends[words_each - 1:].tolist()
    else:
        starts, ends = [0], [len(joined)]
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for k in range(0, count, 1 << 15):  # whole texts, in pieces of bounded memory
        h = np.fromiter((digest(joined[s:e], SEED) for s, e in zip(starts[k:k + (1 << 15)], ends[k:k + (1 << 15)])), np.uint64)
        ones += np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > count, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words_each: int = SHINGLE_WORDS, id_col: str = "doc_id", text_col: str = "text",
                 text_hash: bool = False) -> DataFrame:
    """(doc_id, fp): one row per document; fp is the fingerprint as a signed long. With ``text_hash`` also a hash of
    the whole text."""
    extra = [F.xxhash64("text").alias("text_hash")] if text_hash else []
    schema = pa.schema([*FP_SCHEMA, *([("text_hash", pa.int64())] if text_hash else [])])

    def run(batches):
        for batch in batches:
            fp = np.array([fingerprint(t, words_each) for t in batch.column("text").to_pylist()], np.uint64)
            hashes = {"text_hash": batch.column("text_hash")} if text_hash else {}
            yield arrow(schema, doc_id=batch.column("doc_id"), fp=fp.view(np.int64), **hashes)

    return id_and_text(docs, id_col, text_col).select("*", *extra).mapInArrow(
        run, "doc_id long, fp long" + (", text_hash long" if text_hash else ""))


def _masks(bits: int, flips: int) -> np.ndarray:
    """All masks of at most ``flips`` of the low ``bits`` bits, fewest first."""
    out, last = [0], [(0, -1)]
    for _ in range(flips):
        last = [(m | (1 << i), i) for m, top in last for i in range(top + 1, bits)]
        out += [m for m, _ in last]
    return np.array(out, np.uint64)


def ball_size(bits: int, flips: int) -> int:
    size, term = 0, 1
    for k in range(flips + 1):
        size, term = size + term, term * (bits - k) // (k + 1)
    return size


def _roots(n: int, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Smallest member of each node's component, for links lo-hi among n nodes."""
    label = np.arange(n)
    while True:
        m = np.minimum(label[lo], label[hi])
        new = label.copy()
        np.minimum.at(new, lo, m)
        np.minimum.at(new, hi, m)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def linked(fp: np.ndarray, flips: np.ndarray, low_bits: int, half: int, max_distance: int) -> np.ndarray:
    """Spanning links (m x 2 fingerprints) of one prefix: ``fp`` distinct, ``flips`` the bits already
    spent on the prefix."""
    order = np.argsort(fp, kind="stable")
    fp, flips = fp[order], flips[order]
    n = len(fp)
    low = fp & np.uint64((1 << low_bits) - 1)
    values, owners = [], []
    for k in range(half + 1):
        who, masks = np.flatnonzero(flips == k), _masks(low_bits, half - k)
        values.append((low[who][:, None] ^ masks[None]).ravel())
        owners.append(np.repeat(who, len(masks)))
    v, o = np.concatenate(values), np.concatenate(owners)
    del values, owners
    ranked = np.argsort(v)
    v = v[ranked]
    same = np.flatnonzero(v[1:] == v[:-1])
    a, b = o[ranked[same]], o[ranked[same + 1]]
    code = np.unique(np.minimum(a, b) * n + np.maximum(a, b))
    lo, hi = code // n, code % n
    near = np.bitwise_count(fp[lo] ^ fp[hi]) <= max_distance
    lo, hi = lo[near], hi[near]
    if not len(lo):
        return np.zeros((0, 2), np.uint64)
    root = _roots(n, lo, hi)
    child = np.flatnonzero(root != np.arange(n))
    return np.stack([fp[root[child]], fp[child]], axis=1)


def prefix_bits(distinct: int, half: int) -> int:
    """Leading bits so that a prefix gathers about ``PREFIX_VARIANTS`` variants."""
    bits = 0
    while bits < MAX_PREFIX_BITS and distinct * ball_size(64, half) > PREFIX_VARIANTS << bits:
        bits += 1
    return bits


def links(fps: DataFrame, distinct: int, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """(a, b): links that span every group of fingerprints connected at ``max_distance`` or less. ``fps``: distinct fp."""
    half = (max_distance + 1) // 2
    bits = prefix_bits(distinct, half)
    masks = [m - (1 << 64) if m >= 1 << 63 else m for m in (int(x) << (64 - bits) for x in _masks(bits, half))]
    rows = fps.select("fp", F.explode(F.array(*[F.lit(m).cast("long") for m in masks])).alias("mask")).select(
        "fp", F.bit_count("mask").cast("int").alias("flips"),
        F.shiftrightunsigned(F.col("fp").bitwiseXOR(F.col("mask")), 64 - bits).alias("prefix")
        if bits else F.lit(0).cast("long").alias("prefix"))
    parts = None
    while True:
        weight = F.element_at(F.array(*[F.lit(ball_size(64 - bits, half - k)) for k in range(half + 1)]), F.col("flips") + 1)
        crowded = written(rows.groupBy("prefix").agg(F.sum(weight).alias("variants"))
                          .where(F.col("variants") > 4 * PREFIX_VARIANTS).select("prefix"), "crowded-prefixes")
        more = bits < 64 and bool(crowded.head(1))
        part = (rows.join(crowded, "prefix", "left_anti") if more else rows).withColumn("bits", F.lit(bits))
        parts = part if parts is None else parts.unionByName(part)
        if not more:
            break
        step = min(DEEPER_BITS, 64 - bits)
        rows = written(deeper(rows.join(crowded, "prefix", "left_semi"), bits, step, half), "crowded-rows")
        bits += step

    def match(t: pa.Table) -> pa.Table:
        found = linked(t["fp"].to_numpy().view(np.uint64), t["flips"].to_numpy(), 64 - t["bits"][0].as_py(), half,
                       max_distance).view(np.int64)
        return pa.Table.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], schema=LINK_SCHEMA)

    return parts.groupBy("bits", "prefix").applyInArrow(match, "a long, b long")


def deeper(rows: DataFrame, bits: int, step: int, half: int) -> DataFrame:
    """(fp, flips, prefix) under prefixes ``step`` bits longer: the same variants, each under one longer prefix."""
    own = F.shiftrightunsigned("fp", 64 - bits - step).bitwiseAND(F.lit((1 << step) - 1).cast("long"))
    masks = F.array(*[F.lit(int(m)).cast("long") for m in _masks(step, half)])
    spread = rows.withColumn("mask", F.explode(masks)).withColumn("now", F.col("flips") + F.bit_count("mask").cast("int"))
    return spread.filter(F.col("now") <= half).select(
        "fp", F.col("now").alias("flips"),
        F.shiftleft("prefix", step).bitwiseOR(own.bitwiseXOR(F.col("mask"))).alias("prefix"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root): a shared root for every node that has a link. Each round takes the smallest label
    next door, then the label's own label; rounds are written tables, so no lineage grows."""
    spark = edges.sparkSession
    both = written(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    label = written(both.groupBy("a").agg(F.min("b").alias("m"))
                    .select(F.col("a").alias("node"), F.least("a", "m").alias("root")), "labels")
    if not label.head(1):
        return label
    while True:
        near = (both.join(label.select(F.col("node").alias("b"), "root"), "b").groupBy("a").agg(F.min("root").alias("m")))
        step = (label.join(near, label["node"] == near["a"])
                .select("node", F.col("root").alias("was"), F.least("root", "m").alias("root")))
        jump = label.select(F.col("node").alias("_n"), F.col("root").alias("_r"))
        new = written(step.join(jump, step["root"] == jump["_n"], "left")
                      .select("node", "was", F.least("root", F.coalesce("_r", "root")).alias("root")), "labels")
        moved = new.where("root <> was").count()
        label = new.select("node", "root")
        if not moved:
            return label


def simhash_components(docs: DataFrame, words_each: int = SHINGLE_WORDS, max_distance: int = MAX_DISTANCE,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id.

    component_id is the smallest doc_id that links reach, the document's own
    included. Null and empty texts, and texts of white space, have fingerprint
    zero and link like any other. Repeated rows share fingerprint and component.
    Rows with a null doc_id get the smallest id of the others in their group
    (null if there is none). An empty table gives an empty result.
    """
    session(docs.sparkSession)
    fp = written(fingerprints(docs, words_each, id_col, text_col), "fingerprints")
    full = _labelled(fp, max_distance).select("fp", "component_id")
    return fp.join(full, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _labelled(fp: DataFrame, max_distance: int) -> DataFrame:
    """(fp, root, component_id) of every distinct fingerprint; ``root`` names the component, whether it has ids or not."""
    groups = written(fp.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    tree = components(written(links(groups.select("fp"), groups.count(), max_distance), "spanning-links"))
    named = tree.join(groups, tree["node"] == groups["fp"]).select("fp", "root", "first_id")
    least = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = named.join(least, "root").select(F.col("fp").alias("_fp"), "root", "component_id")
    # Written first: then both sides of the last join are plain exchanges, and a fingerprint with many rows is split.
    return written(groups.join(named, groups["fp"] == named["_fp"], "left")
                   .select("fp", F.coalesce("root", "fp").alias("root"), F.coalesce("component_id", "first_id").alias("component_id")),
                   "fingerprint-components")


def drop_near_copies(docs: DataFrame, words_each: int = SHINGLE_WORDS, max_distance: int = MAX_DISTANCE,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with exactly one row of each component, all its columns kept: the one with the smallest id, null ids
    last; of several texts under that id the one with the smallest hash, of equal rows any one. Rows that share
    an id but not a component are told apart by their texts. An empty table gives an empty result."""
    session(docs.sparkSession)
    fp = written(fingerprints(docs, words_each, id_col, text_col, text_hash=True), "fingerprints")
    full = _labelled(fp, max_distance).select(F.col("fp").alias("_fp"), "root")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("first")
    winners = (fp.join(full, fp["fp"] == full["_fp"]).groupBy("root").agg(first)
               .select(F.col("first.doc_id").alias("_id"), F.col("first.text_hash").alias("_hash")))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    stay = written(fp.join(winners, same).groupBy("_id", "_hash").agg(F.count(F.lit(1)).alias("_n")), "near-winners")
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                      F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).alias("text_hash"))
    once = row.join(stay.where("_n = 1"), same, "left_semi").select("_row")
    more = (row.join(stay.where("_n > 1"), same, "left_semi")
            .groupBy("doc_id", "text_hash").agg(F.first("_row").alias("_row")).select("_row"))
    return once.unionByName(more).select("_row.*")
