"""Substring deduplication by hashing lines and sentences.

A text is cut into units: at line ends, and within a line after a sentence mark
followed by a space. Every unit with words is normalised (case, white space, edge
punctuation) and hashed to 128 bits; units without words are passed over.

What is removed are passages: consecutive units of together ``min_words`` words
or more that have come before, word for word, in the same order. A unit of that
many words is a passage by itself; a shorter one is looked at with its neighbours,
in the least passage that begins with it and the least one that ends with it. The
earliest occurrence, by (doc_id, hash of the text, row, offset), stays; every unit of a later one is
removed, and reported with its place in the original text. ``min_words=1``
removes every repeated unit, however short.

The passages follow from two groupings: units that occur once are left out first,
by digest alone; only stretches of units that come again are cut into passages,
whose digests (of their units' digests) are grouped in turn.

The default of 12 words comes from the sf0.1 documents: of documents that share a
passage of 50 words or more with an earlier one, 98 % have a unit removed, of the
others 6 % (with 5 words: 99 % and 39 %, the latter by common short lines).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringwatch.llm.common import discard, id_and_text, scratch, session, written

MIN_WORDS = 12
#: Rows of units gathered before they are cut into passages; a stretch is never cut, so a batch may be longer.
STEP_ROWS = 50_000
#: Where a unit ends: after a line feed, or after a sentence mark and the spaces behind it.
_END = re.compile(r"\n|[.!?]+[ \t]+")
_EDGES = b" \t\r\x0b\x0c.,;:!?\"'()[]"

#: The two halves of a digest, as longs: exchanged, counted and compared without binary values.
DIGEST = ["high", "low"]
UNITS = pa.schema([("high", pa.int64()), ("low", pa.int64()), ("doc_id", pa.int64()), ("version", pa.int64()), ("row", pa.int64()),
                   ("no", pa.int32()), ("start", pa.int32()), ("size", pa.int32()), ("words", pa.int32())])
UNITS_DDL = "high long, low long, doc_id long, version long, row long, no int, start int, size int, words int"
PARTS = ("start", "size", "words")
PASSAGES_DDL = "high long, low long, doc_id long, version long, row long, no int, start array<int>, size array<int>, words array<int>"


def unit_spans(text: str) -> list[tuple[int, int]]:
    """(start, end) of the units; they follow each other and cover the text."""
    out, at = [], 0
    for m in _END.finditer(text):
        out.append((at, m.end()))
        at = m.end()
    if at < len(text):
        out.append((at, len(text)))
    return out


def normalised(unit: str) -> tuple[bytes, int]:
    """(normal form, number of words): lower case, single spaces, no punctuation at the edges."""
    words = unit.lower().encode("utf-8", "surrogatepass").split()
    return b" ".join(words).strip(_EDGES), len(words)


def numbered(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, doc_id, version, text): a number per row, and the text's hash, which ranks rows of equal id however they lie."""
    return id_and_text(docs, id_col, text_col).select(F.monotonically_increasing_id().alias("row"), "doc_id",
                                                      F.xxhash64("text").alias("version"), "text")


def halves(digests: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The two longs of each digest of 16 bytes."""
    pairs = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
    return np.ascontiguousarray(pairs[:, 0]), np.ascontiguousarray(pairs[:, 1])


def units(rows: DataFrame) -> DataFrame:
    """One row per unit with words of ``numbered`` rows: the digest's halves, doc_id, version, row, no (from 0), start, size (code points), words."""

    def run(batches):
        for batch in batches:
            digests: list[bytes] = []
            out: list[list] = [[] for _ in range(len(UNITS) - len(DIGEST))]
            for row, doc_id, version, text in zip(*(batch.column(c).to_pylist() for c in ("row", "doc_id", "version", "text"))):
                no = 0
                for start, end in unit_spans(text):
                    form, n = normalised(text[start:end])
                    if n:
                        digests.append(hashlib.blake2b(form, digest_size=16).digest())
                        for column, value in zip(out, (doc_id, version, row, no, start, end - start, n)):
                            column.append(value)
                        no += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip((*halves(digests), *out), UNITS)], schema=UNITS)

    return rows.mapInArrow(run, UNITS_DDL)


def spans(words: np.ndarray, fresh: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, last) of the least passages of ``min_words`` words that begin or end with each unit, each once;
    none crosses a unit that is ``fresh``, the first of its stretch."""
    n = len(words)
    before = np.concatenate([[0], np.cumsum(words, dtype=np.int64)])
    heads = np.flatnonzero(fresh)
    stretch = np.cumsum(fresh) - 1
    low, high = heads[stretch], np.append(heads[1:], n)[stretch] - 1
    at = np.arange(n)
    last = np.searchsorted(before, before[:-1] + min_words, "left") - 1
    first = np.searchsorted(before, before[1:] - min_words, "right") - 1
    begins, ends = last <= high, first >= low
    pairs = np.unique(np.concatenate([at[begins] * n + last[begins], first[ends] * n + at[ends]]))
    return pairs // n, pairs % n


def _passages(t: pa.Table, min_words: int) -> pa.RecordBatch | None:
    """Passages of whole stretches, units in order of (row, no)."""
    row, no = t["row"].to_numpy(), t["no"].to_numpy()
    fresh = np.concatenate([[True], (row[1:] != row[:-1]) | (no[1:] != no[:-1] + 1)])
    first, last = spans(t["words"].to_numpy(), fresh, min_words)
    if not len(first):
        return None
    digests = np.stack([t[c].to_numpy() for c in DIGEST], axis=1).tobytes()
    size = last - first + 1
    bounds = np.concatenate([[0], np.cumsum(size)])
    units_of = pa.array(np.repeat(first - bounds[:-1], size) + np.arange(bounds[-1]))
    lists = [pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), t[c].combine_chunks().take(units_of)) for c in PARTS]
    names = [hashlib.blake2b(digests[16 * a:16 * b], digest_size=16).digest() for a, b in zip(first.tolist(), (last + 1).tolist())]
    own = ("doc_id", "version", "row", "no")
    return pa.RecordBatch.from_arrays([*map(pa.array, halves(names)), *(t[c].combine_chunks().take(pa.array(first)) for c in own), *lists],
                                      names=[*DIGEST, *own, *PARTS])


def passages(repeated: DataFrame, min_words: int) -> DataFrame:
    """One row per passage of units that come again: the digest's halves, doc_id, version, row, its first unit's no, its units' start, size, words."""

    def run(batches: Iterator[pa.RecordBatch]):
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size < STEP_ROWS:
                continue
            t = pa.Table.from_batches(held)
            row = t["row"].to_numpy()
            cut = int(np.searchsorted(row, row[-1]))  # the last document may go on in the next batch
            if cut:
                made = _passages(t.slice(0, cut), min_words)
                if made is not None:
                    yield made
                held = t.slice(cut).to_batches()
            # A document of many units waits until it is whole; look again when as much has come once more.
            size = 0 if not cut else sum(b.num_rows for b in held)
        if sum(b.num_rows for b in held):
            made = _passages(pa.Table.from_batches(held), min_words)
            if made is not None:
                yield made

    return repeated.repartition("row").sortWithinPartitions("row", "no").mapInArrow(run, PASSAGES_DDL)


def _removed(rows: DataFrame, min_words: int) -> DataFrame:
    """One row per unit to remove of ``numbered`` rows: row, doc_id, start, end, words, keep_doc_id, keep_start, group_size."""
    if min_words < 1:
        raise ValueError("min_words must be 1 or more")
    session(rows.sparkSession)
    spark = rows.sparkSession
    unit_path, again_path = scratch(spark, "units"), scratch(spark, "again")
    every = written(units(rows), "units", "zstd", unit_path)
    # A digest may hold a third of all rows: counts are combined before the exchange, and written, since adaptive
    # execution splits the rows' side only of a join whose sides come straight from exchanges. Half a digest is
    # enough here: a unit too many changes nothing, since a passage that holds one comes once.
    again = written(every.groupBy("high").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("high"), "again", path=again_path, tidy=True)
    found = written(passages(every.join(again, "high", "left_semi"), min_words), "passages", "zstd", tidy=True)
    discard(spark, unit_path)
    discard(spark, again_path)
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "version", "row", "no", F.col("start").alias("starts"))
    groups = (found.groupBy(*DIGEST).agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("group_size"))
              .where("group_size > 1"))
    # Passages travel whole and are taken apart where their row's others are.
    kept = [F.col(f"first.{c}").alias(f"keep_{c}") for c in ("none", "doc_id", "version", "row", "starts")]
    later = (found.join(groups, DIGEST).where("NOT (row = first.row AND no = first.no)")
             .select("row", "doc_id", *PARTS, *kept, "group_size").repartition("row")
             .select("*", F.posexplode("start").alias("at", "unit"))
             .select("row", "doc_id", F.col("unit").alias("start"), F.expr("size[at]").alias("size"), F.expr("words[at]").alias("words"),
                     F.struct(F.col("keep_none").alias("none"), F.col("keep_doc_id").alias("doc_id"), F.col("keep_version").alias("version"),
                              F.col("keep_row").alias("row"), F.expr("keep_starts[at]").alias("start"), "group_size").alias("place")))
    # Passages overlap: each unit once, with the earliest place kept.
    return (later.groupBy("row", "doc_id", "start", "size", "words").agg(F.min("place").alias("keep"))
            .select("row", "doc_id", F.col("start").cast("long").alias("start"), (F.col("start").cast("long") + F.col("size")).alias("end"), "words",
                    F.col("keep.doc_id").alias("keep_doc_id"), F.col("keep.start").cast("long").alias("keep_start"), "keep.group_size"))


def repeated_units(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per unit to remove: doc_id, start, end, words, keep_doc_id, keep_start, group_size. The last three are
    those of the passage that came first among the unit's repeated ones.

    Null ids rank last, so a passage of a document with an id stays if there is
    one. Rows of equal id, equal rows too, are documents of their own, ranked by
    their text's hash; so the result is the same however the rows lie. Null and empty texts have no
    units, very long ones as many as they hold; an empty table gives an empty
    result. Other columns, whatever their names, are not read.
    """
    return _removed(numbered(docs, id_col, text_col), min_words).drop("row")


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the given spans."""
    out, at = [], 0
    for s, e in sorted(spans):
        out.append(text[at:s])
        at = max(at, e)
    return "".join([*out, text[at:]])


def drop_repeated_units(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, text without the removed units, and the removed spans (start, end) in the
    original (null: none).

    Every row loses its own units only, rows of equal or null id too. A
    document's spans are no more than its own units, so they fit where its text
    does. Null texts come back as empty ones; an empty table gives an empty result.
    """
    session(docs.sparkSession)
    rows = written(numbered(docs, id_col, text_col), "numbered")  # both readings below see the same numbers
    gone = (_removed(rows, min_words).groupBy("row")
            .agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("removed")))
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("removed", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])

    def cut(batches):
        for batch in batches:
            spans_of = batch.column("removed").to_pylist()
            texts = [without(t, [(s["start"], s["end"]) for s in spans]) if spans else t
                     for t, spans in zip(batch.column("text").to_pylist(), spans_of)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string()), pa.array(spans_of, schema.field("removed").type)],
                                             schema=schema)

    return (rows.join(gone, "row", "left").select("doc_id", "text", "removed")
            .mapInArrow(cut, "doc_id long, text string, removed array<struct<start: long, end: long>>"))
