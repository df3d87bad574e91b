"""Phrase collocations, counted by tries over all text positions at once.

Texts become blocks of word numbers (``wordblocks``). Level by level (Apriori): a
phrase of k words is a candidate only where both its parts of k - 1 words are frequent
and the counts that the blocks report for it, each cut off at ``least``, reach ``least``
together; no phrase with ``least`` occurrences is missed. The candidates go into
double-array tries over the base-256 digits of their words' numbers; a trie holds
``WAVE_PHRASES`` phrases at most and ends where a prefix belongs to one phrase alone, so a
broadcast and the driver's work on it have a fixed bound, and further
candidates go to further tries. For each trie a pass over the blocks moves the states of
all text positions on together, digit by digit, with numpy, counts the accepting
states with ``bincount`` and sums the tasks' shards of the counts beside their candidates.
Candidates and counts stay apart: the counts come from the tries alone.

Scores, the test against longer candidates and the ranking are joins and windows over the
counted phrases, in exact decimals (word counts up to 10^15).

Defined cases: a null text is empty; a null lang is ``und``; empty texts and empty
tables give no rows; very long texts are never cut (a block holds one whole text at
least); repeated rows count as often as they come; doc_id is not read; ties are ranked
by score, frequency, then the phrase's UTF-8 bytes; further columns, whatever their
names, are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ringwatch.llm import wordblocks as B
from ringwatch.llm.common import arrow, part_of, scratch, session, written

#: Bytes that end a piece (fixed values of the definition); blanks within one.
BREAKS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
#: Phrases of one trie: 20 to 50 bytes each, and two to three times as much while the driver builds it.
WAVE_PHRASES = 1 << 21
#: Counts of one row of a shard.
SLICE = 1 << 16
RADIX = 256
#: Children from which on a node gets a window of its own; nodes placed at a time.
WIDE, PLACED = 23, 1 << 17
#: Keys of a chunk when pairs are marked.
MARKED = 1 << 18

_NUMBERED = pa.schema([("block", pa.int64()), ("codes", pa.binary()), ("ids", pa.binary()), ("kinds", pa.int64())])
_NUMBERED_DDL = "block long, codes binary, ids binary, kinds long"
_KEYS_DDL = "bucket long, n long, a binary, b binary"
_OUT = pa.schema([("kind", pa.string()), *B.SENT_PHRASES])
_OUT_DDL = "kind string, " + B.SENT_PHRASES_DDL


class Trie:
    """Double-array trie of phrases of ``words.shape[1]`` words each (rows distinct, sorted).

    From a state ``s`` digit ``d`` leads to ``base[s] + d`` if ``check`` there is ``s``. Where a prefix belongs to one
    phrase alone the trie ends: the state accepts that phrase if its codes (``tail``) are those of the text, and its
    ``base`` is ``~number`` of the phrase. So there are at most two states per phrase. Nodes with many children get a
    window of their own, the others are dealt to free places in rounds. ``numbers`` names the phrases (their rows by
    default)."""

    def __init__(self, words: np.ndarray, numbers: np.ndarray | None = None):
        n, self.words = words.shape
        self.alphabet = np.unique(words)
        self.tail = np.empty((self.words, n), np.int32)
        for w in range(self.words):
            self.tail[w] = np.searchsorted(self.alphabet, words[:, w]) + 1
        self.digits = max(1, -(-int(len(self.alphabet)).bit_length() // 8))
        parents, digits, ends, first = [], [], [], 1
        live, above = np.arange(n, dtype=np.int32), np.zeros(n, np.int32)
        for code, k in ((c, k) for c in self.tail for k in reversed(range(self.digits))):
            if not len(live):
                break
            sign = (code[live] >> (8 * k) & 255).astype(np.uint8)
            new = np.ones(len(live), bool)
            new[1:] = (above[1:] != above[:-1]) | (sign[1:] != sign[:-1])
            at = np.flatnonzero(new).astype(np.int32)
            parents.append(above[at])
            digits.append(sign[at])
            alone = np.diff(at, append=np.int32(len(live))) == 1
            ends.append(np.where(alone, live[at], np.int32(-1)))
            node = first + np.cumsum(new, dtype=np.int32) - 1
            first += len(at)
            more = ~alone[node - node[0]]
            live, above = live[more], node[more]
        del live, above
        parent = np.concatenate(parents) if parents else np.zeros(0, np.int32)
        end = np.concatenate([np.full(1, -1, np.int32), *ends])
        del parents, ends
        base, slot, size = self._place(parent, np.concatenate(digits) if digits else np.zeros(0, np.uint8), first)
        accepts = np.flatnonzero(end >= 0)
        base[accepts] = ~(end[accepts] if numbers is None else numbers[end[accepts]].astype(np.int32))
        if numbers is not None:  # phrase by number, as states name them
            self.tail[:, numbers] = self.tail.copy()
        self.base, self.check = np.zeros(size, np.int32), np.full(size, -1, np.int32)
        self.base[slot] = base
        self.check[slot[1:]] = slot[parent]

    @property
    def leaf(self) -> np.ndarray:
        """The accepting state of each phrase."""
        at = np.flatnonzero(self.base < 0)
        out = np.empty(len(at), np.int64)
        out[~self.base[at]] = at
        return out

    @staticmethod
    def _place(parent: np.ndarray, digit: np.ndarray, nodes: int):
        """(base of each node, place of each node, places) for children given as (parent, digit) from node 1 on, by parent."""
        rng = np.random.default_rng(7)
        start = np.flatnonzero(np.diff(parent, prepend=np.int32(-1))).astype(np.int32)
        owner, width = parent[start], np.diff(start, append=np.int32(len(parent)))
        base, slot = np.zeros(nodes, np.int32), np.zeros(nodes, np.int32)
        wide = np.flatnonzero(width >= WIDE)
        # places beside the windows: of those for nodes as wide as w or wider at most 2 / w are taken, so that a try mostly fits
        of = np.bincount(width[width < WIDE], minlength=WIDE) * np.arange(WIDE)
        room = np.cumsum(of[::-1])[::-1] * np.maximum(1.5, np.arange(WIDE) / 2) * (of > 0)
        size = 1 + RADIX * (len(wide) + 4) + int(room.max())
        used = np.zeros(size, bool)
        used[0] = True  # the root's

        def children(which):
            each = width[which]
            own = np.repeat(np.arange(len(which), dtype=np.int32), each)
            at = np.arange(len(own), dtype=np.int32) + np.repeat(start[which] - np.append(0, np.cumsum(each)[:-1]).astype(np.int32), each)
            return own, at

        for x in range(0, len(wide), PLACED):
            part = wide[x:x + PLACED]
            base[owner[part]] = 1 + RADIX * np.arange(x, x + len(part))
            own, kids = children(part)
            slot[kids + 1] = base[owner[part]][own] + digit[kids]
            used[slot[kids + 1]] = True
        for w in range(WIDE - 1, 0, -1):
            todo = np.flatnonzero(width == w).astype(np.int32)
            for x in range(0, len(todo), PLACED):
                left = todo[x:x + PLACED]
                while len(left):
                    own, kids = children(left)
                    tried = rng.integers(1, size - RADIX, len(left), dtype=np.int32)
                    places = tried[own] + digit[kids]
                    bad = used[places]
                    seen, at, back = np.unique(places, return_index=True, return_inverse=True)
                    bad |= own[at][back] != own
                    fails = np.zeros(len(left), bool)
                    fails[own[bad]] = True
                    ok = ~fails[own]
                    base[owner[left[~fails]]] = tried[~fails]
                    slot[kids[ok] + 1] = places[ok]
                    used[places[ok]] = True
                    left = left[fails]
        return base, slot, size

    def codes(self, ids: np.ndarray) -> np.ndarray:
        """This trie's code of each word number, 0 for words that are in no phrase of it."""
        at = np.minimum(np.searchsorted(self.alphabet, ids), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == ids, at + 1, 0)

    def accepted(self, code: np.ndarray):
        """(positions, accepting states) of all phrases in a text of codes; 0 belongs to no phrase."""
        steps = [[(code >> (8 * k) & 255).astype(np.uint8) for k in reversed(range(self.digits))]][0]
        live = code > 0
        for w in range(1, self.words):
            live[:-w] &= code[w:] > 0
            live[-w:] = False
        at = np.flatnonzero(live)
        state = np.zeros(len(at), np.int64)
        found = []
        for w in range(self.words):
            for step in steps:
                to = self.base[state] + step[at + w].astype(np.int64)
                ok = self.check[to] == state
                at, state = at[ok], to[ok]
                ends = self.base[state] < 0
                if ends.any():
                    here, its = at[ends], state[ends]
                    own = ~self.base[its]
                    for v in range(w, self.words):  # the digits and words that are left
                        same = self.tail[v][own] == code[here + v]
                        here, its, own = here[same], its[same], own[same]
                    found.append((here, its))
                    at, state = at[~ends], state[~ends]
        return tuple(np.concatenate([x[k] for x in found]) if found else np.zeros(0, np.int64) for k in range(2))


def numbered_blocks(docs: DataFrame, least: int, text_col: str, lang_col: str):
    """(blocks with a number per word, words, sizes, words in all): numbers only for words of ``least``
    occurrences in their language, 0 for others; words are (id, lang, word, f), sizes (lang, n)."""
    rows = docs.select(F.lit(0).cast("long").alias("key"), F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("grp"),
                       F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    made = B.blocks(rows, BREAKS, BLANKS)
    table, buckets = B.word_table(made, scoped=True, least=least, keep_words=True)

    def join(block: pa.Table, back: pa.Table) -> pa.Table:
        hashes = B.word_hashes(B.unpack_words(block.column("words")[0].as_py()))
        ids = B.in_block_order(hashes % np.uint64(buckets), back, "ids")
        return pa.table([block.column("block"), block.column("codes"), pa.array([B.pack(ids)], pa.binary()),
                         pa.array([len(hashes)], pa.int64())], schema=_NUMBERED)

    def spread(batches):
        for batch in batches:
            for row in B.rows_of(batch):
                words = B.unpack_words(row["words"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(B.unpack(row["ids"])), pa.array([row["grp"]] * len(words), pa.string()),
                     words.cast(pa.large_string()).cast(pa.string()), pa.array(B.unpack(row["totals"]))], names=["id", "lang", "word", "f"])

    answers = table.where("block >= 0").select("block", "bucket", "ids")
    whole = made.where("kinds > 0").select("block", "words", "codes")
    numbered = written(whole.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(join, _NUMBERED_DDL), "numbered")
    words = written(table.where("block < 0").select("grp", "ids", "totals", "words").mapInArrow(
        spread, "id long, lang string, word string, f long"), "frequent")
    sizes = made.groupBy(F.col("grp").alias("lang")).agg(F.sum("tokens").alias("n"))
    return numbered, words, sizes, int(made.agg(F.sum("tokens")).first()[0] or 0)


def tokens(row: dict) -> np.ndarray:
    """Word numbers of one block's texts, 0 for rare words and breaks."""
    return np.append(B.unpack(row["ids"], row["kinds"]), 0)[B.block_codes(row["codes"])]


def candidate_keys(sent: DataFrame, least: int, pairs: bool) -> DataFrame:
    """One row per bucket: the phrases whose reported counts reach ``least`` together, sorted."""

    def settle(table: pa.Table) -> pa.Table:
        a, b, counts, _ = B.received(table, pairs)
        x, y, _, place = B.phrases(a, b)
        safe = np.bincount(place, counts[0], len(x)) >= least
        x, y = x[safe], y[safe] if pairs else None
        return pa.table([pa.array([table.column("bucket")[0].as_py()], pa.int64()), pa.array([len(x)], pa.int64()),
                         pa.array([B.pack(np.diff(x, prepend=np.uint64(0)))], pa.binary()),
                         pa.array([B.pack(y) if pairs else b"\0"], pa.binary())], names=["bucket", "n", "a", "b"])

    return written(sent.groupBy("bucket").applyInArrow(settle, _KEYS_DDL), "candidates")


def waves(keys: DataFrame, wave_phrases: int):
    """The candidates in sets of at most ``wave_phrases``, or one bucket's, as (a, b, buckets, sizes) arrays of the driver."""
    sizes = sorted((r.bucket, r.n) for r in keys.where("n > 0").select("bucket", "n").collect())
    taken: list[int] = []
    held = 0
    sets = []
    for bucket, n in sizes:
        if taken and held + n > wave_phrases:
            sets.append(taken)
            taken, held = [], 0
        taken.append(bucket)
        held += n
    for chosen in sets + ([taken] if taken else []):
        rows = sorted(keys.where(F.col("bucket").between(chosen[0], chosen[-1]) & (F.col("n") > 0)).collect(), key=lambda r: r.bucket)
        yield (np.concatenate([np.cumsum(B.unpack(r.a).view(np.uint64), dtype=np.uint64) for r in rows]),
               np.concatenate([B.unpack(r.b, r.n) for r in rows]), [r.bucket for r in rows], [r.n for r in rows])


def split_keys(a: np.ndarray, third: np.ndarray, span: int, size: int) -> np.ndarray:
    """The word numbers of phrases of ``size`` words, a row each."""
    out = np.empty((len(a), size), np.int64)
    out[:, 0] = a // np.uint64(span)
    out[:, 1] = a % np.uint64(span)
    if size == 3:
        out[:, 2] = third
    return out


def trie_of(a: np.ndarray, third: np.ndarray, span: int, size: int) -> Trie:
    """The trie of the phrases (a, third), which are numbered as they come."""
    order = np.lexsort((third, a) if size == 3 else (a,)).astype(np.int32)
    return Trie(split_keys(a[order], third[order] if size == 3 else third, span, size), order)


def pair_marks(keys: DataFrame, wave_phrases: int) -> np.ndarray:
    """A bit per pair, of a fixed number at most: a position that fails is in no frequent pair."""
    total = keys.agg(F.sum("n")).first()[0] or 0
    bits = 1 << min(27, max(16, int(total * 16).bit_length()))
    marks = np.zeros(bits >> 3, np.uint8)
    for a, *_ in waves(keys, wave_phrases):
        for x in range(0, len(a), MARKED):
            place = (B.mixed(a[x:x + MARKED]) % np.uint64(bits)).astype(np.int64)
            np.bitwise_or.at(marks, place >> 3, (1 << (place & 7)).astype(np.uint8))
    return marks


def counted(numbered: DataFrame, sent: DataFrame, span: int, size: int, least: int, wave_phrases: int, emit_longer: int = 0):
    """(counted phrases (id1, id2, id3, f), messages on longer candidates or None): one pass over the blocks per trie.

    ``span`` scales the first word's number in a key; ``emit_longer`` is the number of buckets for phrases
    one word longer, wanted only after the pairs. Each bucket's counts go back to its candidates in ``keys``; the driver
    holds one trie at a time, and no list of phrases."""
    spark = numbered.sparkSession
    keys = candidate_keys(sent, least, size == 3)
    counts_at, longer_at = scratch(spark, f"counts{size}"), scratch(spark, f"longer{size}")
    none = spark.createDataFrame([], "id1 long, id2 long, id3 long, f long")
    none.write.parquet(counts_at)
    marks = None
    if emit_longer:
        marks = spark.sparkContext.broadcast(pair_marks(keys, wave_phrases))
        spark.createDataFrame([], B.SENT_PHRASES_DDL).write.parquet(longer_at)

    def count_pass(trie, names: list[int], sizes: list[int]) -> None:
        edges = list(zip(names, np.append(0, np.cumsum(sizes)).tolist(), sizes))
        phrases_held = sum(sizes)

        def run(batches):
            own = trie.value
            found = np.zeros(phrases_held, np.int64)
            mark = marks.value if marks else None
            seen = False
            for batch in batches:
                for row in B.rows_of(batch):
                    text = tokens(row)
                    at, state = own.accepted(own.codes(text))
                    if not len(at):
                        continue
                    seen = True
                    found += np.bincount(~own.base[state], minlength=phrases_held)
                    if marks is None:
                        continue
                    after = at[at < len(text) - 2] + 1
                    after = after[(text[after] > 0) & (text[after + 1] > 0)]
                    place = (B.mixed(text[after].astype(np.uint64) * np.uint64(span) + text[after + 1].astype(np.uint64))
                             % np.uint64(len(mark) * 8)).astype(np.int64)
                    after = after[mark[place >> 3] >> (place & 7) & 1 == 1]
                    if len(after):
                        x, y, n, _ = B.phrases(text[after - 1].astype(np.uint64) * np.uint64(span) + text[after].astype(np.uint64), text[after + 1])
                        out = B.sent_phrases(row["block"], x, y, np.minimum(n, least), emit_longer)
                        yield pa.RecordBatch.from_arrays([pa.array(["longer"] * out.num_rows), *out.columns], schema=_OUT)
            if seen:
                for bucket, first, n in edges:
                    starts = [x for x in range(0, n, SLICE) if found[first + x:first + min(n, x + SLICE)].any()]
                    k = len(starts)
                    yield arrow(_OUT, kind=["counts"] * k, bucket=[bucket] * k, block=starts, a=[b"\0"] * k, b=[b"\0"] * k,
                                counts=[B.pack(found[first + x:first + min(n, x + SLICE)]) for x in starts])

        def add(key: pa.Table, shards: pa.Table) -> pa.Table:
            n = key.column("n")[0].as_py()
            total = np.zeros(n, np.int64)
            for x, c in zip(shards.column("block").to_pylist(), shards.column("counts").to_pylist()):
                total[x:x + SLICE] += B.unpack(c, min(SLICE, n - x))
            often = np.flatnonzero(total >= least)
            a = np.cumsum(B.unpack(key.column("a")[0].as_py()).view(np.uint64), dtype=np.uint64)[often]
            rows = split_keys(a, B.unpack(key.column("b")[0].as_py(), n)[often], span, size)
            rows = np.column_stack([rows, np.zeros((len(rows), 3 - size), np.int64)])
            return pa.table([*(pa.array(rows[:, k]) for k in range(3)), pa.array(total[often])], names=["id1", "id2", "id3", "f"])

        got = written(numbered.mapInArrow(run, _OUT_DDL), "pass")
        mine = keys.where(F.col("bucket").between(names[0], names[-1]) & (F.col("n") > 0))
        (mine.groupBy("bucket").cogroup(got.where("kind = 'counts'").select("bucket", "block", "counts").groupBy("bucket"))
         .applyInArrow(add, "id1 long, id2 long, id3 long, f long").write.mode("append").parquet(counts_at))
        if emit_longer:
            got.where("kind = 'longer'").drop("kind").write.mode("append").parquet(longer_at)

    for a, third, names, sizes in waves(keys, wave_phrases):
        built = trie_of(a, third, span, size)
        del a, third
        trie = spark.sparkContext.broadcast(built)
        del built
        count_pass(trie, names, sizes)
        trie.destroy()  # the driver's copy too
        del trie
    if marks:
        marks.destroy()
    phrases = spark.read.schema(none.schema).parquet(counts_at)
    return phrases, spark.read.schema(B.SENT_PHRASES_DDL).parquet(longer_at) if emit_longer else None


def counted_phrases(docs: DataFrame, least: int = 10, text_col: str = "text", lang_col: str = "lang", wave_phrases: int | None = None):
    """(pairs, triples, words, sizes): (id1, id2, id3, f) of all phrases of two and three words with ``least``
    occurrences, (id, lang, word, f) of all such words, and (lang, n)."""
    session(docs.sparkSession)
    wave = wave_phrases or WAVE_PHRASES
    numbered, words, sizes, total = numbered_blocks(docs, least, text_col, lang_col)
    span = (words.agg(F.max("id")).first()[0] or 0) + 1
    buckets = part_of(total, B.BUCKET_PHRASES)

    def pairs(batches):
        for batch in batches:
            for row in B.rows_of(batch):
                text = tokens(row)
                both = np.flatnonzero((text[:-1] > 0) & (text[1:] > 0))
                if len(both):
                    a, _, n, _ = B.phrases(text[both].astype(np.uint64) * np.uint64(span) + text[both + 1].astype(np.uint64))
                    yield B.sent_phrases(row["block"], a, None, np.minimum(n, least), buckets)

    two, longer = counted(numbered, numbered.mapInArrow(pairs, B.SENT_PHRASES_DDL), span, 2, least, wave, buckets)
    three, _ = counted(numbered, longer, span, 3, least, wave)
    return two, three, words, sizes


def collocations(docs: DataFrame, least: int = 10, top: int = 2000, inside: int = 50, text_col: str = "text",
                 lang_col: str = "lang", wave_phrases: int | None = None) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top`` phrases of two or three words.

    A phrase goes if its words lie inside a longer candidate with ``inside`` per cent of its occurrences or more."""
    two, three, words, sizes = counted_phrases(docs, least, text_col, lang_col, wave_phrases)
    single = words.select("id", "f")

    def whole(c):
        return F.col(c).cast("decimal(15,0)").alias(c)

    def score(first, rest):
        return F.expr(f"1000000BD * a * a div ({first} * {rest})")

    pair = two.select("id1", "id2", F.col("f").alias("a"))
    left = pair.select("id1", "id2", F.col("a").alias("front"))
    right = pair.select(F.col("id1").alias("id2"), F.col("id2").alias("id3"), F.col("a").alias("back"))
    third = three.select("id1", "id2", "id3", F.col("f").alias("a"))
    longest = third.selectExpr("stack(2, id1, id2, id2, id3) as (id1, id2)", "a").groupBy("id1", "id2").agg(F.max("a").alias("longer"))
    cuts2 = (pair.join(longest, ["id1", "id2"], "left")
             .where(F.expr(f"longer is null or 100 * longer < {inside} * a"))
             .join(single.toDF("id1", "l"), "id1").join(single.toDF("id2", "r"), "id2")
             .select("id1", "id2", F.lit(0).cast("long").alias("id3"), whole("a"), whole("l"), whole("r"))
             .withColumn("score", score("l", "r")))
    cuts3 = (third.join(left, ["id1", "id2"]).join(right, ["id2", "id3"])
             .join(single.toDF("id1", "first"), "id1").join(single.toDF("id3", "last"), "id3")
             .select("id1", "id2", "id3", whole("a"), whole("first"), whole("back"), whole("front"), whole("last"))
             .withColumn("one", score("first", "back")).withColumn("two", score("front", "last"))
             .select("id1", "id2", "id3", "a", F.expr("if(one <= two, first, front)").alias("l"),
                     F.expr("if(one <= two, back, last)").alias("r"), F.least("one", "two").alias("score")))
    spelled = words.select("id", "lang", "word")
    named = (cuts2.unionByName(cuts3)
             .join(spelled.toDF("id1", "lang", "w1"), "id1")
             .join(spelled.select(F.col("id").alias("id2"), F.col("word").alias("w2")), "id2")
             .join(spelled.select(F.col("id").alias("id3"), F.col("word").alias("w3")), "id3", "left")
             .withColumn("phrase", F.concat_ws(" ", "w1", "w2", "w3")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (named.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
            .join(sizes, "lang")
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", *(F.col(c).cast("long").alias(c) for c in ("a", "l", "r", "n", "score"))))
