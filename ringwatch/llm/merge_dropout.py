"""SentencePiece merges with seeded dropout.

Encoding follows the model's own agenda: all adjacent pairs that form a piece
wait in a queue, best score first, leftmost on ties; a pair taken from the queue
is merged and its new neighbours join the queue. Here a keyed hash of (seed,
document, place of the word in it, place of the pair in the word, piece) decides
whether a taken pair is skipped instead, for each occurrence of a word anew.
The same key always gives the same segmentation, another seed another one, and
any of them decodes to the text it came from: skipped merges leave smaller
pieces, and characters without a piece become byte pieces.

Pieces never cross from a word into the space before the next one, so words (and,
where the model has no mixed pieces, runs of letters and of other characters)
are segmented on their own. What an agenda does depends on nothing but the word
and the pairs skipped, so a worker keeps a tree for each short word: the merges of
an agenda that skips no more, and for each of them the agenda that skips it too.
All occurrences of a batch walk their trees together, as arrays, each with its own
hashes; branches are made when first taken. Long words and those with many skips run
their own agendas.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from ringwatch.llm.common import arrow, id_and_text, session
from ringwatch.llm.packing import ddl

MODEL = "piece_bpe_32k.model"
SEED, DROPOUT = 8, 0.1
#: Agendas that a worker's trees may hold before they start anew.
GENERATION = 1_000_000
#: Words of up to so many characters have a tree of agendas with up to so many skips; others run their own.
TREE, DEPTH = 16, 2
#: Occurrences walked at a time.
STEP = 1 << 16
#: Words of up to so many characters keep their agenda in a list.
SHORT = 32
NEVER, MASK = 1 << 60, (1 << 64) - 1
SPACE = "▁"
#: A run of spaces (written as the model does) and the run of other characters after it.
_WORDS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


def segments(pieces: list[str]) -> re.Pattern:
    """What to segment on its own. Where no piece has a letter and another character side by side,
    runs of letters and runs of others are apart; else only the words between spaces are."""
    odd = "".join(sorted({c for p in pieces for c in p if re.fullmatch(r"[^\W\d_]", c) and not c.isalpha()}))
    letter, other = f"[^\\W\\d_{re.escape(odd)}]", f"(?!{SPACE})[\\W\\d_{re.escape(odd)}]"
    if any(re.search(f"{letter}{other}|{other}{letter}", p) for p in pieces):
        return _WORDS
    return re.compile(f"{SPACE}*{letter}+|{SPACE}*(?:{other})+|{SPACE}+")


def skips(key: int, place: int, rank: int, limit: int) -> bool:
    """Keyed decision on one candidate merge: place of its first character and rank of the piece it would make."""
    x = (key ^ (place << 32 | rank)) * 0x9E3779B97F4A7C15 & MASK
    return (x ^ x >> 32) * 0xBF58476D1CE4E5B9 & MASK < limit


class Pieces:
    """The model's pieces and scores, and the bytes that each id decodes to."""

    def __init__(self, name: str = MODEL):
        import public_tokenizers
        import sentencepiece

        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))
        self.id: dict[str, int] = {}
        self.score: list[float] = []
        self.byte: dict[int, int] = {}
        self.rank: dict[str, int] = {}  # of normal pieces, best score first
        self.bytes: list[bytes] = []
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            self.score.append(sp.get_score(i))
            if sp.is_byte(i):
                b = int(piece[3:5], 16)
                self.byte[b] = i
                self.bytes.append(bytes([b]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.bytes.append(b"")
            else:
                self.id[piece] = i
                self.bytes.append(piece.replace(SPACE, " ").encode())
        for r, piece in enumerate(sorted(self.id, key=lambda p: (-self.score[self.id[p]], self.id[p]))):
            self.rank[piece] = r
        self.words = segments(list(self.id)).findall
        self.byte_text = np.frombuffer(b"".join(self.bytes), np.uint8)  # all pieces' bytes, in order of ids
        self.byte_size = np.array([len(b) for b in self.bytes], np.int64)
        self.byte_start = np.cumsum(self.byte_size) - self.byte_size
        self._pair_table()

    def _symbol(self, part: str) -> int | None:
        """Number of a part: its id; a single character without a piece has a number past the ids."""
        i = self.id.get(part)
        return i if i is not None else len(self.bytes) + ord(part) if len(part) == 1 else None

    def _pair_table(self):
        """Open-addressing table from pairs of parts to the rank of the piece they make."""
        self.made = np.array([self.id[p] for p in self.rank], np.int64)  # id by rank
        pairs = {}
        for piece, r in self.rank.items():
            for k in range(1, len(piece)):
                a, b = self._symbol(piece[:k]), self._symbol(piece[k:])
                if a is not None and b is not None:
                    pairs[a << 22 | b] = r
        self.slots = 1 << max(10, (4 * len(pairs)).bit_length())
        self.pair_key, self.pair_rank = np.full(self.slots, -1, np.int64), np.full(self.slots, NEVER, np.int64)
        todo = np.array(list(pairs), np.int64)
        ranks = np.array(list(pairs.values()), np.int64)
        at = self._slot(todo)
        self.probes = 0
        while len(todo):  # each round, the first of those that share a free slot takes it
            free = self.pair_key[at] < 0
            first = np.zeros(len(todo), bool)
            first[np.flatnonzero(free)[np.unique(at[free], return_index=True)[1]]] = True
            self.pair_key[at[first]], self.pair_rank[at[first]] = todo[first], ranks[first]
            todo, ranks, at = todo[~first], ranks[~first], (at[~first] + 1) & (self.slots - 1)
            self.probes += 1

    def _slot(self, key: np.ndarray) -> np.ndarray:
        mixed = key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(32)).astype(np.int64) & (self.slots - 1)

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the piece that each pair makes, ``NEVER`` where it makes none."""
        key = left << 22 | right
        at = self._slot(key)
        out = np.full(key.shape, NEVER, np.int64)
        open_ = np.arange(len(key))
        for _ in range(self.probes):
            have = self.pair_key[at]
            hit = have == key[open_]
            out[open_[hit]] = self.pair_rank[at[hit]]
            go = ~hit & (have >= 0)
            open_, at = open_[go], (at[go] + 1) & (self.slots - 1)
            if not len(open_):
                break
        return out

    def segment_many(self, words: list[str], keys: np.ndarray | None, limit: int) -> list[bytes]:
        """Little-endian 32-bit ids of each word; the same as ``segment`` word by word."""
        out: list[bytes] = [b""] * len(words)
        size = np.fromiter(map(len, words), np.int64, len(words))
        for low, high in ((0, 8), (8, 16), (16, SHORT)):
            which = np.flatnonzero((size > low) & (size <= high))
            for k in range(0, len(which), 1 << 16):
                part = which[k:k + (1 << 16)]
                ids = self._agendas([words[i] for i in part.tolist()], size[part], high, None if keys is None else keys[part], limit)
                raw, ends = ids[0].astype("<u4").tobytes(), (4 * np.cumsum(ids[1])).tolist()
                for i, a, b in zip(part.tolist(), [0, *ends], ends):
                    out[i] = raw[a:b]
        for i in np.flatnonzero(size > SHORT).tolist():
            out[i] = array("I", self.segment(words[i], None if keys is None else int(keys[i]), limit)).tobytes()
        return out

    def _agendas(self, words: list[str], size: np.ndarray, width: int, keys: np.ndarray | None, limit: int,
                 skipped: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids, ids of each word, merges after the word's last skip, how many each has). Pairs are skipped by the
        words' keys, or, without keys, those (place << 32 | rank) in the word's row of ``skipped``."""
        n, never = len(words), np.int32(2**31 - 1)
        points = np.frombuffer("".join([w.ljust(width, "\0") for w in words]).encode("utf-32-le", "surrogatepass"), np.uint32)
        kinds, inverse = np.unique(points, return_inverse=True)
        part = np.array([self._symbol(chr(c)) for c in kinds.tolist()], np.int64)[inverse.reshape(-1)]  # -1: merged into the part before
        column = np.tile(np.arange(width), n)
        row_size = np.repeat(size, width)
        part[column >= row_size] = -1
        after, before = column + 1, column - 1  # columns of the next parts
        agenda = np.full(n * width, never, np.int32)  # at a part: the pair of it and the next
        pair = np.flatnonzero(column < row_size - 1)
        agenda[pair] = np.minimum(self.ranks_of(part[pair], part[pair + 1]), never)
        merges, count = np.zeros((n, width), np.uint64), np.zeros(n, np.int64)
        live = np.arange(n)
        while len(live):
            at = agenda.reshape(n, width)[live].argmin(axis=1)
            cell = live * width + at
            best = agenda[cell]
            go = best != never
            live, at, cell, best = live[go], at[go], cell[go], best[go].astype(np.int64)
            merge = at.astype(np.uint64) << np.uint64(32) | best.astype(np.uint64)
            row = live
            if keys is not None or skipped is not None:
                if keys is not None:
                    x = (keys[live] ^ merge) * np.uint64(0x9E3779B97F4A7C15)
                    skip = (x ^ x >> np.uint64(32)) * np.uint64(0xBF58476D1CE4E5B9) <= np.uint64(limit - 1) if limit else np.zeros(len(live), bool)
                else:
                    skip = (skipped[live] == merge[:, None]).any(axis=1)
                agenda[cell[skip]] = never
                count[live[skip]] = 0
                row, at, cell, best, merge = row[~skip], at[~skip], cell[~skip], best[~skip], merge[~skip]
            merges[row, count[row]] = merge
            count[row] += 1
            base = row * width
            gone = base + after[cell]
            part[cell], part[gone] = self.made[best], -1
            agenda[cell] = agenda[gone] = never
            far = after[cell] = after[gone]
            ok = far < size[row]
            right, c = (base + far)[ok], cell[ok]
            before[right] = at[ok]
            agenda[c] = np.minimum(self.ranks_of(part[c], part[right]), never)
            near = before[cell]
            ok = near >= 0
            left, c = (base + near)[ok], cell[ok]
            agenda[left] = np.minimum(self.ranks_of(part[left], part[c]), never)
        kept = part >= 0
        ids, sizes = part[kept], kept.reshape(n, width).sum(axis=1)
        odd = np.flatnonzero(ids >= len(self.bytes))
        if len(odd):  # characters without a piece: spelled in bytes
            spelled = [[self.byte[b] for b in chr(x - len(self.bytes)).encode("utf-8", "replace")] for x in ids[odd].tolist()]
            more = np.array([len(b) for b in spelled]) - 1
            np.add.at(sizes, np.repeat(np.arange(n), sizes)[odd], more)
            times = np.ones(len(ids), np.int64)
            times[odd] += more
            place = np.repeat(ids >= len(self.bytes), times)
            ids = np.repeat(ids, times)
            ids[place] = [b for bs in spelled for b in bs]
        return ids, sizes, merges[np.arange(width) < count[:, None]], count

    def segment(self, word: str, key: int | None, limit: int) -> list[int]:
        """Ids of one word. ``key`` None: no dropout; else a merge is skipped if its hash is below ``limit``."""
        return self._ids(self._short(word, key, limit) if len(word) <= SHORT else self._long(word, key, limit))

    def _ids(self, part: list[str]) -> list[int]:
        out: list[int] = []
        for p in part:
            i = self.id.get(p)
            if i is None:
                out += [self.byte[b] for b in p.encode("utf-8", "replace")]
            else:
                out.append(i)
        return out

    def _short(self, word: str, key: int | None, limit: int) -> list[str]:
        """The agenda as a plain list, one place per pair: for a few characters a scan beats a queue."""
        rank, part = self.rank.get, list(word)
        agenda = [rank(a + b, NEVER) for a, b in zip(part, part[1:])]
        begin = list(range(len(part)))
        while agenda:
            best = min(agenda)
            if best == NEVER:
                break
            at = agenda.index(best)
            if key is not None:  # the same decision as skips(), in place
                x = (key ^ (begin[at] << 32 | best)) * 0x9E3779B97F4A7C15 & MASK
                if (x ^ x >> 32) * 0xBF58476D1CE4E5B9 & MASK < limit:
                    agenda[at] = NEVER
                    continue
            whole = part[at] + part.pop(at + 1)
            part[at] = whole
            del begin[at + 1], agenda[at]
            if at:
                agenda[at - 1] = rank(part[at - 1] + whole, NEVER)
            if at < len(agenda):
                agenda[at] = rank(whole + part[at + 1], NEVER)
        return part

    def _long(self, word: str, key: int | None, limit: int) -> list[str]:
        """The agenda as a queue with stale entries dropped when taken."""
        rank, part = self.rank, list(word)
        n = len(part)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda: list[tuple[int, int, int, str]] = []

        def offer(a: int, b: int):
            if a >= 0 and b < n:
                whole = part[a] + part[b]
                if whole in rank:
                    heapq.heappush(agenda, (rank[whole], a, b, whole))

        for a in range(n - 1):
            offer(a, a + 1)
        while agenda:
            best, a, b, whole = heapq.heappop(agenda)
            if not part[a] or right[a] != b or part[a] + part[b] != whole:
                continue  # one side has changed meanwhile
            if key is not None and skips(key, a, best, limit):
                continue
            part[a], part[b] = whole, ""
            right[a] = right[b]
            if right[b] < n:
                left[right[b]] = a
            offer(left[a], a)
            offer(a, right[a])
        return [p for p in part if p]

    def decode(self, ids: np.ndarray) -> str:
        """Text of the ids, the space that encoding put before it removed."""
        size = self.byte_size[ids]
        ends = np.cumsum(size)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.byte_start[ids] - ends + size, size)
        return self.byte_text[at].tobytes().decode("utf-8")[1:]


#: Stands for the character that the model writes for a space, where a text has it itself (no text has a surrogate).
LITERAL = "\udfff"


class Grown:
    """An array that grows at its end."""

    def __init__(self, kind):
        self.data, self.n = np.empty(1024, kind), 0

    def add(self, values):
        values = np.asarray(values, self.data.dtype)
        end = self.n + len(values)
        if end > len(self.data):
            self.data = np.concatenate([self.data[:self.n], np.empty(max(end, 2 * len(self.data)) - self.n, self.data.dtype)])
        self.data[self.n:end] = values
        self.n = end


class DropoutEncoder:
    """Encodes texts for one seed and dropout; keeps the agendas that the words it has met ran."""

    def __init__(self, pieces: Pieces, seed: int = SEED, dropout: float = DROPOUT):
        self.pieces, self.seed = pieces, seed
        self.limit, self.dropout = int(dropout * 2**64), dropout
        self._clear()

    def _clear(self):
        self.root: dict[str, int] = {}
        self.word: list[str] = []  # by agenda
        self.above, self.skip, self.depth = Grown(np.int32), Grown(np.uint64), Grown(np.int8)  # by agenda: the one it left, by which pair
        self.merges, self.branch = Grown(np.uint64), Grown(np.int32)  # by merge: its pair, the agenda that skips it or -1
        self.ids = Grown(np.uint32)
        self.merge_end, self.ids_end = Grown(np.int64), Grown(np.int64)  # by agenda, a 0 before the first
        self.merge_end.add([0])
        self.ids_end.add([0])
        self.root[LITERAL] = 0
        self._add([""], [-1], [0])
        self.ids.add([self.pieces.byte[b] for b in SPACE.encode()])
        self.ids_end.data[1] = self.ids.n

    def _add(self, words: list[str], above: list[int], skip: list[int]) -> range:
        """Runs new agendas: ``above``'s skips and one more, or none for -1; their numbers."""
        skipped = np.full((len(words), DEPTH), MASK, np.uint64)
        one, depth = np.array(above, np.int64), np.zeros(len(words), np.int64)
        pair = np.array(skip, np.uint64)
        for k in range(DEPTH):
            on = np.flatnonzero(one >= 0)
            skipped[on, k] = pair[on]
            depth[on] += 1
            pair[on], one[on] = self.skip.data[one[on]], self.above.data[one[on]]
        size = np.fromiter(map(len, words), np.int64, len(words))
        ids, n_ids, merges, n_merges = self.pieces._agendas(words, size, int(size.max(initial=1)), None, 0, skipped if depth.any() else None)
        merge_end, ids_end = self.merges.n + np.cumsum(n_merges), self.ids.n + np.cumsum(n_ids)
        first = len(self.word)
        self.word += words
        for column, values in ((self.above, above), (self.skip, skip), (self.depth, depth), (self.merges, merges),
                               (self.branch, np.full(len(merges), -1)), (self.ids, ids), (self.merge_end, merge_end),
                               (self.ids_end, ids_end)):
            column.add(values)
        return range(first, first + len(words))

    def _walk(self, agenda: np.ndarray, keys: np.ndarray):
        """Moves each occurrence from its word's undropped agenda to the one that skips what its hashes skip, -1 if that has no place."""
        live = np.flatnonzero(agenda >= 0) if self.limit else np.empty(0, np.int64)
        while len(live):
            now = agenda[live]
            begin = self.merge_end.data[now]
            size = self.merge_end.data[now + 1] - begin
            ends = np.cumsum(size)
            at = np.arange(ends[-1]) + np.repeat(begin - ends + size, size)
            x = (np.repeat(keys[live], size) ^ self.merges.data[at]) * np.uint64(0x9E3779B97F4A7C15)
            x = (x ^ x >> np.uint64(32)) * np.uint64(0xBF58476D1CE4E5B9)
            hit = np.flatnonzero(x <= np.uint64(self.limit - 1))
            owner = np.searchsorted(ends, hit, side="right")
            first = np.diff(owner, prepend=-1) > 0  # what comes after an occurrence's first skip is another agenda's
            owner, at = owner[first], at[hit[first]]
            lost = (self.branch.data[at] < 0) & (self.depth.data[now[owner]] < DEPTH)
            if lost.any():
                slots, one = np.unique(at[lost], return_index=True)
                above = now[owner[lost][one]].tolist()
                self.branch.data[slots] = self._add([self.word[a] for a in above], above, self.merges.data[slots].tolist())
            live, to = live[owner], self.branch.data[at]
            agenda[live] = to
            live = live[to >= 0]

    def _segment(self, words: list[str], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all the occurrences, one after the other, and how many each has."""
        if len(self.word) > GENERATION:
            self._clear()
        look = self.root.get
        found = list(map(look, words))
        if None in found:
            new = sorted({w for w, a in zip(words, found) if a is None and len(w) <= TREE})
            self.root.update(zip(new, self._add(new, [-1] * len(new), [0] * len(new))))
            found = [look(w, -1) if a is None else a for w, a in zip(words, found)]
        agenda = np.array(found, np.int64)
        self._walk(agenda, keys)
        long = np.flatnonzero(agenda < 0)
        begin, end = self.ids_end.data[agenda], self.ids_end.data[agenda + 1]
        kept = self.ids.n
        if len(long):  # their ids stand behind the table's for this call
            raw = self.pieces.segment_many([words[i] for i in long.tolist()], keys[long] if self.limit else None, self.limit)
            self.ids.add(np.frombuffer(b"".join(raw), "<u4"))
            end[long] = kept + np.cumsum([len(r) // 4 for r in raw])
            begin[long] = end[long] - [len(r) // 4 for r in raw]
        size = end - begin
        out = self.ids.data[np.arange(size.sum()) + np.repeat(begin - np.cumsum(size) + size, size)]
        self.ids.n = kept
        return out, size

    def encode(self, text: str, key: str) -> np.ndarray:
        """Ids of ``text``; ``key`` (the document) and the place key each word's skips."""
        return self.encode_batch([text], [key])[0]

    def encode_batch(self, texts: list[str], keys: list[str]) -> list[np.ndarray]:
        words: list[str] = []
        own, ends = [np.empty(0, np.uint64)], []
        for text, key in zip(texts, keys):
            found = self._words(text)
            words += found
            ends.append(len(words))
            own.append(self._keys(len(found), key))
        key_of = np.concatenate(own)
        parts = [self._segment(words[k:k + STEP], key_of[k:k + STEP]) for k in range(0, len(words), STEP)]
        if not parts:
            return [np.empty(0, "<u4") for _ in texts]
        ids = np.concatenate([p[0] for p in parts])
        after = np.concatenate([[0], *(p[1] for p in parts)]).cumsum()
        return np.split(ids, after[ends[:-1]])

    def _words(self, text: str) -> list[str]:
        if not text:
            return []
        if SPACE not in text:
            return self.pieces.words(SPACE + text.replace(" ", SPACE))
        out = []
        for k, part in enumerate(text.split(SPACE)):  # the character itself must not be read as a space
            out += [LITERAL] if k else []
            out += self.pieces.words(("" if k else SPACE) + part.replace(" ", SPACE))
        return out

    def _keys(self, n: int, key: str) -> np.ndarray:
        """The keys of a document's occurrences, by place."""
        x = np.arange(n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(xxhash.xxh64_intdigest(key, self.seed))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


_WORKER: dict[tuple, DropoutEncoder] = {}


def worker_encoder(seed: int, dropout: float, model: str = MODEL) -> DropoutEncoder:
    """This worker's encoder; its tables serve all tasks that the worker runs."""
    key = (seed, dropout, model)
    if key not in _WORKER:
        _WORKER[key] = DropoutEncoder(Pieces(model), seed, dropout)
    return _WORKER[key]


ENCODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])
DECODED = pa.schema([("doc_id", pa.int64()), ("n_pieces", pa.int64()), ("ids_crc32", pa.int64()), ("text", pa.string())])


def encode(docs: DataFrame, seed: int = SEED, dropout: float = DROPOUT,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): little-endian unsigned 32-bit ids of each text under seeded merge dropout.

    Null and empty texts have no ids. The document's id keys its skips, so
    repeated rows get equal ids. An empty table gives an empty result.
    """
    session(docs.sparkSession)

    def run(batches):
        enc = worker_encoder(seed, dropout)
        for batch in batches:
            ids = enc.encode_batch(batch.column("text").to_pylist(), [str(d) for d in batch.column("doc_id").to_pylist()])
            yield arrow(ENCODED, doc_id=batch.column("doc_id"), ids=[x.tobytes() for x in ids])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, ddl(ENCODED))


def decode(encoded: DataFrame) -> DataFrame:
    """(doc_id, n_pieces, ids_crc32, text) from (doc_id, ids)."""

    def run(batches):
        pieces = worker_encoder(SEED, 0.0).pieces
        for batch in batches:
            raw = batch.column("ids").to_pylist()
            yield arrow(DECODED, doc_id=batch.column("doc_id"), n_pieces=[len(r) // 4 for r in raw],
                        ids_crc32=[zlib.crc32(r) for r in raw], text=[pieces.decode(np.frombuffer(r, "<u4")) if r else "" for r in raw])

    return encoded.mapInArrow(run, ddl(DECODED))


ROUND_TRIP = pa.schema([("doc_id", pa.int64()), ("n_pieces", pa.int64()), ("ids_crc32", pa.int64()), ("decoded_sha256", pa.string())])


def round_trip(docs: DataFrame, seed: int = SEED, dropout: float = DROPOUT,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_pieces, ids_crc32, and the SHA-256 of the text decoded from the
    ids; the same as ``decode(encode(docs))`` in one pass, so that ids need not leave the task."""
    session(docs.sparkSession)

    def run(batches):
        enc = worker_encoder(seed, dropout)
        for batch in batches:
            ids = enc.encode_batch(batch.column("text").to_pylist(), [str(d) for d in batch.column("doc_id").to_pylist()])
            yield arrow(ROUND_TRIP, doc_id=batch.column("doc_id"), n_pieces=[len(x) for x in ids],
                        ids_crc32=[zlib.crc32(x.tobytes()) for x in ids],
                        decoded_sha256=[hashlib.sha256((enc.pieces.decode(x) if len(x) else "").encode()).hexdigest() for x in ids])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, ddl(ROUND_TRIP))
