"""Toxicity: a learned lexicon, misspellings through automata, scores by context window.

The lexicon is learned from labelled rows: words whose share of toxic texts
exceeds their share of clean ones by far. Its trie is intersected with
Levenshtein automata (one edit for terms of 5 letters or more, two from 8): the
product automaton reads a word letter by letter, and words leave it as soon as
no term is in reach. All words of a batch step through it together, as arrays.

Each hit is read in a window around it. Quotation marks, reporting verbs and
mention ("the word ...") speak for quotation; address in the second person and
further hits nearby speak for abuse. Sums over hits go into a logistic
regression, fitted on labelled rows that did not shape the lexicon.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringwatch.llm.common import arrow, id_and_text, session, written
from ringwatch.llm.packing import ddl

#: Bounds of the fit: labelled rows, and terms of the lexicon.
TRAIN_ROWS = 30_000
TERMS = 400
#: A term's least number of toxic training texts, least weight (log of the ratio of shares) and z-score.
MIN_TOXIC, MIN_WEIGHT, MIN_Z = 3, 2.5, 3.0
WINDOW = 48
FOLDS, HELD_FOLD = 5, 0

# Cues in the window around a hit (English, German, French, Spanish).
REPORTING = frozenset("""said says wrote writes called calls quote quoted quoting term word phrase tweeted replied shouted
sagte sagt schrieb nannte wort zitat dit disait appelle mot citation dijo dice escribió llamó palabra cita""".split())
ADDRESS = frozenset("""you your yours youre u ur are such a an du dich dir dein deine ihr tu toi ton ta vous votre
tú tu eres usted vosotros""".split())
QUOTES = "\"“”„«»‘’"
_WORD = re.compile(r"[^\W\d_]+")


def folded(text: str) -> str:
    """``text`` in lower case, a letter for each letter, so that offsets hold (a capital I with a dot gives one i)."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower()[0] for c in text)


class Automaton:
    """Product of a lexicon trie and Levenshtein automata, its states made when first reached.

    A state is a set of (trie node, edits so far), each node with its fewest edits.
    """

    def __init__(self, terms: list[str]):
        self.terms = terms
        letters = sorted({c for t in terms for c in t})
        self.other = len(letters) + 1  # 0: no letter
        self.classes = np.full(0x250, 0, np.uint16)
        for cp in range(0x250):
            if chr(cp).isalnum():
                self.classes[cp] = self.other
        self.code = {}
        for i, c in enumerate(letters, 1):
            self.code[c] = i
            if ord(c) < 0x250:
                self.classes[ord(c)] = i
        self.child: list[dict[int, int]] = [{}]
        self.term_at: list[int] = [-1]
        self.reach: list[int] = [0]  # edits that some term below allows
        for k, t in enumerate(terms):
            node, allowed = 0, self.allowed(t)
            self.reach[0] = max(self.reach[0], allowed)
            for c in t:
                if self.code[c] not in self.child[node]:
                    self.child[node][self.code[c]] = len(self.child)
                    self.child.append({})
                    self.term_at.append(-1)
                    self.reach.append(0)
                node = self.child[node][self.code[c]]
                self.reach[node] = max(self.reach[node], allowed)
            self.term_at[node] = k
        self.longest = max(map(len, terms), default=0) + 2
        self.states: list[tuple] = [()]
        self.number: dict[tuple, int] = {(): 0}
        self.next = np.full((64, self.other + 1), -1, np.int32)
        self.next[0] = 0
        self.term = np.full(64, -1, np.int32)
        self.edits = np.zeros(64, np.int8)
        self.start = self._state({0: 0})

    @staticmethod
    def allowed(term: str) -> int:
        return 0 if len(term) < 5 else 1 if len(term) < 8 else 2

    def _state(self, nodes: dict[int, int]) -> int:
        todo = list(nodes.items())
        while todo:  # letters of a term left out
            node, e = todo.pop()
            for below in self.child[node].values():
                if e + 1 <= self.reach[below] and e + 1 < nodes.get(below, 99):
                    nodes[below] = e + 1
                    todo.append((below, e + 1))
        key = tuple(sorted(nodes.items()))
        if key not in self.number:
            me = self.number[key] = len(self.states)
            self.states.append(key)
            if me >= len(self.term):
                self.next = np.concatenate([self.next, np.full_like(self.next, -1)])
                self.term = np.concatenate([self.term, np.full_like(self.term, -1)])
                self.edits = np.concatenate([self.edits, np.zeros_like(self.edits)])
            ends = [(e, self.term_at[n]) for n, e in key if self.term_at[n] >= 0 and e <= self.allowed(self.terms[self.term_at[n]])]
            if ends:
                self.edits[me], self.term[me] = min(ends)
        return self.number[key]

    def _step(self, state: int, letter: int) -> int:
        new: dict[int, int] = {}

        def put(node, e):
            if e <= self.reach[node] and e < new.get(node, 99):
                new[node] = e

        for node, e in self.states[state]:
            put(node, e + 1)  # an extra letter
            for c, below in self.child[node].items():
                put(below, e + (c != letter))
        to = self._state(new)
        self.next[state, letter] = to
        return to

    def hits(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(text number, start, end, term, edits) of every word in reach of a term, and the words of each text."""
        joined = "\n".join(folded(t) for t in texts) + "\n"
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        cls = np.empty(len(points), np.uint16)
        small = points < 0x250
        cls[small] = self.classes[points[small]]
        kinds, inverse = np.unique(points[~small], return_inverse=True)
        large = [self.code.get(chr(c), self.other if chr(c).isalnum() else 0) for c in kinds.tolist()]
        cls[~small] = np.array(large, np.uint16)[inverse]
        inside = cls > 0
        edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
        starts, ends = edge[::2], edge[1::2]
        bounds = np.cumsum([0] + [len(t) + 1 for t in texts])
        words = np.diff(np.searchsorted(starts, bounds))
        live = np.flatnonzero(ends - starts <= self.longest)
        at, end = starts[live], ends[live]
        state = np.full(len(live), self.start, np.int32)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for _ in range(self.longest + 1):
            done = at == end
            if done.any():
                ok = done & (self.term[state] >= 0)
                found.append((live[ok], state[ok]))
                go = ~done
                live, at, end, state = live[go], at[go], end[go], state[go]
            if not len(live):
                break
            letter = cls[at]
            to = self.next[state, letter]
            unknown = to < 0
            if unknown.any():
                code = np.unique(state[unknown].astype(np.int64) << 16 | letter[unknown])
                for s, c in zip((code >> 16).tolist(), (code & 0xFFFF).tolist()):
                    self._step(s, c)
                to = self.next[state, letter]
            keep = to > 0
            live, at, end, state = live[keep], at[keep] + 1, end[keep], to[keep]
        word = np.concatenate([w for w, _ in found]) if found else np.zeros(0, np.int64)
        last = np.concatenate([s for _, s in found]) if found else np.zeros(0, np.int32)
        order = np.argsort(word, kind="stable")
        word, last = word[order], last[order]
        text = np.searchsorted(bounds, starts[word], side="right") - 1
        return (text, starts[word] - bounds[text], ends[word] - bounds[text], self.term[last], self.edits[last], words)


def quoted(text: str, start: int, end: int) -> float:
    """Context of a hit, from 0 (abuse) to 1 (quotation): cues in the window on both sides."""
    before, after = text[max(0, start - WINDOW):start], text[end:end + WINDOW]
    words = [w.lower() for w in _WORD.findall(before)]
    score = -1.0
    marks = sum(before.count(q) for q in QUOTES)
    if marks % 2 and any(q in after for q in QUOTES):
        score += 2.0
    score += 1.5 * any(w in REPORTING for w in words[-5:])
    score -= 1.0 * any(w in ADDRESS for w in words[-3:])
    return 1 / (1 + math.exp(-score))


FEATURES = 8


def text_features(texts: list[str], auto: Automaton, weights: np.ndarray) -> np.ndarray:
    """Per text: sums over hits, exact and misspelled, each discounted by its context, and their density."""
    out = np.zeros((len(texts), FEATURES))
    if not auto.terms:
        return out
    where, start, end, term, edits, words = auto.hits(texts)
    for i, s, e, t, d in zip(where.tolist(), start.tolist(), end.tolist(), term.tolist(), edits.tolist()):
        q = quoted(texts[i], s, e)
        w = weights[t] * (1 - q)
        row = out[i]
        row[min(d, 2)] += w
        row[3] = max(row[3], w if not d else 0)
        row[4] += q
        row[5] += 1 if not d else 0
    out[:, 6] = out[:, 0] / np.sqrt(np.maximum(words, 1))
    out[:, 7] = (out[:, 5] > 0)
    out[:, :6] = np.log1p(out[:, :6])
    return out


def learn_lexicon(rows: DataFrame, terms: int = TERMS) -> list[tuple[str, float]]:
    """(term, weight) from (text, toxic) rows: at most ``terms``, by z-score of the log ratio of shares."""
    words = rows.select("toxic", F.explode(F.array_distinct(F.split(F.lower("text"), r"[^\p{L}]+"))).alias("term")).where(
        "length(term) between 3 and 24")
    n = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = n.get(1, 0), n.get(0, 0)
    if not n1 or not n0:
        return []
    counts = words.groupBy("term").agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b"))
    a, b = F.col("a") + 0.5, F.col("b") + 0.5
    weight = F.log(a / (n1 + 1)) - F.log(b / (n0 + 1))
    best = (counts.where(F.col("a") >= MIN_TOXIC).withColumn("w", weight).withColumn("z", F.col("w") / F.sqrt(1 / a + 1 / b))
            .where((F.col("w") >= MIN_WEIGHT) & (F.col("z") >= MIN_Z)).orderBy(F.desc("z"), "term").limit(terms))
    return [(r.term, float(r.w)) for r in best.collect()]  # at most ``terms`` rows


class Scorer:
    """Lexicon, weights and regression; plain values, so that tasks can build their own automaton."""

    def __init__(self, lexicon: list[tuple[str, float]], coef: list[float], intercept: float):
        self.lexicon, self.coef, self.intercept = lexicon, coef, intercept

    def __call__(self, texts: list[str], auto: Automaton) -> np.ndarray:
        x = text_features(texts, auto, np.array([w for _, w in self.lexicon]))
        return 1 / (1 + np.exp(-(x @ np.array(self.coef) + self.intercept)))


def fold(column: str = "doc_id"):
    """crc32 of the id as text, modulo ``FOLDS``; null ids count as held out."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % FOLDS, F.lit(HELD_FOLD))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Scorer:
    """Learn from about ``TRAIN_ROWS`` labelled rows outside the held-out fold: half of them give
    the lexicon, the other half the regression. With one class only, every score is the base rate."""
    spark = session(docs.sparkSession)
    known = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
             .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
             .where(fold() != HELD_FOLD))
    total = known.count()
    share = min(1.0, TRAIN_ROWS / max(1, total))
    # Bounded by TRAIN_ROWS (12 bytes a row), so every task may hold it.
    chosen = known.where(F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(1_000_000)) < int(share * 1_000_000))
    rows = written(id_and_text(docs, id_col, text_col).join(F.broadcast(chosen), "doc_id")
                   .select("text", "toxic", (F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(2)) == 0).alias("first")), "toxic-training")
    lexicon = learn_lexicon(rows.where("first"))
    weights = np.array([w for _, w in lexicon])
    terms = [t for t, _ in lexicon]

    def run(batches):
        auto = Automaton(terms)
        for batch in batches:
            x = text_features(batch.column("text").to_pylist(), auto, weights)
            yield pa.RecordBatch.from_arrays([batch.column("toxic").cast(pa.float64()), pa.array(x.tolist(), pa.list_(pa.float64()))],
                                             names=["label", "features"])

    shaped = written(rows.where("not first").select("text", "toxic").mapInArrow(run, "label double, features array<double>"),
                     "toxic-features")
    n = {r.label: r.n for r in shaped.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    positive, everything = n.get(1.0, 0), sum(n.values())
    if not lexicon or not positive or positive == everything:
        rate = (positive + 0.5) / (everything + 1) if everything else 0.01
        return Scorer(lexicon, [0.0] * FEATURES, math.log(rate / (1 - rate)))
    model = LogisticRegression(regParam=0.002, maxIter=50).fit(shaped.select("label", array_to_vector("features").alias("features")))
    return Scorer(lexicon, [float(c) for c in model.coefficients.toArray()], float(model.intercept))


SCORES = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])


def toxicity(docs: DataFrame, labels: DataFrame, scorer: Scorer | None = None, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, score (0 to 1), predicted (score >= 0.5).

    Only the text is scored; null and empty texts have no hits and get the
    intercept's score. Repeated rows get equal scores; an empty table gives an
    empty result.
    """
    session(docs.sparkSession)
    scorer = fit(docs, labels, id_col, text_col) if scorer is None else scorer
    terms = [t for t, _ in scorer.lexicon]

    def run(batches):
        auto = Automaton(terms)
        for batch in batches:
            score = scorer(batch.column("text").to_pylist(), auto)
            yield arrow(SCORES, doc_id=batch.column("doc_id"), held_out=batch.column("held_out"), score=score,
                        predicted=(score >= 0.5).astype(np.int32))

    return id_and_text(docs, id_col, text_col).select("doc_id", "text", (fold() == HELD_FOLD).alias("held_out")).mapInArrow(
        run, "doc_id long, held_out boolean, score double, predicted int")
