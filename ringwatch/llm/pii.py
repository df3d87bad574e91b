"""Personal data: overlapping candidates, boosted trees, calibrated thresholds.

Generators propose spans with high recall: the base patterns, numbers without a
plus, numbers inside longer digit runs, spelled-out or spaced addresses. They
may overlap. Gradient-boosted trees score each candidate from its format
(digits, groups, separators, checksums, neighbours) and its context (words
before it). Every kind has its own threshold, read off a calibration of the
scores on held-out examples. Matches of the base patterns always stay.

The trees are fitted on a bounded sample: into texts of the corpus, at seeded
places, the sample writes personal data in the formats that the base patterns
miss, and look-alikes (dates, amounts, versions, numbers with a wrong
checksum), so contexts are the corpus's own and labels are known.
"""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ringwatch.llm.common import arrow, id_and_text, session, written
from ringwatch.llm.packing import ddl

KINDS = ("email", "ip", "card", "phone")

#: Bounds of the training sample: documents, and examples written into each.
SAMPLE_DOCS = 3000
EXAMPLES_EACH = 4
TREES, DEPTH = 16, 4
#: Held-out precision that a kind's threshold must reach.
PRECISION = 0.97

# The base patterns (ASCII). A start inside a run of digits can't match where the run's
# own start didn't, which the look-behind says without trying.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping addresses: around each @, the run of local characters before it
    (not before the last match's end) and the dotted domain after it."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        left = len(text[free:at].rstrip(_LOCAL)) + free
        m = _DOMAIN.match(text, at + 1) if left < at else None
        if m:
            out.append((left, m.end()))
            free = m.end()
        else:
            free = at + 1
        at = text.find("@", at + 1)
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The base spans, by kind as listed and then by start."""
    out = [("email", s, e) for s, e in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m[0].split(".")):
                out.append(("ip", *m.span()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 16:
                d = _digits(m[0])
                if 16 <= len(d) <= 19 and luhn(d):
                    out.append(("card", *m.span()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 8 <= len(_digits(m[0])) <= 15:
                    out.append(("phone", *m.span()))
    return out


# High-recall generators; bounded repeats keep them linear.
_AT = r"(?:@|\[at\]|\(at\)|\bat\b)"
_DOT = r"(?:\.|\[dot\]|\(dot\)|\bdot\b)"
_LOOSE_EMAIL = re.compile(rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{{1,64}} {{0,2}}{_AT} {{0,2}}[A-Za-z0-9-]{{1,63}}"
                          rf"(?: {{0,2}}{_DOT} {{0,2}}[A-Za-z0-9-]{{2,63}}){{1,4}}", re.I)
_HAS_AT = re.compile(_AT, re.I)  # part of every match of the above
_LOOSE_IP = re.compile(r"(?<![0-9.])[0-9]{1,3}(?: ?(?:\[\.\]|\(\.\)|\.) ?[0-9]{1,3}){3}(?![0-9])")
_LOOSE_CARD = re.compile(r"(?<![0-9])(?:[0-9]{4}[ ._/-]{1,2}){3}[0-9]{4}(?![0-9])|(?<![0-9])[0-9]{13,19}(?![0-9])")
_LOOSE_PHONE = re.compile(r"(?<![0-9A-Za-z+.])(?:00|\()?[0-9]{1,4}\)?(?:[ ./-]{1,2}\(?[0-9]{2,5}\)?){1,5}(?![0-9A-Za-z])")


def candidates(text: str) -> list[tuple[str, int, int]]:
    """Overlapping spans beyond the base patterns, as many as the generators see."""
    out = []
    if _HAS_AT.search(text):
        out += [("email", *m.span()) for m in _LOOSE_EMAIL.finditer(text)]
    if _DIGIT.search(text):
        out += [("ip", *m.span()) for m in _LOOSE_IP.finditer(text)]
        out += [("card", *m.span()) for m in _LOOSE_CARD.finditer(text)]
        out += [("phone", *m.span()) for m in _LOOSE_PHONE.finditer(text) if 7 <= len(_digits(m[0])) <= 15]
    return out


# Words that come before personal data of each kind.
CUES = {
    "email": ("email", "e-mail", "mail", "contact", "write", "address", "correo", "courriel", "reach"),
    "ip": ("ip", "host", "server", "address", "from", "client", "login", "node"),
    "card": ("card", "visa", "mastercard", "amex", "credit", "payment", "karte", "tarjeta", "carte"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "cell", "telefon", "whatsapp", "sms", "contact"),
}
_WORD = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)?")
FEATURES = 30


def features(text: str, kind: str, start: int, end: int) -> list[float]:
    """Format and context of one candidate; no feature says which pattern found it."""
    s = text[start:end]
    d = _digits(s)
    groups = re.findall(r"[0-9]+", s)
    sizes = [len(g) for g in groups]
    before, after = text[max(0, start - 48):start], text[end:end + 24]
    words = [w.lower() for w in _WORD.findall(before)][-4:]
    prev, nxt = before[-1:] or " ", after[:1] or " "
    octets = [int(g[:4]) for g in groups]
    year = bool(groups) and (1900 <= octets[0] <= 2100 and sizes[0] == 4 or 1900 <= octets[-1] <= 2100 and sizes[-1] == 4)
    return [float(x) for x in (
        KINDS.index(kind), len(s), len(d), len(groups), max(sizes, default=0), min(sizes, default=0),
        sizes[0] if sizes else 0, sizes[-1] if sizes else 0, len(set(sizes)), luhn(d) if d else 0,
        max(octets, default=0) <= 255, len(groups) == 4, year and len(groups) in (1, 2, 3), len(set(d)),
        s.count(" "), s.count("-"), s.count("."), s.count("/"), s.count("(") + s.count("["), "@" in s,
        sum(c.isalpha() for c in s), "dot" in s.lower(), prev.isalnum(), nxt.isalnum(), prev in "$€£#=vV\"", nxt in "%€$\"",
        any(w in CUES[kind] for w in words), any(w in CUES[k] for k in KINDS if k != kind for w in words),
        d[:1] in ("3", "4", "5", "6"), d[:1] == "0")]


def _valid_luhn(r: random.Random, n: int, first: str, good: bool) -> str:
    body = first + "".join(r.choice("0123456789") for _ in range(n - 1 - len(first)))
    check = next(c for c in "0123456789" if luhn(body + c))
    return body + (check if good else str((int(check) + r.randint(1, 9)) % 10))


def _grouped(s: str, sizes, sep: str) -> str:
    out, at = [], 0
    for n in sizes:
        out.append(s[at:at + n])
        at += n
    return sep.join(x for x in [*out, s[at:]] if x)


def example(r: random.Random, kind: str, label: int) -> tuple[str, str]:
    """(cue or nothing, invented string): personal data (1) or a look-alike (0)."""
    num = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    name = "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(3, 9)))
    host = "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(3, 9)))
    cue = r.choice(CUES[kind]) + r.choice((": ", " ", " is ")) if r.random() < 0.5 else ""
    if kind == "email":
        if label:
            at, dot = r.choice(((" [at] ", " [dot] "), (" (at) ", " (dot) "), (" at ", " dot "), (" @ ", "."), ("[at]", "[dot]"),
                                (" [at] ", "."), (" (at) ", "."), ("[at]", "."), (" [AT] ", " [Dot] "), (" [AT] ", ".")))
            return cue, f"{name}{at}{host}{dot}{r.choice(('com', 'org', 'net', 'de', 'es'))}"
        return "", r.choice((f"{name} at {host}. {name}", f"look at {host} dot {name}{host}", f"{name} @ {host}. {host}"))
    if kind == "ip":
        sep = r.choice(("[.]", "(.)", " . ", ". "))
        if label:
            return cue, sep.join(str(r.randint(1, 254)) for _ in range(4))
        return "", r.choice((sep.join(str(r.randint(256, 999)) for _ in range(4)), f"{num(1)}. {num(1)}. {num(1)}. {num(1)}",
                             f"{r.randint(1, 31)}. {r.randint(1, 12)}. {num(2)}. {num(3)}"))
    if kind == "card":
        digits = _valid_luhn(r, 16, r.choice("3456"), bool(label))
        shown = r.choice((digits, _grouped(digits, (4, 4, 4), r.choice((" ", "-", ".")))))
        if label:
            return cue, r.choice((shown, f"{num(r.randint(1, 5))} {digits}", f"{digits} {num(r.randint(1, 16))}"))
        return cue if r.random() < 0.5 else "", r.choice((shown, num(r.randint(13, 15)), f"{num(4)}.{num(4)}.{num(4)}.{num(4)}"))
    sep = r.choice((" ", "-", "."))
    if label:
        return cue or r.choice(CUES["phone"]) + " ", r.choice((f"({num(3)}) {num(3)}-{num(4)}", f"{num(3)}{sep}{num(3)}{sep}{num(4)}",
                                                               f"00{num(2)} {num(3)} {num(6)}", f"0{num(3)} {num(3)} {num(4)}"))
    return "", r.choice((f"{r.randint(1900, 2099)}-{r.randint(10, 12)}-{r.randint(10, 28)}", f"{num(4)} {num(4)}", f"{num(2)}/{num(2)}/20{num(2)}",
                         f"{num(3)}-{num(4)}", f"{num(5)}-{num(5)}", f"{num(3)} {num(2)} {num(4)} {num(3)}"))


TRAIN = pa.schema([("kind", pa.string()), ("label", pa.int64()), ("held", pa.bool_()), ("features", pa.list_(pa.float64()))])
TRAIN_DDL = "kind string, label long, held boolean, features array<double>"


def training_rows(text: str, seed: str) -> list[tuple[str, int, bool, list[float]]]:
    """Labelled candidates: invented strings written into ``text`` at seeded word boundaries."""
    r = random.Random(seed)
    gaps = [m.start() for m in re.finditer(" ", text)] or [0]
    out = []
    for _ in range(EXAMPLES_EACH):
        kind, label = r.choice(KINDS), r.randint(0, 1)
        cue, s = example(r, kind, label)
        at = r.choice(gaps)
        new = f"{text[max(0, at - 100):at]} {cue}"
        start = len(new)
        new += s + text[at:at + 100]
        for k, a, b in candidates(new):
            if k == kind and a < start + len(s) and b > start:
                # A look-alike that holds a valid card number by chance is no look-alike.
                d = _digits(new[a:b])
                good = label and a >= start and b <= start + len(s)
                if kind == "card":
                    good = 13 <= len(d) <= 19 and luhn(d)
                out.append((kind, int(good), r.random() < 0.3, features(new, kind, a, b)))
    return out


class Trees:
    """Boosted trees as flat arrays; ``score`` gives probabilities for a feature matrix."""

    def __init__(self, nodes: np.ndarray, roots: list[int], weights: list[float]):
        self.nodes, self.roots, self.weights = nodes, roots, weights

    @classmethod
    def of(cls, model) -> Trees:
        nodes: list[list[float]] = []  # feature (-1: leaf), threshold, left, right, value

        def walk(node) -> int:
            me = len(nodes)
            nodes.append([-1, 0, 0, 0, node.prediction()])
            if node.subtreeDepth():
                split = node.split()
                nodes[me][:2] = [split.featureIndex(), split.threshold()]
                nodes[me][2] = walk(node.leftChild())
                nodes[me][3] = walk(node.rightChild())
            return me

        roots = [walk(t._call_java("rootNode")) for t in model.trees]
        return cls(np.array(nodes, float), roots, list(model.treeWeights))

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        for root, w in zip(self.roots, self.weights):
            at = np.full(len(x), root)
            while True:
                f = self.nodes[at, 0].astype(int)
                inner = np.flatnonzero(f >= 0)
                if not len(inner):
                    break
                left = x[inner, f[inner]] <= self.nodes[at[inner], 1]
                at[inner] = np.where(left, self.nodes[at[inner], 2], self.nodes[at[inner], 3]).astype(int)
            total += w * self.nodes[at, 4]
        return 1 / (1 + np.exp(-2 * total))


def isotonic(score: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Calibration steps (score from, share of positives), never falling: pool adjacent violators."""
    blocks: list[list[float]] = []  # first score, sum, count
    for s, y in sorted(zip(score.tolist(), label.tolist())):
        blocks.append([s, y, 1])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1][1] += last[1]
            blocks[-1][2] += last[2]
    return np.array([b[0] for b in blocks]), np.array([b[1] / b[2] for b in blocks])


class Detector:
    """Fitted trees and, for each kind, the least score whose calibrated probability reaches ``PRECISION``."""

    def __init__(self, trees: Trees | None, thresholds: dict[str, float]):
        self.trees, self.thresholds = trees, thresholds

    def added(self, text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
        """Spans beyond the base ones: best score first, none that overlaps a base span or a better one."""
        if self.trees is None:
            return []
        taken = sorted((s, e) for _, s, e in base)
        free = lambda s, e: (i := bisect_left(taken, (e, 0))) == 0 or max(b for _, b in taken[max(0, i - 4):i]) <= s
        found = [c for c in dict.fromkeys(candidates(text)) if free(c[1], c[2])]
        if not found:
            return []
        score = self.trees.score(np.array([features(text, *c) for c in found]))
        out = []
        for p, (kind, s, e) in sorted(zip((-score).tolist(), found)):
            if -p >= self.thresholds[kind] and free(s, e):
                out.append((kind, s, e))
                taken.insert(bisect_left(taken, (s, e)), (s, e))
        return sorted(out, key=lambda x: (KINDS.index(x[0]), x[1]))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Detector:
    """Fit on a sample of about ``SAMPLE_DOCS`` different texts, chosen by hash; without texts there is nothing to add."""
    spark: SparkSession = session(docs.sparkSession)
    share = min(1.0, SAMPLE_DOCS / max(1, docs.count()))
    # By the text's hash, each text once: the same documents however the rows lie, and no more of them for many copies.
    sample = (id_and_text(docs, id_col, text_col).where(F.pmod(F.xxhash64("text", F.lit(4)), F.lit(1 << 40)) < int(share * (1 << 40)))
              .select("text").distinct())

    def run(batches):
        for batch in batches:
            rows = [x for t in batch.column("text").to_pylist() if t.strip()
                    for x in training_rows(t, hashlib.md5(t.encode("utf-8", "replace")).hexdigest())]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in rows], f.type) for k, f in enumerate(TRAIN)], schema=TRAIN)

    # The examples, bounded by the sample, meet in four partitions whose rows and order follow from their values alone.
    rows = written(sample.mapInArrow(run, TRAIN_DDL).repartition(4, "features").sortWithinPartitions(*TRAIN.names), "pii-training")
    have = {(r.held, r.label): r.n for r in rows.groupBy("held", "label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not all(have.get((h, y)) for h in (False, True) for y in (0, 1)):
        return Detector(None, {})
    train = rows.where("not held").select(F.col("label").cast("double").alias("label"), array_to_vector("features").alias("features"))
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=4, maxBins=32, cacheNodeIds=False).fit(train)
    trees = Trees.of(model)
    held = rows.where("held").toPandas()  # bounded by the sample: at most a third of its examples
    score = trees.score(np.array(held["features"].tolist()))
    thresholds = {}
    for kind in KINDS:
        mine = (held["kind"] == kind).to_numpy()
        from_, share = isotonic(score[mine], held["label"].to_numpy()[mine])
        good = from_[share >= PRECISION]
        thresholds[kind] = float(max(0.5, good.min())) if len(good) else 2.0
    return Detector(trees, thresholds)


def _said(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


REPORT = pa.schema([("doc_id", pa.int64()), *[(f"n_{k}", pa.int64()) for k in KINDS], ("base_sha256", pa.string()),
                    ("spans", pa.string()), ("n_added", pa.int64())])


def pii_report(docs: DataFrame, detector: Detector | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts of base spans by kind, digest of the base spans, all spans, number added.

    Offsets are code points, ends exclusive. Null and empty texts have no spans
    (the digest is that of the empty string). Repeated rows get a row each; an
    empty table gives an empty result.
    """
    session(docs.sparkSession)
    detector = fit(docs, id_col, text_col) if detector is None else detector

    def run(batches):
        for batch in batches:
            out = {n: [] for n in REPORT.names}
            out["doc_id"] = batch.column("doc_id")
            for text in batch.column("text").to_pylist():
                base = base_spans(text)
                more = detector.added(text, base)
                spans = sorted(base + more, key=lambda x: (KINDS.index(x[0]), x[1]))
                for k in KINDS:
                    out[f"n_{k}"].append(sum(b[0] == k for b in base))
                out["base_sha256"].append(hashlib.sha256(_said(base).encode()).hexdigest())
                out["spans"].append(_said(spans))
                out["n_added"].append(len(more))
            yield arrow(REPORT, **out)

    return id_and_text(docs, id_col, text_col).mapInArrow(run, ddl(REPORT))


def redacted(text: str, spans: list[tuple[str, int, int]]) -> str:
    """``text`` with each span replaced by its kind in brackets; overlapping spans become one."""
    out, at = [], 0
    for kind, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
        if s >= at:
            out += [text[at:s], f"[{kind.upper()}]"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, detector: Detector | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with personal data in ``text_col`` replaced; null texts stay null, other columns as they are."""
    session(docs.sparkSession)
    detector = fit(docs, id_col, text_col) if detector is None else detector
    at = docs.columns.index(text_col)

    def clean(text):
        if text is None:
            return None
        base = base_spans(text)
        spans = base + detector.added(text, base)
        return redacted(text, spans) if spans else text

    def run(batches):
        for batch in batches:
            column = pa.array([clean(t) for t in batch.column(at).to_pylist()], pa.string())
            yield batch.set_column(at, batch.schema.field(at), column.cast(batch.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)
