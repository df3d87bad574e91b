"""Quality rules as a short-circuit cascade.

Every document gets the base counts. Documents that pass the base rule then go
through the cascade: the rules run in an order chosen from a sample, most
rejections per unit of cost first, and the first rule that rejects ends the
work on that document. The verdict is a conjunction, so the order changes the
time and never the result.
"""

from __future__ import annotations

import re
import time
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringwatch.llm.common import arrow, id_and_text, session

#: Documents of the sample that orders the rules (expected number; the order is all it decides).
SAMPLE_DOCS = 2000
SAMPLE_SEED = 9

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

SPACES = b" \t\n\r\x0b\x0c"
SYMBOLS = b"#*$%&|<>"
_SENTENCE_MARKS = re.compile(rb"[.!?,;:]+$")


@dataclass
class Doc:
    """One text with what several rules share, computed when first asked for."""

    text: str
    raw: bytes = b""
    words: list = field(default_factory=list)
    base: dict = field(default_factory=dict)

    def __post_init__(self):
        self.raw = self.text.encode("utf-8", "surrogatepass")
        self.words = self.raw.split()  # splits at exactly space and \x09-\x0d


def repeated_words(words: list) -> int:
    """Words that lie in a 3-word window found twice or more in the text."""
    n = len(words)
    if n < 4:
        return 0
    number: dict = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    base = len(number)
    key = ids[:-1] * base + ids[1:]
    if base > 2_000_000:  # three numbers no longer fit one integer
        key = np.unique(key, return_inverse=True)[1].astype(np.int64)
    window = key[:-1] * base + ids[2:]
    order = np.argsort(window)
    ranked = window[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    hit = np.zeros(n - 2, bool)
    hit[order[1:][same]] = True
    hit[order[:-1][same]] = True
    cover = np.zeros(n, bool)
    for k in range(3):
        cover[k:n - 2 + k] |= hit
    return int(cover.sum())


def base_counts(doc: Doc) -> dict:
    spaces = len(doc.raw) - len(doc.raw.translate(None, SPACES))
    lines, again = set(), 0
    if b"\n" in doc.raw:
        for line in doc.raw.split(b"\n"):
            if line and not line.isspace():
                again += line in lines
                lines.add(line)
    out = {"n_words": len(doc.words), "word_chars": len(doc.text) - spaces,
           "n_symbols": len(doc.raw) - len(doc.raw.translate(None, SYMBOLS)),
           "n_dup_lines": again, "n_repeat_words": repeated_words(doc.words)}
    out["base_failed"] = out["n_words"] < MIN_WORDS or 100 * out["n_repeat_words"] > MAX_REPEAT_PERCENT * out["n_words"]
    return out


# Rules: true means the document is rejected. Thresholds are far from what running prose shows.

def symbol_heavy(doc: Doc) -> bool:
    """More than one symbol for every four words: markup or table debris."""
    return 4 * doc.base["n_symbols"] > len(doc.words)


def word_length(doc: Doc) -> bool:
    """Mean word length outside 2 to 15 characters."""
    mean = doc.base["word_chars"] / max(1, len(doc.words))
    return not 2 <= mean <= 15


def dup_lines(doc: Doc) -> bool:
    """More than 70 % of the lines repeat an earlier one."""
    return doc.base["n_dup_lines"] > 0.7 * (doc.raw.count(b"\n") + 1)


def shouting(doc: Doc) -> bool:
    """More than a quarter of the words (of two letters or more) are all capitals."""
    return sum(len(w) > 1 and w.isupper() for w in doc.words) > 0.25 * len(doc.words)


def exclaiming(doc: Doc) -> bool:
    """More than a quarter of the words end in an exclamation or question mark."""
    marks = doc.raw.count(b"! ") + doc.raw.count(b"? ") + doc.raw.count(b"!\n") + doc.raw.count(b"?\n")
    return marks > 0.25 * len(doc.words)


def few_letters(doc: Doc) -> bool:
    """Fewer than 60 % of the words hold a letter."""
    return sum(not w.isdigit() and (w.isalpha() or any(c >= 65 for c in w)) for w in doc.words) < 0.6 * len(doc.words)


def one_word(doc: Doc) -> bool:
    """One word makes up more than 30 % of the text."""
    return Counter(doc.words).most_common(1)[0][1] > 0.3 * len(doc.words) if doc.words else False


def few_kinds(doc: Doc) -> bool:
    """Windows of 200 words, over the whole text, that use fewer than 15 % different ones on average; shorter texts
    pass. Prose of any length uses some 40 % or more."""
    n = len(doc.words)
    if n < 200:
        return False
    starts = [*range(0, n - 200, 200), n - 200]
    return sum(len(set(doc.words[i:i + 200])) for i in starts) < 0.15 * 200 * len(starts)


RULES: dict[str, Callable[[Doc], bool]] = {
    f.__name__: f for f in (symbol_heavy, word_length, dup_lines, shouting, exclaiming, few_letters, one_word, few_kinds)}


def passes(doc: Doc, order: list[str]) -> bool:
    """The cascade: stops at the first rule that rejects."""
    return not any(RULES[name](doc) for name in order)


def judge(text: str, order: list[str]) -> dict:
    doc = Doc(text)
    doc.base = base_counts(doc)
    return doc.base | {"kept": not doc.base["base_failed"] and passes(doc, order)}


SAMPLE_SCHEMA = pa.schema([("rule", pa.string()), ("seconds", pa.float64()), ("rejected", pa.int64()), ("seen", pa.int64())])


def _try_rules(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    took, rejected, seen = Counter(), Counter(), 0
    for batch in batches:
        for text in batch.column("text").to_pylist():
            doc = Doc(text)
            doc.base = base_counts(doc)
            if doc.base["base_failed"]:
                continue
            seen += 1
            for name, rule in RULES.items():
                began = time.perf_counter()
                rejected[name] += bool(rule(doc))
                took[name] += time.perf_counter() - began
    names = list(RULES)
    yield arrow(SAMPLE_SCHEMA, rule=names, seconds=[took[n] for n in names],
                rejected=[rejected[n] for n in names], seen=[seen] * len(names))


def rule_order(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", total: int | None = None) -> list[str]:
    """Rules by rejections per second on a seeded sample of about ``SAMPLE_DOCS`` documents; ties by name."""
    session(docs.sparkSession)
    total = docs.count() if total is None else total
    sample = id_and_text(docs, id_col, text_col).sample(fraction=min(1.0, SAMPLE_DOCS / max(1, total)), seed=SAMPLE_SEED)
    rows = (sample.mapInArrow(_try_rules, "rule string, seconds double, rejected long, seen long")
            .groupBy("rule").agg(F.sum("seconds").alias("s"), F.sum("rejected").alias("r")).collect())  # one row per rule
    gain = {x.rule: x.r / max(x.s, 1e-9) for x in rows}
    return sorted(RULES, key=lambda n: (-gain.get(n, 0.0), n))


VERDICT_SCHEMA = pa.schema([("doc_id", pa.int64()), *[(c, pa.int64()) for c in (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")], ("base_failed", pa.bool_()), ("kept", pa.bool_())])


def quality_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   order: list[str] | None = None) -> DataFrame:
    """One row per document: doc_id, the base counts, base_failed and kept.

    Null and empty texts have no words and fail the base rule. Repeated rows get
    a row each; an empty table gives an empty result.
    """
    session(docs.sparkSession)
    order = rule_order(docs, id_col, text_col) if order is None else order

    def run(batches):
        for batch in batches:
            found = [judge(t, order) for t in batch.column("text").to_pylist()]
            yield arrow(VERDICT_SCHEMA, doc_id=batch.column("doc_id"),
                        **{c: [x[c] for x in found] for c in VERDICT_SCHEMA.names[1:]})

    return id_and_text(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
             "base_failed boolean, kept boolean")


def keep_good(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", order: list[str] | None = None) -> DataFrame:
    """``docs`` without the documents that the rules reject; all columns stay as they are."""
    session(docs.sparkSession)
    order = rule_order(docs, id_col, text_col) if order is None else order
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            keep = [judge(t or "", order)["kept"] for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
