import random
import zlib

import numpy as np

from ringwatch.llm import toxicity as X
from tests.llm.fixtures import corner, docs, prose  # noqa: F401

TERMS = ["idiot", "worthless", "scum", "moron", "disgusting", "trash"]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_automaton_equals_edit_distance():
    r = random.Random(1)
    words = []
    for t in TERMS * 60:
        w = list(t)
        for _ in range(r.randint(0, 3)):
            k, op = r.randrange(len(w) + 1), r.random()
            if op < 0.4:
                w.insert(k, r.choice("aeioustz1é"))
            elif w:
                k = min(k, len(w) - 1)
                if op < 0.7:
                    w[k] = r.choice("aeioustz0ü")
                else:
                    del w[k]
        if w:
            words.append("".join(w))
    words += [prose(i, 1).lower().strip(".") for i in range(200)]
    auto = X.Automaton(TERMS)
    texts = [" ".join(words[:300]), "", ", ".join(words[300:]).upper(), "x"]
    where, start, end, term, edits, n = auto.hits(texts)
    got = {(texts[i][s:e].lower(), d) for i, s, e, d in zip(where.tolist(), start.tolist(), end.tolist(), edits.tolist())}
    want = set()
    for w in words:
        best = min((distance(w, t) for t in TERMS if distance(w, t) <= X.Automaton.allowed(t)), default=None)
        if best is not None:
            want.add((w, best))
    assert got == want
    assert n.tolist() == [300, 0, len(words) - 300, 1]


def test_hits_carry_the_right_term():
    auto = X.Automaton(TERMS)
    _, _, _, term, edits, _ = auto.hits(["you m0ron", "an idiott, worthles thing"])
    assert [TERMS[t] for t in term] == ["moron", "idiot", "worthless"] and edits.tolist() == [1, 1, 1]


def test_case_of_any_text_is_folded():
    auto, weights = X.Automaton(TERMS), np.ones(len(TERMS))
    for plain, odd in (("YOU IDIOT go", "YOU IDIOT İ go"), ("the MORON", "İİ the MORON"), ("IDİOT", "idiot")):
        a, b = (auto.hits([t]) for t in (plain, odd))
        assert len(a[0]) == len(b[0]) == 1 and a[3].tolist() == b[3].tolist() and a[4].tolist() == b[4].tolist()
    text, odd = "İ they said. YOU IDIOT, go home", "I they said. YOU IDIOT, go home"
    _, start, end, *_ = auto.hits([text])
    assert text[start[0]:end[0]] == "IDIOT"
    assert (X.text_features([text], auto, weights) == X.text_features([odd], auto, weights)).all()
    for t in ("İSTANBUL ẞ ǅ Σ ΑΣ ﬁ", "\u0130" * 50, ""):
        assert len(X.folded(t)) == len(t)


def test_quotation_and_abuse():
    hit = lambda t, w="idiot": X.quoted(t, t.index(w), t.index(w) + len(w))
    assert hit("he wrote \"what an idiot\" in it") > 0.7 > 0.4 > hit("the idiot went home") > hit("you idiot go home")
    assert hit("she said idiot once") > hit("the idiot went home")


def corpus(n=900):
    r = random.Random(4)
    rows, labels = [], []
    for i in range(n):
        words = prose(i, 60).split()
        toxic = i % 6 == 0
        if toxic:
            for _ in range(3):
                words.insert(r.randrange(len(words)), r.choice(TERMS))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_held_out_accuracy_and_misspellings(spark, docs):
    rows, labels = corpus()
    extra = [(5000, "you are a worthles idiott and a moronn, utter scum " + prose(5, 30)), (5001, prose(6, 60)),
             (5002, prose(7, 60) + " disgustng worthlesss disgustingg idiiot")]
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = {r.doc_id: r for r in X.toxicity(docs(rows + extra), lab).collect()}
    held = [(out[i].predicted, t) for i, _, t in labels if out[i].held_out]
    assert len(held) > 100 and np.mean([p == t for p, t in held]) > 0.97
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in out.items())
    assert out[5000].predicted == 1 and out[5001].predicted == 0 and out[5002].score > out[5001].score
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out.values())


def test_held_out_labels_are_never_used(spark, docs):
    rows, labels = corpus(300)
    flip = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    make = lambda x: spark.createDataFrame(x, "doc_id long, quality int, toxic int")
    a = {r.doc_id: r.score for r in X.toxicity(docs(rows), make(labels)).collect()}
    b = {r.doc_id: r.score for r in X.toxicity(docs(rows), make(flip)).collect()}
    assert a.keys() == b.keys() and all(abs(a[i] - b[i]) < 1e-9 for i in a)


def test_corner_cases(spark, corner, docs):
    df, pairs = corner
    lab = spark.createDataFrame([(1, 1, 0), (1, 1, 1), (5, 0, 0), (None, 1, 1), (6, 1, None), (77, 1, 1)], "doc_id long, quality int, toxic int")
    rows = X.toxicity(df, lab).collect()
    assert len(rows) == len(pairs) and all(0 <= r.score <= 1 for r in rows)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert X.toxicity(df, none).count() == len(pairs)
    assert X.toxicity(docs([]), lab).count() == 0


def test_punctuation_and_letters_of_any_script():
    from ringwatch.llm import toxicity

    auto = toxicity.Automaton(["idiot", "bad", "дурак", "ηλίθιος", "笨蛋东西", *(chr(0x4E00 + k) * 3 for k in range(400))])
    texts = ["“idiot” ‘bad’", "idiot—bad…", "bad\u200b 😀idiot😀", "ты Дурак, дурaк!", "ηλίθιος", "笨蛋东西", chr(0x4E00 + 399) * 3, "дура"]
    where, start, end, term, edits, words = auto.hits(texts)
    got = [(i, texts[i][s:e].lower(), auto.terms[t], d) for i, s, e, t, d in zip(*(x.tolist() for x in (where, start, end, term, edits)))]
    assert got == [(0, "idiot", "idiot", 0), (0, "bad", "bad", 0), (1, "idiot", "idiot", 0), (1, "bad", "bad", 0), (2, "bad", "bad", 0),
                   (2, "idiot", "idiot", 0), (3, "дурак", "дурак", 0), (3, "дурaк", "дурак", 1), (4, "ηλίθιος", "ηλίθιος", 0),
                   (5, "笨蛋东西", "笨蛋东西", 0), (6, chr(0x4E00 + 399) * 3, chr(0x4E00 + 399) * 3, 0), (7, "дура", "дурак", 1)]
    assert words.tolist() == [2, 2, 2, 3, 1, 1, 1, 1]
