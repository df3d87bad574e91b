import random
from collections import Counter

from ringwatch.llm import quality as Q
from tests.llm.fixtures import corner, docs, prose  # noqa: F401


def plain(text):
    spaces = " \t\n\x0b\x0c\r"
    cut = lambda t: [w for w in "".join(" " if c in spaces else c for c in t).split(" ") if w]
    words = cut(text)
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if cut(line):
            dup += line in seen
            seen.add(line)
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(text.count(c) for c in "#*$%&|<>"),
            "n_dup_lines": dup, "n_repeat_words": len(covered)}


TEXTS = ["", " ", "a b c a b c", "a a a a", "x\n\ny\nx\n x\nx", "é ü #é# $ <b> |", "one two three four one two three", "a\x1cb c d", "\r\n\r\nq\r\nq\r\n",
         prose(2, 300), prose(2, 40) + "\n" + prose(2, 40), "z " * 99]


def test_base_counts_follow_the_definition():
    for t in TEXTS:
        got = Q.base_counts(Q.Doc(t))
        assert {k: got[k] for k in plain(t)} == plain(t), t


def test_verdict_does_not_depend_on_the_order():
    for t in [*TEXTS, prose(1, 100).replace(" ", "$$$ "), prose(1, 100).upper(), prose(1, 100).replace(" ", "!! ")]:
        assert len({Q.judge(t, o)["kept"] for o in (list(Q.RULES), list(Q.RULES)[::-1])}) == 1


def test_junk_goes_and_prose_stays():
    order = list(Q.RULES)
    good = prose(1, 200)
    assert Q.judge(good, order)["kept"] and Q.judge("Überall möchte " + good, order)["kept"]
    for bad in (good.replace(" ", "$$$ "), good.replace(" ", " | "), good.upper(), good.replace(" ", "!! "), "12 " * 10 + "1 2 3 4 5 6 7 " * 40, "w" * 400 + " " + "v" * 90):
        assert not Q.judge(bad, order)["kept"]


def test_cascade_stops_at_the_first_rejection(monkeypatch):
    calls = []
    rules = {n: (lambda d, n=n: calls.append(n) or n == "b") for n in "abc"}
    monkeypatch.setattr(Q, "RULES", rules)
    assert not Q.passes(Q.Doc("x"), ["a", "b", "c"]) and calls == ["a", "b"]


def test_order_puts_rejections_per_cost_first(docs):
    pairs = [(i, prose(i, 120).replace(" ", "$$$ ") if i % 2 else prose(i, 120)) for i in range(60)]
    assert Q.rule_order(docs(pairs))[0] == "symbol_heavy"


def test_corner_cases(corner, docs):
    df, pairs = corner
    rows = Q.quality_report(df).collect()
    assert len(rows) == len(pairs)
    by = Counter((r.doc_id, r.n_words, r.base_failed) for r in rows)
    assert by == Counter((i, (p := plain(t or "") if len(t or "") < 10_000 else Q.base_counts(Q.Doc(t)))["n_words"],
                          p["n_words"] < 50 or 100 * p["n_repeat_words"] > 50 * p["n_words"]) for i, t in pairs)
    assert all(not r.kept for r in rows if r.base_failed)
    out = Q.keep_good(df)
    assert out.columns == df.columns and out.count() == sum(r.kept for r in rows)
    assert Q.quality_report(docs([])).count() == 0 and Q.keep_good(docs([])).count() == 0


def test_few_kinds_does_not_depend_on_length():
    r = random.Random(4)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}" for i in range(3000)]
    for n in (200, 7_000, 500_000):
        assert Q.judge(" ".join(r.choice(words) for _ in range(n)), list(Q.RULES))["kept"]
        low = Q.Doc(" ".join(r.choice(words[:20]) for _ in range(n)))
        assert Q.few_kinds(low)
