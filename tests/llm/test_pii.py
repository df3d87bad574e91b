import hashlib
import random
import re

import numpy as np

from ringwatch.llm import pii as P
from tests.llm.fixtures import corner, docs, prose  # noqa: F401

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def checksum(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def plain(t):
    n = lambda m: re.sub(r"[^0-9]", "", m[0])
    return ([("email", *m.span()) for m in EMAIL.finditer(t)]
            + [("ip", *m.span()) for m in IP.finditer(t) if all(int(x) <= 255 for x in m[0].split("."))]
            + [("card", *m.span()) for m in CARD.finditer(t) if 16 <= len(n(m)) <= 19 and checksum(n(m))]
            + [("phone", *m.span()) for m in PHONE.finditer(t) if 8 <= len(n(m)) <= 15])


def test_base_spans_follow_the_patterns():
    r = random.Random(5)
    letters = "01234567890123456789..--+@@ ()aZ._%"
    texts = ["".join(r.choice(letters) for _ in range(r.randint(0, 80))) for _ in range(4000)]
    texts += ["a@b.c@d.e", "x@@y.z", "1.2.3.4.5.6.7.8", "001.002.003.004", "1.2.3.4000", "+1 (974) 555-3436, +49", "4111 1111-1111 1111",
              "é.x@ü.de k@l.mé", "@a.b", "a@b", "a@b..c", "+" * 50 + "1 234567890"]
    for t in texts:
        assert P.base_spans(t) == plain(t), t


def test_long_runs_take_linear_time():
    for t in ("a" * 300_000 + " @", "@" * 100_000, "1" * 200_000, "1." * 100_000, "+" * 100_000 + "1", "+1" * 50_000, "a@" * 50_000):
        P.base_spans(t)
        P.candidates(t)


def test_isotonic_never_falls_and_keeps_the_mean():
    r = np.random.default_rng(1)
    s = r.random(500)
    y = (r.random(500) < s).astype(int)
    from_, share = P.isotonic(s, y)
    assert (np.diff(share) > 0).all() and (np.diff(from_) >= 0).all() and abs(share[0]) < 0.2 and share[-1] > 0.8


def test_fitted_detector_finds_what_the_base_misses(docs):
    detector = P.fit(docs([(i, prose(i, 150)) for i in range(300)]))
    r = random.Random(11)
    found = wrong = n = 0
    for k in range(400):
        kind, label = P.KINDS[k % 4], k // 4 % 2
        cue, s = P.example(r, kind, label)
        if kind == "card" and label and " " in s:
            continue
        text = f"{prose(k, 12)} {cue}{s} {prose(k + 1, 9)}"
        at = len(prose(k, 12)) + 1 + len(cue)
        hits = [x for x in detector.added(text, P.base_spans(text)) if x[1] < at + len(s) and x[2] > at]
        covered = bool(hits) or any(b[1] < at + len(s) and b[2] > at for b in P.base_spans(text))
        n += label
        found += label and covered
        wrong += not label and bool(hits)
    assert found > 0.6 * n and wrong < 0.1 * n, (found, wrong, n)
    assert all(not detector.added(prose(i, 200), []) for i in range(50))


def test_added_spans_leave_base_spans_alone(docs):
    detector = P.fit(docs([(i, prose(i, 150)) for i in range(300)]))
    text = "card 7536784127813050 4845168114407329 and mail a.b@c.de or tel (030) 555-1234, 10.1.2.3"
    base = P.base_spans(text)
    more = detector.added(text, base)
    spans = sorted(base + more, key=lambda x: x[1])
    assert all(a[2] <= b[1] for a, b in zip(spans, spans[1:]))
    assert text.index("4845168114407329") in {s for k, s, _ in more if k == "card"}


def test_corner_cases(corner, docs):
    df, pairs = corner
    rows = P.pii_report(df).collect()
    assert len(rows) == len(pairs)
    said = lambda spans: ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
    want = sorted((i is not None, i or 0, hashlib.sha256(said(plain(t or "")).encode()).hexdigest()) for i, t in pairs)
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.base_sha256) for r in rows) == want
    assert P.pii_report(docs([])).count() == 0 and P.redact(docs([])).count() == 0


def test_report_and_redaction(docs):
    df = docs([(1, "write to jo.doe@mail.example.com or +1 (974) 555-3436"), (2, "nothing here"), (3, None)])
    detector = P.Detector(None, {})
    rows = {r.doc_id: r for r in P.pii_report(df, detector).collect()}
    assert (rows[1].n_email, rows[1].n_phone, rows[1].n_ip, rows[1].n_card) == (1, 1, 0, 0)
    assert rows[1].spans == "email:9:32,phone:36:53" and rows[2].spans == "" == rows[3].spans
    out = P.redact(df, detector)
    assert out.columns == df.columns
    assert {r.doc_id: r.text for r in out.collect()} == {1: "write to [EMAIL] or [PHONE]", 2: "nothing here", 3: None}


def test_overlaps_become_one_mark():
    assert P.redacted("abcdefgh", [("ip", 1, 4), ("card", 3, 6), ("phone", 7, 8)]) == "a[IP]g[PHONE]"


def test_addresses_are_proposed_whatever_else_the_text_holds():
    from ringwatch.llm import pii

    for s in ("john.smith [at] example.com", "anna (at) firma.de", "Anna [AT] firma [Dot] de", "anna[At]firma.de", "a at b.com"):
        for text in (f"Write to: {s}", f"Write to: {s}, not @all or dot"):
            assert ("email", 10, 10 + len(s)) in pii.candidates(text), text
    assert not any(k == "email" for k, *_ in pii.candidates("that is no address. de"))


def test_sample_does_not_follow_the_layout_nor_copies(docs):
    pairs = [(i, prose(i, 60)) for i in range(80)]
    one = P.fit(docs(pairs, 1))
    many = P.fit(docs(pairs + [(1000 + i, pairs[3][1]) for i in range(200)], 9))
    assert one.thresholds == many.thresholds
    text = "mail jo [at] firma.de, tel (030) 555-1234 or 7536 7841 2781 3050, ref 5555 1234, 1999-12-24"
    assert one.added(text, P.base_spans(text)) == many.added(text, P.base_spans(text))


def test_examples_are_written_into_the_whole_text(monkeypatch):
    seen = []
    monkeypatch.setattr(P, "candidates", lambda t: seen.append(t) or [])
    P.training_rows("x" * 30_000 + "".join(f" w{k}w" for k in range(9000)), "s")
    assert seen and all("w" in t for t in seen) and len({t[-20:] for t in seen}) > 1
