import random
import time
from collections import defaultdict
from pathlib import Path
from urllib.parse import urlparse

import pytest
import xxhash

from ringwatch.llm import unit_dedup as U
from ringwatch.llm.common import scratch, written
from tests.llm.fixtures import corner, docs, prose  # noqa: F401


def plain(pairs, min_words):
    """Units to remove by a straight reading of the definition: (row, id, start, end, keep id, keep start, group size)."""
    places = defaultdict(set)
    for row, (i, t) in enumerate(pairs):
        version = xxhash.xxh64((t or "").encode(), seed=42).intdigest()
        version -= (version >> 63) << 64
        f = [(s, e, form, n) for s, e in U.unit_spans(t or "") for form, n in [U.normalised((t or "")[s:e])] if n]
        for a in range(len(f)):
            total = 0
            for b in range(a, len(f)):  # least passage that begins with a
                total += f[b][3]
                if total >= min_words:
                    places[tuple(u[2] for u in f[a:b + 1])].add(((i is None, i or 0, version, row, a), i, tuple(u[:2] for u in f[a:b + 1])))
                    break
            total = 0
            for b in range(a, -1, -1):  # least passage that ends with a
                total += f[b][3]
                if total >= min_words:
                    places[tuple(u[2] for u in f[b:a + 1])].add(((i is None, i or 0, version, row, b), i, tuple(u[:2] for u in f[b:a + 1])))
                    break
    best = {}
    for found in places.values():
        (first, keep_id, kept), *later = sorted(found, key=lambda x: x[0])
        for (*_, row, _), i, spans in later:
            for (s, e), (keep, _) in zip(spans, kept):
                mine = (first[:4], keep, len(found), keep_id)
                best[row, i, s, e] = min(best.get((row, i, s, e), mine), mine, key=lambda x: x[:3])
    return [(*k, keep_id, keep, n) for k, (_, keep, n, keep_id) in best.items()]


def lying(df):
    """(id, text) of the rows."""
    return [(r.doc_id, r.text) for r in df.collect()]


def rows_of(df, min_words):
    return sorted(((r.doc_id, r.start, r.end, r.keep_doc_id, r.keep_start, r.group_size) for r in U.repeated_units(df, min_words).collect()), key=str)


def test_units_cover_the_text():
    for t in ["", "\n", "a. b", "One two. Three!\nFour?  Five\n\n", "no end", "3.14 is. not", prose(1, 200)]:
        spans = U.unit_spans(t)
        assert "".join(t[s:e] for s, e in spans) == t
    assert [("One two. Three!\nFour"[s:e]) for s, e in U.unit_spans("One two. Three!\nFour")] == ["One two. ", "Three!\n", "Four"]


def test_normal_form():
    assert U.normalised("  The  QUICK\tfox. \n") == (b"the quick fox", 3) == U.normalised("the quick, fox".replace(",", "") + "!")


def test_passage_inside_lines_is_found_with_offsets(docs):
    passage = "Alpha beta gamma delta epsilon zeta. Eta theta iota kappa lambda mu nu. Xi omicron pi rho sigma tau."
    a, b = f"start here {passage} and on", f"{prose(3, 30)}\nlead words. {passage} tail"
    rows = U.repeated_units(docs([(1, a), (2, b), (3, prose(9, 80))]), 5).collect()
    assert {r.doc_id for r in rows} == {2} and {r.keep_doc_id for r in rows} == {1}
    assert all(U.normalised(b[r.start:r.end]) == U.normalised(a[r.keep_start:r.keep_start + r.end - r.start]) for r in rows)
    assert "Eta theta" in "".join(b[r.start:r.end] for r in rows)


@pytest.mark.parametrize("min_words", [1, 5, U.MIN_WORDS])
def test_corner_cases(corner, docs, min_words):
    df, _ = corner
    assert rows_of(df, min_words) == sorted((x[1:] for x in plain(lying(df), min_words)), key=str)


def test_empty_table(docs):
    assert U.repeated_units(docs([])).count() == 0 and U.drop_repeated_units(docs([])).count() == 0


@pytest.mark.parametrize("min_words", [1, 4, U.MIN_WORDS])
def test_short_and_long_units_mixed(docs, min_words):
    r = random.Random(8)
    kinds = [" ".join(prose(100 + k, r.choice((1, 2, 3, 5, 8, 14))).replace(".", "").split()) for k in range(12)]
    pairs = [(r.choice((None, *range(9))), "\n".join(r.choice(kinds) for _ in range(r.randint(0, 25)))) for _ in range(60)]
    pairs += [(3, "\n".join([kinds[0]] * 40)), (2, "\n\n--\n".join(kinds)), (2, "\n".join(kinds))]
    df = docs(pairs)
    assert rows_of(df, min_words) == sorted((x[1:] for x in plain(lying(df), min_words)), key=str)


def test_long_documents_cross_batches(docs, monkeypatch):
    monkeypatch.setattr(U, "STEP_ROWS", 50)
    long = "\n".join(prose(k, 3).replace(".", "") for k in range(700))
    pairs = [(i, long if i % 3 else f"own {i}\n{long}") for i in range(5)] + [(9, prose(77, 40))]
    df = docs(pairs)
    assert rows_of(df, 10) == sorted((x[1:] for x in plain(lying(df), 10)), key=str)


def test_equal_rows_and_ids(docs):
    b = f"{prose(5, 14)}\n{prose(6, 15)}"
    a = f"{prose(7, 20)}\n{prose(5, 14)}"
    for pairs in ([(3, b), (3, b)], [(5, a), (5, b), (None, b), (None, b)]):
        df, got = docs(pairs), {}
        pairs = lying(df)
        for r in U.drop_repeated_units(df).collect():
            got.setdefault(r.doc_id, []).append(r.text)
        gone = defaultdict(list)
        for row, _, s, e, *_ in plain(pairs, U.MIN_WORDS):
            gone[row].append((s, e))
        want = {}
        for row, (i, t) in enumerate(pairs):
            want.setdefault(i, []).append(U.without(t, gone[row]))
        assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
        assert "" in got[sorted(pairs, key=lambda p: p[0] is None)[-1][0]]  # nothing of the last row is new


def test_one_line_in_every_document(docs):
    line = "this very line stands in every document"
    pairs = [(i, f"{line}\n{prose(i, 30)}") for i in range(300)]
    df = docs(pairs)
    assert rows_of(df, 5) == sorted((x[1:] for x in plain(lying(df), 5)), key=str)
    rows = U.repeated_units(df, 5).collect()
    assert {r.doc_id for r in rows if r.group_size == 300} == set(range(1, 300))


def test_cleaned_texts(corner):
    df, _ = corner
    pairs = lying(df)
    gone = defaultdict(list)
    for row, _, s, e, *_ in plain(pairs, 5):
        gone[row].append((s, e))
    got = sorted(((r.doc_id, r.text) for r in U.drop_repeated_units(df, 5).collect()), key=str)
    assert got == sorted(((i, U.without(t or "", gone[row])) for row, (i, t) in enumerate(pairs)), key=str)


def test_short_units_stay(docs):
    short, long = "a line of six words only", "a line of more than a dozen words, which stands in two documents"
    rows = U.repeated_units(docs([(1, f"{short}\n{long}"), (2, f"x\n{long}\n{short}")])).collect()
    assert [(r.doc_id, r.words) for r in rows] == [(2, 13)]


def test_passage_of_short_lines_goes_whole(docs):
    words = prose(7, 90).replace(".", "").split()
    verse = "".join(" ".join(words[k:k + 5]) + "\n" for k in range(0, 90, 5))
    long = "here follows one line with rather more than a dozen words in it\n"
    a, b = f"first its own heading\n{verse}\n{long}so it ends.\n", f"another one\nand more\n{verse}{long}so it ends.\nnot this\n"
    df = docs([(1, a), (2, b), (3, "so it ends.\nelsewhere")])
    rows = U.repeated_units(df).collect()
    assert {r.doc_id for r in rows} == {2} and {r.keep_doc_id for r in rows} == {1}
    assert len({r.start for r in rows}) == len(rows) == 20
    for r in rows:
        form = U.normalised(b[r.start:r.end])[0]
        assert U.normalised(a[r.keep_start:].split("\n")[0])[0] == form
    got = {r.doc_id: r.text for r in U.drop_repeated_units(df).collect()}
    assert got == {1: a, 2: "another one\nand more\nnot this\n", 3: "so it ends.\nelsewhere"}


def test_passages_travel_whole_and_units_are_not_kept(docs):
    """Units are taken apart behind the last exchange, and the table of units is gone."""
    line = "this very line stands in every document and is rather longer than a dozen words"
    df = docs([(i, f"{line}\n{prose(i, 30)}\nfirst short line\nthen one more\nand the last of these three short lines ends here") for i in range(20)])
    root = Path(urlparse(scratch(df.sparkSession, "x")).path).parent
    before = set(root.glob("units-*"))
    found = U.repeated_units(df)
    rows = found.collect()
    assert len(rows) == 4 * 19 and {r.keep_doc_id for r in rows} == {0}
    assert set(root.glob("units-*")) == before
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].split("\n")
    apart = next(k for k, x in enumerate(plan) if "Generate" in x)
    exchanges = [k for k, x in enumerate(plan) if "Exchange " in x]
    assert exchanges and apart < min(exchanges)  # from the result down
    assert [f.dataType.simpleString() for f in found.schema] == ["bigint", "bigint", "bigint", "int", "bigint", "bigint", "bigint"]


def test_half_a_digest_may_be_shared(docs, monkeypatch):
    """Units that only look repeated change nothing."""
    halves = U.halves
    monkeypatch.setattr(U, "halves", lambda digests: (halves(digests)[0] % 2, halves(digests)[1]))
    pairs = [(i % 7, "\n".join(prose(k % 9, 4 + k % 3) for k in range(i, i + 12))) for i in range(12)]
    df = docs(pairs)
    assert rows_of(df, 10) == sorted((x[1:] for x in plain(lying(df), 10)), key=str)


def test_shuffle_files_go_with_the_job_that_wrote_them(docs):
    """Disk does not hang on when the driver collects garbage."""
    df = docs([(i, prose(i, 30)) for i in range(40)])
    spark = df.sparkSession
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        return {p for d in disk.localDirsString() for p in Path(d).glob("*/shuffle_*.data")}

    before = files()
    back = written(df.repartition(3, "doc_id").groupBy("doc_id").count(), "counts", tidy=True)
    for _ in range(50):
        if files() - before:
            time.sleep(0.1)
    assert not files() - before and back.count() == 40
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
