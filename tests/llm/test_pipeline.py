import sys

import pytest

import corpus_pipeline as C
from ringwatch.llm import exact_dedup, packing, pii, quality, simhash
from tests.llm.test_packing import check
from tests.llm.test_simhash import groups
from tests.llm.fixtures import corner, docs, prose  # noqa: F401


def brute(pairs, detector, order):
    """The stages on plain lists."""
    rows = [(i, t) for i, t in pairs if quality.judge(t or "", order)["kept"]]
    best = {}
    for i, t in rows:
        if t not in best or i > best[t]:
            best[t] = i
    rows = [(i, t) for t, i in best.items()]
    fp = {i: simhash.fingerprint(t) for i, t in rows}
    label = groups(fp.values())
    first = {}
    for i, _ in rows:
        k = label[fp[i]]
        first[k] = min(first.get(k, i), i)
    rows = [(i, t) for i, t in rows if first[label[fp[i]]] == i]
    return [(i, pii.redacted(t, (b := pii.base_spans(t)) + detector.added(t, b))) for i, t in rows]


def test_stages_against_brute_force(spark, docs, monkeypatch, tmp_path):
    near = prose(50, 400)
    pairs = [(i, prose(i, 40 + 7 * i % 300)) for i in range(60)]
    pairs += [(100 + i, prose(3, 300)) for i in range(5)] + [(200, near + " one"), (201, near + " two"), (202, near)]
    pairs += [(300, prose(60, 90) + " mail me@host.example.com or +1 (974) 555-3436."), (301, None), (302, ""), (303, prose(61, 90).replace(" ", "$$$ "))]
    df = docs(pairs).select("doc_id", "text", "n_chars")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    detector = pii.Detector(None, {})
    monkeypatch.setattr(pii, "fit", lambda *a, **k: detector)
    want = brute(pairs, detector, list(quality.RULES))
    rows = C.run(spark, str(tmp_path)).collect()
    check(rows, want)
    assert {r.doc_id for r in rows} == {i for i, _ in want} and len(want) < len(pairs) - 8


def test_stages_keep_columns_and_take_the_empty_table(spark, docs):
    for df in (docs([]), docs([(1, None), (2, ""), (None, "x"), (None, None), (3, prose(1, 60)), (3, prose(1, 60))])):
        for name, stage in C.STAGES[:-1]:
            out = stage(spark, df, "")
            assert out.columns == df.columns and out.count() <= df.count(), name
        assert C.STAGES[-1][1](spark, df, "").count() >= df.count()


def test_redaction_updates_the_length(spark, docs):
    out = C.redact_personal_data(spark, docs([(1, "a@b.cd"), (2, None)]), "")
    assert {r.doc_id: (r.text, r.n_chars) for r in out.collect()}[1] == ("[EMAIL]", 7)


def test_entry_lists_every_operator():
    import __spark_entry__ as e
    names = set(e.queries())
    assert "pipeline" in names
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert {"op6_exact_dedup"} <= set(e.oracle_sql())


@pytest.mark.parametrize("gone", ["corpus_pipeline", "ringwatch.llm"])
def test_entry_works_without_the_subpackage(monkeypatch, gone):
    import importlib.util
    import os
    root = os.path.dirname(os.path.abspath(C.__file__))
    for name in [m for m in sys.modules if m == "corpus_pipeline" or m.startswith("ringwatch.llm")]:
        monkeypatch.delitem(sys.modules, name)
    real = importlib.util.find_spec

    class Block:
        def find_spec(self, name, path=None, target=None):
            if name == gone:
                raise ModuleNotFoundError(f"No module named '{name}'", name=name)

    monkeypatch.setattr(sys, "meta_path", [Block(), *sys.meta_path])
    spec = importlib.util.spec_from_file_location("entry_alone", f"{root}/__spark_entry__.py")
    m = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(m)
    assert "q_account_history" in m.queries() and not any(q.startswith("op") for q in m.queries()) and real
