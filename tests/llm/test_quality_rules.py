import pytest

from weekcast.llm import quality_rules as q

from .conftest import sentence


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def brute_repeat(words):
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    return len({i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)})


@pytest.mark.parametrize("text", ["a b c a b c", "a a a a a", "x y z", "", "a b a b a b q a b a", sentence(4, 90) + " " + sentence(4, 30)])
def test_repeated_windows_against_brute_force(text):
    assert q.measure(text)[q.MEASURES.index("n_repeat_words")] == brute_repeat(text.split())


def test_measurements():
    m = dict(zip(q.MEASURES, q.measure("Éa b\x85c #$\n\nx\n x\nx\n"), strict=True))
    assert (m["n_words"], m["word_chars"], m["n_symbols"], m["n_lines"], m["n_dup_lines"]) == (6, 10, 2, 4, 1)


def test_edges(make_docs, edge_rows):
    ledger = q.build_ledger(make_docs(edge_rows, clashing=True))
    rows = ledger.collect()
    assert len(rows) == len(edge_rows)
    found = by_id(ledger)
    assert found[1]["n_words"] == found[2]["n_words"] == found[3]["n_words"] == 0 and found[1]["failed_bits"] & 1
    assert found[6]["n_words"] == 100_000 and found[6]["n_lines"] == 2500
    assert sum(r["doc_id"] == 5 for r in rows) == 2
    assert q.build_ledger(make_docs([])).collect() == []


def test_policies_and_ablation(make_docs):
    clean, loud = sentence(1, 80), sentence(2, 80).upper()
    marked = " ".join(w + "%%%" for w in sentence(3, 80).split())
    ledger = q.build_ledger(make_docs([(1, clean), (2, loud), (3, marked), (4, "short"), (5, marked.upper())]))
    kept = {v: {i for i, r in by_id(q.apply_policy(ledger, names)).items() if r["kept"]} for v, names in q.POLICIES.items()}
    assert kept["base"] == {1, 2, 3, 5} and kept["2024-2"] == {1}
    table = {(r["policy"], r["rule"]): r for r in q.ablation(ledger).collect()}
    symbols = table["2024-2", "symbols"]
    assert (symbols["n_failed"], symbols["n_only"], symbols["n_rejected"], symbols["n_docs"]) == (2, 1, 4, 5)
    with pytest.raises(ValueError):
        q.policy_mask(("no such rule",))
    assert q.ablation(q.build_ledger(make_docs([]))).collect() == []


def test_op2_writes_the_ablation_of_the_whole_table(spark, make_docs, tmp_path, monkeypatch):
    monkeypatch.setattr(q, "shared_dir", lambda _, name: str(tmp_path / name))
    make_docs([(i, sentence(i, 80) if i % 3 else "short") for i in range(30)]).write.parquet(str(tmp_path / "documents.parquet"))
    rows = q.op2(spark, str(tmp_path)).collect()
    table = {(r["policy"], r["rule"]): r for r in spark.read.parquet(str(tmp_path / "op2_ablation")).collect()}
    assert set(table) == {(v, r) for v, names in q.POLICIES.items() for r in names}
    assert all(r["n_docs"] == 30 for r in table.values())
    assert table["base", "few_words"]["n_failed"] == 10 and table["base", "few_words"]["n_rejected"] == sum(r["base_failed"] for r in rows)
    assert table["2024-2", "few_words"]["n_rejected"] == sum(not r["kept"] for r in rows)
