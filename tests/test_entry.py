import importlib

import __spark_entry__


def test_queries_without_what_cannot_be_imported(monkeypatch):
    whole = importlib.import_module

    def broken(name, *rest):
        if name.startswith("retrograph.llm"):
            raise ImportError(name)
        return whole(name, *rest)

    monkeypatch.setattr(importlib, "import_module", broken)
    names, sql = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert "reverse_pairs_es_en" in names and "pipeline" not in names
    assert not any(n.startswith("op") for n in names)
    assert set(sql) <= set(names)
