"""The driver's entry points work with and without the text operators."""

from __future__ import annotations

import importlib
import sys

import pytest

from checks.oracle import ORACLE
from checks.queries import QUERIES


def fresh_entry(monkeypatch):
    monkeypatch.delitem(sys.modules, "__spark_entry__", raising=False)
    return importlib.import_module("__spark_entry__")


def test_queries_without_the_text_operators(monkeypatch):
    for name in list(sys.modules):
        if name.startswith(("stayline.llm", "corpus_pipeline")):
            monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "stayline.llm", None)
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    entry = fresh_entry(monkeypatch)
    assert set(entry.queries()) == set(QUERIES)
    assert set(entry.oracle_sql()) == set(ORACLE)


def test_other_missing_modules_are_not_hidden(monkeypatch):
    monkeypatch.setitem(sys.modules, "checks.queries", None)
    with pytest.raises(ModuleNotFoundError):
        fresh_entry(monkeypatch)


def test_every_oracle_has_a_query(monkeypatch):
    entry = fresh_entry(monkeypatch)
    assert set(entry.oracle_sql()) <= set(entry.queries())
