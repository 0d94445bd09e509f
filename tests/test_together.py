"""Queries that run at the same time in one application, as threads of a server or a notebook do."""

from concurrent.futures import ThreadPoolExecutor
from threading import Event

import pytest
from compare import connect, differences
from test_cluster import tables  # noqa: F401

import __spark_entry__ as registered
from partysieve.catalog import fixtures

QUERIES = (
    "agg_distinct_pairs",
    "agg_distinct",
    "agg_max_by",
    "agg_max_date",
    "audit_log",
    "agg_singletons",
    "blank_to_null",
    "audit_full_run",
    "delete_marked",
    "copy_insured_by_name",
    "fixed_overrides",
    "copy_insured_by_code",
    "fn_case",
    "documents_all",
    "fn_cast",
    "fn_text",
    "fn_null",
    "fn_concat",
    "fn_substr",
    "fn_translate",
)


@pytest.mark.parametrize("name", QUERIES)
def test_one_extract_for_queries_at_the_same_time(spark, tables, tmp_path, monkeypatch, name):  # noqa: F811
    data = tmp_path / "data"  # a path of its own: the extract is written anew
    data.symlink_to(tables)
    first, second, ended, calls = Event(), Event(), Event(), []

    def derived(session, folder, derive=fixtures.derived_extract):
        """The second one that derives, if there is one, is not done before the first query has its frame."""
        calls.append(folder)
        if len(calls) == 1:
            first.set()
            second.wait(1)
        else:
            second.set()
            ended.wait(60)
        return derive(session, folder)

    def one():
        try:
            return registered.QUERIES[name](spark, str(data))
        finally:
            ended.set()

    monkeypatch.setattr(fixtures, "derived_extract", derived)
    with ThreadPoolExecutor(2) as pool:
        early = pool.submit(one)
        assert first.wait(60)
        late = pool.submit(one)
        for out in (early.result(), late.result()):
            assert out.count() and differences(out, connect(str(data)), registered.build()[name]) is None
    assert len(calls) == 1


def test_one_temporary_folder(monkeypatch):
    from partysieve.sources import stages

    class Slow(stages.tempfile.TemporaryDirectory):
        def __init__(self, **options):
            Event().wait(0.2)
            super().__init__(**options)

    monkeypatch.setattr(stages, "_local_root", None)
    monkeypatch.setattr(stages.tempfile, "TemporaryDirectory", Slow)
    with ThreadPoolExecutor(4) as pool:
        found = list(pool.map(lambda _: stages._temporary(), range(4)))
    assert set(found) == {stages._local_root.name}
