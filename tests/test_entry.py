import pathlib

import pytest

SF = "/root/testdata/sf0.001"


def test_queries_and_sql_match():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())


@pytest.mark.skipif(not pathlib.Path(SF).exists(), reason="no test data")
def test_entry_runs(spark):
    import __spark_entry__ as e

    assert e.entry(spark).columns == ["page_id", "segments", "chars"] and e.entry(spark).count() > 0


def test_nothing_else_needs_the_corpus_subpackage():
    root = pathlib.Path(__file__).parents[1]
    for p in root.glob("quern/**/*.py"):
        if "llm" not in p.parts:
            assert "quern.llm" not in p.read_text()
