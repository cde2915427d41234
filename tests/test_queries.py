import pytest

from graphloom.plans import catalog, jobs, problems

CASES = [(m, n) for m in (catalog, jobs, problems) for n in m.QUERIES if n != "lake_workflows"]


@pytest.mark.parametrize("module,name", CASES, ids=[n for _, n in CASES])
def test_query_agrees_with_its_sql(same, module, name):
    same(module, name)


def test_entry_point():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert {"p2_found", "p3_found", "p4_found"} <= set(entry.queries())


def test_core_does_not_import_the_optional_part():
    from pathlib import Path

    import graphloom

    root = Path(graphloom.__file__).parent
    for file in root.rglob("*.py"):
        if "llm" not in file.relative_to(root).parts:
            assert "graphloom.llm" not in file.read_text(), file
