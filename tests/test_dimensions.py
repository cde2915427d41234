import json

import pytest

from graphloom.operators import attribution
from graphloom.sources import dimensions


def test_documents_become_dimensions(spark, tmp_path):
    core, names, packs = (str(tmp_path / n) for n in ("core.json", "map.json", "packs.jsonl"))
    (tmp_path / "core.json").write_text(json.dumps({"class_types": ["A", "B"], "hidden_prompt_class_types": ["B"], "inputs": {"A": ["ckpt_name", "x"]}}, indent=1))
    (tmp_path / "map.json").write_text(json.dumps({"https://h.example/O/R": [["C", "D"], {"title_aux": "t"}], "https://h.example/o/q": [["D"]]}))
    (tmp_path / "packs.jsonl").write_text('{"pack_id": "r", "cnr_id": "r", "repo": "h.example/o/r"}\n\nbroken\n')
    classes, inputs = dimensions.core_document(spark, core)
    assert {tuple(r) for r in classes.collect()} == {("A", False), ("B", True)}
    assert dimensions.declared_inputs(inputs) == {"A": ["ckpt_name", "x"]}
    repos = attribution.repo_packs(dimensions.pack_lines(spark, packs))
    named = {r["class_type"]: r["named_packs"] for r in attribution.class_packs(dimensions.name_map(spark, names), repos).collect()}
    assert named == {"C": ["r"], "D": ["https://h.example/o/q", "r"]}


def test_core_document_without_classes_is_an_error(spark, tmp_path):
    (tmp_path / "core.json").write_text("{}")
    with pytest.raises(ValueError):
        dimensions.core_document(spark, str(tmp_path / "core.json"))
