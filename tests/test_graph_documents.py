import copy
import hashlib
import json

import pytest

from graphloom.functions import devalue
from graphloom.functions.graph import carries_model, derive, identity, loader_bindings, read_graph, shape, strict_shape

CANVAS = {
    "version": 1, "extra": {"frontendVersion": "2.0.1", "ds": {"scale": 1}}, "groups": [{"title": "left"}, {"title": "right"}],
    "links": [
        [11, 20, 0, 30, 0, "MODEL"], [12, 30, 0, 40, 1, "LATENT"], {"id": 13, "origin_id": 10, "origin_slot": 0, "target_id": 30, "target_slot": 2, "type": ["MODEL", "VAE"]},
    ],
    "nodes": [
        {"id": 40, "type": "Saver", "mode": 2, "properties": {"aux_id": "maker/tools", "cnr_id": "tool-pack", "ver": "7"}, "widgets_values": {"name": "out"}, "size": [5, 5]},
        {"id": 30, "type": "Mixer", "mode": 0, "inputs": [{"name": "vae_name", "link": 13, "widget": {"name": "vae_name"}}, {"name": "image", "link": None}]},
        {"id": 20, "type": "Opener", "properties": {"cnr_id": "comfy-core"}, "widgets_values": ["base.bin", 0.5]},
        {"id": 10, "type": "Opener", "widgets_values": ["extra.bin", 1]},
    ],
}
PROMPT = {
    "4": {"class_type": "Loader", "inputs": {"ckpt_name": "m.ckpt"}},
    "5": {"class_type": "Sampler", "inputs": {"model": ["4", 0], "seed": 7, "lora_name": ["4", 1], "list": [1, 2, 3]}},
}


def test_canvas_document():
    got = derive(CANVAS, {"Opener": ["ckpt_name", "other"], "Mixer": ["vae_name"]})
    assert (got["format"], got["node_count"], got["link_count"], got["group_count"], got["model_edges"]) == ("save", 4, 3, 2, 2)
    assert (got["frontend_version"], got["graph_version"]) == ("2.0.1", "1")
    assert [n["mode"] for n in got["nodes"]] == [2, 0, 0, 0] and got["nodes"][0]["aux_id"] == "maker/tools"
    assert [(b["node_id"], b["input"], b["binding"], b["evidence"]) for b in got["bindings"]] == [
        ("30", "vae_name", "link", "save.inputs"), ("20", "ckpt_name", "literal", "save.widget"), ("10", "ckpt_name", "literal", "save.widget"),
    ]


def test_prompt_document():
    got = derive(PROMPT)
    assert (got["format"], got["node_count"], got["link_count"], got["model_edges"]) == ("api", 2, 2, 1)
    assert {(b["node_id"], b["input"], b["binding"]) for b in got["bindings"]} == {("4", "ckpt_name", "literal"), ("5", "lora_name", "link")}


def test_identity_texts_are_exact():
    compact = json.dumps(CANVAS, sort_keys=True, separators=(",", ":"))
    assert derive(CANVAS)["workflow_id"] == hashlib.sha256(compact.encode()).hexdigest()
    # by class, then by values: Mixer 0, the openers 1 and 2, Saver 3; edges name these places
    nodes = [["Mixer", "null"], ["Opener", '["base.bin", 0.5]'], ["Opener", '["extra.bin", 1]'], ["Saver", '{"name": "out"}']]
    form = {"e": [[0, 0, 3, 1, "LATENT"], [1, 0, 0, 0, "MODEL"], [2, 0, 0, 2, ["MODEL", "VAE"]]], "n": nodes}
    assert identity(read_graph(CANVAS), True) == hashlib.sha256(json.dumps(form, separators=(",", ":")).encode()).hexdigest()
    # without values the two openers are ranked as they stand in the document: 20 before 10
    bare = {"e": form["e"], "n": [[n[0], ""] for n in nodes]}
    assert identity(read_graph(CANVAS), False) == hashlib.sha256(json.dumps(bare, separators=(",", ":")).encode()).hexdigest()
    api = {"e": [[0, 0, 1, "model"], [0, 1, 1, "lora_name"]], "n": [["Loader", '{"ckpt_name": "m.ckpt"}'], ["Sampler", '{"seed": 7}']]}
    assert identity(read_graph(PROMPT), True) == hashlib.sha256(json.dumps(api, separators=(",", ":")).encode()).hexdigest()


def test_identities_ignore_what_a_copy_changes():
    moved = copy.deepcopy(CANVAS)
    for node in moved["nodes"]:
        node["id"] += 100
        node["pos"] = [9, 9]
    for link in moved["links"]:
        if isinstance(link, list):
            link[1], link[3] = link[1] + 100, link[3] + 100
        else:
            link["origin_id"], link["target_id"] = link["origin_id"] + 100, link["target_id"] + 100
    moved["nodes"] = [moved["nodes"][at] for at in (1, 0, 2, 3)]
    a, b = derive(CANVAS), derive(moved)
    assert a["canonical_hash"] == b["canonical_hash"] and a["workflow_id"] != b["workflow_id"]
    moved["nodes"][1]["widgets_values"] = [1]
    c = derive(moved)
    assert c["canonical_hash"] != a["canonical_hash"] and c["structural_hash"] == a["structural_hash"]


@pytest.mark.parametrize("edge,yes", [(["MODEL", "CLIP"], True), ("MODEL", True), (["CONDITIONING"], False), (None, False), ([["MODEL"]], False)])
def test_model_edges(edge, yes):
    assert carries_model(edge) is yes


def test_two_loaders_of_one_class_stay_two():
    node = {"type": "L", "inputs": [{"name": "vae_name", "link": None}]}
    graph = read_graph({"nodes": [node | {"id": 1}, node | {"id": 2}], "links": [{"origin_id": 1, "target_id": 2, "type": "MODEL"}, "junk"]})
    assert [b[0] for b in loader_bindings(graph)] == ["1", "2"] and graph.model_edges == 1


def test_shapes():
    assert [shape(x) for x in ({"a": 1}, [], None, {"nodes": 3}, {"nodes": []})] == ["unknown", "unknown", "unknown", "unknown", "save"]
    mixed = {"1": {"class_type": "A"}, "2": {}}
    assert (shape(mixed), strict_shape(mixed)) == ("api", "unknown")
    assert strict_shape(PROMPT) == "api"


def test_bad_documents_give_an_error():
    for bad in ({"a": 1}, [], None, {"nodes": [{"id": [1], "type": "A"}]}, {"nodes": [{"id": 1, "properties": "x"}]}, {"1": {"class_type": "A", "inputs": [1]}}):
        got = derive(bad)
        assert got["format"] == "unknown" and got["error"]


def test_devalue_round_trip_and_references():
    value = {"a": [1, 1, {"b": None}], "c": "x", "d": True, "e": []}
    assert devalue.decode(devalue.encode(value)) == value
    assert devalue.decode("[[1,1,-1,-2],{\"k\":2},5]") == [{"k": 5}, {"k": 5}, None, None]
    circular = devalue.decode("[[0]]")
    assert circular[0] is circular
    assert str(devalue.decode("[[-3,-4,-5,-6]]")) == "[nan, inf, -inf, -0.0]"
    assert devalue.decode('{"a":1}') == {"a": 1}
    deep: list = []
    for _ in range(50_000):
        deep = [deep]
    flat = [[i + 1] for i in range(50_000)] + [[]]
    assert isinstance(devalue.decode(flat), list)
    assert devalue.route_result('{"result":{"data":{"json":3}}}') == 3
    assert [devalue.unwrap_date(v) for v in (["Date", "x"], "y", ["D", "x"], None, 3)] == ["x", "y", None, None, None]
