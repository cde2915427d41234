"""Graph documents of both formats read into one model, and what follows from the model.

``read_graph`` turns a canvas document (nodes, links) or a prompt document (id to class and
inputs) into :class:`Graph`; counts, loader bindings and the three identities are functions of
that model, and pack attribution is left to joins.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass, field
from typing import Any

from graphloom.functions.jsontext import clean

# Results must equal those of the tables already in the lake.
#: Inputs that name a model file.
LOADER_INPUTS = (
    "ckpt_name", "unet_name", "lora_name", "vae_name", "clip_name", "control_net_name", "style_model_name",
    "gguf_name", "model_name", "diffusion_model",
)
#: Classes that the canvas itself provides.
CANVAS_CLASSES = (
    "Note", "MarkdownNote", "Reroute", "PrimitiveNode", "PrimitiveBoolean", "PrimitiveFloat", "PrimitiveInt",
    "PrimitiveString", "PrimitiveStringMultiline",
)
#: Registry name of the built-in nodes; such a stamp attributes nothing.
CORE_STAMP = "comfy-core"
MODEL_TYPE = "MODEL"
MODEL_INPUTS = ("model", "unet")
#: Node modes muted and bypassed.
SILENT_MODES = (2, 4)
COMPACT = (",", ":")


@dataclass
class Node:
    key: Any
    class_type: str
    widgets: Any = None  # what the canonical identity keeps of the values
    outline: str = ""  # what the structural identity keeps
    cnr_id: Any = None
    ver: Any = None
    aux_id: Any = None
    mode: Any = None
    #: (input, fed by a link) of the inputs the document shows
    inputs: list[tuple[str, bool]] = field(default_factory=list)


@dataclass
class Graph:
    format: str
    nodes: list[Node] = field(default_factory=list)
    #: source key, target key, and the function of both ranks that is the edge's identity
    edges: list[tuple[Any, Any, Any]] = field(default_factory=list)
    node_count: int = 0
    link_count: int = 0
    group_count: int = 0
    model_edges: int = 0
    frontend_version: Any = None
    graph_version: Any = None


def shape(doc: Any) -> str:
    """``save``, ``api`` or ``unknown``; a prompt document may hold foreign entries as long as at
    least half of its objects (rounded down, one at least) have a class."""
    if isinstance(doc, dict):
        if isinstance(doc.get("nodes"), list):
            return "save"
        objects = [v for v in doc.values() if isinstance(v, dict)]
        classed = sum("class_type" in v for v in objects)
        if objects and classed >= max(1, len(objects) // 2):
            return "api"
    return "unknown"


def strict_shape(doc: Any) -> str:
    """As :func:`shape`, but every object of a prompt document must have a class."""
    if isinstance(doc, dict):
        if isinstance(doc.get("nodes"), list):
            return "save"
        classed = ["class_type" in v for v in doc.values() if isinstance(v, dict)]
        if classed and all(classed):
            return "api"
    return "unknown"


def carries_model(edge_type: Any) -> bool:
    """Whether an edge type is the model type or a list with it."""
    return edge_type == MODEL_TYPE or isinstance(edge_type, list) and MODEL_TYPE in edge_type


def _canvas_inputs(node: dict) -> list[tuple[str, bool]]:
    shown: dict[str, bool] = {}
    for slot in node.get("inputs") or []:
        if isinstance(slot, dict):
            widget = slot.get("widget")
            name = (widget.get("name") if isinstance(widget, dict) else None) or slot.get("name")
            if isinstance(name, str):
                shown[name] = slot.get("link") is not None
    return list(shown.items())


def _canvas_edge(link: Any) -> tuple | None:
    """(source, source slot, target, target slot, type) of a link of either notation."""
    if isinstance(link, list) and len(link) > 5:
        return tuple(link[1:6])
    if isinstance(link, dict):
        return tuple(link.get(k) for k in ("origin_id", "origin_slot", "target_id", "target_slot", "type"))
    return None


def _read_canvas(doc: dict) -> Graph:
    listed, links = doc.get("nodes") or [], doc.get("links") or []
    graph = Graph(
        "save", node_count=len(listed), link_count=len(links), group_count=len(doc.get("groups") or []),
        frontend_version=(doc.get("extra") or {}).get("frontendVersion"), graph_version=doc.get("version"),
    )
    for item in listed:
        if isinstance(item, dict):
            stamp = item.get("properties") or {}
            graph.nodes.append(Node(
                item.get("id"), item.get("type") or "", json.dumps(item.get("widgets_values"), sort_keys=True),
                cnr_id=stamp.get("cnr_id"), ver=stamp.get("ver"), aux_id=stamp.get("aux_id"), mode=item.get("mode"),
                inputs=_canvas_inputs(item),
            ))
    for link in links:
        edge = _canvas_edge(link)
        if edge is not None:
            source, out_slot, target, in_slot, kind = edge
            graph.model_edges += carries_model(kind)
            graph.edges.append((source, target, lambda a, b, o=out_slot, i=in_slot, k=kind: [a, o, b, i, k]))
    return graph


def _read_prompt(doc: dict) -> Graph:
    graph = Graph("api", node_count=len(doc))
    for key, item in doc.items():
        if not isinstance(item, dict):
            continue
        given = item.get("inputs") or {}
        fixed = {name: value for name, value in given.items() if not isinstance(value, list)}
        graph.nodes.append(Node(
            key, item.get("class_type") or "", json.dumps(fixed, sort_keys=True), json.dumps(sorted(fixed)),
            inputs=[(name, isinstance(value, list) and len(value) == 2) for name, value in given.items()],
        ))
        for name, value in given.items():
            if isinstance(value, list):
                graph.model_edges += name in MODEL_INPUTS
                if len(value) == 2:
                    graph.link_count += 1
                    graph.edges.append((value[0], key, lambda a, b, s=value[1], n=name: [a, s, b, n]))
    return graph


def read_graph(doc: Any) -> Graph | None:
    """The model of a document, None for a document of neither format."""
    kind = shape(doc)
    return _read_canvas(doc) if kind == "save" else _read_prompt(doc) if kind == "api" else None


def digest(value: Any) -> str:
    return hashlib.sha256(json.dumps(value, sort_keys=True, separators=COMPACT, default=str).encode()).hexdigest()


def identity(graph: Graph, keep_values: bool) -> str:
    """Digest of a graph without node ids, layout and order. Nodes are ranked by class and what is
    kept of their values, ties in the order of the document; edges name ranks, -1 for a node
    that is not there."""
    labels = [[n.class_type, n.widgets if keep_values else n.outline] for n in graph.nodes]
    order = sorted(range(len(labels)), key=labels.__getitem__)
    rank = {graph.nodes[at].key: place for place, at in enumerate(order)}

    def place(key: Any) -> int:
        if graph.format == "api" and str(key) in rank:
            return rank[str(key)]
        return rank.get(key, -1)

    edges = sorted((build(place(a), place(b)) for a, b, build in graph.edges), key=json.dumps)
    return digest({"n": [labels[at] for at in order], "e": edges})


def loader_bindings(graph: Graph, declared: dict[str, list[str]] | None = None) -> list[tuple[str, str, str, str, str]]:
    """(node_id, class_type, input, binding, evidence) of each loader input: fed by a link or a
    literal. Canvas documents leave out inputs that hold a literal, so inputs ``declared`` for
    the class and not shown are literals too."""
    rows = []
    for node in graph.nodes:
        shown = [(name, linked) for name, linked in node.inputs if name in LOADER_INPUTS]
        evidence = "api.inputs" if graph.format == "api" else "save.inputs"
        rows += [(str(node.key), node.class_type, name, "link" if linked else "literal", evidence) for name, linked in shown]
        if graph.format == "save":
            missing = set((declared or {}).get(node.class_type, ())) & set(LOADER_INPUTS) - {name for name, _ in shown}
            rows += [
                (str(node.key), node.class_type, name, "literal", "save.widget")
                for name in (declared or {}).get(node.class_type, ()) if name in missing
            ]
    return rows


def text(value: Any) -> str:
    """A stamp or version as text, '' for anything that counts as nothing."""
    return clean(str(value)) if value else ""


def derive(doc: Any, declared: dict[str, list[str]] | None = None) -> dict:
    """All that one document gives, as plain values; ``error`` is set and the rest empty if it is
    of neither format or cannot be read. Never raises."""
    try:
        graph = read_graph(doc)
        if graph is None:
            return {"format": "unknown", "error": "unrecognised graph shape"}
        return {
            "format": graph.format, "workflow_id": digest(doc), "canonical_hash": identity(graph, True),
            "structural_hash": identity(graph, False), "node_count": graph.node_count, "link_count": graph.link_count,
            "group_count": graph.group_count, "model_edges": graph.model_edges,
            "frontend_version": text(graph.frontend_version), "graph_version": text(graph.graph_version),
            "nodes": [
                {
                    "node_id": clean(str(n.key)), "class_type": clean(str(n.class_type)), "cnr_id": text(n.cnr_id), "ver": text(n.ver),
                    "aux_id": text(n.aux_id), "mode": n.mode if isinstance(n.mode, int) and -128 <= n.mode < 128 else 0,
                }
                for n in graph.nodes
            ],
            "bindings": [
                dict(zip(("node_id", "class_type", "input", "binding", "evidence"), map(clean, b), strict=True))
                for b in loader_bindings(graph, declared)
            ],
            "error": None,
        }
    except Exception as problem:  # third-party documents: any shape may come
        return {"format": "unknown", "error": f"{type(problem).__name__}: {problem}"[:500]}
