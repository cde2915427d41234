"""Schemas, keys and versions of the lake's tables; nothing is inferred from data."""

from __future__ import annotations

from dataclasses import dataclass

#: Raised when derived rows must be built anew in place.
INGEST_VERSION = 1
PARSER_VERSION = "1"
CRAWLER_VERSION = "0.1.0"

#: A manifest line as it stands in a file; source_meta keeps its text byte for byte.
MANIFEST = (
    "capture_id string, crawled_at string, crawler_version string, parser_version string, run_id string, source string, "
    "channel string, source_artifact_id string, parent_url string, fetch_url string, author string, author_id string, "
    "title string, description string, tags array<string>, published_at string, stats map<string,bigint>, source_meta string, "
    "http_status int, content_type string, container string, total_size bigint, needed_bytes bigint, bytes_fetched bigint, "
    "windows array<bigint>, from_tail boolean, payload_kind string, payload_sha256 string, payload_bytes bigint, prefix_sha256 string"
)

NODE = "struct<node_id: string, class_type: string, cnr_id: string, ver: string, aux_id: string, mode: tinyint>"
BINDING = "struct<node_id: string, class_type: string, input: string, binding: string, evidence: string>"
DERIVED = (
    "sha256 string, format string, workflow_id string, canonical_hash string, structural_hash string, node_count bigint, "
    "link_count bigint, group_count bigint, model_edges bigint, frontend_version string, graph_version string, "
    f"nodes array<{NODE}>, bindings array<{BINDING}>, error string"
)


@dataclass(frozen=True)
class TableSpec:
    """A table of the lake: its schema, the key that is unique in it, what makes a row the latest,
    how files are laid out. A change of ``version`` means that it has to be built again."""

    schema: str
    key: tuple[str, ...]
    latest: tuple[str, ...] = ("ingest_version", "manifest_key", "line")
    partition_by: tuple[str, ...] = ()
    sort_by: tuple[str, ...] = ()
    version: int = 1


_STAMP = "ingest_version bigint, manifest_key string, line bigint"

TABLES = {
    "raw_artifacts": TableSpec(
        "capture_id string, crawled_at timestamp, crawler_version string, source string, channel string, source_artifact_id string, "
        "parent_url string, fetch_url string, author string, author_id string, title string, description string, tags array<string>, "
        "published_at timestamp, stats map<string,bigint>, source_meta string, http_status int, content_type string, container string, "
        "total_size bigint, bytes_fetched bigint, needed_bytes bigint, windows array<bigint>, from_tail boolean, payload_kind string, "
        f"payload_ref string, payload_bytes bigint, workflow_id string, yyyymm string, {_STAMP}",
        ("source", "source_artifact_id", "channel", "crawled_at", "capture_id"), partition_by=("source", "yyyymm"),
        sort_by=("source_artifact_id", "channel"),
    ),
    "derived_workflows": TableSpec(
        "workflow_id string, canonical_hash string, structural_hash string, format string, node_count bigint, link_count bigint, "
        "group_count bigint, muted_or_bypassed bigint, model_edges bigint, hidden_prompt_nodes bigint, frontend_version string, "
        "graph_version string, stamped_nodes bigint, cnr_nodes bigint, aux_nodes bigint, pack_set array<string>, pack_set_size int, "
        f"first_source string, first_seen timestamp, {_STAMP}",
        ("workflow_id",), sort_by=("workflow_id",),
    ),
    "derived_workflow_nodes": TableSpec(
        "workflow_id string, node_id string, class_type string, is_core boolean, cnr_id string, ver string, aux_id string, mode tinyint, "
        f"packs array<string>, pack_ambiguous boolean, pack_unknown boolean, {_STAMP}",
        ("workflow_id", "node_id"), sort_by=("workflow_id", "node_id"),
    ),
    "derived_workflow_bindings": TableSpec(
        f"workflow_id string, node_id string, class_type string, input string, binding string, evidence string, {_STAMP}",
        ("input", "binding", "class_type", "workflow_id", "node_id"), sort_by=("input", "binding", "class_type"),
    ),
    "derived_artifact_workflows": TableSpec(
        "workflow_id string, source string, source_artifact_id string, channel string, payload_kind string, author string, "
        f"published_at timestamp, {_STAMP}",
        ("workflow_id", "source", "source_artifact_id", "channel", "payload_kind"), sort_by=("workflow_id",),
    ),
    "packs": TableSpec(
        "pack_id string, cnr_id string, repo string, repo_url string, title string, author string, publisher_id string, "
        "description string, downloads bigint, stars bigint, last_update timestamp, created_at timestamp, latest_version string, "
        "in_registry boolean, in_manager boolean",
        ("pack_id",), latest=("last_update",),
    ),
    "pack_versions": TableSpec(
        "pack_id string, version string, published_at timestamp, deprecated boolean, status string, download_url string, "
        "dependencies array<string>, supported_version string",
        ("pack_id", "version"), latest=("published_at",),
    ),
    "pack_nodes": TableSpec(
        "class_type string, pack_id string, repo string, version string, schema_hash string, source string",
        ("class_type", "pack_id", "version"), latest=("schema_hash",),
    ),
}

#: Enumerations that a write checks.
ENUMS = {
    "queue_state": ("pending", "leased", "done", "failed", "skipped"),
    "partition_kind": ("user", "post", "model_version"),
    "blob_kind": ("workflow", "prompt", "prefix"),
}

QUEUE = (
    "source string, artifact_id string, post_id string, author_id string, published_at timestamp, priority int, state string, "
    "lease_until timestamp, attempts int, last_error string"
)
PARTITION = (
    "source string, kind string, key string, cursor string, exhausted boolean, swept_at timestamp, discovered_at timestamp, "
    "pages_read bigint, images_seen bigint, lease_until timestamp, last_error string"
)
