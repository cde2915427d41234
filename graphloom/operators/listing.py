"""Listing items: projections and the decision what is worth fetching."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The tool that marks a graph's image, the file types that never carry one, and
#: the share of those that is read all the same.
GRAPH_TOOL = 86
BARREN = (".jpg", ".jpeg")
CANARY_SHARE = 0.02


def wanted(tool_ids: Column, has_meta: Column, mode: str) -> Column:
    """``all``; ``tagged``: marked by the tool; ``complete``: marked or with generation data."""
    marked = F.coalesce(F.array_contains(tool_ids, GRAPH_TOOL), F.lit(False))
    return {"all": F.lit(True), "tagged": marked, "complete": marked | F.coalesce(has_meta, F.lit(False))}[mode]


def worth_fetching(url: Column, share: float = CANARY_SHARE) -> Column:
    """False for barren file types but for a stable sample: URLs whose SHA-256 begins with a byte
    under 256 times the share. A null URL is not worth it."""
    path = F.lower(F.coalesce(F.try_parse_url(url, F.lit("PATH")), url))
    barren = F.lit(False)
    for ending in BARREN:
        barren = barren | path.endswith(ending)
    first = F.conv(F.substring(F.sha2(url, 256), 1, 2), 16, 10).cast("int")
    return F.coalesce(~barren | (first < 256 * share), F.lit(False))


def absolute_url(url: Column, name: Column, template: str) -> Column:
    """A full URL as it is; a bare id in the template's ``{id}`` and ``{name}``; null for none."""
    before, after = template.split("{id}")
    middle, end = after.split("{name}")
    file = F.coalesce(name, F.concat(url, F.lit(".png")))
    return F.when(F.coalesce(url, F.lit("")) == "", F.lit(None)).when(url.startswith("http"), url).otherwise(
        F.concat(F.lit(before), url, F.lit(middle), file, F.lit(end))
    )
