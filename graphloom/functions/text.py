"""Column functions on text. All are null in, null out unless stated."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def strip(column: Column | str) -> Column:
    """Without Unicode white space at either end, line ends included."""
    return F.regexp_replace(_col(column), r"(?U)^\s+|\s+$", "")


def squeeze(column: Column | str) -> Column:
    """Stripped, lower-cased, each inner run of white space one blank."""
    return F.regexp_replace(F.lower(strip(column)), r"(?U)\s+", " ")


def normal_hash(column: Column | str) -> Column:
    """Stripped and lower-cased, without a leading ``sha256:``; null for null or blank."""
    bare = strip(F.regexp_replace(F.lower(strip(column)), r"^sha256:", ""))
    return F.when(bare != "", bare)


def seconds_text(column: Column | str) -> Column:
    """``YYYY-MM-DD HH:MM:SS`` of an ISO time; null if there are fewer than 19 characters.

    The offset, if any, is cut off and not converted.
    """
    text = F.substring(F.replace(F.replace(_col(column), F.lit("T"), F.lit(" ")), F.lit("Z"), F.lit("")), 1, 19)
    return F.when(F.length(text) == 19, text)


def normal_repo(column: Column | str) -> Column:
    """Repository address without scheme, ``www.``, closing slashes and ``.git``, lower-cased;
    '' for null."""
    text = F.rtrim(F.trim(F.coalesce(_col(column), F.lit(""))), F.lit("/"))
    text = F.regexp_replace(text, r"^https?://", "")
    text = F.regexp_replace(text, r"^www\.", "")
    return F.lower(F.regexp_replace(text, r"\.git$", ""))


def total_size(content_range: Column | str, content_length: Column | str, status: Column | str) -> Column:
    """Size of a whole file from its response headers: what stands behind the slash of a range, or
    the length of a full answer; null if neither tells."""
    ranged = F.regexp_extract(F.coalesce(_col(content_range), F.lit("")), r"/(\d+)\s*$", 1)
    whole = F.when(_col(status) == 200, _col(content_length))
    return F.coalesce(F.nullif(ranged, F.lit("")), whole).try_cast("bigint")


def error_text(column: Column | str, limit: int = 500) -> Column:
    """The first ``limit`` characters of an error; null for ''."""
    return F.nullif(F.left(_col(column), F.lit(limit)), F.lit(""))


def host(column: Column | str) -> Column:
    """Host of a URL, without port; null where there is none."""
    return F.try_parse_url(_col(column), F.lit("HOST"))


def blob_key(digest: Column | str, kind: Column | str) -> Column:
    """Object key of a blob: JSON for graphs, binary for byte prefixes."""
    suffix = F.when(_col(kind) == "prefix", F.lit("bin")).otherwise(F.lit("json"))
    return F.concat(F.lit("blob/"), F.substring(_col(digest), 1, 2), F.lit("/"), _col(digest), F.lit("."), suffix, F.lit(".gz"))


def manifest_key(source: Column | str, at: Column | str, run: Column | str, part: Column | str) -> Column:
    """``raw/<source>/<YYYY-MM>/<run>-<part, four digits>.jsonl.gz``."""
    return F.concat(
        F.lit("raw/"), _col(source), F.lit("/"), F.date_format(_col(at), "yyyy-MM"), F.lit("/"), _col(run), F.lit("-"),
        F.lpad(_col(part).cast("string"), 4, "0"), F.lit(".jsonl.gz"),
    )


def backoff_seconds(streak: Column, threshold: int = 3, base: int = 900, cap: int = 86400) -> Column:
    """0 under the threshold, then the base doubled with each further failure, up to the cap."""
    exponent = F.least(F.greatest(streak - threshold, F.lit(0)), F.lit(40)).cast("int")
    return F.when(streak < threshold, F.lit(0).cast("long")).otherwise(
        F.least(F.lit(base).cast("long") * F.pow(F.lit(2.0), exponent).cast("long"), F.lit(cap).cast("long"))
    )
