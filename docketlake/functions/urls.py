"""Addresses put together as RFC 3986 has it, with column functions alone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_PARTS = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(//[^/?#]*)?([^?#]*)(\?[^#]*)?(#.*)?$"


def _parts(url: Column) -> list[Column]:
    """Scheme, ``//`` and authority, path, ``?`` and query, ``#`` and fragment; empty where there is none."""
    return [F.regexp_extract(url, _PARTS, i) for i in range(1, 6)]


def without_dots(path: Column) -> Column:
    """A path that begins with a slash, its ``.`` and ``..`` segments resolved; those above the root are dropped."""
    segments = F.split(F.substring(path, 2, 2**31 - 1), "/")
    step = lambda kept, s: F.when(s == ".", kept).when(s == "..", F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(0)))).otherwise(F.concat(kept, F.array(s)))
    kept = F.aggregate(segments, F.array().cast("array<string>"), step)
    closed = F.when(F.element_at(segments, -1).isin(".", ".."), F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    return F.concat(F.lit("/"), F.array_join(closed, "/"))


def joined_url(base: Column, reference: Column) -> Column:
    """U-3: a reference as seen from a page; null where either is. The base must be absolute."""
    scheme, authority, path, query, _ = _parts(base)
    own_scheme, own_authority, own_path, own_query, fragment = _parts(reference)
    rooted = lambda p: F.when(F.startswith(p, F.lit("/")), without_dots(p)).otherwise(p)
    folder = F.when((path == "") & (authority != ""), F.lit("/")).otherwise(F.regexp_extract(path, r"(?s)^(.*/)", 1))
    whole = own_scheme != ""
    far = whole | (own_authority != "")
    new_path = (
        F.when(far, rooted(own_path))
        .when(own_path == "", path)
        .when(F.startswith(own_path, F.lit("/")), without_dots(own_path))
        .otherwise(rooted(F.concat(folder, own_path)))
    )
    new_query = F.when(far | (own_path != "") | (own_query != ""), own_query).otherwise(query)
    return F.concat(F.when(whole, own_scheme).otherwise(scheme), F.lit(":"), F.when(far, own_authority).otherwise(authority), new_path, new_query, fragment)
