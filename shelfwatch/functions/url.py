"""URL checks, normalisation and resolution as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwatch.functions.text import SPACE_CLASS, blank_to_null, strip

_HTTP_URL = rf"(?iU)\Ahttps?://[^{SPACE_CLASS}]+\z"


def is_http_url(url: Column) -> Column:
    """True for an http(s) URL without white space; strip it first."""
    return F.coalesce(url.rlike(_HTTP_URL), F.lit(False))


def page_key(url: Column) -> Column:
    """The URL without its fragment: two URLs with one key are one page."""
    return F.substring_index(url, "#", 1)


def clean_url(url: Column) -> Column:
    """Stripped, fragment-less URL; an empty one is null."""
    return blank_to_null(page_key(strip(url)))


_PARTS = r"(?s)^(?:([a-zA-Z][a-zA-Z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


class _Parts:
    """Scheme, authority, path, query and fragment of a URL, and which are there."""

    def __init__(self, url: Column):
        self.scheme, self.authority, self.path, self.query, self.fragment = (
            F.regexp_extract(url, _PARTS, k) for k in range(1, 6)
        )
        self.has_authority = url.rlike(r"(?s)^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//")


def _without_dots(steps: Column) -> Column:
    """Path steps with ``.`` dropped and ``..`` taking the step before it along."""
    walked = F.aggregate(
        steps,
        F.array().cast("array<string>"),
        lambda done, step: F.when(step == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))))
        .when(step == ".", done)
        .otherwise(F.concat(done, F.array(step))),
    )
    closed = F.when(
        F.element_at(steps, -1).isin(".", ".."), F.concat(walked, F.array(F.lit("")))
    ).otherwise(walked)
    path = F.array_join(closed, "/")
    return F.when(path == "", "/").otherwise(path)


def resolve_url(base: Column, href: Column) -> Column:
    """Absolute form of *href* on page *base*, null if either is null.

    For web addresses: a path without a slash in front starts from the directory of
    the base, empty steps inside it are dropped, and a reference that is empty but
    for its fragment keeps the query of the base.
    """
    old, new = _Parts(base), _Parts(href)
    other_scheme = (new.scheme != "") & (F.lower(new.scheme) != F.lower(old.scheme))
    folder = F.split(F.regexp_replace(old.path, "[^/]*$", ""), "/")
    joined = F.concat(F.slice(folder, 1, F.greatest(F.size(folder) - 1, F.lit(0))), F.split(new.path, "/"))
    inside = F.filter(
        joined, lambda step, i: (step != "") | (i == 0) | (i == F.size(joined) - 1)
    )
    steps = F.when(new.path.startswith("/"), F.split(new.path, "/")).otherwise(inside)
    path = F.when(new.path == "", old.path).otherwise(_without_dots(steps))
    path = F.when(old.has_authority & path.rlike("^[^/]"), F.concat(F.lit("/"), path)).otherwise(path)
    query = F.when((new.path == "") & (new.query == ""), old.query).otherwise(new.query)
    resolved = F.concat(
        F.lower(old.scheme),
        F.when(old.scheme != "", ":").otherwise(""),
        F.when(old.has_authority, F.concat(F.lit("//"), old.authority)).otherwise(""),
        path,
        F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""),
        F.when(new.fragment != "", F.concat(F.lit("#"), new.fragment)).otherwise(""),
    )
    with_host = F.concat(
        F.lower(old.scheme), F.lit("://"), F.regexp_replace(href, "^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//", "")
    )
    return (
        F.when(base.isNull() | href.isNull(), F.lit(None))
        .when(href == "", base)
        .when(base == "", href)
        .when(other_scheme, href)
        .when(new.has_authority, with_host)
        .otherwise(resolved)
    )
