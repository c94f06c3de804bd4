"""Keys and addresses read from result-page URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from racelake.functions.text import null_if_blank


def race_id(url: Column) -> Column:
    """The number after ``/races/``, null when the URL has none."""
    return F.regexp_extract(url, r"/races/(\d+)(?:/|$)", 1).try_cast("int")


def event_slug(url: Column) -> Column:
    """The segment after the race number."""
    return null_if_blank(F.regexp_extract(url, r"/races/\d+/([^/]+)/", 1))


def parent_slug(url: Column) -> Column:
    """The last segment but one."""
    return F.try_element_at(F.split(F.rtrim(url, F.lit("/")), "/"), F.lit(-2))


def session_url(race_url: Column, session: Column | str) -> Column:
    """The race's page for another session: its last segment replaced, null for an empty URL."""
    session = F.lit(session) if isinstance(session, str) else session
    return session_of(race_url, session_base(race_url), session)


def session_base(race_url: Column) -> Column:
    """The race's page without its last segment."""
    return F.regexp_replace(race_url, r"/[^/]*$", "")


def session_of(race_url: Column, base: Column, session: Column) -> Column:
    """The page of a session, from the base that all sessions of the race share."""
    return F.when(race_url != "", F.concat(base, F.lit("/"), session))


def practice_url(race_url: Column, number: int) -> Column:
    if number not in (1, 2, 3):
        raise ValueError("a race weekend has practices 1, 2 and 3")
    return session_url(race_url, f"practice/{number}")


def origin(url: Column) -> Column:
    """Scheme and host."""
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", 0)


def _resolved(url: Column) -> Column:
    """An absolute URL without ``.`` and ``..`` segments in its path."""
    path = F.regexp_replace(F.substring(url, F.length(origin(url)) + 1, F.length(url)), r"[?#].*$", "")
    rest = F.substring(url, F.length(origin(url)) + F.length(path) + 1, F.length(url))
    segments = F.split(path, "/", -1)
    none = F.array().cast("array<string>")

    def step(done: Column, segment: Column) -> Column:
        # the first segment is the empty one ahead of the leading slash
        up = F.when(F.size(done) > 1, F.slice(done, F.lit(1), F.size(done) - 1)).otherwise(done)
        return F.when(segment == "..", up).when(segment == ".", done).otherwise(F.concat(done, F.array(segment)))

    walked = F.array_join(F.aggregate(segments, none, step), "/")
    # a path that ends in a dot segment names a folder
    folder = F.when(F.element_at(segments, -1).isin(".", ".."), F.lit("/")).otherwise("")
    return F.when(path.rlike(r"/\.\.?(/|$)"), F.concat(origin(url), walked, folder, rest)).otherwise(url)


def absolute(page_url: Column, href: Column) -> Column:
    """A link as an absolute URL, seen from the page it stands on."""
    page = F.regexp_replace(page_url, r"[?#].*$", "")
    has_path = F.length(page) > F.length(origin(page_url))
    folder = F.when(has_path, F.regexp_replace(page, r"/[^/]*$", "/")).otherwise(F.concat(page, F.lit("/")))
    return (
        # most links first, with least work: a path without a segment that begins with a dot
        F.when(href.startswith("/") & ~href.startswith("//") & ~href.contains("/."), F.concat(origin(page_url), href))
        .when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(F.regexp_extract(page_url, r"^[^:]*:", 0), href))
        .when(href.startswith("/"), _resolved(F.concat(origin(page_url), href)))
        .when(href == "", page_url)
        .when(href.startswith("?"), F.concat(page, href))
        .when(href.startswith("#"), F.concat(F.regexp_replace(page_url, r"#.*$", ""), href))
        .otherwise(_resolved(F.concat(folder, href)))
    )


def download_link(url: Column) -> Column:
    """A shared-image link with its query replaced by the download flag."""
    return F.regexp_replace(url, r"\?.*", "?download=1")
