"""Route patterns such as /<int:id>/update: matching paths and building URLs."""

import re
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

_PLACEHOLDER = re.compile(r"<(?:(?P<kind>\w+):)?(?P<name>\w+)>")

# What each kind of placeholder accepts.
KINDS = {
    "int": r"\d+",
    "string": r"[^/]+",
    "path": r"[^/].*?",
}


def placeholders(pattern: str) -> list[tuple[str, str]]:
    """(name, kind) of each placeholder, left to right."""
    return [(m["name"], m["kind"] or "string") for m in _PLACEHOLDER.finditer(pattern)]


def path_regex(pattern: str) -> str:
    """The regular expression a whole path must match."""
    out, end = "", 0
    for m in _PLACEHOLDER.finditer(pattern):
        out += re.escape(pattern[end : m.start()]) + f"({KINDS[m['kind'] or 'string']})"
        end = m.end()
    return f"^{out}{re.escape(pattern[end:])}\\z"


def path_params(path: Column, pattern: str) -> Column:
    """Struct of the typed parts of `path`; every part is NULL where it does not match."""
    regex = path_regex(pattern)
    parts = []
    for position, (name, kind) in enumerate(placeholders(pattern), start=1):
        part = F.nullif(F.regexp_extract(path, regex, position), F.lit(""))
        parts.append((part.try_cast("bigint") if kind == "int" else part).alias(name))
    return F.struct(*parts)


def quote(text: Column) -> Column:
    """Percent-encode everything but the unreserved characters of RFC 3986."""
    encoded = F.url_encode(text)
    for found, wanted in (("+", "%20"), ("*", "%2A"), ("%7E", "~")):
        encoded = F.replace(encoded, F.lit(found), F.lit(wanted))
    return encoded


def build_url(pattern: str, params: Mapping[str, Column]) -> Column:
    """URL of a route: placeholders are filled in, other values go to the query part.

    A query value that is NULL is left out; a NULL path part makes the URL NULL.
    """
    names = [name for name, _ in placeholders(pattern)]
    if missing := set(names) - set(params):
        raise ValueError(f"no value for {sorted(missing)}")
    pieces, end = [], 0
    for m in _PLACEHOLDER.finditer(pattern):
        part = quote(params[m["name"]].cast("string"))
        if m["kind"] == "path":
            part = F.replace(part, F.lit("%2F"), F.lit("/"))
        pieces += [F.lit(pattern[end : m.start()]), part]
        end = m.end()
    pieces.append(F.lit(pattern[end:]))
    query = F.concat_ws(
        "&",
        *[
            F.concat(quote(F.lit(name)), F.lit("="), quote(value.cast("string")))
            for name, value in params.items()
            if name not in names
        ],
    )
    return F.concat(*pieces, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))
