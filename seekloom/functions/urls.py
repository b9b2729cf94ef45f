"""URL functions and link predicates as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from seekloom import fixed_values as fv

_IPV4 = r"^(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)$"
_IPV4_TAIL = r"(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)$"
_IPV6_GROUP = r"^[0-9A-Fa-f]{1,4}$"


def domain(url: Column) -> Column:
    """The network location with port and user; empty when there is none."""
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1)


def base_url(url: Column) -> Column:
    """``scheme://authority``."""
    scheme = F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1))
    return F.concat(scheme, F.lit("://"), domain(url))


def url_path(url: Column) -> Column:
    """Path and query of a URL, at least ``/``."""
    rest = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^#]*)", 1)
    return F.when(rest.startswith("/"), rest).otherwise(F.concat(F.lit("/"), rest))


def _collapse_dots(path: Column) -> Column:
    """Resolve ``.`` and ``..`` segments of an absolute path."""
    segments = F.split(F.regexp_replace(path, "^/", ""), "/")
    kept = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda acc, s: F.when(s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
        .when(s == ".", acc)
        .otherwise(F.concat(acc, F.array(s))),
        # A path that ends in a dot segment names a folder.
        lambda acc: F.concat(
            F.array_join(acc, "/"), F.when(path.rlike(r"/\.\.?$") & (F.size(acc) > 0), "/").otherwise("")
        ),
    )
    return F.concat(F.lit("/"), kept)


def resolve_link(base: Column, link: Column) -> Column:
    """Full URL of a link.

    Links that start with ``/`` or ``../`` are resolved against the base URL, not
    the page's own path; ``//host/x`` takes the scheme only. Others stay as they are.
    """
    scheme = F.regexp_extract(base, r"^([^:]+):", 1)
    path = F.regexp_extract(link, r"^/*([^?]*)", 1)
    rooted = F.concat(F.lit("/"), path)
    query = F.regexp_extract(link, r"^[^?]*(\?.+)$", 1)
    resolved = F.when(link.rlike(r"^[^?]*/\.\.?(?:[/?]|$)|^\.\./"), _collapse_dots(rooted)).otherwise(rooted)
    return (
        F.when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when(link.startswith("/") | link.startswith("../"), F.concat(base, resolved, query))
        .otherwise(link)
    )


def is_fragment(link: Column) -> Column:
    return link.startswith("#")


def strip_fragment(link: Column) -> Column:
    return F.substring_index(link, "#", 1)


def is_eligible(link: Column, suffixes: tuple[str, ...] = fv.FILE_SUFFIXES) -> Column:
    """Not mail, not a phone number, not a file, and ``http``-like."""
    return has_http_scheme(link) & ~link.rlike(r"\.(?:" + "|".join(suffixes) + r")\z")


def has_http_scheme(url: Column) -> Column:
    return url.startswith("http")


def is_blocked(url: Column, domains: tuple[str, ...] = fv.BLOCKED_DOMAINS) -> Column:
    """Whether the URL holds any of the domains, anywhere."""
    blocked = F.lit(False)
    for name in domains:
        blocked = blocked | F.contains(url, F.lit(name))
    return blocked


def is_valid_ip(address: Column) -> Column:
    """Whether the text is an IPv4 or IPv6 address."""
    bare = F.regexp_replace(address, r"%[^%]+\z", "")
    # An IPv4 tail stands for two groups of four hex digits.
    groups_text = F.regexp_replace(bare, _IPV4_TAIL, "0:0")
    halves = F.split(groups_text, "::", -1)
    groups = F.flatten(F.transform(halves, lambda h: F.when(h == "", F.array().cast("array<string>")).otherwise(F.split(h, ":", -1))))
    ipv6 = (
        bare.contains(":")
        & F.forall(groups, lambda g: g.rlike(_IPV6_GROUP))
        & F.when(F.size(halves) == 1, F.size(groups) == 8).otherwise((F.size(halves) == 2) & (F.size(groups) <= 7))
    )
    return F.coalesce(address.rlike(_IPV4) | ipv6, F.lit(False))


def safe_join(*items: Column) -> Column:
    """Items joined by a space; nulls are skipped."""
    return F.concat_ws(" ", *[item.cast("string") for item in items])


def safe_str(item: Column) -> Column:
    return F.coalesce(item.cast("string"), F.lit(""))
