"""Scalar functions on domains, URLs, durations and page text, all as native columns."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, functions as F

#: Fixed values.
LOW_COST_TLDS = ["top", "xyz", "info", "biz", "online", "site", "store", "shop", "click", "fun", "bond", "cfd", "icu", "today", "sbs", "live", "pro", "vip", "club", "space", "press", "rocks", "link", "download", "loan", "bid", "one", "gdn", "work", "science", "trade", "party", "win", "stream", "men", "mom", "kim", "xin", "dev", "pictures", "pizza", "poker", "qpon", "tk", "ml", "ga", "cf", "gq", "li", "es", "ru", "cc", "cn", "ai"]
MULTIPART_SUFFIXES = ["co.uk", "ac.uk", "com.br", "com.np", "com.pk", "org.ng", "co.tz", "biz.id"]
HOSTED_SUFFIXES = ["pages.dev", "workers.dev", "onrocket.site", "github.io", "vercel.app", "netlify.app", "herokuapp.com", "readthedocs.io", "cloudfront.net", "azurewebsites.net"]


def _or_false(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def normalize_domain(c: Column) -> Column:
    """Trimmed, lower case, without scheme, path, query, fragment, port and outer dots; userinfo stays."""
    x = F.regexp_replace(F.lower(F.trim(c)), "^[a-z][a-z0-9+.-]*://", "")
    x = F.regexp_extract(x, "^[^/?#]*", 0)
    x = F.when(F.startswith(x, F.lit("[")), x).otherwise(F.substring_index(x, ":", 1))
    return F.trim(x, F.lit("."))


def canonical_domain(c: Column) -> Column:
    return F.regexp_replace(normalize_domain(c), "^www\\.", "")


def domain_variants(c: Column) -> Column:
    d = canonical_domain(c)
    return F.when(d == "", F.array().cast("array<string>")).otherwise(F.array(d, F.concat(F.lit("www."), d)))


def url_host(c: Column) -> Column:
    """Host of a URL with or without scheme: no userinfo, no port, no IPv6 brackets, no trailing dot."""
    x = F.regexp_replace(F.trim(c), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    x = F.regexp_extract(x, "^[^/?#]*", 0)
    x = F.regexp_replace(x, "^[^@]*@", "")
    x = F.regexp_replace(x, "^\\[([^\\]]*)\\]?.*$|:\\d*$", "$1")  # in brackets, or without the port
    return F.rtrim(F.lower(x), F.lit("."))


def ascii_host(host: Column) -> Column:
    """The host with labels beyond ASCII in their IDNA form; one that has no such form stays as it is.

    Only hosts with other characters go to Python; all others stay native.
    """
    @F.pandas_udf("string")
    def idna(hosts: pd.Series) -> pd.Series:
        def one(h):
            try:
                return h.encode("idna").decode("ascii") if h else h
            except UnicodeError:
                return h

        return hosts.map(one)

    odd = host.rlike("[^\\x00-\\x7F]")
    return F.coalesce(idna(F.when(odd, host)), host)


def tld(c: Column) -> Column:
    return F.lower(F.substring_index(F.rtrim(F.trim(c), F.lit(".")), ".", -1))


def tld_poor(c: Column) -> Column:
    return _or_false(tld(c).isin(LOW_COST_TLDS))


def is_ip(host: Column) -> Column:
    octet = "(25[0-5]|2[0-4]\\d|1?\\d?\\d)"
    return host.rlike(f"^{octet}(\\.{octet}){{3}}$|:")


def registered_domain(host: Column, second_level: list[str] | None = None) -> Column:
    """The last two labels, or three under a multi-part suffix (or a listed second-level label); IPs stay."""
    parts = F.split(host, "\\.")
    n = F.size(parts)
    if second_level is None:
        three = F.array_join(F.slice(parts, F.greatest(n - 1, F.lit(1)), 2), ".").isin(MULTIPART_SUFFIXES) & (n >= 3)
    else:
        three = (n >= 3) & F.get(parts, n - 2).isin(second_level)
    k = F.when(three, 3).otherwise(2)
    tail = F.array_join(F.slice(parts, F.greatest(n - k + 1, F.lit(1)), k), ".")
    return F.when(is_ip(host) | (n < 2), host).otherwise(tail)


def is_hosted(host: Column) -> Column:
    return _or_false(registered_domain(host).isin(HOSTED_SUFFIXES))


def duration_seconds(c: Column) -> Column:
    """h:m:s, m:s (h:m if the second part is 60 or more) or plain seconds; null for anything else."""
    x = F.trim(c)
    parts = F.split(x, ":")
    clean = F.transform(parts, lambda p: F.regexp_extract(p, "^\\s*(\\d+)(?:\\.\\d*)?\\s*$", 1))
    ok = F.forall(clean, lambda p: p != "")
    at = lambda k: F.get(clean, F.lit(k)).try_cast("int")
    plain = F.when(x.rlike("^(\\d+\\.?\\d*|\\.\\d+)$"), F.floor(x.try_cast("double")).cast("int"))
    two = F.when(at(1) >= 60, at(0) * 3600 + at(1) * 60).otherwise(at(0) * 60 + at(1))
    return (
        F.when(x.isNull() | F.lower(x).isin("", "nan", "none", "missing"), F.lit(None).cast("int"))
        .when(F.size(parts) == 1, plain)
        .when(~ok, F.lit(None).cast("int"))
        .when(F.size(parts) == 2, two)
        .when(F.size(parts) == 3, at(0) * 3600 + at(1) * 60 + at(2))
    )


def word_count(c: Column) -> Column:
    return F.size(F.filter(F.split(c, "(?U)\\s+"), lambda w: w != ""))


def collapse(c: Column) -> Column:
    """White space as single blanks, without supplementary-plane symbols."""
    return F.trim(F.regexp_replace(F.regexp_replace(c, "[\\x{10000}-\\x{10FFFF}]", ""), "(?U)\\s+", " "))


def shingles(c: Column, n: int = 5) -> Column:
    """Distinct n-word shingles of a text; empty where it has fewer words.

    The words are bound by a one-element transform, so that they are cut once and not for each shingle.
    """
    words = F.filter(F.split(F.lower(c), "(?U)\\s+"), lambda x: x != "")
    of = lambda w: F.when(F.size(w) >= n, F.array_distinct(F.transform(F.sequence(F.lit(1), F.size(w) - (n - 1)), lambda i: F.array_join(F.slice(w, i, n), " ")))).otherwise(F.array().cast("array<string>"))
    return F.get(F.transform(F.array(words), of), F.lit(0))


def parse_timestamp(c: Column) -> Column:
    return F.try_to_timestamp(F.regexp_replace(c, "Z$", ""))


def safe_identifier(name: str) -> str:
    """name, if it can stand for a table or column; ValueError else."""
    import re

    if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", name):
        raise ValueError(f"not an identifier: {name!r}")
    return name
