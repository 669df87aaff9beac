"""URL functions: parts, cleaning, resolving, identity of candidates, site documents."""

from __future__ import annotations

import re
import unicodedata
from urllib.parse import quote, unquote, urljoin, urlsplit, urlunsplit

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType

# Parts of names of documents that belong to a site, not to a work.
SITE_MARKERS = (
    "politica-de-informacao",
    "politica-de-privacidade",
    "privacy-policy",
    "termos-de-uso",
    "terms-of-use",
    "politica-do-repositorio",
)
# Characters that stay as they are in a cleaned path and query.
PATH_SAFE = "/%:@!$&'()*+,;=-._~"
QUERY_SAFE = "/%?:@!$&'()*+,;=-._~"


def origin(url: Column) -> Column:
    return F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)


def host(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)


def path(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def query(url: Column) -> Column:
    return F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)


def last_segment(url: Column) -> Column:
    return F.element_at(F.split(path(url), "/"), -1)


def percent_decoded(text: Column) -> Column:
    """Percent-decoding that keeps +; null if the bytes are no UTF-8."""
    return F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))


def slug(name: str) -> str:
    """A name as lower-case ASCII words joined by hyphens."""
    flat = unicodedata.normalize("NFKD", unquote(name).casefold())
    return re.sub("[^a-z0-9]+", "-", "".join(c for c in flat if not unicodedata.combining(c))).strip("-")


def is_site_document(url: str | None) -> bool:
    name = slug(urlsplit(url or "").path.rsplit("/", 1)[-1])
    return any(m in name for m in SITE_MARKERS)


def cleaned(url: str | None) -> str | None:
    """The URL without fragment and with its path and query quoted; null unless http(s) without credentials."""
    try:
        p = urlsplit((url or "").strip())
        if p.scheme not in ("http", "https") or not p.hostname or p.username or p.password:
            return None
        return urlunsplit((p.scheme, p.netloc, quote(p.path, safe=PATH_SAFE), quote(p.query, safe=QUERY_SAFE), ""))
    except ValueError:
        return None


def resolved(base: str | None, ref: str | None) -> str | None:
    """A reference resolved against its page and cleaned; null if that gives no URL."""
    try:
        return cleaned(urljoin(base or "", ref or ""))
    except ValueError:
        return None


@F.pandas_udf(BooleanType())
def site_document(url: pd.Series) -> pd.Series:
    return url.map(is_site_document)


@F.pandas_udf(StringType())
def clean_url(url: pd.Series) -> pd.Series:
    return url.map(cleaned)


@F.pandas_udf(StringType())
def resolve_url(base: pd.Series, ref: pd.Series) -> pd.Series:
    return pd.Series([resolved(b, r) for b, r in zip(base, ref)], dtype=object)


@F.pandas_udf(StringType())
def slugged(name: pd.Series) -> pd.Series:
    return name.map(lambda n: None if n is None else slug(n))


def identity(url: Column) -> Column:
    """A key shared by the known variants of a candidate's URL.

    Repeated slashes and session ids do not count. A bitstream below a handle, in either of its forms
    and with or without the interface prefix, is named by handle and file name whatever the query is.
    """
    p = F.regexp_replace(path(url), "/+", "/")
    p = F.regexp_replace(p, "(?i);jsessionid=[^/;]+", "")
    bare = F.regexp_replace(p, "(?i)^/xmlui/", "/")
    form = r"(?i)^/bitstream/(?:handle/([^/]+/[^/]+)|([^/]+/[^/]+)/[0-9]+)/([^/]+)$"
    handle = F.concat(F.regexp_extract(bare, form, 1), F.regexp_extract(bare, form, 2))
    name = F.lower(F.regexp_extract(bare, form, 3))
    scheme = F.lower(F.regexp_extract(url, "^([A-Za-z][A-Za-z0-9+.-]*):", 1))
    site = F.concat_ws(" ", scheme, F.lower(host(url)))
    return F.when(handle != "", F.concat_ws(" ", F.lit("dspace"), site, handle, name)).otherwise(F.concat_ws(" ", F.lit("url"), site, p, query(url)))
