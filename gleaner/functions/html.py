"""Links, metadata and challenges in HTML pages."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions.urls import identity, is_site_document, resolved

# What marks a page that checks the browser, and files that are no candidates.
CHALLENGES = ("verificando seu navegador", "verify you are human", "checking your browser", "cf-chl-", "g-recaptcha")
AUXILIARY = (".jpg", ".png", ".gif", ".txt", ".xml", ".zip")
METADATA = ("citation_", "dc.", "dcterms.")
LINKING = ("a", "link", "iframe", "embed", "object")


def is_challenge(html: Column) -> Column:
    low = F.lower(html)
    return F.exists(F.array(*[F.lit(m) for m in CHALLENGES]), lambda m: F.contains(low, m))


class _Page(HTMLParser):
    """Collects (target, source) of candidate links, in order, and (name, content) of metadata."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.links: list[tuple[str, str]] = []
        self.metadata: list[tuple[str, str]] = []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        get = dict(attrs).get
        if tag == "meta":
            name, content = (get("name") or get("property") or "").lower(), get("content")
            if content and name.startswith(METADATA):
                self.metadata.append((name, content))
                if name == "citation_pdf_url":
                    self.links.append((content, name))
        elif tag in LINKING and (target := get("href") or get("src") or get("data")):
            if is_candidate(target, get("type")):
                self.links.append((target, tag))


def is_candidate(target: str, kind: str | None) -> bool:
    low = target.lower()
    file = ".pdf" in low or "/bitstream/" in low or ("/bitstreams/" in low and "/download" in low)
    try:
        return (file or kind == "application/pdf") and not urlsplit(low).path.endswith(AUXILIARY)
    except ValueError:
        return False


def parsed(html: str | None) -> _Page:
    page = _Page()
    page.feed(html or "")
    return page


LINKS = "position INT, url STRING, source STRING, is_filtered BOOLEAN"


def links(pages: DataFrame, key: str = "page_id", base: str = "url", html: str = "html") -> DataFrame:
    """(key, position, url, source, is_filtered): every candidate link of a page, resolved.

    Links to a site's own documents are marked as filtered, unless the page's metadata names them.
    References that resolve to no URL are left out.
    """
    slim = pages.select(key, F.col(base).alias("base"), F.col(html).alias("html"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for k, b, text in zip(batch[key], batch["base"], batch["html"]):
                for i, (target, source) in enumerate(parsed(text).links):
                    if (url := resolved(b, target)) is not None:
                        rows.append((k, i, url, source, source != "citation_pdf_url" and is_site_document(url)))
            yield pd.DataFrame(rows, columns=[key, "position", "url", "source", "is_filtered"])

    return slim.mapInPandas(run, f"{key} {slim.schema[key].dataType.simpleString()}, {LINKS}")


def candidates(found: DataFrame, key: str = "page_id", most: int | None = None) -> DataFrame:
    """(key, position, url): links of ``links`` without repeated identities, in order of first position.

    Of a candidate's variants the first without a doubled slash in its path stands for it. With ``most``
    only that many per page are kept.
    """
    doubled = F.contains(F.regexp_extract("url", r"^[^:]+://[^/?#]*([^?#]*)", 1), F.lit("//"))
    rows = found.where(~F.col("is_filtered")).withColumn("_id", identity(F.col("url")))
    out = rows.groupBy(key, "_id").agg(F.min("position").alias("position"), F.min_by("url", F.struct(doubled, "position")).alias("url")).drop("_id")
    if most is not None:
        from gleaner.operators.files import capped

        out = capped(out, key, "position", most)
    return out


def metadata(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """(key, fields): a map from metadata names to the values that the page gives, in order."""
    slim = pages.select(key, F.col(html).alias("html"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fields = []
            for text in batch["html"]:
                found: dict[str, list[str]] = {}
                for name, content in parsed(text).metadata:
                    found.setdefault(name, []).append(content)
                fields.append(found)
            yield pd.DataFrame({key: batch[key], "fields": fields})

    return slim.mapInPandas(run, f"{key} {slim.schema[key].dataType.simpleString()}, fields MAP<STRING, ARRAY<STRING>>")


def hrefs(html: Column) -> Column:
    """The quoted targets of a page's anchors, by pattern; enough for well-formed pages."""
    return F.regexp_extract_all(html, F.lit(r'(?i)<a\s[^>]*?href="([^"]*)"'), F.lit(1))
