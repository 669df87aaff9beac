"""Evidence of refused requests that is fit to be kept: short, printable, without cookies."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Headers that say why and until when a request was refused.
HEADERS = ("retry-after", "content-type", "date", "server", "x-ratelimit-limit", "x-ratelimit-remaining", "x-ratelimit-reset")
BODY_BYTES, EXCERPT = 64 * 1024, 4096


@F.pandas_udf(StringType())
def _decoded(raw: pd.Series) -> pd.Series:
    """UTF-8 with replacements, as a body may be in another charset or cut inside a character."""
    return raw.map(lambda x: None if x is None else x.decode("utf-8", "replace"))


def excerpt(body: Column) -> Column:
    """The start of a body of bytes as text with control characters blanked."""
    text = _decoded(F.substring(body, 1, BODY_BYTES))
    return F.substring(F.regexp_replace(text, r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]", " "), 1, EXCERPT)


def kept_headers(headers: Column) -> Column:
    """The map entries of listed headers, names in lower case."""
    low = F.transform_keys(headers, lambda k, _: F.lower(k))
    return F.map_filter(low, lambda k, _: k.isin(*HEADERS))


def institution_fields(record: Column) -> Column:
    """The entries of a map whose name speaks of an institution."""
    return F.map_filter(record, lambda k, _: F.contains(F.lower(k), F.lit("institution")))
