"""Robots policies: what a policy response allows."""

from __future__ import annotations

from urllib.robotparser import RobotFileParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions.urls import origin


def policy_state(status: Column, body: Column) -> Column:
    """allow (no policy), rules, or unavailable: an HTML body or any other answer confirms no access."""
    html = F.contains(F.lower(body), F.lit("<html")) | F.contains(F.lower(body), F.lit("<!doctype html"))
    return F.when(status == 404, "allow").when((status == 200) & ~F.coalesce(html, F.lit(False)), "rules").otherwise("unavailable")


def _parser(text: str) -> RobotFileParser:
    parser = RobotFileParser()
    parser.parse(text.splitlines())
    return parser


def allows(agent: str):
    """A function of (policy state, policy body, URL): whether the agent may fetch the URL."""

    @F.pandas_udf("boolean")
    def allowed(state: pd.Series, body: pd.Series, url: pd.Series) -> pd.Series:
        parsers: dict[str, RobotFileParser] = {}
        out = []
        for s, b, u in zip(state, body, url):
            if s == "rules":
                text = b or ""
                parser = parsers.get(text) or parsers.setdefault(text, _parser(text))
                out.append(parser.can_fetch(agent, u or ""))
            else:
                out.append(s == "allow")
        return pd.Series(out, dtype=bool)

    return allowed


def delay(agent: str):
    """A function of the policy body: the crawl delay in seconds, at least 1."""

    @F.pandas_udf("double")
    def seconds(body: pd.Series) -> pd.Series:
        return body.map(lambda b: max(1.0, float(_parser(b or "").crawl_delay(agent) or 1)))

    return seconds


def checked(urls: DataFrame, policies: DataFrame, agent: str, url: str = "url") -> DataFrame:
    """``urls`` with ``robots``: allowed, robots_bloqueado or robots_indisponivel, by a table of policies.

    ``policies`` has origin, status and body, one row per origin.
    """
    state = policies.select("origin", policy_state(F.col("status"), F.col("body")).alias("_state"), F.col("body").alias("_body"))
    rows = urls.withColumn("origin", origin(F.col(url))).join(state, "origin", "left").withColumn("_state", F.coalesce("_state", F.lit("unavailable")))
    ok = allows(agent)(F.col("_state"), F.col("_body"), F.col(url))
    verdict = F.when(F.col("_state") == "unavailable", "robots_indisponivel").when(ok, "allowed").otherwise("robots_bloqueado")
    return rows.withColumn("robots", verdict).drop("_state", "_body")


def fresh(policies: DataFrame, as_of: Column, ttl_s: int = 86_400) -> DataFrame:
    """The cached policies (with fetched_at) that are young enough to be used without asking again."""
    age = F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(F.col("fetched_at").cast("timestamp"))
    return policies.where(age < ttl_s * 1_000_000)
