"""Records: validation, rejection, normalisation, first-write-wins, conflicts, repeated pages, imports."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

# The reason codes of rejected and flagged records.
NO_ID = "record_id_ausente_ou_invalido"
NO_TITLE = "titulo_ausente"
BLANK_TITLE = "titulo_vazio"
ODD_TITLE = "titulo_tipo_inesperado"
NO_URL = "_e_sem_url_utilizavel"
THESIS_FORMATS = ("masterThesis", "doctoralThesis")

_BLANK = r"(?U)^[\s\x1C-\x1F]*$"


def title_issue(title: Column, kind: Column | None = None) -> Column:
    """The flag of a title: missing, blank, of another type (``kind`` other than STRING), or null if it is fine."""
    issue = F.when(title.isNull(), NO_TITLE)
    if kind is not None:
        issue = F.when(kind.isNull() | (kind == "VOID"), NO_TITLE).when(kind != "STRING", ODD_TITLE)
    return issue.when(title.rlike(_BLANK), BLANK_TITLE)


def usable_urls(urls: Column) -> Column:
    """The http(s) addresses of an array of strings."""
    return F.filter(urls, lambda u: u.startswith("http://") | u.startswith("https://"))


def rejected(record_id: Column, issue: Column, n_usable: Column) -> Column:
    """The reason to reject a record, null if it is accepted."""
    bad_id = record_id.isNull() | record_id.rlike(_BLANK)
    return F.when(bad_id, NO_ID).when(issue.isNotNull() & (n_usable == 0), F.concat(issue, F.lit(NO_URL)))


def _flat(value: object) -> list[str]:
    """The strings of nested lists, in order; a stack holds what is still to come, so depth is no limit."""
    out, rest = [], [value]
    while rest:
        item = rest.pop()
        if isinstance(item, str):
            out.append(item)
        elif isinstance(item, list):
            rest += reversed(item)
    return out


@F.pandas_udf(ArrayType(StringType()))
def _flat_json(text: pd.Series) -> pd.Series:
    return text.map(lambda t: [] if t is None else _flat(json.loads(t)))


def strings(value: Column) -> Column:
    """All strings of a variant that is a string or lists nested to any depth, in order."""
    return _flat_json(F.to_json(value))


def page_error(page: Column) -> Column:
    """Why a variant is no valid answer, null if it is: status OK, a whole resultCount of 0 or more, a list of records, no accepted id twice."""
    at = lambda p, t: F.try_variant_get(page, p, t)
    bad_status = F.coalesce(at("$.status", "string") != "OK", F.lit(True))
    count_kind = F.schema_of_variant(at("$.resultCount", "variant"))
    bad_shape = at("$.records", "array<variant>").isNull() | F.coalesce(count_kind != "BIGINT", F.lit(True)) | F.coalesce(at("$.resultCount", "bigint") < 0, F.lit(True))
    ids = F.filter(F.transform(at("$.records", "array<variant>"), lambda r: F.when(_reason(r).isNull(), _text(r, "id"))), lambda i: i.isNotNull())
    repeated = F.size(F.array_distinct(ids)) < F.size(ids)
    return F.when(bad_status, "resposta_erro_api").when(bad_shape, "estrutura_inesperada").when(repeated, "ids_repetidos")


def _text(record: Column, key: str) -> Column:
    """The value of a key if it is a string."""
    return F.when(F.schema_of_variant(F.try_variant_get(record, f"$.{key}", "variant")) == "STRING", F.try_variant_get(record, f"$.{key}", "string"))


def _urls(record: Column) -> Column:
    return F.filter(F.transform(F.try_variant_get(record, "$.urls", "array<variant>"), lambda u: _text(u, "url")), lambda u: u.isNotNull())


def _issue(record: Column) -> Column:
    return title_issue(F.try_variant_get(record, "$.title", "string"), F.schema_of_variant(F.try_variant_get(record, "$.title", "variant")))


def _reason(record: Column) -> Column:
    return rejected(_text(record, "id"), _issue(record), F.coalesce(F.size(usable_urls(_urls(record))), F.lit(0)))


def validated(pages: DataFrame, body: str = "body") -> DataFrame:
    """Rows of raw pages (any key columns and a JSON ``body``) exploded to records with verdicts.

    Adds page_error (null if the page is valid: an object with status OK, a whole resultCount of 0 or
    more and a list of records, no accepted id twice), position, record, record_id, title, flags, urls and
    reject_reason. A page without records, or with an error, has one row with null record.
    """
    out = pages.withColumn("_page", F.try_parse_json(F.col(body)))
    out = out.withColumns({"page_error": page_error(F.col("_page")), "total": F.try_variant_get("_page", "$.resultCount", "bigint")})
    rows = F.when(F.col("page_error").isNull(), F.try_variant_get("_page", "$.records", "array<variant>"))
    out = out.select(*out.columns, F.posexplode_outer(rows).alias("position", "record"))
    record = F.col("record")
    out = out.withColumns({"record_id": _text(record, "id"), "_issue": _issue(record), "urls": _urls(record), "reject_reason": F.when(record.isNotNull(), _reason(record))})
    out = out.withColumns({"title": F.when(F.col("_issue").isNull(), _text(record, "title")), "flags": F.array_compact(F.array("_issue"))})
    return out.drop("_page", "_issue", body)


def normalised(accepted: DataFrame) -> DataFrame:
    """Rows of ``validated`` as harvested records; the first present key of the abstracts counts."""
    get = lambda p: F.try_variant_get("record", p, "variant")
    primary = F.try_variant_get("record", "$.authors.primary", "map<string,variant>")
    abstracts = F.coalesce(get("$.abstracts"), get("$.abstract"), get("$.description"))
    keys = [c for c in accepted.columns if c not in ("record", "reject_reason", "page_error", "flags")]
    return accepted.where("record IS NOT NULL AND reject_reason IS NULL").select(
        *keys, F.col("flags").alias("metadata_quality_flags"),
        F.coalesce(F.map_keys(primary), strings(get("$.authors.primary"))).alias("authors"),
        *(strings(get(f"$.{c}")).alias(c) for c in ("formats", "languages", "subjects")),
        strings(abstracts).alias("abstracts"), F.to_json("record").alias("original_record"),
        F.lit("consulta_exploratoria_nao_validada").alias("area_status"), F.lit("search").alias("metadata_level"),
    )


def first_wins(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first row of each key; aggregated as the least struct, so hot keys combine before they move."""
    rest = [c for c in rows.columns if c not in (key, *order)]
    least = F.min(F.struct(*order, *rest)).alias("_r")
    return rows.groupBy(key).agg(least).select(key, *(F.col(f"_r.{c}").alias(c) for c in (*order, *rest))).select(*rows.columns)


def last_wins(rows: DataFrame, key: str, version: list[str]) -> DataFrame:
    """The row of each key with the greatest version (columns that tell rows apart): an upsert without MERGE."""
    most = F.max_by(F.struct(*rows.columns), F.struct(*version)).alias("_r")
    return rows.groupBy(key).agg(most).select("_r.*")


def canonical(json: Column) -> Column:
    """JSON text with sorted keys, for equality of documents; types stay strict."""
    return F.to_json(F.try_parse_json(json))


def conflicts(rows: DataFrame, key: str, order: str, payload: str) -> DataFrame:
    """(key, order, payload) of rows whose payload is not that of the key's first row; null payload never conflicts."""
    first = rows.groupBy(F.col(key)).agg(F.min_by(payload, order).alias("_first"), F.countDistinct(payload).alias("_n")).where("_n > 1")
    return rows.join(first, key).where(F.col(payload) != F.col("_first")).select(key, order, payload)


def links_summary(links: DataFrame, record: str, partition: str) -> DataFrame:
    """(links, records, duplicates): links of records to partitions, and how many are not a record's first."""
    each = links.select(record, partition).distinct()
    return each.agg(F.count("*").alias("links"), F.countDistinct(record).alias("records")).withColumn("duplicates", F.greatest(F.col("links") - F.col("records"), F.lit(0)))


def page_fingerprints(rows: DataFrame, page: list[str], position: str, value: str) -> DataFrame:
    """(page..., n, fingerprint): SHA-256 of a page's values in order, one per line."""
    ordered = F.array_sort(F.collect_list(F.struct(position, value)))
    out = rows.groupBy(*page).agg(F.count("*").alias("n"), ordered.alias("_r"))
    return out.select(*page, "n", F.sha2(F.array_join(F.col(f"_r.{value}"), "\n"), 256).alias("fingerprint"))


def repeated_pages(pages: DataFrame, partition: str, page: str, fingerprint: str) -> DataFrame:
    """(partition, page, first_page) of pages whose fingerprint an earlier page of the partition has."""
    first = pages.groupBy(partition, fingerprint).agg(F.min(page).alias("first_page"), F.count("*").alias("_n")).where("_n > 1")
    return pages.join(first, [partition, fingerprint]).where(F.col(page) > F.col("first_page")).select(partition, page, "first_page")


def growth(previous: DataFrame, current: DataFrame, key: str, payload: str) -> DataFrame:
    """(old, missing, changed, added): what the immutable-growth contract allows has missing = changed = 0."""
    a, b = previous.select(key, F.col(payload).alias("_a"), F.lit(1).alias("_old")), current.select(key, F.col(payload).alias("_b"), F.lit(1).alias("_new"))
    both = a.join(b, key, "full")
    return both.agg(
        F.count("_old").alias("old"), F.count_if(F.col("_old").isNotNull() & F.col("_new").isNull()).alias("missing"),
        F.count_if(F.col("_old").isNotNull() & F.col("_new").isNotNull() & ~F.col("_a").eqNullSafe(F.col("_b"))).alias("changed"),
        F.count_if(F.col("_old").isNull()).alias("added"),
    )


def query_values(url: Column, name: str) -> Column:
    """The decoded values of a repeated query parameter; + is a space there."""
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    pairs = F.filter(F.split(query, "&"), lambda p: F.try_url_decode(F.substring_index(p, "=", 1)) == name)
    return F.transform(pairs, lambda p: F.try_url_decode(F.substring(p, F.instr(p, "=") + 1, F.length(p))))


def import_basis(formats: Column, source_url: Column, config: dict) -> Column:
    """Why an imported record belongs to the current query, null if it does not.

    It must be a thesis, its source URL must carry all the query's filters and, in its groups, all the
    query's (term, type) pairs; a flat query counts as one group.
    """
    groups = config.get("groups") or [{"clauses": [{"lookfor": config["lookfor"], "type": config["type"]}]}]
    wanted = sorted({(c["lookfor"].lower(), c["type"]) for g in groups for c in g["clauses"]})
    seen = F.array().cast("array<string>")
    for i in [*(str(i) + "[]" for i in range(max(4, len(groups)))), ""]:
        terms, kinds = query_values(source_url, f"lookfor{i}"), query_values(source_url, f"type{i}")
        n = F.least(F.size(terms), F.size(kinds))
        pairs = F.transform(F.slice(F.arrays_zip(terms.alias("t"), kinds.alias("k")), F.lit(1), n), lambda p: F.concat(F.lower(p["t"]), F.lit("\x00"), p["k"]))
        seen = F.concat(seen, F.coalesce(pairs, F.array().cast("array<string>")))
    all_terms = F.size(F.array_except(F.array(*[F.lit("\x00".join(w)) for w in wanted]), seen)) == 0
    filters = F.array(*[F.lit(f) for f in config.get("filters", [])]).cast("array<string>")
    all_filters = F.size(F.array_except(filters, query_values(source_url, "filter[]"))) == 0
    thesis = F.arrays_overlap(formats, F.array(*[F.lit(f) for f in THESIS_FORMATS]))
    return F.when(thesis & all_filters & all_terms, "consulta_atual_com_quatro_campos")
