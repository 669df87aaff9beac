import random

import duckdb
import pytest
from pyspark.sql import functions as F

from gleaner import oracle, queries
from gleaner.functions import html, robots, urls
from gleaner.operators import attempts, files, pacing, records
from gleaner.plans import partitions, query_spec
from gleaner.session import TABLES

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def shown(rows):
    return sorted(tuple(round(v, 6) if isinstance(v, float) else str(v) for v in r) for r in rows)


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_queries_equal_sql(spark, duck, name):
    df = queries.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    got = df.select(*columns).collect()
    if name in oracle.oracle_sql():
        want = duck.execute(f"SELECT {', '.join(chr(34) + c + chr(34) for c in columns)} FROM ({oracle.oracle_sql()[name]})").fetchall()
        assert shown(got) == shown(want)
    else:
        assert got


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())] if values else [(1,)], list(values) or ["x"]).select(column.alias("v")).first()["v"]


def test_query_spec(spark):
    assert query_spec.quoted("f", 'a\\"b', True) == '-f:"a\\\\\\"b"'
    assert spark.range(1).select(query_spec.quoted_column("f", F.lit('a\\"b')).alias("v")).first()["v"] == 'f:"a\\\\\\"b"'
    assert query_spec.split_year(["year:2020", 'publishDate:"2020"', "x"]) == (["x"], "2020")
    with pytest.raises(ValueError):
        query_spec.split_year(["year:2020", "year:2021"])
    url = query_spec.request_url(queries.CONFIG, 2, filters=["year:1999"])
    assert "bool0%5B%5D=OR" in url and "publishDatefrom=1999" in url and "page=2&limit=100" in url
    a = query_spec.signature(queries.CONFIG)
    assert a == query_spec.signature(dict(reversed(queries.CONFIG.items())) | {"facets": ["x"]}) != query_spec.signature(queries.CONFIG | {"extra": 1})


def test_partition_nulls_and_states(spark):
    rows = [(i, "2024" if i < 1100 else None if i < 1110 else "1990", "X" if i % 2 else None) for i in range(1150)]
    corpus = spark.createDataFrame(rows, "record_id int, year string, institution string")
    years = partitions.exposed(partitions.facet(corpus, "year"), 1)
    parts = {r.label: r for r in partitions.plan(corpus, years, partitions.facet(corpus, "institution")).collect()}
    assert parts["2024"].status == "split" and parts["no year"].total == 10 and parts["other years"].total == 40
    assert parts["2024 / X"].total + parts["2024 / other institutions"].total == 1100
    state = [("year", True, "planned", 1200, 1, 100, False, False, False), ("institution", False, "harvesting", 1200, 11, 100, True, False, False),
             ("institution", False, "harvesting", 250, 3, 50, False, False, False), ("none", False, "harvesting", 250, 2, 100, False, True, False),
             ("none", False, "harvesting", 250, 2, 100, False, False, True), ("none", False, "harvesting", 250, 2, 100, True, False, False)]
    df = spark.createDataFrame(state, "kind string, has_children_facet boolean, status string, total long, page int, rows int, repeated boolean, retryable boolean, total_changed boolean")
    assert [r.next_status for r in partitions.transition(df).collect()] == ["split", "partial", "complete", "harvesting", "inaccessible", "inaccessible"]


def test_validation_and_normalisation(spark):
    bodies = [
        '{"status":"OK","resultCount":2,"records":[{"id":"a","title":"T","subjects":[["x"],"y"],"authors":{"primary":{"Ann":{}}},"urls":[{"url":"http://u"},{"url":"ftp://v"},{}],"description":"d","abstracts":null}]}',
        '{"status":"OK","resultCount":1,"records":[{"id":"a","title":"1"},{"id":"a","title":"2"}]}', '{"status":"OK","resultCount":-1,"records":[]}', "no json", None,
        '{"status":"OK","resultCount":0,"records":[]}', '{"status":"OK","resultCount":1,"records":[{"id":"b","title":7,"urls":[{"url":"https://w"}]},5]}',
    ]
    pages = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "page int, body string")
    rows = records.validated(pages).collect()
    errors = {r.page: r.page_error for r in rows}
    assert errors == {0: None, 1: "ids_repetidos", 2: "estrutura_inesperada", 3: "resposta_erro_api", 4: "resposta_erro_api", 5: None, 6: None}
    last = {r.position: r for r in rows if r.page == 6}
    assert last[0].flags == ["titulo_tipo_inesperado"] and last[0].reject_reason is None and last[1].reject_reason == "record_id_ausente_ou_invalido"
    first = records.normalised(records.validated(pages.where("page = 0"))).first()
    assert (first.authors, first.subjects, first.urls, first.title) == (["Ann"], ["x", "y"], ["http://u", "ftp://v"], "T")


def test_upserts_conflicts_and_growth(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 3, None), ("b", 1, None), ("b", 2, "z")], "k string, o int, p string")
    assert {tuple(r) for r in records.first_wins(rows, "k", ["o"]).collect()} == {("a", 1, "x"), ("b", 1, None)}
    assert {tuple(r) for r in records.last_wins(rows, "k", ["o"]).collect()} == {("a", 3, None), ("b", 2, "z")}
    assert [tuple(r) for r in records.conflicts(rows, "k", "o", "p").collect()] == [("a", 2, "y")]
    old, new = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", None)], "k string, p string"), spark.createDataFrame([("a", "1"), ("b", "x"), ("d", "1"), ("c", None)], "k string, p string")
    assert tuple(records.growth(old, new, "k", "p").first()) == (3, 0, 1, 1)
    assert tuple(records.growth(new, old, "k", "p").first()) == (4, 1, 1, 0)
    pages = spark.createDataFrame([("p", 1, "f"), ("p", 2, "g"), ("p", 3, "f"), ("q", 4, "f")], "part string, page int, f string")
    assert [tuple(r) for r in records.repeated_pages(pages, "part", "page", "f").collect()] == [("p", 3, 1)]


def test_next_fit(spark):
    rng = random.Random(1)
    rows = sorted((f"{rng.getrandbits(256):064x}", rng.randint(1, 60)) for _ in range(300))
    want, n, size = [], 0, 0
    for _, b in rows:
        if n and size >= 100:
            want.append((n, size))
            n, size = 0, 0
        n, size = n + 1, size + b
    df = spark.createDataFrame(rows, "sha string, bytes long").repartition(5)
    forced = [(r.files, r.bytes) for r in files.next_fit(df, 100).orderBy("batch").collect()]
    assert forced == [*want, (n, size)]
    assert [(r.files, r.bytes) for r in files.next_fit(df, 100, force=False).collect()] == want + [(n, size)] * (size >= 100)
    assert files.next_fit(df.where("false"), 100).count() == 0
    assert files.batch_prefix(df, 100).count() == want[0][0]


def test_missing_metadata_is_an_error(spark):
    links, held = spark.createDataFrame([("a",), ("b",)], "record_id string"), spark.createDataFrame([("a", 1)], "record_id string, m int")
    with pytest.raises(Exception, match="no metadata"):
        files.manifest(links, held).collect()
    assert tuple(files.inclusion(links, held, "record_id").first()) == (1, 0)


def test_content_kinds(spark):
    cases = [(b" \n%PDF-1" + b"x" * 70000 + b"%%EOF", "text/html", "pdf"), (b"%PDF-1 cut", "text/html", "invalid_pdf"), (b"%%EOF" + b"x" * 70000, "application/pdf", "invalid_pdf"),
             (b"<p>", "text/html", "html"), (b"", None, "other"), (b"x" * 1100 + b"%PDF-%%EOF", "text/plain", "other")]
    df = spark.createDataFrame([(bytearray(c), t, k) for c, t, k in cases], "c binary, t string, k string")
    assert [r.v for r in df.select(files.content_kind(F.col("c"), F.col("t")).alias("v")).collect()] == [k for _, _, k in cases]


def test_pacing(spark):
    rows = [("h", t, i) for i, t in enumerate([0, 1, 2, 50, 51, 90])] + [("g", 5, 9)]
    out = pacing.paced(spark.createDataFrame(rows, "h string, t long, i int"), "h", "t", "i", 10).orderBy("i").collect()
    assert [r.start_us for r in out] == [0, 10, 20, 50, 60, 90, 5]
    waits = queries.retry_after_parse(spark, DATA).orderBy("id").collect()
    assert [(r.seconds, r.source.split("_")[-3]) for r in waits][:5] == [(120.0, "server"), (3600.0, "no"), (3600.0, "no"), (1680.0, "server"), (3600.0, "invalid")]
    assert [r.seconds for r in waits][5:] == [0.0, 1.5, 0.0]
    assert spark.range(1).select(pacing.backoff(F.lit(3.0), F.lit(3), 15.0, F.lit(0.5), 60.0).alias("v")).first()["v"] == 60.0


def test_urls(spark):
    assert urls.slug("Pol%C3%ADtica de  Informa%C3%A7%C3%A3o+ﬁ.PDF") == "politica-de-informacao-fi-pdf"
    assert urls.is_site_document("http://a/x/Terms%20of%20Use.pdf?x") and not urls.is_site_document("http://a/terms-of-use/work.pdf") and not urls.is_site_document(None)
    assert [urls.cleaned(u) for u in (" http://a/b c?d=é#e ", "ftp://a", "http://", "http://u@a/", None, "http://[bad")] == ["http://a/b%20c?d=%C3%A9", None, None, None, None, None]
    same = ["http://A/xmlui/bitstream/handle/1/2/F.pdf?sequence=1", "http://a//bitstream/1/2/7/f.PDF;jsessionid=9"]
    df = spark.createDataFrame([(u,) for u in [*same, "http://a/b//c?x", "http://a/b/c?x", "http://a/b/c?y"]], "u string").select(urls.identity(F.col("u")).alias("i"))
    got = [r.i for r in df.collect()]
    assert got[0] == got[1] and got[2] == got[3] != got[4]
    assert spark.range(1).select(urls.percent_decoded(F.lit("a+b%20c")).alias("v")).first()["v"] == "a+b c"


def test_links(spark):
    page = (
        '<meta name="DC.Description" content="d&amp;e"><meta property="citation_pdf_url" content="/privacy-policy.pdf"><a HREF="x//y.pdf">1</a><a href="x/y.pdf">2</a>'
        '<link src="/bitstream/1/2/t.jpg"><a href="/bitstreams/9/download">3</a><object data="o" type="application/pdf"></object><a href="/terms-of-use.pdf">4</a><a href="http://[bad.pdf">5</a><a>6</a>'
    )
    pages = spark.createDataFrame([(1, "http://h/d/", page), (2, "http://h/", None)], "page_id int, url string, html string")
    found = html.links(pages)
    assert [r.url for r in html.candidates(found).orderBy("position").collect()] == ["http://h/privacy-policy.pdf", "http://h/d/x/y.pdf", "http://h/bitstreams/9/download", "http://h/d/o"]
    assert [r.url for r in found.where("is_filtered").collect()] == ["http://h/terms-of-use.pdf"]
    assert html.candidates(found, most=2).count() == 2
    assert html.metadata(pages).where("page_id = 1").first()["fields"] == {"dc.description": ["d&e"], "citation_pdf_url": ["/privacy-policy.pdf"]}


def test_robots(spark):
    rows = [("http://a/x",), ("http://a/private/x",), ("http://b/x",), ("http://c/x",), ("http://d/x",)]
    policies = [("http://a", 200, "User-agent: *\nDisallow: /private"), ("http://b", 404, None), ("http://c", 200, "<HTML>")]
    got = robots.checked(spark.createDataFrame(rows, "url string"), spark.createDataFrame(policies, "origin string, status int, body string"), "bot").collect()
    assert {r.url: r.robots for r in got} == {"http://a/x": "allowed", "http://a/private/x": "robots_bloqueado", "http://b/x": "allowed", "http://c/x": "robots_indisponivel", "http://d/x": "robots_indisponivel"}


def test_imports(spark):
    url = query_spec.request_url(queries.CONFIG, 3)
    rows = [(["masterThesis"], url), (["article"], url), (["doctoralThesis"], url.replace("lookfor1", "lookfor9")), (None, url), (["masterThesis"], None)]
    df = spark.createDataFrame(rows, "f array<string>, u string").select(records.import_basis(F.col("f"), F.col("u"), queries.CONFIG).alias("b"))
    assert [r.b is not None for r in df.collect()] == [True, False, False, False, False]


def test_attempt_rules(spark):
    df = spark.createDataFrame([(1, 1, ["pdf_obtido"]), (0, 0, []), (0, 2, ["html_grande"])], "f int, u int, s array<string>")
    got = df.select(attempts.result_status(F.col("f"), F.col("u")).alias("r"), attempts.limited(F.col("s"), F.lit(False), F.lit(False)).alias("l")).collect()
    assert [(r.r, r.l) for r in got] == [("sucesso", False), ("sem_link_origem", False), ("nao_obtido", True)]
    logs = spark.createDataFrame([("a", "2026-01-01 00:00:00", 5), ("b", "2026-01-01 00:00:00", 5)], "url string, ts string, bytes long")
    raw = spark.createDataFrame([("s", "2026-01-01 00:00:01.9", 5), ("t", "2026-01-01 00:00:02.1", 5), ("u", "2026-01-01 00:00:00", 6)], "sha string, modified string, bytes long")
    assert {(r.url, r.sha) for r in pacing.matching_raw(logs, raw).collect()} == {("a", "s"), ("b", "s")}


def test_evidence_and_policy_age(spark):
    from gleaner.functions import evidence

    df = spark.createDataFrame([(bytearray(b"a\x00b" + b"x" * 70000), {"Retry-After": "5", "Set-Cookie": "secret"}, {"Institution_str": "U", "title": "T"})], "b binary, h map<string,string>, r map<string,string>")
    row = df.select(evidence.excerpt(F.col("b")).alias("e"), evidence.kept_headers(F.col("h")).alias("h"), evidence.institution_fields(F.col("r")).alias("r")).first()
    assert row.e.startswith("a bx") and len(row.e) == 4096 and row.h == {"retry-after": "5"} and row.r == {"Institution_str": "U"}
    policies = spark.createDataFrame([("a", "2026-01-01 00:00:00"), ("b", "2026-01-01 20:00:00")], "origin string, fetched_at string")
    assert [r.origin for r in robots.fresh(policies, F.lit("2026-01-02 01:00:00")).collect()] == ["b"]


def test_heartbeat(spark):
    from gleaner.streaming.progress import Heartbeat, observed

    lines = []
    beat = Heartbeat(0.01, lines.append).start()
    beat.update(records=5, attempted=7)
    beat.begin("download")
    df, count = observed(spark.range(9), "rows")
    df.collect()
    beat.update(rows=count.get["rows"])
    beat.end()
    beat.stop()
    assert "queue=0" in lines[0] or any("queue=0" in x for x in lines)
    assert any(x == "download records=5 attempted=7 rows=9 queue=0" for x in lines)
