"""Validation of answers, retries of records, waits that the API asks for."""

import json
from datetime import UTC, datetime, timedelta

from pyspark.sql import functions as F

from gleaner import collect
from gleaner.functions import evidence
from gleaner.operators import records
from gleaner.plans import downloads, partitions, query_spec, schemas
from gleaner.sources import transport

CONFIG = {"endpoint": "http://api.test/search", "lookfor": "x", "type": "AllFields", "filters": [], "limit": 100}
AT = datetime(2026, 1, 1, tzinfo=UTC)


def answer(*rows):
    return json.dumps({"status": "OK", "resultCount": len(rows), "records": list(rows)})


def test_only_accepted_ids_may_not_repeat(spark):
    bodies = [
        answer({"id": "a", "title": "A"}, {"id": "a", "title": "\t\n"}, {"id": " ", "title": "T"}),
        answer({"id": "a", "title": "A"}, {"id": "a", "title": None, "urls": [{"url": "http://x"}]}),
    ]
    got = records.validated(spark.createDataFrame(list(enumerate(bodies)), "page int, body string")).collect()
    first = sorted((r.position, r.reject_reason) for r in got if r.page == 0)
    assert first == [(0, None), (1, "titulo_vazio_e_sem_url_utilizavel"), (2, "record_id_ausente_ou_invalido")]
    assert [r.page_error for r in got if r.page == 1] == ["ids_repetidos"]


def test_strings_of_any_depth(spark):
    deep = "x"
    for _ in range(40):
        deep = [deep, {"no": "object"}, 3]
    rows = [("a",), (json.dumps([[["deep"]], "x", [], None]),), (json.dumps(deep),), (json.dumps("one"),), (None,)]
    got = spark.createDataFrame(rows[1:], "t string").select(records.strings(F.try_parse_json("t")).alias("s")).collect()
    assert [r.s for r in got] == [["deep", "x"], ["x"], ["one"], []]


def test_charsets(spark):
    rows = [(b"caf\xe9", "latin-1"), (b"caf\xe9", "utf-8"), (b"caf\xe9", "no-such"), (None, "utf-8"), ("é".encode(), None)]
    df = spark.createDataFrame(rows, "content binary, charset string")
    got = [tuple(r) for r in df.select(downloads.decoded("content", "charset"), evidence.excerpt(F.col("content"))).collect()]
    assert [r[0] for r in got] == ["caf\xe9", "caf�", "caf�", None, "é"] and got[0][1] == "caf�"


def test_a_retry_keeps_what_was_obtained(spark):
    file = lambda sha, url: (sha, f"raw/pdf/{sha}.pdf", 5, url)
    prior = spark.createDataFrame(
        [("r", [file("a", "http://x/a.pdf")], [{"dc.title": ["T"]}]), ("q", [], None)],
        "record_id string, files array<struct<sha256 string, path string, bytes bigint, url string>>, metadata_from_html array<map<string, array<string>>>",
    )
    rows = spark.createDataFrame([("r", "T", ["http://x/a", "http://x/b"]), ("q", None, ["http://x/c"]), ("n", None, [])], "record_id string, title string, urls array<string>")
    tried = spark.createDataFrame(
        [("r", 0, "http://x/b", AT, None, None, None, None, "http_404", "http_404", "resource", False), ("r", 1, "http://x/again", AT, "http://x/a2.pdf", "pdf", "a", 5, "pdf_obtido", None, None, False),
         ("q", 0, "http://x/c", AT, "http://x/c", "pdf", "c", 7, "pdf_obtido", None, None, False)],
        "record_id string, depth int, url string, at timestamp, final_url string, kind string, sha256 string, bytes bigint, status string, error string, stage string, too_many boolean",
    )
    said = spark.createDataFrame([("r", {"dc.title": ["T"]}), ("r", {"dc.creator": ["C"]})], "record_id string, fields map<string, array<string>>")
    got = {r.record_id: r for r in downloads.results(rows, tried, F.lit(AT), prior, said).collect()}
    assert got["r"].status == "sucesso" and [f.url for f in got["r"].files] == ["http://x/a.pdf"]
    assert [a.status for a in got["r"].attempts] == ["http_404", "pdf_duplicado"]
    assert got["r"].metadata_from_html == [{"dc.title": ["T"]}, {"dc.creator": ["C"]}]
    assert [f.sha256 for f in got["q"].files] == ["c"] and got["n"].status == "sem_link_origem" and got["n"].files == []


def test_cooldowns_outlive_the_run(spark, tmp_path):
    c = collect.Collector(spark, CONFIG, tmp_path / "run")
    log = lambda *rows: spark.createDataFrame([(AT + timedelta(minutes=m), "http://api.test/search", s, None, 0, None, "network", None) for m, s in rows], schemas.HTTP_LOG).write.mode("append").parquet(c._path("http_log"))
    assert c.cooldown(AT) is None
    log((0, "200"), (5, "429"))
    assert c.cooldown(AT + timedelta(minutes=10)) == AT + timedelta(minutes=65)  # the run's own wait, from the log alone
    row = {"harvest_ts": AT + timedelta(minutes=5), "url": "http://api.test/search", "retry_after": "7200", "body": None, "error": None}
    c._limited(row)
    again = collect.Collector(spark, CONFIG, tmp_path / "run")
    assert again.cooldown(AT + timedelta(minutes=10)) == AT + timedelta(minutes=125) and again.cooldown(AT + timedelta(minutes=126)) is None
    log((20, "200"))
    assert again.cooldown(AT + timedelta(minutes=21)) is None


def test_archived_facets(spark):
    values = spark.createDataFrame([("institution", "X", 7, AT), ("publishDate", "1999", 1, AT)], schemas.FACET_VALUES)
    body = json.dumps({"facets": {"institution": [{"value": "X", "count": 1}, {"value": "Y", "count": 3}, {"value": None, "count": 0}]}})
    answers = spark.createDataFrame([("http://u", body), ("http://v", "no json")], "url string, body string")
    found = partitions.archived_facets(values, answers, "institution")
    assert sorted(map(tuple, found.collect())) == [("X", 7), ("Y", 3)] and partitions.smallest(found).first()["value"] == "Y"


def test_policies_and_waits():
    waited, now = [], [0.0]

    def sleep(s):
        waited.append(s)
        now[0] += s

    def web(url, agent):
        if url == "http://a/robots.txt":
            return 301, {"location": "http://b/robots.txt"}, [b""]
        if url == "http://b/robots.txt":
            return 200, {}, [b"User-agent: *\nRequest-rate: 1/5\nDisallow: /no"]
        return (429, {"retry-after": "30"}, [b""]) if url.endswith("/busy") else (200, {}, [b"x"])

    client = transport.Client("agent", web, transport.Limits(retry_429=False), sleep, lambda: now[0])
    assert client.fetch("http://a/x")["bytes"] == 1 and set(client.policies) == {"http://a", "http://b"} and client.delays["a"] == 5.0
    assert client._transfer("http://a/busy", 10, "resource")[0] == 429 and client.delays["b"] == 5.0
    loop = transport.Client("agent", lambda u, a: (302, {"location": u}, [b""]), transport.Limits(), sleep, lambda: now[0])
    try:
        loop.fetch("http://a/x")
        raise AssertionError
    except transport.FetchError as error:
        assert error.code == "robots_indisponivel"


def test_request_parameters():
    url = query_spec.request_url(CONFIG | {"groups": [{"operator": "OR", "clauses": [{"lookfor": "a", "type": "T"}]}], "date_ranges": ["y"], "publishDateto": "3"}, 2, filters=["year:1999"])
    assert url == "http://api.test/search?join=AND&bool0%5B%5D=OR&lookfor0%5B%5D=a&type0%5B%5D=T&page=2&limit=100&daterange%5B%5D=publishDate&publishDatefrom=1999&publishDateto=1999"
    assert query_spec.request_url(CONFIG | {"date_ranges": ["y"], "publishDateto": "3"}, 1, 5, facets=["f"]) == "http://api.test/search?lookfor=x&type=AllFields&page=1&limit=5&facet%5B%5D=f&daterange%5B%5D=y&publishDateto=3"
    assert query_spec.split_year(['publishDate:"2000"', "a", "year:2000"]) == (["a"], "2000")
