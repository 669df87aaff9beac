import json

import pytest

from gleaner.sources import scans, sinks, web
from gleaner.sources.transport import Client, FetchError, Limits, wait_seconds

CONFIG = {"endpoint": "http://api.test/search", "lookfor": "x", "type": "AllFields", "filters": [], "limit": 100}
WEB = {"transport": "fake_web:transport", "interval_s": "0"}


def client(answers, **limits):
    """A client whose transport gives the listed answers by URL, each a list used up in turn."""
    log, now = [], [0.0]

    def transport(url, agent):
        log.append((url, now[0]))
        answer = answers[url].pop(0) if len(answers[url]) > 1 else answers[url][0]
        if isinstance(answer, Exception):
            raise answer
        status, headers, body = answer
        return status, headers, [body]

    def sleep(s):
        now[0] += s

    return Client("agent", transport, Limits(**limits), sleep, lambda: now[0]), log


OPEN = {"http://a/robots.txt": [(404, {}, b"")]}
OK = (200, {"content-type": "text/plain"}, b"hello")


@pytest.mark.parametrize(
    "answers,url,code",
    [
        ({}, "ftp://a/x", "url_invalida"),
        ({}, "http://user:pw@a/x", "url_invalida"),
        ({"http://a/robots.txt": [(200, {}, b"<html>")]}, "http://a/x", "robots_indisponivel"),
        ({"http://a/robots.txt": [(403, {}, b"")]}, "http://a/x", "robots_indisponivel"),
        ({"http://a/robots.txt": [(200, {}, b"User-agent: *\nDisallow: /x")]}, "http://a/x", "robots_bloqueado"),
        (OPEN | {"http://a/x": [(302, {"location": "/y"}, b"")], "http://a/y": [(302, {"location": "/x"}, b"")]}, "http://a/x", "redirect_loop"),
        (OPEN | {f"http://a/{i}": [(302, {"location": f"/{i + 1}"}, b"")] for i in range(20)}, "http://a/0", "redirect_limite"),
        (OPEN | {"http://a/x": [(410, {}, b"")]}, "http://a/x", "http_410"),
        (OPEN | {"http://a/x": [(503, {"retry-after": "100"}, b"")]}, "http://a/x", "retry_after"),
        (OPEN | {"http://a/x": [OSError("down")]}, "http://a/x", "erro_rede"),
        (OPEN | {"http://a/x": [TimeoutError("slow")]}, "http://a/x", "timeout"),
        (OPEN | {"http://a/x": [(200, {"content-length": "9"}, b"hello")]}, "http://a/x", "download_incompleto"),
        (OPEN | {"http://a/x": [(200, {}, b"x" * 200)]}, "http://a/x", "limite_arquivo"),
        (OPEN | {"http://a/x": [(200, {"content-length": "200"}, b"x" * 200)]}, "http://a/x", "limite_arquivo"),
    ],
)
def test_failures_have_codes(answers, url, code):
    c, _ = client({k: list(v) for k, v in answers.items()}, file_bytes=100)
    with pytest.raises(FetchError) as error:
        c.fetch(url)
    assert error.value.code == code


def test_retries_pacing_and_budget():
    c, log = client(OPEN | {"http://a/x": [(503, {}, b""), OSError("down"), OK]})
    assert c.fetch("http://a/x#part")["content"] == b"hello"
    times = [t for _, t in log]
    assert len(times) == 4 and all(b - a >= 1 for a, b in zip(times, times[1:]))
    slow, log = client({"http://a/robots.txt": [(200, {}, b"User-agent: *\nCrawl-delay: 7")], "http://a/x": [OK]})
    slow.fetch("http://a/x")
    slow.fetch("http://a/x")
    assert log[2][1] - log[1][1] >= 7 and len(log) == 3
    poor, _ = client(OPEN | {"http://a/x": [OK]}, budget_bytes=5)
    poor.fetch("http://a/x")
    with pytest.raises(FetchError, match="limite_execucao"):
        poor.fetch("http://a/x")
    assert wait_seconds("Thu, 01 Jan 1970 00:01:00 GMT", 0) == 60 and wait_seconds("soon", 0) is None and wait_seconds(None, 0) is None


def test_search_source_and_cache(spark):
    asked = [{"filters": ["year:2024"], "page": p} for p in (1, 2)]
    rows = web.search(spark, CONFIG, asked, **WEB).collect()
    assert len(rows) == 2 and all(json.loads(r.body)["resultCount"] == 1200 and r.status == 200 for r in rows)
    cache = spark.createDataFrame([(rows[0].url, "sha", "cached")], "url string, sha string, body string")
    again = web.search(spark, CONFIG, asked, cache, **WEB).collect()
    assert sorted(r.body == "cached" for r in again) == [False, True]


def test_fetch_source(spark):
    urls = [("a", "http://repo.test/item/0", 0), ("b", "http://repo.test/item/0", 0), ("b", "http://repo.test/none", 0), ("c", "http://other.test/x", 0)]
    rows = {(r.record_id, r.url): r for r in web.fetch(spark, urls, {"interval_s": 0.0}, **WEB).collect()}
    assert rows["a", urls[0][1]].content_type == "text/html" and rows["b", "http://repo.test/none"].error == "http_404" and len(rows) == 4


def test_scans(spark, tmp_path):
    (tmp_path / "in.jsonl").write_text('﻿{"record_id": "a", "urls": ["u"]}\n\n{"record_id": "b", "urls": []}\n', encoding="utf-8")
    assert {r.record_id for r in scans.download_input(spark, str(tmp_path / "in.jsonl")).collect()} == {"a", "b"}
    for bad in ('{"record_id": "a", "urls": []}\n' * 2, '{"urls": []}\n', '{"record_id": "a"}\n', "{"):
        (tmp_path / "bad.jsonl").write_text(bad)
        with pytest.raises(Exception):
            scans.download_input(spark, str(tmp_path / "bad.jsonl")).collect()
    (tmp_path / "log.jsonl").write_text('{"url": "a"}\nbroken\n{"url": "b"}\n')
    assert [r.url for r in scans.log(spark, str(tmp_path / "log.jsonl"), "url string").collect()] == ["a", "b"]
    assert scans.jsonl(spark, str(tmp_path / "none"), "a int").count() == 0
    assert {r.bytes for r in scans.files(spark, str(tmp_path), "log*").collect()} == {33}


def test_sinks(spark, tmp_path, monkeypatch):
    import os

    denied, replace = [1, 2], os.replace
    monkeypatch.setattr(os, "replace", lambda a, b: replace(a, b) if not denied else (_ for _ in ()).throw(PermissionError(denied.pop())))
    sinks.atomic_text(tmp_path / "x.txt", "text", pause=0)
    assert (tmp_path / "x.txt").read_text() == "text" and len(list(tmp_path.iterdir())) == 1
    df = spark.createDataFrame([(i, "v") for i in (3, 1, 2)], "k int, v string")
    sinks.jsonl(df, str(tmp_path / "out"), "k")
    lines = [x for p in sorted((tmp_path / "out").glob("part-*")) for x in p.read_text().splitlines()]
    assert [json.loads(x)["k"] for x in lines] == [1, 2, 3]
    import hashlib

    rows = spark.createDataFrame([(hashlib.sha256(c.encode()).hexdigest(), c) for c in ("a", "b", "a")], "sha string, content string")
    assert sinks.archive(rows, str(tmp_path / "store")) == 2 and sinks.archive(rows, str(tmp_path / "store")) == 0
    with pytest.raises(Exception):
        sinks.archive(spark.createDataFrame([("0" * 64, "a")], "sha string, content string"), str(tmp_path / "store"))
    assert sinks.csv_text(df.where("k = 1")) == "﻿k;v\n1;v\n"
