from datetime import UTC, datetime

import pytest

from gleaner import batches, collect
from gleaner.plans import schemas
from gleaner.sources import sinks
from gleaner.streaming import commit as commits

CONFIG = {"endpoint": "http://api.test/search", "lookfor": "x", "type": "AllFields", "filters": [], "limit": 100}
WEB = {"transport": "fake_web:transport", "interval_s": "0"}


def test_algebra_plan_and_harvest(spark, tmp_path):
    c = collect.Collector(spark, CONFIG, tmp_path / "run", **WEB)
    report = c.validate()
    assert report["root"] == 1260 and report["year"] == "1997" and report["no_year"] == 5 and report["valid"]
    c.plan()
    c.plan()
    parts = {r.label: r for r in c.partitions().collect()}
    assert [parts[k].priority for k in ("2024", "1997", "other years", "no year")] == [0, 1, 2, 3]
    assert c.harvest_one()
    parts = {r.label: r for r in c.partitions().collect()}
    assert parts["2024"].status == "split" and {"2024 / X", "2024 / Y", "2024 / other institutions"} < parts.keys()
    c._put([r.asDict() | {"status": "complete"} for r in parts.values() if r.label not in ("2024 / Y", "no year", "2024")])
    steps = 0
    while c.harvest_one():
        steps += 1
    assert steps == 5
    again = collect.Collector(spark, CONFIG, tmp_path / "run", **WEB)
    assert not again.harvest_one()
    assert again.table("records", schemas.RECORDS).count() == 399 + 5
    assert [r.reason for r in again.table("rejections", schemas.REJECTIONS).collect()] == ["titulo_ausente_e_sem_url_utilizavel"]
    with pytest.raises(ValueError):
        collect.Collector(spark, CONFIG | {"lookfor": "y"}, tmp_path / "run")

    n = again.download(datetime(2026, 1, 1, tzinfo=UTC), limits={"interval_s": 0.0}, most=1000)
    assert n == 404
    got = {r.record_id: r for r in again.results().where("size(files) > 0").collect()}
    assert got["r00000"].status == "sucesso" and {f.url for f in got["r00000"].files} == {"http://repo.test/file/0.pdf", "http://repo.test/file/same.pdf"}
    assert again.candidates() == 2 * len(got) - (len(got) - 1)
    assert again.download(datetime(2026, 1, 1, 1, tzinfo=UTC), limits={"interval_s": 0.0}) == 0
    assert again.download(datetime(2026, 1, 3, tzinfo=UTC), limits={"interval_s": 0.0}, most=5) == 5
    report = again.report("meta_atingida")
    assert report["records"] == 404 and report["split"] == 1 and report["candidate_unique_pdfs"] == again.candidates()


def page(n, body, sha="s"):
    return ("p", n, f"http://api/{n}", sha, body, datetime(2026, 1, 1, tzinfo=UTC))


def test_page_commits_are_exactly_once(spark, tmp_path):
    folder = str(tmp_path)
    body = '{"status":"OK","resultCount":3,"records":[{"id":"a","title":"A"},{"id":"b","title":null,"urls":[{"url":"http://x"}]},{"title":"no id"},{"id":"c","title":null}]}'
    other = '{"status":"OK","resultCount":3,"records":[{"id":"a","title":"changed"},{"id":"d","title":"D"}]}'
    bad = '{"status":"ERROR"}'
    pages = spark.createDataFrame([page(1, body), page(2, other, "t"), page(3, bad, "u"), page(4, '{"status":"OK","resultCount":true,"records":[]}', "v")], commits.PAGE_INPUT)
    count = lambda name, schema: commits.stored(spark, f"{folder}/{name}", schema).count()
    tables = {"records": schemas.RECORDS, "rejections": schemas.REJECTIONS, "conflicts": schemas.CONFLICTS, "record_partitions": schemas.RECORD_PARTITIONS, "pages": schemas.PAGES, "invalid": "url string, category string"}
    assert commits.commit(pages, folder) == 2
    want = {"records": 3, "rejections": 2, "conflicts": 1, "record_partitions": 3, "pages": 2, "invalid": 2}
    assert {k: count(k, s) for k, s in tables.items()} == want
    assert commits.commit(pages, folder) == 0
    assert {k: count(k, s) for k, s in tables.items()} == want
    with pytest.raises(commits.ChangedPage):
        commits.commit(spark.createDataFrame([page(1, body, "new")], commits.PAGE_INPUT), folder)


def test_streamed_commits(spark, tmp_path):
    body = '{"status":"OK","resultCount":1,"records":[{"id":"a","title":"A"}]}'
    spark.createDataFrame([page(1, body)], commits.PAGE_INPUT).write.json(str(tmp_path / "inbox"))
    for _ in range(2):
        commits.stream(spark, str(tmp_path / "inbox"), str(tmp_path / "state"), str(tmp_path / "check")).awaitTermination(120)
    assert commits.stored(spark, str(tmp_path / "state/pages"), schemas.PAGES).count() == 1
    spark.createDataFrame([page(2, body.replace('"a"', '"b"'), "t")], commits.PAGE_INPUT).write.mode("append").json(str(tmp_path / "inbox"))
    commits.stream(spark, str(tmp_path / "inbox"), str(tmp_path / "state"), str(tmp_path / "check")).awaitTermination(120)
    assert commits.stored(spark, str(tmp_path / "state/records"), schemas.RECORDS).count() == 2


def test_cooldown_stream(spark, tmp_path):
    from gleaner.streaming.cooldown import tracked

    rows = [("o", 10, 429, 3_600_000_000), ("o", 5, 200, 0), ("p", 10, 429, 60), ("p", 20, 200, 0), ("q", 1, 500, 0)]
    spark.createDataFrame(rows, "origin string, ts_us long, status int, wait_us long").coalesce(1).write.json(str(tmp_path / "log"))
    log = spark.readStream.schema("origin string, ts_us long, status int, wait_us long").json(str(tmp_path / "log"))
    q = tracked(log).writeStream.format("memory").queryName("cooldown").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert {(r.origin, r.change) for r in spark.table("cooldown").collect()} == {("o", "blocked"), ("p", "blocked"), ("p", "cleared")}


def test_packing(spark, tmp_path):
    file = lambda k, n, url="http://a/w.pdf": (k * 64, f"raw/pdf/{k}.pdf", n, url, "pdf")
    rows = [("r1", [file("a", 60), file("b", 50)]), ("r2", [file("b", 50)]), ("r3", [file("c", 30), file("d", 5, "http://a/terms-of-use.pdf")])]
    shape = f"record_id STRING, files ARRAY<{schemas.FILE}>"
    results = spark.createDataFrame(rows, shape)
    metadata = spark.createDataFrame([(r, "{}") for r, _ in rows] + [("r4", "{}")], "record_id string, payload string")
    packer = sinks.Packer(spark, tmp_path / "batches", 100)
    assert packer.close_all(results, metadata) == [1]
    assert {r.sha[0] for r in packer.files().collect()} == {"a", "b"}
    assert packer.close_all(results, metadata, force=True) == [2] and packer.close_all(results, metadata, force=True) == []
    assert packer.verify_all() == [True, True]
    late = spark.createDataFrame([*rows, ("r4", [file("a", 60)])], shape)
    packer.inventory(late)
    assert [(r.record_id, r.batch_number) for r in packer.associations().where("NOT included_in_batch").collect()] == [("r4", 1)]
    plan = packer.transfer_plan(tmp_path / "plan.json")
    assert plan["total_pdfs"] == 3 and (tmp_path / "plan.csv").read_text(encoding="utf-8").startswith("﻿batch_number;")
    packer.mark_transferred(1, "tape", tmp_path / "plan.json")
    assert {r.sha[0] for r in packer.archived().collect()} == {"a", "b"}
    (tmp_path / "batches/batch-0002/metadata/extra.json").write_text("x")
    with pytest.raises(ValueError):
        packer.verify(tmp_path / "batches/batch-0002")
    with pytest.raises(ValueError):
        packer.mark_transferred(9, "tape", tmp_path / "plan.json")
    (tmp_path / "batches/.building-0003").mkdir()
    again = sinks.Packer(spark, tmp_path / "batches", 100)
    assert list((tmp_path / "batches").glob(".incomplete-0003-*")) and again.batches().count() == 2
    with pytest.raises(Exception):
        packer.close_ready(spark.createDataFrame([("r9", [file("e", 500)])], shape), metadata)


def test_command_lines(spark, tmp_path):
    with pytest.raises(SystemExit):
        collect.arguments(["--contact", "nobody", "--config", "c.json"])
    with pytest.raises(SystemExit):
        collect.arguments(["--contact", "a@b.org", "--config", "c.json", "--target-pdfs", "9999"])
    assert collect.arguments(["--contact", "a@b.org", "--config", "c.json"]).max_hours == 8
    assert batches.main(["--data-dir", str(tmp_path)], spark) == 0
    assert batches.main(["--data-dir", str(tmp_path), "--verify"], spark) == 0
    with pytest.raises(SystemExit):
        batches.main(["--data-dir", str(tmp_path), "--mark-transferred", "1"], spark)
