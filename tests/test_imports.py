"""Records and downloads of other harvests, and the exports of one."""

import hashlib
import json
from datetime import UTC, datetime

import pytest

from gleaner import collect
from gleaner.plans import schemas
from gleaner.sources import scans

CONFIG = {"endpoint": "http://api.test/search", "lookfor": "x", "type": "AllFields", "filters": [], "limit": 100}
AT = "2026-01-01T00:00:00Z"


def lines(path):
    parts = sorted(path.glob("part-*")) if path.is_dir() else [path]
    return [json.loads(x) for p in parts for x in p.read_text(encoding="utf-8").splitlines()]


def harvest(spark, folder, *ids):
    c = collect.Collector(spark, CONFIG, folder)
    now = datetime(2026, 1, 1, tzinfo=UTC)
    rows = [(i, json.dumps({"title": f"T {i}", "urls": []}), now) for i in ids]
    spark.createDataFrame(rows, schemas.RECORDS).write.mode("append").parquet(c._path("records"))
    return c


def prior(folder, *rows):
    """A folder of another harvest; each row has an id, a status and (content, url, path or None) of its files."""
    out = []
    for record, status, held in rows:
        named = []
        for content, url, path in held:
            sha = hashlib.sha256(content).hexdigest()
            at = f"raw/pdf/{sha[:2]}/{sha}.pdf"
            (folder / at).parent.mkdir(parents=True, exist_ok=True)
            (folder / at).write_bytes(content)
            named.append({"sha256": sha, "path": path or at, "bytes": len(content), "url": url})
        out.append({"record_id": record, "title": record, "status": status, "files": named, "attempts": [{"url": "http://x", "status": "pdf_obtido"}], "limited": False, "finished_at": AT})
    (folder / "raw").mkdir(parents=True, exist_ok=True)
    (folder / "raw/manifest_pdf.jsonl").write_text("".join(json.dumps(x) + "\n" for x in out), encoding="utf-8")
    return folder


def test_paths_stay_in_their_folder(spark):
    cases = {"a/b": "a/b", "a/../b": "b", "./a": "a", "../a": None, "a/../../b": None, "/a": None, "": None, "..": None, ".": None, "a\\..\\..\\b": None, "a..b/c": "a..b/c", None: None}
    df = spark.createDataFrame([(c,) for c in cases], "p string")
    assert {r.p: r.q for r in df.select("p", scans.contained("p").alias("q")).collect()} == cases


def test_downloads_are_taken_over_with_their_files(spark, tmp_path):
    c = harvest(spark, tmp_path / "run", "r1", "r2", "r3")
    one = prior(tmp_path / "one", ("r1", "sucesso", [(b"%PDF a", "http://x/a.pdf", None), (b"%PDF t", "http://x/terms-of-use.pdf", None)]), ("r2", "nao_obtido", []), ("r9", "sucesso", [(b"%PDF z", "http://x/z.pdf", None)]))
    got = c.reuse_downloads(one)
    assert got == {"sources": 1, "records_reused": 2, "file_associations": 2, "unique_files": 2, "candidate_files": 1, "site_document_files": 1, "skipped_unknown_records": 1}
    results = {r.record_id: r for r in c.results().collect()}
    assert set(results) == {"r1", "r2"} and not results["r1"].limited and results["r2"].limited
    assert c.table("archive", "sha STRING, content BINARY, prefix STRING").count() == 2
    assert c.reuse_downloads(one)["records_reused"] == 2 and c.results().count() == 2
    two = prior(tmp_path / "two", ("r1", "sucesso", [(b"%PDF other", "http://x/o.pdf", None)]), ("r3", "sucesso", [(b"%PDF a", "http://x/a.pdf", None)]))
    got = c.reuse_downloads(one, two)
    assert (got["sources"], got["records_reused"], got["file_associations"], got["unique_files"]) == (2, 3, 4, 2)
    assert [f.url for f in {r.record_id: r for r in c.results().collect()}["r1"].files] == ["http://x/a.pdf", "http://x/terms-of-use.pdf"]
    c.export()
    third = harvest(spark, tmp_path / "third", "r1", "r3")
    assert third.reuse_downloads(tmp_path / "run")["records_reused"] == 2  # from the exported manifest and the archive table


def test_wrong_files_are_errors(spark, tmp_path):
    c = harvest(spark, tmp_path / "run", "r1")
    escape = prior(tmp_path / "a", ("r1", "sucesso", [(b"%PDF a", "http://x", "../b/raw/pdf/x.pdf")]))
    with pytest.raises(ValueError, match="leaves"):
        c.reuse_downloads(escape)
    changed = prior(tmp_path / "c", ("r1", "sucesso", [(b"%PDF a", "http://x", None)]))
    next((changed / "raw/pdf").rglob("*.pdf")).write_bytes(b"other")
    with pytest.raises(ValueError, match="differs"):
        c.reuse_downloads(changed)
    with pytest.raises(ValueError):
        c.reuse_downloads(tmp_path / "none")
    assert c.results().count() == 0 and c.table("reuse_sources", schemas.REUSE_SOURCES).count() == 0


def test_import_counts_and_exports(spark, tmp_path):
    c = harvest(spark, tmp_path / "run", "r1")
    url = "http://api.test/search?lookfor=x&type=AllFields"
    for name, ids in (("a", ["r1", "r2"]), ("b", ["r2", "r3"])):
        rows = [{"record_id": i, "title": i, "urls": [], "formats": ["masterThesis"], "source_url": url} for i in ids] + [{"record_id": "n" + name, "title": "no", "urls": [], "source_url": "http://api.test/search?lookfor=other"}]
        (tmp_path / f"{name}.jsonl").write_text("".join(json.dumps(x) + "\n" for x in rows))
    got = c.import_metadata(tmp_path / "a.jsonl", tmp_path / "b.jsonl")
    counts = [(x["rows"], x["compatible"], x["rejected"], x["inserted"]) for x in got["sources"]]
    assert counts == [(3, 2, 1, 1), (3, 2, 1, 1)] and got["duplicate_records"] == 2 and (got["unique_records_before"], got["unique_records_after"]) == (1, 3)
    assert got["sources"][0]["sha256"] == hashlib.sha256((tmp_path / "a.jsonl").read_bytes()).hexdigest()
    assert c.table("record_sources", schemas.RECORD_SOURCES).where("source_sha IS NULL").count() == 0
    now = datetime(2026, 1, 1, tzinfo=UTC)
    refused = [("p", 2, 0, None, "why", '{"a": 1}', "s", now), ("p", 1, 3, "x", "why", "[2]", "s", now)]
    spark.createDataFrame(refused, schemas.REJECTIONS).write.parquet(c._path("rejections"))
    done = [("r1", "T", "sucesso", [], [], [{"dc.title": ["A", "B"]}, {}], now, False)]
    spark.createDataFrame(done, schemas.RESULTS).write.parquet(c._path("results"))
    c.export()
    run = tmp_path / "run"
    assert len(lines(run / "metadata/records.jsonl")) == 3 and lines(run / "metadata/records.jsonl")[0] == {"title": "T r1", "urls": []}
    assert [(x["page"], x["payload"]) for x in lines(run / "metadata/rejections.jsonl")] == [(1, [2]), (2, {"a": 1})]
    assert lines(run / "staging/metadata_html.jsonl") == [{"record_id": "r1", "dc.title": ["A", "B"]}, {"record_id": "r1"}]
    assert [x["record_id"] for x in lines(run / "raw/manifest_pdf.jsonl")] == ["r1"]
