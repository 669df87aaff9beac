import hashlib

from gleaner.llm import warc
from gleaner.llm.workspace import new_path


def test_round_trip(spark):
    fake = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x-page:999>\r\nContent-Length: 9\r\n\r\nHTTP/1.1 \r\n\r\n"
    long = "x" * 100
    payloads = ["", None, long, long, "y" * 99, "y" * 99, "é\r\n\r\nü", fake, fake * 3, long + "WARC/1.1\r\n", "WARC/1.1\r\n", "WARC/1.1\r\nContent-Length: 5\r\n\r\n" + "z" * 300, "\r\n\r\n" * 40, "WARC/1.1\r\n" * 200, fake * 40]
    rows = [(i, f"http://a/{i}\nb" if i % 3 else None, p, "t") for i, p in enumerate(payloads * 3)]
    rows += [(2, "again", long, "t"), (None, "none", "short", "t"), (None, "none", long, "t")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, type string")
    first = {}
    for i, _, p, _ in rows:
        if i is not None:
            first[p or ""] = min(i, first.get(p or "", i))
    want = []
    for i, _, p, _ in rows:
        data = (p or "").encode()
        again = len(data) >= 100 and i != first[p or ""]
        want.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first[p or ""] if again else None))
    for parts, split in ((1, "100m"), (3, "100m"), (2, "1000b"), (1, "517b")):
        path = new_path(spark, "warc")
        warc.write(pages.repartition(parts), path, "page_id", "url", "html")
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", "10")
        try:
            got = [(r.id, r.payload_bytes, r.payload_digest, r.type, r.refers_to) for r in warc.read(spark, path).collect()]
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
        assert sorted(map(str, got)) == sorted(map(str, want)), (parts, split)


def test_empty(spark):
    path = new_path(spark, "warc")
    warc.write(spark.createDataFrame([], "page_id long, url string, html string"), path, "page_id", "url", "html")
    assert warc.read(spark, path).count() == 0


def test_ids_that_are_strings(spark):
    from gleaner.llm.workspace import new_path

    rows = [("a>b", "http://x", "p" * 200), ("é", None, "p" * 200), (None, "http://y", None), ("7", "http://z", "x WARC/1.1\r\n y")]
    path = new_path(spark, "warc")
    warc.write(spark.createDataFrame(rows, "page string, url string, html string"), path, "page", "url", "html")
    got = {r.id: (r.type, r.refers_to, r.payload_bytes) for r in warc.read(spark, path, "string").collect()}
    assert got == {"a>b": ("response", None, 200), "é": ("revisit", "a>b", 200), None: ("response", None, 0), "7": ("response", None, 14)}
