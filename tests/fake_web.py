"""A simulated search API and repository, used as a transport by name."""

import json
from urllib.parse import parse_qs, urlsplit

PDF = b"%PDF-1.7 body of "
END = b" %%EOF\n"


def corpus():
    rows = []
    for i in range(1260):
        year = "2024" if i < 1200 else ("1997" if i < 1220 else ("1990" if i < 1255 else None))
        urls = [{"url": f"http://repo.test/item/{i}"}] if i % 400 == 0 else []
        rows.append({"id": f"r{i:05d}", "title": f"Work {i}", "urls": urls, "year": year, "institution": "X" if i % 3 else "Y"})
    rows[3] = {"id": "r00003", "title": None, "urls": [], "year": "2024", "institution": "Y"}
    rows[4] = {"id": "r00004", "title": None, "urls": [{"url": "http://repo.test/item/0"}], "year": "2024", "institution": "X"}
    return rows


def keeps(row, f):
    negative, f = f.startswith("-"), f.removeprefix("-")
    field, _, value = f.partition(":")
    got = row["year"] if field == "publishDate" else row[field]
    hit = got is not None if value == "[* TO *]" else got == value.strip('"')
    return hit != negative


def transport(url, agent):
    p = urlsplit(url)
    if p.path == "/robots.txt":
        return 404, {}, [b""]
    if p.netloc == "api.test":
        q = parse_qs(p.query)
        rows = [r for r in corpus() if all(keeps(r, f) for f in q.get("filter[]", []))]
        if "publishDatefrom" in q:
            rows = [r for r in rows if r["year"] == q["publishDatefrom"][0]]
        page, limit = int(q["page"][0]), int(q["limit"][0])
        start = (min(page, 10) - 1) * limit
        body = {"status": "OK", "resultCount": len(rows), "records": rows[start : start + limit]}
        if "facet[]" in q:
            years = {"2024": 1200, "1997": 20}
            body["facets"] = {"publishDate": [{"value": k, "count": v} for k, v in years.items()], "institution": [{"value": k, "count": sum(r["institution"] == k for r in corpus())} for k in ("X", "Y")]}
        return 200, {"content-type": "application/json"}, [json.dumps(body).encode()]
    if p.path.startswith("/item/"):
        n = p.path.rpartition("/")[2]
        html = f'<meta name="citation_pdf_url" content="/file/{n}.pdf"><a href="/file//{n}.pdf">x</a><a href="/file/same.pdf">y</a><a href="/terms-of-use.pdf">z</a>'
        return 200, {"content-type": "text/html; charset=utf-8"}, [html.encode()]
    if p.path.startswith("/file/"):
        return 200, {"content-type": "application/pdf"}, [PDF, p.path.encode(), END]
    return 404, {}, [b""]
