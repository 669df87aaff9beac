import math
import random

import numpy as np
from pyspark.sql import functions as F

from gleaner.llm import urls
from gleaner.llm.queries import URL_RULES


def brute(url):
    if not url or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        cut = min([i for i in map(rest.find, "/?#") if i >= 0], default=len(rest))
        host, rest = rest[:cut], rest[cut:]
        path = rest[: min([i for i in map(rest.find, "?#") if i >= 0], default=len(rest))]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = []
    for r in URL_RULES:
        name, _, start = r.text.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + start):
            fits.append(r)
    best = max(fits, key=lambda r: len(r.text), default=None)
    return host, path, best and best.text, best and best.verdict


def test_rules(spark):
    cases = [None, "", "no scheme", "http://", "https://A.Example.COM/en/71?x#y", "http://com/en/", "http://xcom/en/", "x://example.net/de/8", "http://a.net/de/",
             "http://b.example.com/en/x", "http://o.org/es/?q=1&r=2", "http://o.org?/es/", "http://É.NET/de/a\nb", "a://b://c/d", "http://u:p@h.com:80/en/"]
    df = spark.createDataFrame([(i, u, "mine", 1.5) for i, u in enumerate(cases)] + [(1, "", "mine", 1.5)], "page_id int, url string, host string, score double")
    out = urls.filtered(df, URL_RULES).collect()
    assert len(out) == len(cases) + 1
    for r in out:
        host, path, rule, verdict = brute(cases[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if rule else r.verdict in ("allow", "block")
    assert urls.filtered(df.where("false"), URL_RULES).count() == 0
    assert {r.verdict for r in urls.filtered(df.where("page_id < 3"), URL_RULES).collect()} == {"allow"}


def test_held_out_accuracy(spark):
    rng = random.Random(5)
    rows = []
    for i in range(2000):
        bad = rng.random() < 0.4
        host = rng.choice(["spam.biz", "win.top", "shop.org"] if bad else ["news.org", "uni.edu", "shop.org"])
        tail = "/".join("%x" % rng.getrandbits(40 if bad else 8) for _ in range(rng.randint(2, 5) if bad else rng.randint(1, 3)))
        rows.append((i, f"http://{host}/{tail}" + ("?a=1&b=2" if bad and rng.random() < 0.5 else ""), int(bad)))
    df = spark.createDataFrame(rows, "id int, url string, blocked int")
    out = urls.filtered(df.where("id >= 1000"), [], df.where("id < 1000")).collect()
    right = np.mean([(r.verdict == "block") == bool(r.blocked) for r in out])
    assert len(out) == 1000 and right > 0.93
    assert sorted(map(str, out)) == sorted(map(str, urls.filtered(df.where("id >= 1000").repartition(3), [], df.where("id < 1000").repartition(2)).collect()))


def test_columns_with_the_names_of_features(spark):
    rows = [(1, "http://a.example.com/en/1", 5, 6, 7, "s"), (2, None, 5, 6, 7, "s")]
    df = spark.createDataFrame(rows, "page_id int, url string, depth int, rate_1 int, labels int, suffix_1 string")
    out = urls.filtered(df, [urls.Rule("block", "com/en/")])
    assert out.columns == [*df.columns, "host", "path", "rule", "verdict", "score"]
    assert sorted(tuple(r)[:6] for r in out.collect()) == rows


def test_rates_leave_out_the_fold_of_the_row(spark):
    rng = random.Random(2)
    rows = [(f"http://h{i}.{rng.choice(['org', 'net', 'x.org'])}/", rng.randint(0, 1), i % urls.FOLDS) for i in range(200)]
    df = spark.createDataFrame(rows, "url string, blocked int, fold long")
    df = df.withColumn("host", urls.host_path(F.col("url"))[0]).withColumns({f"suffix_{k}": F.substring_index("host", ".", -k) for k in (1, 2)})
    all_rows = [r.asDict() for r in df.collect()]
    mean = sum(r["blocked"] for r in all_rows) / len(all_rows)
    for apart in (True, False):
        for r in urls._with_rates(df, df, out_of_fold=apart).collect():
            for k in (1, 2):
                same = [x["blocked"] for x in all_rows if x[f"suffix_{k}"] == r[f"suffix_{k}"] and not (apart and x["fold"] == r["fold"])]
                assert math.isclose(r[f"rate_{k}"], (sum(same) + 10 * mean) / (len(same) + 10))


def test_the_score_expression_matches_the_trees(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(400, len(urls.FEATURES)))
    y = (x[:, 0] * x[:, 3] + x[:, 5] > 0.2).astype(float)
    trees = urls.Trees().fit(x, y)

    def plain(row):
        total = trees.start
        for node in trees.roots:
            while not isinstance(node, float):
                node = node[2] if row[node[0]] <= node[1] else node[3]
            total += node
        return total

    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], ["i", *urls.FEATURES])
    got = {r.i: r.s for r in df.select("i", trees.score(urls.FEATURES).alias("s")).collect()}
    assert all(math.isclose(got[i], plain(r), abs_tol=1e-9) for i, r in enumerate(x))
    assert np.mean([(got[i] > 0) == bool(y[i]) for i in range(400)]) > 0.95
