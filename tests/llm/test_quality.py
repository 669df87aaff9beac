from collections import defaultdict

from pyspark.sql import functions as F

from gleaner.llm import quality


def brute(text):
    import re

    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    where = defaultdict(list)
    for i in range(len(words) - 2):
        where[tuple(words[i : i + 3])].append(i)
    covered = {i + k for at in where.values() if len(at) > 1 for i in at for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))


CASES = ["a b c a b c a", "", None, " \n\t ", "é#ü x\ny z\ny z \ny z", "a a a a a", "one two", "w " * 5000, "a|b\n\na|b\n x\x1cy <>"]


def test_measures_match_brute_force():
    for text in CASES:
        assert quality.measure((text or "").encode()) == brute(text)


def test_verdicts(spark):
    good = " ".join(f"word{i}" for i in range(60))
    rows = [(i, good if i % 10 else "short", "fine") for i in range(40)] + [(100 + i, "short" if i < 35 else good, "bad") for i in range(40)]
    rows += [(200, good, None), (201, None, None), (202, good, "bad"), (202, good, "bad")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 AS kept", "'x' AS host")
    out = {r.doc_id: r for r in quality.judged(docs).collect()}
    assert out[1].kept and not out[0].kept and out[0].base_failed
    assert out[139].host_rejected and not out[139].kept and not out[139].base_failed
    assert out[200].kept and not out[201].kept and out[201].n_words == 0
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i in range(40) if i % 10} | {200}
    assert quality.judged(docs).where("doc_id = 202").count() == 2
    assert quality.judged(docs.where("false")).count() == 0


def test_rows_of_one_id_are_judged_apart(spark):
    good = " ".join(f"word{i}" for i in range(60))
    rows = [(None, good, "a"), (None, "short", "a"), (None, None, "a"), (1, good, "a"), (1, "short", "a"), (2, good, None)]
    rows += [(3 + i, good, "a") for i in range(5)]  # else most of the host's documents fail, and it goes as a whole
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert sorted(map(str, quality.keep_good(docs).collect())) == sorted(map(str, docs.where(F.col("text") == good).collect()))


def test_a_host_is_rejected_when_over_half_of_its_documents_fail(spark):
    good = " ".join(f"word{i}" for i in range(60))
    junk = good + " #" * 20
    rows = [(i, good, "fine") for i in range(200)] + [(1000 + i, junk if i % 20 < 13 else good, "symbols") for i in range(200)]
    rows += [(2000 + i, junk if i % 10 < 4 else good, "below") for i in range(200)]
    out = quality.judged(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert all(r.host_rejected == (1000 <= r.doc_id < 2000) for r in out)
