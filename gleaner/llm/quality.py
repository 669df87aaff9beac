"""Quality rules with host-level verdicts.

Every document is measured once. Failures of each rule are summed by host (a document's ``source``);
an empirical beta prior, fitted to all hosts by moments, shrinks the failure rates of small hosts
towards the corpus rate; a host whose shrunken rate of any rule is above that rule's limit is
rejected with all its documents. The shrunken rate is the chance that a document of the host fails, so
the limits are one half: beyond it a document of the host is more likely bad than good. Documents
without a host are judged by the base rule alone.

Null text has no words and so fails the base rule; empty and blank texts likewise. Repeated rows are
measured and returned one by one. A long text is measured whole, in memory of some ten times its
size. Columns besides the three named ones are not read and may have any name. An empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.llm.workspace import alone, joined_small, staged

_SPACE = b" \t\n\x0b\x0c\r"
_SYMBOLS = b"#*$%&|<>"
_NOT_IN_WORDS = _SPACE + bytes(range(0x80, 0xC0))  # white space and UTF-8 continuation bytes

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """A condition on the measures and the share of a host's documents that may meet it."""

    name: str
    fails: str
    most: float


RULES = (
    Rule("base", "n_words < 50 OR 100 * n_repeat_words > 50 * n_words", 0.5),
    Rule("symbols", "10 * n_symbols > n_words", 0.5),
    Rule("lines", "20 * n_dup_lines > n_words", 0.5),
    Rule("word_length", "word_chars < 3 * n_words OR word_chars > 12 * n_words", 0.5),
)


def measure(text: bytes) -> tuple[int, int, int, int, int]:
    """The measures of one text, in the order of ``MEASURES``."""
    words = text.split()  # splits bytes at exactly space and \t to \r
    lines = [x for x in text.split(b"\n") if x.strip()]
    n_symbols = len(text) - len(text.translate(None, _SYMBOLS))
    return len(words), len(text.translate(None, _NOT_IN_WORDS)), n_symbols, len(lines) - len(set(lines)), _repeated(words)


def _repeated(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found at least twice."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    times = Counter(windows)
    covered, upto = 0, 0
    for i, w in enumerate(windows):
        if times[w] > 1:
            covered += i + 3 - max(i, upto)
            upto = i + 3
    return covered


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """(id, host, measures) of every row."""
    from pyspark.sql.types import LongType, StructField, StructType

    slim = docs.select(F.col(id_col).alias("id"), F.col(host_col).cast("string").alias("host"), F.col(text_col).cast("binary").alias("text"))
    schema = StructType([slim.schema["id"], slim.schema["host"], *(StructField(m, LongType()) for m in MEASURES)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [measure(t.as_py() or b"") for t in batch.column("text")]
            columns = [pa.array([x[k] for x in found], pa.int64()) for k in range(len(MEASURES))]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("host"), *columns], ["id", "host", *MEASURES])

    return slim.mapInArrow(run, schema)


def host_verdicts(measures: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(host, host_docs, rate_<rule>..., host_rejected): failure rates by host, shrunk by a beta prior.

    With k of n documents failing, the corpus rate m and between-host variance v (that of the hosts'
    rates less what chance gives), the prior is Beta(m s, (1 - m) s), s = m (1 - m) / v - 1, and the
    shrunken rate (k + m s) / (n + s). Rows without a host are left out.
    """
    failed = [F.sum(F.expr(f"CAST({r.fails} AS BIGINT)")).alias(f"k_{r.name}") for r in rules]
    hosts = measures.where("host IS NOT NULL").groupBy("host").agg(F.count("*").alias("host_docs"), *failed)
    k, n = (lambda r: F.col(f"k_{r.name}")), F.col("host_docs")
    corpus = hosts.agg(
        F.sum(n).alias("docs"),
        F.count("*").alias("hosts"),
        *(F.sum(k(r)).alias(f"all_{r.name}") for r in rules),
        *(F.sum(k(r) * k(r) / n).alias(f"square_{r.name}") for r in rules),
    )
    rate = {r.name: _shrunk(r) for r in rules}
    rejected = F.lit(False)
    for r in rules:
        rejected = rejected | (F.col(f"rate_{r.name}") > F.lit(r.most))
    return (
        hosts.join(F.broadcast(corpus))  # one row
        .withColumns({f"rate_{name}": x for name, x in rate.items()})
        .withColumn("host_rejected", rejected)
        .select("host", "host_docs", *(f"rate_{r.name}" for r in rules), "host_rejected")
    )


def _shrunk(rule: Rule) -> Column:
    docs, k, n = F.col("docs"), F.col(f"k_{rule.name}"), F.col("host_docs")
    m = F.col(f"all_{rule.name}") / docs
    chance = m * (1 - m) * F.col("hosts") / docs
    between = F.greatest(F.col(f"square_{rule.name}") / docs - m * m - chance, F.lit(1e-9))
    strength = F.greatest(m * (1 - m) / between - 1, F.lit(1.0))
    return (k + m * strength) / (n + strength)


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(id, measures, base_failed, host_rejected, kept) of every row. ``rules[0]`` also binds documents.

    The measures are staged, as both the host rates and the rows need them; one row per host is
    joined back, broadcast only if there are few hosts.
    """
    rows = staged(measured(docs, id_col, text_col, host_col), "quality")
    verdicts = staged(host_verdicts(rows, rules).select("host", "host_rejected"), "hosts")
    out = joined_small(rows, verdicts, "host", "left")
    base = F.expr(rules[0].fails)
    return out.select(
        F.col("id").alias(id_col),
        *MEASURES,
        base.alias("base_failed"),
        F.coalesce("host_rejected", F.lit(False)).alias("host_rejected"),
        (~base & ~F.coalesce("host_rejected", F.lit(False))).alias("kept"),
    )


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their own columns.

    Only the names of rows that fail travel, their ids, hosts and hashes of texts: they are few, so a
    small set is broadcast and the texts stay where they are. Rows that share an id are judged apart.
    """
    named = docs.withColumn("_row", F.struct(F.col(id_col).alias("id"), F.col(host_col).alias("host"), F.xxhash64(text_col).alias("text")))
    bad = alone(lambda: judged(named, "_row", text_col, host_col, rules).where("NOT kept").select(F.col("_row").alias("_bad")).distinct(), "rejected")
    return joined_small(named, bad, F.col("_row") == F.col("_bad"), "left_anti").drop("_row")
