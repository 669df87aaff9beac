"""WARC archives: writing with revisit records, and splittable reading by boundary chains.

Writing. Each row becomes one WARC/1.1 record whose block is an HTTP response with the payload in
UTF-8. Of records with equal payloads of ``least_bytes`` or more, that with the smallest id is a
response and the others are revisits of it, without payload. Files go through Spark's committer, so
lost or repeated tasks leave no trace.

Reading. The files are split at the magic ``WARC/1.1\\r\\n``, which payloads may contain as well.
Each piece is a candidate record: its start, and the successor that its Content-Length claims. Byte
offsets are running sums of piece lengths over the splits of a file. Within a split, candidates that
claim the next one are chained; the chains' ends are then joined to their successors and followed
from each file's start by pointer jumping (log2 of the number of chains rounds). Only what is
reached is a record; a magic inside a payload is not, and its piece goes back to the record that
holds it.

Null payload is empty; a null id is written as an empty one and read as null; a null URI leaves its
header out, and control characters in URIs are percent-encoded. Rows that repeat the smallest id of
their payload are all responses. An empty table gives an empty archive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleaner.llm.workspace import joined_small, staged
from gleaner.operators.running import running_total

MAGIC = "WARC/1.1\r\n"
_BREAK = "\r\n\r\n"
_NAME = "urn:x-page:"


def write(rows: DataFrame, path: str, id_col: str, uri_col: str, payload_col: str, least_bytes: int = 100, date: str = "2000-01-01T00:00:00Z") -> None:
    """Write one record per row to text files below ``path``."""
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    made = rows.select(
        F.col(id_col).alias("id"), F.col(uri_col).alias("uri"), payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("size"), F.sha2(payload.cast("binary"), 256).alias("digest"),
    )
    # Only payloads that repeat are joined back; as few do, the payloads usually need no shuffle.
    repeated = made.where(F.col("size") >= least_bytes).groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    repeated = staged(repeated.where("n > 1").drop("n"), "repeated")
    made = joined_small(made, repeated, "digest", "left")
    revisit = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("id"))
    uri = F.regexp_replace(F.regexp_replace("uri", "\r", "%0D"), "\n", "%0A")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size").cast("string"), F.lit(_BREAK))
    header = F.concat(
        F.lit(MAGIC + "WARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit(f"\r\nWARC-Record-ID: <{_NAME}"), F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(f">\r\nWARC-Date: {date}"),
        F.coalesce(F.concat(F.lit("\r\nWARC-Target-URI: "), uri), F.lit("")),
        F.when(revisit, F.concat(
            F.lit(f"\r\nWARC-Refers-To: <{_NAME}"), F.col("first").cast("string"),
            F.lit(">\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
        )).otherwise(""),
        F.lit("\r\nWARC-Payload-Digest: sha256:"), F.col("digest"),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        (F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("size"))).cast("string"), F.lit(_BREAK),
    )
    record = F.concat(header, http, F.when(revisit, "").otherwise(F.col("payload")))
    made.select(record.alias("value")).write.option("lineSep", _BREAK).text(path)


def _field(head: Column, name: str) -> Column:
    found = F.regexp_extract(head, rf"(?im)^{name}: *([^\r\n]*)", 1)
    return F.when(found != "", found)


def _named(value: Column, kind: str) -> Column:
    """The id in a record name as ``kind``; an empty one is null."""
    name = F.regexp_extract(value, rf"^<{_NAME}(.*)>$", 1)
    return F.when(name != "", name).try_cast(kind)


def _parsed(value: str, id_type: str = "string") -> dict[str, Column]:
    """What the text after a magic says as a record; ``total`` is its claimed length with the magic."""
    parts = F.split(F.col(value), _BREAK, 3)
    head, http, rest = parts[0], F.coalesce(F.get(parts, F.lit(1)), F.lit("")), F.coalesce(F.get(parts, F.lit(2)), F.lit(""))
    length = _field(head, "Content-Length").try_cast("long")
    body = F.substring(rest.cast("binary"), F.lit(1), F.octet_length(rest) - len(_BREAK))
    return {
        "total": F.when(F.size(parts) > 1, len(MAGIC) + F.octet_length(head) + len(_BREAK) + length + len(_BREAK)),
        "type": _field(head, "WARC-Type"),
        "id": _named(_field(head, "WARC-Record-ID"), id_type),
        "refers_to": _named(_field(head, "WARC-Refers-To"), id_type),
        "uri": _field(head, "WARC-Target-URI"),
        "named_digest": F.regexp_replace(_field(head, "WARC-Payload-Digest"), "^sha256:", ""),
        "http_bytes": _field(http, "Content-Length").try_cast("long"),
        "body_bytes": length - F.octet_length(http) - len(_BREAK),
        "body_digest": F.sha2(body, 256),
    }


_FIELDS = ("type", "id", "refers_to", "uri", "named_digest", "http_bytes", "body_bytes", "body_digest")


def read(spark: SparkSession, path: str, id_type: str = "long") -> DataFrame:
    """(file, start, type, id, refers_to, uri, payload_bytes, payload_digest) of every true record; ids are of ``id_type``.

    Size and digest are those of the payload read; a revisit's are those that it names.
    """
    raw = spark.read.schema("value string").option("lineSep", MAGIC).text(path)
    raw = raw.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("ix"))
    slim = raw.withColumns(_parsed("value", id_type)).withColumn("size", F.octet_length("value").cast("long") + len(MAGIC)).drop("value")
    slim = running_total(staged(slim, "pieces"), ["file"], "split", ["ix"], "size", "end")
    slim = slim.withColumn("start", F.col("end") - len(MAGIC)).withColumn("next", F.col("start") + F.col("total")).drop("end")
    slim = staged(_chained(slim.where("start >= 0")), "candidates")
    reached = _reached(slim)
    true = slim.join(reached, ["file", "chain"]).where("start >= entry").drop("entry")
    out = true.where("total = size").select("file", "start", *_FIELDS)
    torn = staged(true.where("total > size").select("file", "start", "next"), "torn")
    if torn.limit(1).count():
        out = out.unionByName(_joined(raw, slim, true, torn, id_type).select("file", "start", *_FIELDS))
    revisit = F.col("type") == "revisit"
    return out.select(
        "file", "start", "type", "id", "refers_to", "uri",
        F.when(revisit, F.col("http_bytes")).otherwise(F.col("body_bytes")).alias("payload_bytes"),
        F.when(revisit, F.col("named_digest")).otherwise(F.col("body_digest")).alias("payload_digest"),
    )


def _chained(rows: DataFrame) -> DataFrame:
    """Add ``chain``: the start of the first candidate of a run, in a split, each of which claims the next."""
    order = Window.partitionBy("file", "split").orderBy("ix")
    begins = F.coalesce(F.lag("next").over(order) != F.col("start"), F.lit(True))
    return rows.withColumn("chain", F.when(begins, F.col("start"))).withColumn("chain", F.last("chain", ignorenulls=True).over(order))


def _reached(rows: DataFrame) -> DataFrame:
    """(file, chain, entry): the chains that lead from a file's start, and where each is entered."""
    ends = rows.groupBy("file", "chain").agg(F.max_by("next", "start").alias("next"))
    target = rows.select("file", F.col("start").alias("next"), F.col("chain").alias("to"))
    jump = staged(ends.join(target, ["file", "next"]).select("file", "chain", "to", F.col("next").alias("to_entry")), "jumps")
    found = ends.where("chain = 0").select("file", "chain", F.lit(0).cast("long").alias("entry"))
    while jump.limit(1).count():
        onward = found.join(jump, ["file", "chain"]).select("file", F.col("to").alias("chain"), F.col("to_entry").alias("entry"))
        found = staged(found.unionByName(onward), "reached")
        second = jump.select("file", F.col("chain").alias("to"), F.col("to").alias("beyond"), F.col("to_entry").alias("beyond_entry"))
        jump = staged(jump.join(second, ["file", "to"]).select("file", "chain", F.col("beyond").alias("to"), F.col("beyond_entry").alias("to_entry")), "jumps")
    return found


def _joined(raw: DataFrame, rows: DataFrame, true: DataFrame, torn: DataFrame, id_type: str) -> DataFrame:
    """Records whose payload holds the magic, put together from their pieces in a second reading."""
    marks = rows.join(true.select("file", "start", F.lit(True).alias("is_true")), ["file", "start"], "left")
    marks = marks.withColumn("own", F.when(F.col("is_true"), F.col("start")))
    order = Window.partitionBy("file", "split").orderBy("ix")
    here = F.last("own", ignorenulls=True).over(order)
    carried = marks.groupBy("file", "split").agg(F.max("own").alias("last"))
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    carried = carried.select("file", "split", F.max("last").over(earlier).alias("carried"))
    owned = marks.withColumn("here", here).join(carried, ["file", "split"])
    owned = owned.select("file", "split", "ix", "start", F.coalesce("here", "carried").alias("owner"))
    owned = owned.join(torn.select("file", F.col("start").alias("owner"), F.col("next").alias("stop")), ["file", "owner"]).where("start < stop")
    texts = raw.join(staged(owned, "owned"), ["file", "split", "ix"])
    whole = texts.groupBy("file", "owner").agg(F.array_sort(F.collect_list(F.struct("start", "value"))).alias("parts"))
    whole = whole.select("file", F.col("owner").alias("start"), F.array_join(F.col("parts.value"), MAGIC).alias("value"))
    return whole.withColumns(_parsed("value", id_type)).where(F.col("total") == F.octet_length("value") + len(MAGIC))
