"""Cooldowns, retries and pacing. Clocks are parameters, so results can be repeated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def retry_after(raw: Column, now: Column, fallback_s: float = 3600.0) -> tuple[Column, Column]:
    """(seconds, source) of a Retry-After header: a number, an HTTP date, or the fallback.

    The weekday of a date is cut off, as date patterns cannot read it.
    """
    raw = F.trim(F.coalesce(raw, F.lit("")))
    number = raw.try_cast("double")
    date = F.try_to_timestamp(F.regexp_replace(raw, r"^[A-Za-z]+, *", ""), F.lit("dd MMM yyyy HH:mm:ss z"))
    until = (F.unix_micros(date) - F.unix_micros(now)) / 1e6
    seconds = F.when(raw == "", fallback_s).when(number.isNotNull(), number).when(date.isNotNull(), until).otherwise(fallback_s)
    source = F.when(raw == "", "client_policy_no_retry_after").when(number.isNull() & date.isNull(), "client_policy_invalid_retry_after").otherwise("server_retry_after")
    return F.greatest(seconds, F.lit(0.0)), source


def backoff(wait: Column, attempt: Column, base: float, jitter: Column | None = None, most: float | None = None) -> Column:
    """max(wait, base 2^attempt + jitter), at most ``most``."""
    out = F.greatest(wait, F.lit(base) * F.pow(F.lit(2.0), attempt) + (F.rand() if jitter is None else jitter))
    return out if most is None else F.least(out, F.lit(most))


def cooldowns(log: DataFrame, origin: str, ts: str, is_block: Column, is_success: Column, fallback_s: int, as_of: Column) -> DataFrame:
    """(origin, last_block, last_success, blocked_until, active): the state that a log of requests leaves.

    A success later than the last block clears it; an older one does not.
    """
    out = log.groupBy(origin).agg(F.max(F.when(is_block, F.col(ts))).alias("last_block"), F.max(F.when(is_success, F.col(ts))).alias("last_success"))
    out = out.withColumn("blocked_until", F.col("last_block") + F.make_dt_interval(secs=F.lit(fallback_s)))
    clear = F.coalesce(F.col("last_success") > F.col("last_block"), F.lit(False))
    return out.withColumn("active", F.coalesce(~clear & (F.col("blocked_until") > as_of), F.lit(False)))


def retry_eligible(status: Column, valid: Column, limited: Column, finished_at: Column, as_of: Column, retry_s: int) -> Column:
    """skip, wait or retry: finished works stay, others wait until the retry interval has passed; no date retries."""
    age = (F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(finished_at.cast("timestamp"))) / 1e6
    return F.when((status == "sucesso") & valid & ~limited, "skip").when(F.coalesce(age < retry_s, F.lit(False)), "wait").otherwise("retry")


def paced(requests: DataFrame, host: str, arrival_us: str, tie: str, delay_us: int) -> DataFrame:
    """Add start_us: when each request may start if a host's requests keep ``delay_us`` apart.

    start_i = max(arrival_i, start_(i-1) + delay) has the closed form i delay + max over k <= i of
    (arrival_k - k delay), a window over the requests of one host.
    """
    order = Window.partitionBy(host).orderBy(arrival_us, tie)
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    i = F.row_number().over(order) - 1
    rows = requests.withColumn("_i", i).withColumn("_slack", F.col(arrival_us) - F.col("_i") * delay_us)
    return rows.withColumn("start_us", (F.col("_i") * delay_us + F.max("_slack").over(upto)).cast("long")).drop("_i", "_slack")


def matching_raw(log: DataFrame, raw: DataFrame, slack_us: int = 2_000_000) -> DataFrame:
    """Log events joined to raw files of equal size written within ``slack_us`` of them (a band join).

    The band is cut into cells of its width, so the join is an equi-join on size and cell; ``log`` has
    url, ts and bytes, ``raw`` has sha, modified and bytes.
    """
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    a = log.withColumn("_t", micros("ts")).withColumn("_cell", F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda d: F.floor(F.col("_t") / slack_us) + d)))
    b = raw.withColumn("_u", micros("modified")).withColumn("_cell", F.floor(F.col("_u") / slack_us))
    near = a.join(b, ["bytes", "_cell"]).where(F.abs(F.col("_t") - F.col("_u")) <= slack_us)
    return near.drop("_cell", "_t", "_u")
