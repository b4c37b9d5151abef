"""Ad-click statistics as batch operators.

The same functions run on a static DataFrame (batch twin, checked against
SQL) and inside ``foreachBatch`` of the ad stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

AD_LOG_FIELDS = ["epoch_ms", "province", "city", "user_id", "ad_id"]


def parse_ad_log(lines: DataFrame, value_column: str = "value") -> DataFrame:
    """Text lines ``epoch_ms province city user_id ad_id`` (one space apart)
    to typed columns. Lines without exactly five fields, with a field that does
    not parse or with a time outside the years 1 to 9999 are left out, never an
    error; ``ad_line_counts`` counts them."""
    return ad_lines(lines, value_column).where("ok").drop("ok", "value")


def ad_line_counts(lines: DataFrame, value_column: str = "value") -> DataFrame:
    """One row: lines, parsed lines and bad lines."""
    return ad_lines(lines, value_column).agg(
        F.count("*").alias("n_lines"), F.count_if("ok").alias("n_parsed"), F.count_if(~F.col("ok")).alias("n_bad"))


# fixed values: first and last millisecond of the years 1 to 9999
_FIRST_MS, _LAST_MS = -62_135_596_800_000, 253_402_300_799_999


def ad_lines(lines: DataFrame, value_column: str = "value") -> DataFrame:
    """Every line with its typed columns, its text ``value`` and whether it is ``ok``."""
    parts = F.split(F.trim(F.col(value_column)), " ")
    ok = F.size(parts) == 5
    ms = F.get(parts, F.lit(0)).try_cast("bigint")
    ms = F.when(ms.between(_FIRST_MS, _LAST_MS), ms)
    parsed = lines.select(
        F.col(value_column).alias("value"),
        ok.alias("ok"),
        F.timestamp_millis(ms).alias("ts"),
        F.get(parts, F.lit(1)).alias("province"),
        F.get(parts, F.lit(2)).alias("city"),
        F.get(parts, F.lit(3)).try_cast("bigint").alias("user_id"),
        F.get(parts, F.lit(4)).try_cast("bigint").alias("ad_id"),
    )
    good = (
        F.col("ok")
        & F.col("ts").isNotNull()
        & F.col("user_id").isNotNull()
        & F.col("ad_id").isNotNull()
        & (F.col("province") != "")
        & (F.col("city") != "")
    )
    return parsed.withColumn("ok", F.coalesce(good, F.lit(False)))


def with_time_keys(clicks: DataFrame) -> DataFrame:
    """Add ``date`` (yyyy-MM-dd), ``hour`` (HH) and ``minute`` (mm) (once)."""
    if "date" in clicks.columns:
        return clicks
    return clicks.select(
        "*",
        F.date_format("ts", "yyyy-MM-dd").alias("date"),
        F.date_format("ts", "HH").alias("hour"),
        F.date_format("ts", "mm").alias("minute"),
    )


def drop_blacklisted(clicks: DataFrame, blacklist: DataFrame) -> DataFrame:
    """Clicks of users not on the list (left anti join on user id)."""
    return clicks.join(blacklist.select("user_id"), "user_id", "left_anti")


def ad_user_click_count(clicks: DataFrame) -> DataFrame:
    """Per (date, user, ad): clicks."""
    return with_time_keys(clicks).groupBy("date", "user_id", "ad_id").agg(F.count(F.lit(1)).alias("click_count"))


def ad_blacklist(counts: DataFrame, threshold: int) -> DataFrame:
    """Users with some (date, user, ad) count reaching ``threshold``."""
    if threshold is None:
        raise ValueError("a blacklist threshold is required")
    return counts.where(F.col("click_count") >= F.lit(threshold)).select("user_id").distinct()


def ad_stat(clicks: DataFrame) -> DataFrame:
    """Per (date, province, city, ad): clicks."""
    return with_time_keys(clicks).groupBy("date", "province", "city", "ad_id").agg(
        F.count(F.lit(1)).alias("click_count")
    )


def ad_province_top3(stat: DataFrame, n: int = 3) -> DataFrame:
    """Per (date, province) the ``n`` ads with most clicks (ties by ad id),
    from the per-city stat rolled up to provinces."""
    return top_per_province(stat.groupBy("date", "province", "ad_id").agg(F.sum("click_count").cast("bigint").alias("click_count")), n)


def top_per_province(totals: DataFrame, n: int = 3) -> DataFrame:
    """The ``n`` ads with most clicks of every (date, province), ties by ad id, from
    totals per (date, province, ad)."""
    w = Window.partitionBy("date", "province").orderBy(F.desc("click_count"), F.asc("ad_id"))
    return totals.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= n).drop("rn")


def ad_click_trend(clicks: DataFrame) -> DataFrame:
    """Per (date, hour, minute, ad): clicks."""
    return with_time_keys(clicks).groupBy("date", "hour", "minute", "ad_id").agg(
        F.count(F.lit(1)).alias("click_count")
    )


def ad_click_trend_window(clicks: DataFrame, length: str, slide: str | None = None) -> DataFrame:
    """Clicks per ad in event-time windows of ``length`` sliding by ``slide``
    (``window()`` semantics: windows aligned to the epoch, only windows that
    hold a click are returned).

    Clicks are first counted per (slide slot, ad) with partial aggregation;
    only these small per-slot rows are expanded to the ``length / slide``
    windows containing them, so raw clicks are never multiplied by the
    number of windows. A streaming input uses Spark's stateful ``window()``
    aggregation instead (one aggregation per streaming query).
    """
    slide = slide or length
    if clicks.isStreaming or None in (_seconds(length), _seconds(slide)) or _seconds(length) % _seconds(slide):
        win = F.window("ts", length, slide)
        return clicks.groupBy(win.alias("w"), "ad_id").agg(F.count(F.lit(1)).alias("click_count")).select(
            F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "ad_id", "click_count"
        )
    step = _seconds(slide)
    n = _seconds(length) // step
    slot = F.floor(F.unix_seconds("ts") / step).cast("bigint")
    per_slot = clicks.groupBy(slot.alias("slot"), "ad_id").agg(F.count(F.lit(1)).alias("n"))
    expanded = per_slot.select("ad_id", "n", F.explode(F.sequence(F.col("slot") - (n - 1), F.col("slot"))).alias("start_slot"))
    out = expanded.groupBy("start_slot", "ad_id").agg(F.sum("n").cast("bigint").alias("click_count"))
    return out.select(
        F.timestamp_seconds(F.col("start_slot") * step).alias("window_start"),
        F.timestamp_seconds((F.col("start_slot") + n) * step).alias("window_end"),
        "ad_id",
        "click_count",
    )


def _seconds(text: str) -> int | None:
    """Seconds of an interval text such as ``1 minute`` or ``2 hours``; None for texts
    of other units or several parts, which are left to Spark."""
    amount, _, unit = text.strip().lower().partition(" ")
    mult = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}.get(unit.strip().rstrip("s"))
    return int(amount) * mult if mult and amount.isdigit() else None
