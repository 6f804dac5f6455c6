"""Marts and monitors as days arrive.

Every figure of the marts and monitors is a sum over days. Stored are the attributed purchases by day and, for each day, one small
row per mart and key: counts as whole numbers, money as decimals. A batch makes anew the rows of the days that it touched and of
those whose purchases look back on them, and no others; a mart is the sum of the rows of all days. Conversion by channel, which
goes by sessions that may span days, comes from the stored sessions.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import exact_sum, ratio, round_half_away
from ..functions.text import PURCHASE
from ..operators import attribution, marts, monitoring, multi_touch
from ..operators.monitoring import Limits
from ..session import discard, materialize
from ..sources.versioned import UNDATED, VersionedTable, day_of
from .session_days import SessionDays

_MONEY, _SHARE = "decimal(38,4)", "decimal(38,6)"


def _row(mart: str | Column, key: Column | None = None, n: Column | None = None, m: Column | None = None, money: Column | None = None, other: Column | None = None, share: Column | None = None) -> list[Column]:
    """A row of the store: two counts, two sums of money and one of shares, those that the mart has."""
    kinds = (("key", key, "string"), ("n", n, "bigint"), ("m", m, "bigint"), ("money", money, _MONEY), ("other", other, _MONEY), ("share", share, _SHARE))
    return ["day", F.lit(mart).alias("mart"), *[(F.lit(None) if column is None else column).cast(kind).alias(name) for name, column, kind in kinds]]


class MartDays:
    """Attributed purchases and the daily sums of all marts and monitors, below ``root``."""

    def __init__(self, spark: SparkSession, root: str, events: VersionedTable, sessions: SessionDays, limits: Limits = Limits()):
        self.spark, self.events, self.found, self.limits = spark, events, sessions, limits
        self.purchases = VersionedTable(spark, f"{root}/purchases", day_of())
        self.sums = VersionedTable(spark, f"{root}/sums", F.col("day"))

    def _redone(self, days: Iterable[str]) -> list[str]:
        """The days named, and the days with events whose look-back reaches into them."""
        named = set(days)
        ahead = {str(date.fromisoformat(day) + timedelta(days=k)) for day in named - {UNDATED} for k in range(1, attribution.LOOKBACK_DAYS + 1)}
        return sorted(named | (ahead & set(self.events.parts())))

    def update(self, days: Iterable[str]) -> list[str]:
        """Bring purchases and sums up to date after ``days`` of the events were replaced. Returns the days made anew.

        May be repeated.
        """
        redone = self._redone(days)
        back = {str(date.fromisoformat(day) - timedelta(days=k)) for day in redone if day != UNDATED for k in range(attribution.LOOKBACK_DAYS + 1)}
        seen = self.events.read(back | set(redone))
        if seen is None:
            for table in (self.purchases, self.sums):
                if (old := table.read()) is not None:
                    table.replace(old.limit(0), redone)
            return redone
        own = day_of().isin(redone)
        bought = attribution.purchase_attribution(seen).where(own).drop("revenue")
        self.purchases.replace(bought, redone)
        held = self.purchases.read(redone)
        held = self.spark.createDataFrame([], bought.schema) if held is None else held
        credited = multi_touch.credits_of_both(seen, multi_touch.HALF_LIFE_DAYS, "price_first").where(own)
        rows = materialize(self._sums(seen.where(own), held, credited), "sums")
        self.sums.replace(rows, redone)
        discard(rows)
        return redone

    def _sums(self, events: DataFrame, purchases: DataFrame, credited: DataFrame) -> DataFrame:
        """The rows of the store for some days, from their events, purchases and credits."""
        day = day_of().alias("day")
        by_price = purchases.withColumn("revenue", attribution.revenue_of("price_first"))
        count, revenue = F.count("*").alias("n"), exact_sum(F.coalesce("revenue", F.lit(0.0))).alias("money")

        def sold(mart: str, key: Column) -> DataFrame:
            return by_price.groupBy(day, key.alias("key")).agg(count, revenue).select(_row(mart, F.col("key"), F.col("n"), None, F.col("money")))

        parts = [
            sold("daily", F.lit(None)),
            sold("last", F.coalesce("last_utm_source", F.lit(marts.DIRECT))),
            sold("first", F.coalesce("first_utm_source", F.lit(marts.DIRECT))),
            sold("product", F.coalesce("product_id", F.lit("unknown"))),
            sold("type", marts.conversion_type()),
        ]
        devices = marts.device_days(events).groupBy(F.coalesce(F.col("dt").cast("string"), F.lit(UNDATED)).alias("day"), "device_type")
        sums = devices.agg(F.count("client_id").alias("n"), exact_sum(F.col("revenue")).alias("money"))
        parts.append(sums.select(_row("device", F.col("device_type"), F.col("n"), None, F.col("money"))))
        models = {"linear": "linear_", "time_decay": ""}
        sums = [
            F.struct(
                F.lit(model).alias("mart"), exact_sum(round_half_away(F.col(f"{prefix}revenue"), 4)).alias("money"),
                F.sum(round_half_away(F.col(f"{prefix}share"), 6).cast(_SHARE)).alias("share"),
            )
            for model, prefix in models.items()
        ]
        both = credited.groupBy(day, "channel").agg(F.sum("touches").alias("n"), F.array(*sums).alias("models")).select("day", "channel", "n", F.inline("models"))
        parts.append(both.select(_row(F.col("mart"), F.col("channel"), F.col("n"), None, F.col("money"), None, F.col("share"))))
        parts.append(marts.outside_sessions(events).groupBy(day).agg(count).select(_row("outside", n=F.col("n"))))

        is_purchase = F.col("event_name") == PURCHASE
        bad = F.col("event_data").isNotNull() & F.col("event_data_parsed").isNull()
        counted = events.groupBy(day).agg(
            count, F.count_if(is_purchase).alias("m"), F.count_if(F.col("client_id").isNull()).alias("nulls"), F.count_if(bad).alias("bad"),
            exact_sum(F.when(is_purchase, F.col("total"))).alias("money"),
        )
        kept = (("events", "n", "m", F.col("money")), ("faults", "nulls", "bad", F.lit(None)))
        kept = [F.struct(F.lit(mart).alias("mart"), F.col(n).alias("n"), F.col(m).alias("m"), money.cast(_MONEY).alias("money")) for mart, n, m, money in kept]
        found = counted.select("day", F.inline(F.array(*kept)))
        parts.append(found.select(_row(F.col("mart"), None, F.col("n"), F.col("m"), F.col("money"))))
        copies = monitoring.duplicate_groups(events.withColumn("day", day_of()), "day")
        parts.append(copies.select(_row("copies", None, F.col("groups"), F.col("several"))))
        direct = monitoring.direct_revenue(purchases.withColumn("revenue", attribution.revenue_of("total")), day)
        parts.append(direct.select(_row("direct", None, None, None, F.col("direct"), F.col("all"))))
        every = parts[0]
        for part in parts[1:]:
            every = every.unionByName(part)
        return every

    def _of(self, mart: str) -> DataFrame:
        return self.sums.read().where(F.col("mart") == mart)

    def _sold(self, mart: str, key: str) -> DataFrame:
        money = F.sum("money").cast("double").alias("revenue")
        return self._of(mart).groupBy(F.col("key").alias(key)).agg(F.sum("n").alias("purchases"), money)

    def _credited(self, model: str) -> DataFrame:
        sums = F.sum("money").cast("double").alias("revenue"), F.sum("share").cast("double").alias("purchases"), F.sum("n").alias("touches")
        return self._of(model).groupBy(F.col("key").alias("channel")).agg(*sums).orderBy(F.desc("revenue"), "channel")

    def marts(self) -> dict[str, DataFrame]:
        """The marts of ``plans.steps.analyse``, from the stored days."""
        daily = self._of("daily").select(F.to_date(F.nullif("day", F.lit(UNDATED))).alias("date"), F.col("n").alias("purchases"), F.col("money").cast("double").alias("revenue"))
        channels = {touch: self._sold(touch, "channel").select("channel", "revenue", "purchases").orderBy(F.desc("revenue"), "channel") for touch in ("last", "first")}
        devices = self._of("device").groupBy(F.col("key").alias("device_type")).agg(F.sum("n").alias("sessions"), F.sum("money").alias("revenue"))
        outside = self._of("outside").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("purchases"))
        return {
            "daily_revenue": daily.withColumn("avg_order_value", ratio(F.col("revenue"), F.col("purchases"))).orderBy(F.asc_nulls_last("date")),
            "channel_revenue_last_click": channels["last"],
            "channel_revenue_first_click": channels["first"],
            "channel_revenue_linear": self._credited("linear"),
            "channel_revenue_time_decay": self._credited("time_decay"),
            "conversion_rate_by_channel": marts.conversion_of(self.found.sessions(), outside),
            "revenue_by_device": marts.per_device(devices),
            "assisted_vs_direct": self._sold("type", "conversion_type").orderBy(F.desc("purchases"), "conversion_type"),
            "top_products": self._sold("product", "product_id").orderBy(F.desc("revenue"), "product_id").limit(50),
        }

    def totals(self) -> DataFrame:
        """The one row of ``monitoring.totals``."""
        sums = self.sums.read().agg(
            F.max(F.when(F.col("mart") == "events", F.to_date(F.nullif("day", F.lit(UNDATED))))).alias("date"),
            *[F.coalesce(F.sum(F.when(F.col("mart") == mart, F.col(name))), F.lit(0)).alias(alias) for mart, name, alias in (("events", "n", "rows"), ("events", "m", "purchases"), ("faults", "n", "nulls"), ("faults", "m", "bad"))],
        )
        rates = {name: ratio(F.col(part), F.col("rows")) for name, part in (("null_client_rate", "nulls"), ("json_error_rate", "bad"))}
        return sums.withColumns(rates).drop("nulls", "bad")

    def monitors(self) -> DataFrame:
        """``monitoring.monitors``, from the stored days."""
        copies = self._of("copies").agg(F.sum("n").alias("groups"), F.sum("m").alias("several"))
        daily = self._of("events").where("m > 0").select(F.to_date(F.nullif("day", F.lit(UNDATED))).alias("day"), F.col("money").alias("revenue"))
        direct = self._of("direct").agg(F.sum("money").alias("direct"), F.sum("other").alias("all"))
        return monitoring.monitors_of(self.totals(), copies, daily, direct, self.limits)

    def report(self) -> DataFrame:
        return monitoring.report(self.monitors(), self.totals().select("date"))
