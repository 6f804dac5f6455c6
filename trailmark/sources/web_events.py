"""Raw web events derived from the ``events`` test table (FIXTURES.md §4).

One rule is added to the fixture text: every row with ``event_id % 499 = 7`` has an unreadable timestamp, so that the
rules for undated events are exercised too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# User agents by user_id % 8; the eighth is NULL.
USER_AGENTS = (
    "Mozilla/5.0 (iPad; CPU OS 17_0 like Mac OS X) Version/17.0 Safari/604.1",
    "Mozilla/5.0 (iPhone; CPU iPhone OS 17_0 like Mac OS X) CriOS/120.0 Mobile Safari/604.1",
    "Mozilla/5.0 (Linux; Android 14; Pixel 8) Chrome/120.0 Mobile Safari/537.36",
    "Mozilla/5.0 (Linux; Android 13; SM-X700) Chrome/119.0 Safari/537.36",
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) Chrome/120.0 Safari/537.36 Edg/120.0",
    "Mozilla/5.0 (Macintosh; Intel Mac OS X 10_15_7) Version/17.0 Safari/605.1.15",
    "Mozilla/5.0 (X11; Linux x86_64; rv:121.0) Gecko/20100101 Firefox/121.0",
)
EVENT_NAMES = {
    "view": "page_viewed",
    "click": "product_added_to_cart",
    "signup": "email_filled_on_popup",
    "error": "checkout_started",
}


def _case(selector: Column, values: dict[int, Column | None], default: Column | None = None) -> Column:
    result = default if default is not None else F.lit(None).cast("string")
    for key, value in values.items():
        if value is not None:
            result = F.when(selector == key, value).otherwise(result)
    return result


def _event_name() -> Column:
    n = F.col("event_id")
    name = F.when(n % 2 == 0, F.lit("purchase")).otherwise(F.lit("checkout_completed"))
    for kind, value in EVENT_NAMES.items():
        name = F.when(F.col("event_type") == kind, F.lit(value)).otherwise(name)
    return F.when(n % 211 == 0, F.lit("mystery_event")).otherwise(name)


def _page_url() -> Column:
    n, user = F.col("event_id"), F.col("user_id")
    suffix = _case(
        n % 8,
        {
            0: F.concat(F.lit("?utm_source=src"), user % 3, F.lit("&utm_medium=cpc&utm_campaign=c"), n % 5),
            4: F.concat(F.lit("?ref=1&utm_source=src"), n % 7, F.lit("&utm_medium=email")),
            1: F.lit("?utm_source=&utm_source=late%20src"),
            2: F.lit("?utm_medium=social#utm_source=frag"),
        },
        F.lit(""),
    )
    return F.concat(F.lit("https://shop.example.com/p/"), n % 50, suffix)


def _referrer() -> Column:
    n = F.col("event_id")
    shown = F.when(n % 9 == 0, F.lit("https://a1b2c3d4e5f60718.example.net/x")).otherwise(
        F.when(n % 9 == 2, F.lit("")).otherwise(
            F.when(n % 9 != 1, F.lit("https://WWW.Search.example.com:443/q?x=1"))
        )
    )
    return F.when(~F.col("_drift_day"), shown)


def _event_data() -> Column:
    n = F.col("event_id")
    cents = F.floor(F.col("value") * 100 + 0.5).cast("bigint")
    price = F.concat(F.floor(cents / 100).cast("string"), F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0"))
    quantity = 1 + n % 3
    sku = F.concat(F.lit("sku_"), n % 20)

    def text(template: str) -> Column:
        return F.format_string(template.replace("%", "%%").replace("<p>", "%1$s").replace("<q>", "%2$d")
                               .replace("<s>", "%3$s"), price, quantity, sku)

    return _case(
        F.floor(n / 2) % 8,
        {
            0: text('{"price": <p>, "quantity": <q>, "product_id": "<s>"}'),
            1: text('{"items":[{"product_id":"<s>","price":<p>,"quantity":<q>},{"price": 1, "quantity": 2}]}'),
            2: text("{'price': <p>, 'quantity': \"<q>\", 'sku': '<s>'}"),
            3: text('{"total": <p>}'),
            4: text('{"price": 0, "quantity": 0, "items":[{"price":<p>,"quantity":1,"sku":"<s>"}]}'),
            5: text('{"price": "abc", "amount": <p>}'),
            6: F.lit("{bad json"),
        },
    )


def web_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events, text columns only but for ``row_seq`` and the file-level referrer flag."""
    n = F.col("event_id")
    ts = F.col("ts").cast("timestamp")
    agents = {i: F.lit(agent) for i, agent in enumerate(USER_AGENTS)}
    single = (
        spark.read.parquet(f"{sf_dir}/events.parquet")
        .repartition("event_id")  # the test table is one small file
        .withColumn("_drift_day", F.day("ts").between(5, 9))
        .select(
            F.concat(F.lit("events_"), F.date_format(ts, "yyyyMMdd"), F.lit(".csv")).alias("source_file"),
            n.alias("row_seq"),
            F.when(n % 10 != 0, F.concat(F.lit("c"), "user_id")).alias("client_id"),
            _page_url().alias("page_url"),
            _referrer().alias("referrer"),
            F.when(n % 499 == 7, F.lit("not a time"))
            .otherwise(F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
            .alias("timestamp"),
            _event_name().alias("event_name"),
            _event_data().alias("event_data"),
            _case(F.col("user_id") % 8, agents).alias("user_agent"),
            F.col("_drift_day").alias("source_file_referrer_missing"),
        )
    )
    # every 97th row occurs twice
    copies = F.when(F.col("row_seq") % 97 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return single.withColumn("copy_no", F.explode(copies))


def write_daily_files(raw: DataFrame, root: str) -> None:
    """Daily CSV folders as an exporter would leave them: drift days come without a referrer column."""
    columns = ["client_id", "page_url", "referrer", "timestamp", "event_name", "event_data", "user_agent"]
    writer_options = {"header": True, "escape": '"'}
    for missing, mode in ((False, "errorifexists"), (True, "append")):
        part = raw.where(F.col("source_file_referrer_missing") == missing)
        part = part.select("source_file", *[c for c in columns if not (missing and c == "referrer")])
        part.hint("rebalance", "source_file").write.options(**writer_options).mode(mode).partitionBy(
            "source_file"
        ).csv(root)
