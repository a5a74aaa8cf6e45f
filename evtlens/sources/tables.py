"""Behaviour records derived from the shared test tables.

The reference reads CSV files that are not part of the test tables, so each record
type is mapped onto ``events`` / ``orders`` / ``lineitem`` / ``customer`` / ``nation``
by a fixed rule (documented per function, mirrored in the oracle SQL). Every
mapping is a projection / filter / join that Catalyst prunes and pushes into the
parquet scans; nothing is materialised.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evtlens.sources.text import format_apache_log, parse_apache_log

# Fixed values of the mapping (kept in one place, mirrored by the oracle SQL).
CHANNELS = ["app store", "wechat", "weibo"]
BEHAVIOR_OF_EVENT = {"view": "pv", "click": "cart", "purchase": "buy", "signup": "fav"}
MARKETING_OF_EVENT = {"click": "CLICK", "view": "DOWNLOAD", "purchase": "INSTALL",
                      "signup": "UNINSTALL"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _events(spark, sf_dir, *types) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    if types:
        ev = ev.where(F.col("event_type").isin(*types))
    return ev.withColumn("ts", F.col("ts").cast("timestamp"))


def _k() -> F.Column:
    return F.get_json_object("props", "$.k").cast("bigint")


def _case(col: str, mapping: dict, default: str) -> F.Column:
    expr = None
    for k, v in mapping.items():
        expr = (F.when(F.col(col) == k, v) if expr is None else expr.when(F.col(col) == k, v))
    return expr.otherwise(default)


def user_behavior(spark, sf_dir, behavior: str | None = None) -> DataFrame:
    """UserBehavior: item = props.k, category = k % 10, 'view' plays 'pv'; seq = event_id.
    With ``behavior`` only rows of that behaviour; the filter is on the stored column, so
    it reaches the scan."""
    stored = {v: k for k, v in BEHAVIOR_OF_EVENT.items()}
    return user_behavior_from(_events(spark, sf_dir, *([stored[behavior]] if behavior else [])))


def user_behavior_from(ev: DataFrame) -> DataFrame:
    """The UserBehavior projection over an ``events`` DataFrame (batch or stream)."""
    ev = ev.withColumn("ts", F.col("ts").cast("timestamp"))
    return ev.select(
        "user_id", _k().alias("item_id"), (_k() % 10).cast("int").alias("category_id"),
        _case("event_type", BEHAVIOR_OF_EVENT, "other").alias("behavior"),
        "ts", F.col("event_id").alias("seq"))


# Url pattern by k % 10 (prefix, then k unless it is the icon, then suffix).
URL_PREFIX = ["/static/s", "/js/app", "/img/i", "/favicon.ico", "/static/s",
              "/page/", "/page/", "/page/", "/page/", "/page/"]
URL_SUFFIX = [".css", ".js", ".png", "", ".css?v=1", "", "", "", "", ""]


def _url_of_k(k: F.Column) -> F.Column:
    m = (k % 10 + 1).cast("int")
    mid = F.when(m == 4, F.lit("")).otherwise(k.cast("string"))
    return F.concat(F.element_at(F.array(*[F.lit(x) for x in URL_PREFIX]), m), mid,
                    F.element_at(F.array(*[F.lit(x) for x in URL_SUFFIX]), m))


def _log_records(spark, sf_dir, method: str | None = None) -> DataFrame:
    ev = _events(spark, sf_dir)
    if method == "POST":
        ev = ev.where(F.col("event_type") == "signup")
    elif method == "GET":
        ev = ev.where(F.col("event_type").isNull() | (F.col("event_type") != "signup"))
    return log_records_from(ev)


def log_records_from(ev: DataFrame) -> DataFrame:
    """The log mapping over an ``events`` DataFrame (batch or stream)."""
    ev = ev.withColumn("ts", F.col("ts").cast("timestamp"))
    return ev.select(
        F.col("event_id").alias("seq"),
        F.concat(F.lit("10.0."), (F.col("user_id") % 256).cast("string"), F.lit(".1")).alias("ip"),
        F.col("user_id").cast("string").alias("user_id"),
        F.date_trunc("second", "ts").alias("ts"),
        F.when(F.col("event_type") == "signup", "POST").otherwise("GET").alias("method"),
        _url_of_k(_k()).alias("url"))


def apache_log_lines(spark, sf_dir) -> DataFrame:
    """Access-log text lines built from ``events`` (signup is a POST, everything else a GET),
    with the arrival sequence (event_id) next to the text."""
    return format_apache_log(_log_records(spark, sf_dir), keep=["seq"])


def apache_log_text(spark, sf_dir) -> DataFrame:
    """ApacheLogEvent parsed back from the generated text lines."""
    return parse_apache_log(apache_log_lines(spark, sf_dir))


def apache_log(spark, sf_dir, method: str | None = None) -> DataFrame:
    """ApacheLogEvent records of ``events`` - the same rows as :func:`apache_log_text`
    (log time has whole seconds), without the text round trip, so filters on method /
    url push down to plain columns instead of re-building the text."""
    return _log_records(spark, sf_dir, method)


def logins(spark, sf_dir) -> DataFrame:
    """LoginEvent: an 'error' event is a failed login, anything else a success."""
    return logins_from(_events(spark, sf_dir))


def logins_from(ev: DataFrame) -> DataFrame:
    """The login mapping over an ``events`` DataFrame (batch or stream)."""
    ev = ev.withColumn("ts", F.col("ts").cast("timestamp"))
    return ev.select(
        "user_id", F.concat(F.lit("10.0."), (F.col("user_id") % 256).cast("string"), F.lit(".1")).alias("ip"),
        F.when(F.col("event_type") == "error", "fail").otherwise("success").alias("login_state"),
        "ts", F.col("event_id").alias("seq"))


def ad_clicks(spark, sf_dir) -> DataFrame:
    """AdClickEvent: 'click' events, ad = k % 3, province = nation name of customer user_id,
    city = the customer's market segment. Left joins keep every click."""
    return ad_clicks_from(spark, sf_dir, _events(spark, sf_dir, "click"))


def ad_clicks_from(spark, sf_dir, ev: DataFrame) -> DataFrame:
    """The AdClickEvent mapping over click events (batch or stream; the customer /
    nation side is a static table)."""
    ev = ev.withColumn("ts", F.col("ts").cast("timestamp"))
    cust = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), "c_nationkey", F.col("c_mktsegment").alias("city"))
    nation = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("province"))
    geo = cust.join(nation, "c_nationkey", "left").drop("c_nationkey")
    return (ev.select("user_id", (_k() % 3).alias("ad_id"), "ts", F.col("event_id").alias("seq"))
            .join(geo, "user_id", "left")
            .select("user_id", "ad_id", "province", "city", "ts", "seq"))


def marketing(spark, sf_dir, uninstalls: bool = True) -> DataFrame:
    """MarketingUserBehavior: channel = CHANNELS[k % 3], signup plays UNINSTALL (left out
    below the mapping unless ``uninstalls``)."""
    ev = _events(spark, sf_dir)
    if not uninstalls:
        ev = ev.where(F.col("event_type").isNull() | (F.col("event_type") != "signup"))
    return marketing_from(ev)


def marketing_from(ev: DataFrame) -> DataFrame:
    """The marketing mapping over an ``events`` DataFrame (batch or stream)."""
    ev = ev.withColumn("ts", F.col("ts").cast("timestamp"))
    ch = F.element_at(F.array(*[F.lit(c) for c in CHANNELS]), (_k() % 3 + 1).cast("int"))
    return ev.select("user_id", _case("event_type", MARKETING_OF_EVENT, "CLICK").alias("behavior"),
                     ch.alias("channel"), "ts", F.col("event_id").alias("seq"))


def order_events(spark, sf_dir) -> DataFrame:
    """OrderEvent: create = order date, pay = earliest ship date of the order's lines
    (tx id 'tx<orderkey>'). The pay side is pre-aggregated per order before the union."""
    creates = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.lit("create").alias("event_type"),
        F.lit(None).cast("string").alias("tx_id"), F.col("o_orderdate").cast("timestamp").alias("ts"))
    pays = (table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("order_id"))
            .agg(F.min("l_shipdate").cast("timestamp").alias("ts"))
            .select("order_id", F.lit("pay").alias("event_type"),
                    F.concat(F.lit("tx"), F.col("order_id").cast("string")).alias("tx_id"), "ts"))
    return creates.unionByName(pays)


def order_lines(spark, sf_dir) -> DataFrame:
    """OrderEvent with a pay per line (ship date) and no create for every seventh order, so
    that orders have several pays and some have no create."""
    creates = table(spark, sf_dir, "orders").where(F.col("o_orderkey") % 7 != 0).select(
        F.col("o_orderkey").alias("order_id"), F.lit("create").alias("event_type"),
        F.col("o_orderdate").cast("timestamp").alias("ts"))
    return creates.unionByName(table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.lit("pay").alias("event_type"),
        F.col("l_shipdate").cast("timestamp").alias("ts")))


def pays(spark, sf_dir) -> DataFrame:
    """Pay events for transaction matching: 'purchase' events, tx id = user id."""
    return pays_from(_events(spark, sf_dir, "purchase"))


def pays_from(ev: DataFrame) -> DataFrame:
    """The pay mapping over purchase events (batch or stream)."""
    return ev.select(F.col("event_id").alias("order_id"), F.lit("pay").alias("event_type"),
                     F.col("user_id").cast("string").alias("tx_id"), F.col("ts").cast("timestamp").alias("ts"))


def receipts(spark, sf_dir) -> DataFrame:
    """Receipt events: 'click' events, tx id = user id, channel by k % 2."""
    return receipts_from(_events(spark, sf_dir, "click"))


def receipts_from(ev: DataFrame) -> DataFrame:
    """The receipt mapping over click events (batch or stream)."""
    return ev.select(F.col("user_id").cast("string").alias("tx_id"),
                     F.when(_k() % 2 == 0, "alipay").otherwise("wechat").alias("pay_channel"),
                     F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").alias("seq"))
