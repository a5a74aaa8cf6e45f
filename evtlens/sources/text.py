"""comma/space separated text sources, batch or streaming.

The reference splits lines by hand and throws on a bad line; here the CSV reader
runs PERMISSIVE with a fixed schema, so a malformed line becomes a row with NULLs
(route it with ``F.col(...).isNull()`` if needed) instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evtlens.sources import schemas as S

# Fixed value: the apache access-log time format.
APACHE_TIME_FORMAT = "dd/MM/yyyy:HH:mm:ss"


def read_csv_records(spark: SparkSession, path: str, schema, stream: bool = False) -> DataFrame:
    reader = spark.readStream if stream else spark.read
    return (reader.schema(schema).option("header", "false").option("mode", "PERMISSIVE")
            .option("emptyValue", "").csv(path))


def route_bad_rows(df: DataFrame, required=None, route_col: str = "route") -> DataFrame:
    """Mark rows of a PERMISSIVE read whose required fields did not parse (NULL) with
    route 'bad', the rest 'main'; split with ``filter`` (batch) or a route sink (stream)."""
    required = list(required or [c for c in df.columns if c != route_col])
    bad = None
    for c in required:
        bad = F.col(c).isNull() if bad is None else (bad | F.col(c).isNull())
    return df.withColumn(route_col, F.when(bad, F.lit("bad")).otherwise(F.lit("main")))


def with_arrival_seq(df: DataFrame, col: str = "seq") -> DataFrame:
    """Arrival order of a batch read (file order within a split, splits in order);
    used as the tie-break after event time."""
    return df.withColumn(col, F.monotonically_increasing_id())


def _with_seconds_time(df: DataFrame) -> DataFrame:
    return df.withColumn("ts", F.timestamp_seconds("ts_sec"))


def read_user_behavior(spark, path, stream=False) -> DataFrame:
    """userId,itemId,categoryId,behavior,timestamp(s)."""
    return _with_seconds_time(read_csv_records(spark, path, S.USER_BEHAVIOR_CSV, stream))


def read_ad_clicks(spark, path, stream=False) -> DataFrame:
    """S3: userId,adId,province,city,timestamp(s)."""
    return _with_seconds_time(read_csv_records(spark, path, S.AD_CLICK_CSV, stream))


def read_logins(spark, path, stream=False) -> DataFrame:
    """userId,ip,loginState,timestamp(s)."""
    return _with_seconds_time(read_csv_records(spark, path, S.LOGIN_CSV, stream))


def read_order_events(spark, path, stream=False) -> DataFrame:
    """orderId,eventType,txId,timestamp(s); a create has an empty txId."""
    return _with_seconds_time(read_csv_records(spark, path, S.ORDER_EVENT_CSV, stream))


def read_receipts(spark, path, stream=False) -> DataFrame:
    """txId,payChannel,timestamp(s)."""
    return _with_seconds_time(read_csv_records(spark, path, S.RECEIPT_CSV, stream))


def parse_apache_log(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Space-split access-log line; fields 0 ip, 1 user id, 3 time, 5 method, 6 url.
    Other input columns (e.g. an arrival sequence) are kept in front."""
    f = F.split(F.col(value_col), " ")
    return lines.select(
        *[c for c in lines.columns if c != value_col],
        f.getItem(0).alias("ip"),
        f.getItem(1).alias("user_id"),
        F.to_timestamp(f.getItem(3), APACHE_TIME_FORMAT).alias("ts"),
        f.getItem(5).alias("method"),
        f.getItem(6).alias("url"),
    )


def format_apache_log(df: DataFrame, keep=()) -> DataFrame:
    """Inverse of :func:`parse_apache_log` (used to publish / replay logs)."""
    return df.select(*keep, F.concat_ws(
        " ", "ip", "user_id", F.lit("-"), F.date_format("ts", APACHE_TIME_FORMAT), F.lit("+0000"),
        "method", "url").alias("value"))


def read_apache_log(spark, path, stream=False) -> DataFrame:
    reader = spark.readStream if stream else spark.read
    return parse_apache_log(reader.text(path))
