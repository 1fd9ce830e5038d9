"""Tables and CSV files in and out."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plinth.functions import urls

# Spellings of yes and no.
YES, NO = ("true", "1", "yes", "y", "on"), ("false", "0", "no", "n", "off")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir, which driver and executors share; only a local session may leave it unset."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="plinth-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def settled(df: DataFrame) -> DataFrame:
    """df checkpointed in the shared folder, for what is dear to make and read more than once."""
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(f"{shared_dir(df.sparkSession)}/checkpoints")
    return df.checkpoint()


def parse_bool(value: Column, default: bool = True) -> Column:
    """True, false, the default for blank, an error otherwise."""
    v = F.lower(F.trim(F.coalesce(value, F.lit(""))))
    wrong = F.raise_error(F.concat(F.lit("Invalid boolean value: "), value)).cast("boolean")
    return F.when(v == "", default).when(v.isin(*YES), True).when(v.isin(*NO), False).otherwise(wrong)


def is_resource_url(url: Column) -> Column:
    """Scheme, host, port and user are all there."""
    user = F.regexp_extract(urls.netloc(url), r"^([^:@]+)(?::[^@]*)?@", 1)
    return (urls.scheme(url) != "") & (urls.hostname(url) != "") & (urls.port(url) != "") & (urls.port(url) != "0") & (user != "")


def read_resources(spark: SparkSession, path: str) -> DataFrame:
    """proxy_url, is_active and position (in the file) of a CSV file; blank URLs go, others must be whole."""
    raw = spark.read.option("header", True).option("encoding", "UTF-8").option("multiLine", True).csv(path)
    named = raw.toDF(*(c.lstrip("﻿") for c in raw.columns))
    if "proxy_url" not in named.columns:
        raise ValueError("the CSV file must have a column proxy_url")
    enabled = F.col("enabled") if "enabled" in named.columns else F.lit(None).cast("string")
    url = F.trim("proxy_url")
    rows = named.filter(F.coalesce(url, F.lit("")) != "").select(url.alias("proxy_url"), parse_bool(enabled).alias("is_active"), F.monotonically_increasing_id().alias("position"))
    wrong = F.raise_error(F.concat(F.lit("proxy_url must include scheme, host, port, and username: "), F.col("proxy_url"))).cast("string")
    return rows.withColumn("proxy_url", F.when(is_resource_url(F.col("proxy_url")), F.col("proxy_url")).otherwise(wrong))


def write_csv(df: DataFrame, path: str, single: bool = True) -> None:
    """A header, nulls as empty fields; one file unless single is False. The byte-order mark is the first name's."""
    marked = df.withColumnRenamed(df.columns[0], "﻿" + df.columns[0]) if single else df
    (marked.coalesce(1) if single else marked).write.mode("overwrite").option("header", True).option("nullValue", "").option("emptyValue", "").option("escape", '"').csv(path)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def scratch(spark: SparkSession) -> str:
    """A path of its own in the shared folder."""
    return f"{shared_dir(spark)}/plinth-{uuid.uuid4().hex}"
