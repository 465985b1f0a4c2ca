"""Kafka topics as source and sink.

The live connector needs the ``spark-sql-kafka`` package on the classpath;
the functions here build its options and shape its rows, and work on any
frame with the Kafka source schema (key/value binary, topic, partition,
offset, timestamp, timestampType).
"""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Client settings read from the environment and the prefix of
# pass-through client settings (``KAFKA_EXTRA_CONFIG__a__b=v`` -> ``a.b=v``).
ENV_SETTINGS = {
    "KAFKA_BOOTSTRAP_SERVERS": "bootstrap.servers",
    "KAFKA_SECURITY_PROTOCOL": "security.protocol",
    "KAFKA_SASL_MECHANISM": "sasl.mechanism",
}
EXTRA_PREFIX = "KAFKA_EXTRA_CONFIG__"
LOGIN = {"username": "KAFKA_SASL_USERNAME", "password": "KAFKA_SASL_PASSWORD"}
LOGIN_MODULE = "org.apache.kafka.common.security.plain.PlainLoginModule"
TRUE_WORDS = {"1", "true", "yes", "y"}
DEFAULT_BOOTSTRAP = "localhost:9092"


def kafka_options(env: Mapping[str, str] | None = None) -> dict[str, str]:
    """Spark Kafka source/sink options (``kafka.``-prefixed client settings)
    from environment-style settings.  SASL user/password become a JAAS
    config entry."""
    env = dict(os.environ if env is None else env)
    opts: dict[str, str] = {"kafka.bootstrap.servers": DEFAULT_BOOTSTRAP}
    for var, key in ENV_SETTINGS.items():
        if env.get(var):
            opts[f"kafka.{key}"] = env[var]
    login = {name: env.get(var) for name, var in LOGIN.items()}
    if all(login.values()):
        entry = " ".join(f'{name}="{_jaas_text(value)}"' for name, value in login.items())
        opts["kafka.sasl.jaas.config"] = f"{LOGIN_MODULE} required {entry};"
    elif any(login.values()):
        raise ValueError(f"{' and '.join(LOGIN.values())} go together; only one is set")
    if env.get("KAFKA_ENABLE_IDEMPOTENCE", "true").lower() in TRUE_WORDS:
        opts["kafka.enable.idempotence"] = "true"
    extra = {f"kafka.{var.removeprefix(EXTRA_PREFIX)}".replace("__", "."): value
             for var, value in env.items() if var.startswith(EXTRA_PREFIX)}
    return opts | extra


def _jaas_text(value: str) -> str:
    """A value for a quoted JAAS string."""
    return value.replace("\\", "\\\\").replace('"', '\\"')


def read_topic(spark: SparkSession, topic: str, options: Mapping[str, str] | None = None,
               stream: bool = True, starting: str = "earliest",
               group_id: str | None = None) -> DataFrame:
    """Subscribe to one topic from the earliest offsets.  Progress is kept
    in the query checkpoint (exactly-once); ``group_id`` only names the
    consumer group on the broker, e.g. for lag monitoring."""
    r = spark.readStream if stream else spark.read
    r = r.format("kafka").option("subscribe", topic).option("startingOffsets", starting)
    if group_id:
        r = r.option("kafka.group.id", group_id)
    for k, v in (options or kafka_options()).items():
        r = r.option(k, v)
    return r.load()


def shape_kafka(rows: DataFrame) -> DataFrame:
    """Decode Kafka rows: key/value bytes as UTF-8 with invalid sequences
    replaced by U+FFFD; empty or absent key -> NULL; empty or absent value
    -> ''."""
    key = F.make_valid_utf8(F.col("key").cast("string"))
    value = F.make_valid_utf8(F.col("value").cast("string"))
    return rows.select(
        F.col("topic"), F.col("partition").cast("int").alias("partition"),
        F.col("offset").cast("bigint").alias("offset"),
        F.col("timestamp"), F.col("timestampType"),
        F.nullif(key, F.lit("")).alias("key"),
        F.coalesce(value, F.lit("")).alias("value"),
    )


def write_topic(frame: DataFrame, topic: str, options: Mapping[str, str] | None = None) -> None:
    """Publish ``key``/``value`` rows; a failed delivery fails the task,
    which Spark retries."""
    w = frame.select("key", "value").write.format("kafka").option("topic", topic)
    for k, v in (options or kafka_options()).items():
        w = w.option(k, v)
    w.save()
