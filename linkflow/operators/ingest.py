"""Ingest shapes: API responses -> records -> keyed envelopes, payload
normalisation, the flat observation row, and schema-hint key counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkflow.functions.columns import iso_text, tcast
from linkflow.operators.bronze import value_text
from linkflow.operators.quality import metrics_name as unique_name

# Wrapper keys that may hold the record list of an API
# response, tried in this order, and the candidate message-key fields.
RECORD_LIST_KEYS = ("data", "results", "items", "features")
KEY_FIELDS = ("link_id", "linkId", "id", "ID")


def _is_object(text: Column) -> Column:
    """TRUE when ``text`` is a JSON object (NULL/invalid/array/scalar -> FALSE)."""
    return F.json_object_keys(text).isNotNull()


def _kind(text: Column, path: str = "$") -> Column:
    """JSON type at ``path``: ARRAY, OBJECT, STRING, BIGINT, ... (NULL if absent).

    A string is a string, whatever its text looks like."""
    found = F.try_variant_get(F.try_parse_json(text), path, "variant")
    return F.regexp_extract(F.schema_of_variant(found), "^[A-Z]+", 0)


def _objects(text: Column, path: str) -> Column:
    """(pos, record) of the object items of the list at ``path``; the record's
    JSON text is kept as it is."""
    items = F.from_json(text if path == "$" else F.get_json_object(text, path), T.ArrayType(T.StringType()))
    kinds = F.transform(F.try_variant_get(F.try_parse_json(text), path, "array<variant>"),
                        lambda v: F.schema_of_variant(v).startswith("OBJECT"))
    tagged = F.transform(items, lambda t, i: F.struct(i.alias("pos"), t.alias("record"),
                                                      F.coalesce(F.get(kinds, i), F.lit(False)).alias("ok")))
    return F.filter(tagged, lambda x: x["ok"])


def extract_records(responses: DataFrame, body: str = "body",
                    keep: Sequence[str] = ("response_id",)) -> DataFrame:
    """One row per record of each raw API response body.

    A top-level list yields its object items; otherwise the first of the
    wrapper keys holding a list yields that list's object items (an empty
    list yields nothing); otherwise the response object itself is the
    record.  Returns ``keep`` columns + ``pos`` (index in its list) + ``record``
    (JSON text).
    """
    b = F.col(body)
    whole = F.array(F.struct(F.lit(0).alias("pos"), b.alias("record"), F.lit(True).alias("ok")))
    items = F.when(_kind(b) == "ARRAY", _objects(b, "$"))
    for k in RECORD_LIST_KEYS:
        items = items.when(_kind(b, f"$.{k}") == "ARRAY", _objects(b, f"$.{k}"))
    items = items.when(_is_object(b), whole)
    return responses.select(*keep, F.explode(items).alias("r")).select(*keep, "r.pos", "r.record")


def guess_key(record: Column) -> Column:
    """Message key of a record: the first of link_id, linkId, id, ID whose
    JSON value is a string or an integer (booleans count as integers and
    render as True/False), as text; floats, objects and nulls are skipped."""
    v = F.try_parse_json(record)
    out = None
    for k in KEY_FIELDS:
        field = F.try_variant_get(v, f"$.{k}", "variant")
        kind = F.schema_of_variant(field)
        text = F.get_json_object(record, f"$.{k}")
        # integers beyond 64 bits are decimals or doubles by type; their token has digits only
        cand = (F.when(kind == "BOOLEAN", F.initcap(text))
                 .when((kind == "STRING") | (kind.rlike("INT|DECIMAL|DOUBLE") & text.rlike("^-?[0-9]+$")), text))
        out = cand if out is None else F.coalesce(out, cand)
    return out


def build_envelope(payload_json: Column, source_type: Column, source_url: Column,
                   ingested_at: Column) -> Column:
    """``{"ingested_at":..., "source":{type,url}, "payload":<record>}`` as
    compact JSON text; the record's JSON text is embedded unchanged."""
    head = F.to_json(F.struct(iso_text(ingested_at).alias("ingested_at"),
                              F.struct(source_type.alias("type"), source_url.alias("url")).alias("source")))
    # head is the JSON object text of (ingested_at, source): drop its closing
    # brace and append the payload member.
    return F.concat(F.regexp_replace(head, r"\}$", ""), F.lit(',"payload":'), payload_json, F.lit("}"))


def kafka_frame(records: DataFrame, key: Column, value: Column) -> DataFrame:
    """Rows for a Kafka sink: binary ``key`` (NULL allowed) and ``value``."""
    return records.select(F.encode(key, "UTF-8").alias("key"), F.encode(value, "UTF-8").alias("value"))


def envelope_rows(records: DataFrame, source_type: str) -> DataFrame:
    """Provider records (``record``, ``url``, ``ts``) as keyed envelopes for a Kafka sink."""
    keyed = records.select(guess_key(F.col("record")).alias("k"),
                           build_envelope(F.col("record"), F.lit(source_type), F.col("url"), F.col("ts")).alias("v"))
    return kafka_frame(keyed, F.col("k"), F.col("v"))


def published_values(rows: DataFrame) -> DataFrame:
    """Published rows as text: the key, and two fields of the envelope."""
    return rows.select("key", F.get_json_object("value", "$.payload.id").try_cast("int").alias("link_id"),
                       F.get_json_object("value", "$.source.type").alias("source_type"))


# ----------------------------------------------------------------- dump normalisation
FLAGS = ("enough_data", "ignored", "closed", "expected_missing")

# Leaves read by the local observation row.  Measurements stay text (cast
# later, like a column with type affinity); the four flags are typed
# boolean, so only JSON booleans yield a value and a JSON string "true"
# gives NULL.
_OBS_STATS = T.StructType([T.StructField(n, T.StringType()) for n in
                           ("interval_start", "travel_time", "delay", "speed")]
                          + [T.StructField(n, T.BooleanType()) for n in FLAGS])
_OBS_PAYLOAD_FIELDS = [T.StructField(n, T.StringType()) for n in ("id", "name", "length", "minimum_tt")] \
    + [T.StructField("latest_stats", _OBS_STATS)]
_OBS_PAYLOAD = T.StructType(_OBS_PAYLOAD_FIELDS)
# Envelope and bare-payload shapes in one parse: a wrapped record fills
# ``payload``, an unwrapped one fills the top-level payload fields.
_OBS_ENVELOPE = T.StructType([T.StructField("ingested_at", T.StringType()),
                              T.StructField("payload", _OBS_PAYLOAD)] + _OBS_PAYLOAD_FIELDS)


def normalize_payload(dump: DataFrame, metrics_name: str = "payload_normalisation") -> DataFrame:
    """Envelope object (``value_json`` else parsed ``value``) and payload
    object (the envelope's ``payload`` if that is an object, else the whole
    envelope).  Records whose envelope is not a JSON object are dropped
    (counted as ``not_object`` in the observed metrics ``metrics_name``).

    Adds ``envelope_json``, ``wrapped``, ``payload_json`` and the parsed
    payload struct ``payload`` -- one JSON parse per row.
    """
    env_ok = _is_object(F.col("envelope_json"))
    df = (dump.withColumn("envelope_json", value_text(dump))
              .withColumn("_obj", env_ok)
              .observe(unique_name(metrics_name), F.count(F.lit(1)).alias("rows"),
                       F.count_if(~F.col("_obj")).alias("not_object"))
              .filter(F.col("_obj")).drop("_obj"))
    env = F.from_json("envelope_json", _OBS_ENVELOPE)
    df = df.withColumn("_env", env)
    wrapped = F.col("_env.payload").isNotNull()
    bare = F.struct(*[F.col(f"_env.{f.name}").alias(f.name) for f in _OBS_PAYLOAD_FIELDS])
    return (df.withColumn("wrapped", wrapped)
              .withColumn("payload", F.when(F.col("wrapped"), F.col("_env.payload")).otherwise(bare))
              .withColumn("ingested_at_text", F.col("_env.ingested_at"))
              .withColumn("payload_json", F.when(F.col("wrapped"),
                                                 F.get_json_object("envelope_json", "$.payload"))
                                           .otherwise(F.col("envelope_json")))
              .drop("_env"))


def flatten_observations(normalized: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """The 19-column local observation row.  Instants stay as their text;
    numbers are ``try_cast`` (non-numeric text -> NULL); the four quality
    flags are 1/0 only for JSON booleans, NULL otherwise."""
    p = F.col("payload")
    ls = p["latest_stats"]
    return normalized.select(
        F.col("topic").cast("string").alias("topic"),
        tcast("partition", "int").alias("partition"),
        tcast("offset", "bigint").alias("offset"),
        F.col("key").cast("string").alias("key"),
        F.col("dumped_at").cast("string").alias("dumped_at"),
        F.col("ingested_at_text").alias("ingested_at"),
        ls["interval_start"].alias("interval_start"),
        p["id"].try_cast("int").alias("link_id"),
        p["name"].alias("road_name"),
        ls["travel_time"].try_cast("double").alias("travel_time_seconds"),
        ls["delay"].try_cast("double").alias("delay_seconds"),
        ls["speed"].try_cast("double").alias("speed_kmh"),
        p["length"].try_cast("double").alias("length_m"),
        p["minimum_tt"].try_cast("double").alias("minimum_tt_seconds"),
        *[ls[n].cast("int").alias(n) for n in FLAGS],
        F.col("payload_json"),
        *carry,
    )


# ----------------------------------------------------------------- schema hints
def schema_hints(dump: DataFrame) -> DataFrame:
    """Key frequencies of the envelope at three levels (``top``, ``payload``,
    ``latest_stats``) plus the number of messages seen (level ``messages``),
    as ``level, key, n``.  One pass: the keys of each row are packed into one
    array, exploded, and counted with map-side partial aggregation."""
    env = value_text(dump)
    payload = F.get_json_object(env, "$.payload")
    stats = F.get_json_object(payload, "$.latest_stats")
    inner = _kind(env, "$.payload")  # a string that holds JSON is not an object

    def tagged(level: str, keys: Column) -> Column:
        return F.transform(F.coalesce(keys, F.array().cast("array<string>")),
                           lambda k: F.struct(F.lit(level).alias("level"), k.alias("key")))

    keys = F.concat(
        F.array(F.struct(F.lit("messages").alias("level"), F.lit("seen").alias("key"))),
        tagged("top", F.json_object_keys(env)),
        tagged("payload", F.when(inner == "OBJECT", F.json_object_keys(payload))),
        tagged("latest_stats", F.when((inner == "OBJECT") & (_kind(payload, "$.latest_stats") == "OBJECT"),
                                      F.json_object_keys(stats))),
    )
    return (dump.select(F.explode(keys).alias("h"))
                .groupBy(F.col("h.level").alias("level"), F.col("h.key").alias("key"))
                .agg(F.count(F.lit(1)).alias("n")).orderBy("level", F.desc("n"), "key"))


def json_key_counts(df: DataFrame, text_col: str, level: str) -> DataFrame:
    """``level, key, n`` key frequencies of a JSON-object text column."""
    return (df.select(F.explode(F.json_object_keys(text_col)).alias("key"))
              .groupBy(F.lit(level).alias("level"), "key").agg(F.count(F.lit(1)).alias("n")))
