"""Record types and fixed vocabularies.

Records are explicit StructTypes (no schema inference anywhere). Enum fields are strings;
``valid_record`` gives the predicate that checks them and the required fields.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These must equal the reference's enums for results to match.
# ---------------------------------------------------------------------------
SITUATIONS = ["COMPLETE", "MISSING_BODY", "MISSING_ENGINE", "MISSING_REMOTE_CONTROL",
              "MISSING_WHEELS", "INCOMPLETE", "AWAITING_PRICE", "FAILED_GET_PRICE"]
CHANNEL_FREQUENCIES = ["RF_27", "RF_49", "RF_50", "RF_53", "RF_72", "RF_75"]
WHEEL_PLACEMENTS = ["FRONT_LEFT", "FRONT_RIGHT", "REAR_LEFT", "REAR_RIGHT"]
BR_STATES = ["AC", "AL", "AP", "AM", "BA", "CE", "DF", "ES", "GO", "MA", "MT", "MS", "MG",
             "PA", "PB", "PR", "PE", "PI", "RJ", "RN", "RS", "RO", "RR", "SC", "SP", "SE",
             "TO"]
# Topic names used by the jobs (callers may pass others).
TOPIC_BODY = "rccar-body"
TOPIC_ENGINE = "rccar-engine"
TOPIC_REMOTE_CONTROL = "rccar-remote-control"
TOPIC_WHEEL = "rccar-wheel"
TOPIC_TAXTAG = "rccar-taxtag"
TOPIC_COMPLETE = "rccar-complete"
TOPIC_INCOMPLETE = "rccar-incomplete"
TOPIC_LAST_TAX_TAGS = "last-tax-tags"
TOPIC_TEXT_IN = "flink_kafka1"
TOPIC_TEXT_OUT = "flink_kafka3"
WORD_COUNT_SEPARATOR = ":::"
FIRST_BODY_COLOR = "RUNNAWAY_DONKEY"
EXPECTED_WHEELS = 4
LAST_N_TAGS = 3
WHEEL_PRICE_FACTOR = 4
JOIN_WAIT_MS = 5_000
PRICED_WAIT_MS = 15_000
LOOKUP_CAPACITY = 5
LOOKUP_TIMEOUT_S = 30
LOOKUP_RETRIES = 3
LOOKUP_RETRY_DELAY_S = 10
# ---------------------------------------------------------------------------

PART = T.StructType([
    T.StructField("sku", T.StringType()),
    T.StructField("partName", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("productName", T.StringType()),
])
BODY = T.StructType([
    T.StructField("part", PART), T.StructField("id", T.StringType()),
    T.StructField("color", T.StringType()), T.StructField("material", T.StringType()),
    T.StructField("weight", T.FloatType()),
])
ENGINE = T.StructType([T.StructField("part", PART), T.StructField("id", T.StringType())])
REMOTE_CONTROL = T.StructType([
    T.StructField("part", PART), T.StructField("id", T.StringType()),
    T.StructField("channelFrequency", T.StringType()),
])
WHEEL = T.StructType([
    T.StructField("part", PART), T.StructField("id", T.StringType()),
    T.StructField("placement", T.StringType()),
])
CAR = T.StructType([
    T.StructField("sku", T.StringType()),
    T.StructField("totalPrice", T.DoubleType()),
    T.StructField("body", BODY), T.StructField("engine", ENGINE),
    T.StructField("remoteControl", REMOTE_CONTROL),
    T.StructField("wheels", T.ArrayType(WHEEL)),
    T.StructField("situation", T.StringType()),
])
TAX_TAG = T.StructType([T.StructField("icms", T.DoubleType()),
                        T.StructField("state", T.StringType())])
LAST_TAX_TAGS = T.StructType([T.StructField("stateName", T.StringType()),
                              T.StructField("taxTags", T.ArrayType(TAX_TAG))])

# Fields that a record must have (all but those with a default or a null in their schema),
# and fields that take the symbols of an enum.
REQUIRED = {"part", "sku", "partName", "id", "color", "material", "weight",
            "channelFrequency", "placement", "icms", "state", "stateName", "situation"}
ENUMS = {"channelFrequency": CHANNEL_FREQUENCIES, "placement": WHEEL_PLACEMENTS,
         "state": BR_STATES, "situation": SITUATIONS}


def valid_record(col: Column, struct: T.StructType) -> Column:
    """Predicate: required fields are there and enums hold one of their symbols, in nested
    records and arrays too (a null record or array is checked by its own field)."""
    ok = F.lit(True)
    for f in struct.fields:
        c = col.getField(f.name)
        if f.name in REQUIRED:
            ok = ok & c.isNotNull()
        if f.name in ENUMS and isinstance(f.dataType, T.StringType):
            ok = ok & (c.isNull() | c.isin(ENUMS[f.name]))
        if isinstance(f.dataType, T.StructType):
            ok = ok & (c.isNull() | valid_record(c, f.dataType))
        elif (isinstance(f.dataType, T.ArrayType)
              and isinstance(f.dataType.elementType, T.StructType)):
            each = f.dataType.elementType
            ok = ok & (c.isNull() | F.forall(c, lambda x: x.isNull()
                                             | valid_record(x, each)))
    return ok


def avro_schema(struct: T.StructType, name: str, namespace: str = "partflow") -> str:
    """Avro schema (JSON text) for a record StructType, as ``from_avro`` needs it:
    nested structs become records, arrays arrays, nullable fields unions with null."""
    import json
    prim = {T.StringType: "string", T.DoubleType: "double", T.FloatType: "float",
            T.LongType: "long", T.IntegerType: "int", T.BooleanType: "boolean",
            T.BinaryType: "bytes"}

    def conv(dt, nm):
        if isinstance(dt, T.StructType):
            return {"type": "record", "name": nm, "namespace": namespace,
                    "fields": [{"name": f.name, "type": field(f.dataType, f.nullable,
                                                              nm + "_" + f.name)}
                               for f in dt.fields]}
        if isinstance(dt, T.ArrayType):
            return {"type": "array", "items": field(dt.elementType, dt.containsNull, nm + "_item")}
        return prim[type(dt)]

    def field(dt, nullable, nm):
        t = conv(dt, nm)
        return ["null", t] if nullable else t

    return json.dumps(conv(struct, name))
