"""Shape the given tables like nested medical records.

Each builder is a narrow projection of one whole table: no join, no grouping,
so it costs no shuffle and no record can grow beyond its source row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordlake.functions.times import DATE_ONLY, MILLIS_Z, SECONDS_Z
from recordlake.sources.layout import LANDING_LEVELS, landing_columns
from recordlake.sources.ndjson import parse_record
from recordlake.session import scratch_dir
from recordlake.sources.tables import FAST_GZIP, spread
from recordlake.plans.specs import (
    CLINICAL_IMPRESSION,
    IMMUNIZATION,
    MEDICATION_ORDER,
    OBSERVATION,
    VERSIONS,
)

AS_OF = "2024-06-01 12:30:45.678"
RECORDS_PER_FILE = 1_000_000

_TEXT, _LONG, _DOUBLE = T.StringType(), T.LongType(), T.DoubleType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, data_type) for name, data_type in fields.items()])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def _millis(moment: Column) -> Column:
    return F.date_format(moment, MILLIS_Z)


def observations(events: DataFrame) -> DataFrame:
    n, ts = F.col("event_id"), F.col("ts")

    def bound(code: str, value: Column) -> Column:
        return F.struct(
            F.lit(code).alias("code"),
            F.lit("urn:unit").alias("system"),
            F.lit("mg").alias("unit"),
            value.alias("value"),
        )

    low = bound("L", F.col("value"))
    high = bound("H", (n % 1000).cast("double"))
    no_high = F.lit(None).cast("struct<code:string,system:string,unit:string,value:double>")
    full = F.struct(low.alias("low"), high.alias("high"))
    low_only = F.struct(low.alias("low"), no_high.alias("high"))
    ranges = (
        F.when(n % 6 == 0, F.filter(F.array(full), lambda _: F.lit(False)))
        .when(n % 6 == 1, F.lit(None))
        .when(n % 6 == 2, F.array(low_only, full))
        .otherwise(F.array(full))
    )
    return events.select(
        _text("user_id").alias("user_id"),
        F.lit(OBSERVATION).alias("resourceType"),
        F.concat(F.lit("obs-"), n.cast("string")).alias("id"),
        F.when(n % 3 == 1, _millis(ts))
        .when(n % 3 == 2, F.date_format(ts, SECONDS_Z))
        .alias("issued"),
        F.when(n % 5 != 0, _millis(ts)).alias("effectiveDateTime"),
        F.struct(F.col("event_type").alias("text")).alias("code"),
        F.struct(
            F.when(n % 4 != 0, F.col("value")).alias("value"),
            F.when(n % 7 != 0, F.lit("mg")).alias("unit"),
        ).alias("valueQuantity"),
        F.struct(F.when(n % 2 == 0, F.col("event_type")).alias("text")).alias(
            "valueCodeableConcept"
        ),
        F.concat(F.lit("n/a:"), F.col("event_type")).alias("valueString"),
        ranges.alias("referenceRange"),
        F.struct(
            F.when(n % 11 == 0, F.lit("not a time")).otherwise(_millis(ts)).alias("lastUpdated")
        ).alias("meta"),
    )


def immunizations(lineitem: DataFrame) -> DataFrame:
    ship, line, order = F.col("l_shipdate"), F.col("l_linenumber"), F.col("l_orderkey")
    code = F.concat(F.col("l_returnflag"), F.col("l_linestatus"))
    return lineitem.select(
        _text("l_suppkey").alias("user_id"),
        F.lit(IMMUNIZATION).alias("resourceType"),
        F.concat_ws("-", order.cast("string"), line.cast("string")).alias("id"),
        F.when(line % 2 == 0, _millis(ship))
        .otherwise(F.date_format(ship, DATE_ONLY))
        .alias("date"),
        _millis(ship).alias("expirationDate"),
        (line % 2 == 0).alias("wasNotGiven"),
        F.struct(
            F.array(
                F.struct(F.lit("urn:flag").alias("system"), F.col("l_returnflag").alias("code"))
            ).alias("coding"),
            code.alias("text"),
        ).alias("vaccineCode"),
        F.struct(
            F.when(order % 9 == 0, F.concat(F.lit("bad "), _millis(ship)))
            .otherwise(_millis(ship))
            .alias("lastUpdated")
        ).alias("meta"),
    )


def clinical_impressions(documents: DataFrame) -> DataFrame:
    doc = F.col("doc_id")
    day = F.date_add(F.lit("2024-01-01").cast("date"), doc.cast("int")).cast("timestamp")
    return documents.select(
        (doc % 10).cast("string").alias("user_id"),
        F.lit(CLINICAL_IMPRESSION).alias("resourceType"),
        doc.cast("string").alias("id"),
        _millis(day).alias("date"),
        F.when(doc % 5 != 0, F.col("source")).alias("description"),
        F.col("lang").alias("summary"),
        F.struct(_millis(day).alias("lastUpdated")).alias("meta"),
    )


def medication_orders(orders: DataFrame, *, refills: bool = True) -> DataFrame:
    """With ``refills``, some participants carry a prior prescription, some a unit."""
    key, day = F.col("o_orderkey"), F.col("o_orderdate")
    prior = F.when(
        (F.col("o_custkey") % 3 == 0) & (key % 2 == 0),
        F.concat(F.lit("prior "), F.col("o_orderpriority")),
    )
    unit = F.when((F.col("o_custkey") % 5 == 0) & (key % 2 == 1), F.lit("tab"))
    extra = [F.struct(prior.alias("display")).alias("priorPrescription")] if refills else []
    amount = [F.struct(unit.alias("unit")).alias("quantity")] if refills else []
    return orders.select(
        _text("o_custkey").alias("user_id"),
        F.lit(MEDICATION_ORDER).alias("resourceType"),
        key.cast("string").alias("id"),
        F.date_format(day, DATE_ONLY).alias("dateWritten"),
        F.struct(
            F.struct(
                F.when(key % 8 == 0, _millis(day))
                .otherwise(F.date_format(day, DATE_ONLY))
                .alias("start")
            ).alias("validityPeriod"),
            *amount,
        ).alias("dispenseRequest"),
        F.struct(
            F.col("o_orderpriority").alias("display"),
            F.when(key % 4 != 0, F.col("o_orderstatus")).alias("reference"),
        ).alias("medicationReference"),
        F.struct(_millis(day).alias("lastUpdated")).alias("meta"),
        *extra,
    )


BUILDERS = {
    OBSERVATION: (observations, "events"),
    IMMUNIZATION: (immunizations, "lineitem"),
    CLINICAL_IMPRESSION: (clinical_impressions, "documents"),
    MEDICATION_ORDER: (medication_orders, "orders"),
}


def raw_records(spark: SparkSession, sf_dir: str, resource_type: str) -> DataFrame:
    build, source = BUILDERS[resource_type]
    return build(table(spark, sf_dir, source))


# ---- one nested JSON text per line item ----

NESTED_SCHEMA = _struct(
    resourceType=_TEXT,
    id=_TEXT,
    meta=_struct(lastUpdated=_TEXT),
    subject=_struct(displayName=_TEXT, address=_struct(nationKey=_LONG)),
    lineItems=T.ArrayType(
        _struct(
            partKey=_LONG, qty=_DOUBLE, note=_TEXT, coding=T.ArrayType(_struct(retFlag=_TEXT))
        )
    ),
    tags=T.ArrayType(_TEXT),
    emptyList=T.ArrayType(_TEXT),
)


def nested_json(lineitem: DataFrame, *carried: str) -> DataFrame:
    """``value``: JSON text with objects, lists of objects, and empty values.

    The list of items has 0, 1 or 2 entries; only second entries have a note.
    """
    part, line = F.col("l_partkey"), F.col("l_linenumber")
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")

    def item(part_key: Column, qty: Column, note: Column, *flags: Column) -> Column:
        codes = F.array(*[F.struct(f.alias("retFlag")) for f in flags])
        return F.struct(
            part_key.alias("partKey"), qty.alias("qty"), note.alias("note"), codes.alias("coding")
        )

    first = item(part, F.col("l_quantity"), F.lit(None).cast("string"), flag)
    second = item(
        part + 1, F.col("l_extendedprice"), F.concat(F.lit("note "), flag), status, flag
    )
    items = (
        F.when(line % 3 == 0, F.filter(F.array(first), lambda _: F.lit(False)))
        .when(line % 3 == 1, F.array(first))
        .otherwise(F.array(first, second))
    )
    body = F.to_json(
        F.struct(
            F.lit("LineRecord").alias("resourceType"),
            F.concat_ws("-", F.col("l_orderkey").cast("string"), line.cast("string")).alias("id"),
            F.struct(_millis(F.col("l_shipdate")).alias("lastUpdated")).alias("meta"),
            F.struct(
                F.concat(F.lit("Supplier "), _text("l_suppkey")).alias("displayName"),
                F.struct((F.col("l_suppkey") % 25).alias("nationKey")).alias("address"),
            ).alias("subject"),
            items.alias("lineItems"),
            F.array(flag, status).alias("tags"),
            F.array().cast("array<string>").alias("emptyList"),
            F.create_map().cast("map<string,string>").alias("emptyObj"),
        )
    )
    return lineitem.select(*carried, body.alias("value"))


def undeclared_files(spark: SparkSession, sf_dir: str) -> str:
    """Files of nested records, three of four with keys that ``NESTED_SCHEMA`` lacks.

    One of these keys is a text in some records and a number in others, and a
    list's objects have different keys. Files are gzip text of a bounded number
    of records each, since gzip cannot be split.
    """
    line, batch = F.col("l_linenumber"), (F.col("l_partkey") % 10).cast("string")
    kind = F.col("l_linenumber") % 4
    checks = F.concat(
        F.lit('"checks":[{"passed":true,"score":'), line.cast("string"), F.lit('},{"score":1.5}]')
    )
    extra = (
        F.when(kind == 0, F.concat(F.lit('"extraInfo":{"batchCode":"B'), batch, F.lit('",'), checks, F.lit("},")))
        .when(kind == 1, F.concat(F.lit('"extraInfo":{"batchCode":'), batch, F.lit("},")))
        .when(kind == 2, F.lit('"extraInfo":{},'))
        .otherwise(F.lit(""))
    )
    lines = table(spark, sf_dir, "lineitem")
    texts = nested_json(lines.withColumn("extra", extra), "extra")
    root = scratch_dir(spark, "undeclared")
    records = texts.select(F.concat(F.lit("{"), "extra", F.expr("substring(value, 2)")).alias("value"))
    writer = records.write.options(**FAST_GZIP)
    writer.option("maxRecordsPerFile", RECORDS_PER_FILE).text(root)
    return root


def nested_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = nested_json(table(spark, sf_dir, "lineitem"))
    return texts.select(parse_record(F.col("value"), NESTED_SCHEMA).alias("r")).select("r.*")


WRITTEN_SCHEMA = _struct(id=_TEXT, items=T.ArrayType(_struct(qty=_DOUBLE, note=_TEXT)))


def written_null_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``text`` and parsed columns; every other order writes its nulls out."""
    line = F.col("l_linenumber")
    note = F.concat(F.lit("note "), F.col("l_returnflag"))
    record = F.struct(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), line.cast("string")).alias("id"),
        F.array(
            F.struct(F.col("l_quantity").alias("qty"), F.when(line > 1, note).alias("note")),
            F.struct(F.col("l_extendedprice").alias("qty"), F.lit(None).cast("string").alias("note")),
            F.struct(F.col("l_quantity").alias("qty"), note.alias("note")),
        ).alias("items"),
    )
    text = F.when(F.col("l_orderkey") % 2 == 0, F.to_json(record)).otherwise(
        F.to_json(record, {"ignoreNullFields": "false"})
    )
    lines = table(spark, sf_dir, "lineitem").select(text.alias("text"))
    return lines.select("text", parse_record(F.col("text"), WRITTEN_SCHEMA).alias("r")).select(
        "text", "r.*"
    )


MIXED_SCHEMA = _struct(
    id=_TEXT, parts=T.ArrayType(_struct(partKey=_LONG)), mixed=T.ArrayType(_TEXT)
)


def mixed_list_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists of objects, every third with a null among them; lists of objects and scalars."""
    line, part = F.col("l_linenumber"), F.col("l_partkey").cast("string")
    key = F.concat_ws("-", F.col("l_orderkey").cast("string"), line.cast("string"))
    body = F.concat(
        F.lit('{"id":"'),
        key,
        F.lit('","parts":['),
        F.when(line % 3 == 0, F.lit("null,")).otherwise(F.lit("")),
        F.lit('{"partKey":'),
        part,
        F.lit('}],"mixed":[{"flag":"'),
        F.col("l_returnflag"),
        F.lit('"},"text",'),
        part,
        F.lit("]}"),
    )
    lines = table(spark, sf_dir, "lineitem").select(body.alias("value"))
    return lines.select(parse_record(F.col("value"), MIXED_SCHEMA).alias("r")).select("r.*")


CLASHING_SCHEMA = _struct(
    id=_TEXT, Id=_TEXT, parts=T.ArrayType(_struct(qty=_DOUBLE, Qty=_DOUBLE))
)


def clashing_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that spell a key ``Id`` or ``id``, and ``Qty`` or ``qty`` in a list."""
    line = F.col("l_linenumber")
    key = F.concat_ws("-", F.col("l_orderkey").cast("string"), line.cast("string"))
    odd, missing = line % 2 == 1, F.lit(None).cast("double")
    body = F.to_json(
        F.struct(
            F.when(odd, key).alias("Id"),
            F.when(~odd, key).alias("id"),
            F.array(
                F.struct(F.col("l_quantity").alias("qty"), missing.alias("Qty")),
                F.struct(missing.alias("qty"), F.col("l_extendedprice").alias("Qty")),
            ).alias("parts"),
        )
    )
    lines = table(spark, sf_dir, "lineitem").select(body.alias("value"))
    return lines.select(parse_record(F.col("value"), CLASHING_SCHEMA).alias("r")).select("r.*")


ORDERED_SCHEMA = _struct(
    id=_TEXT,
    subKey=_TEXT,
    SubKey=_TEXT,
    sub=_struct(Code=_LONG, code=_LONG),
)


def ordered_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``text`` and parsed columns: names that clash, in either order, one of them null at times."""
    line, part = F.col("l_linenumber"), F.col("l_partkey").cast("string")
    key = F.concat_ws("-", F.col("l_orderkey").cast("string"), line.cast("string"))
    spelt = {
        "low": F.concat(F.lit('"subKey":"low'), part, F.lit('"')),
        "high": F.when(line % 3 == 0, F.lit('"SubKey":null')).otherwise(
            F.concat(F.lit('"SubKey":"high'), part, F.lit('"'))
        ),
        "sub": F.when(line % 2 == 0, F.lit('"sub":{"Code":1,"code":2}')).otherwise(
            F.lit('"sub":{"code":2,"Code":1}')
        ),
    }

    def text(*order: str) -> Column:
        body = F.concat_ws(",", *[spelt[name] for name in order])
        return F.concat(F.lit('{"id":"'), key, F.lit('",'), body, F.lit("}"))

    record = F.when(line % 2 == 0, text("low", "sub", "high")).otherwise(text("high", "sub", "low"))
    lines = table(spark, sf_dir, "lineitem").select(record.alias("text"))
    return lines.select("text", parse_record(F.col("text"), ORDERED_SCHEMA).alias("r")).select("text", "r.*")


# ---- NDJSON files of events ----

EVENT_SCHEMA = _struct(
    event_id=_LONG, ts=_TEXT, user_id=_LONG, event_type=_TEXT, value=_DOUBLE, props=_TEXT
)
BUCKET_DIRECTORY = r"^(.*/bucket=[^/]+)/"
BROKEN_LINE = '{"event_id": 1, "event_type": "cli'


def event_lines(spark: SparkSession, sf_dir: str, *, broken: bool = False) -> DataFrame:
    """``bucket, value``: one JSON text per event; eight buckets of users.

    With ``broken``, bucket 3 gets a malformed line.
    """
    event = F.struct(
        "event_id",
        F.date_format("ts", MILLIS_Z).alias("ts"),
        *["user_id", "event_type", "value", "props"],
    )
    lines = table(spark, sf_dir, "events").select(
        (F.col("user_id") % 8).alias("bucket"), F.to_json(event).alias("value")
    )
    bad = F.lit(3).cast("bigint").alias("bucket"), F.lit(BROKEN_LINE).alias("value")
    return lines.unionByName(spark.range(1).select(*bad)) if broken else lines


def write_event_files(spark: SparkSession, sf_dir: str) -> str:
    """One directory of NDJSON per bucket; bucket 3 gets a malformed line."""
    root = scratch_dir(spark, "event-files")
    lines = event_lines(spark, sf_dir, broken=True)
    lines.hint("rebalance", "bucket").write.partitionBy("bucket").text(root)
    return root


def write_bad_bytes(spark: SparkSession, sf_dir: str) -> str:
    """``write_event_files``, and in bucket 5 a record whose text is no UTF-8."""
    root = scratch_dir(spark, "event-bytes")
    raw = F.concat(F.lit(b'{"event_id": 2, "event_type": "caf'), F.unhex(F.lit("E9")), F.lit(b'"}'))
    bad = spark.range(1).select(
        F.lit(5).cast("bigint").alias("bucket"), raw.cast("string").alias("value")
    )
    lines = event_lines(spark, sf_dir, broken=True).unionByName(bad)
    lines.hint("rebalance", "bucket").write.partitionBy("bucket").text(root)
    return root


def write_typed_landing(spark: SparkSession, sf_dir: str) -> str:
    """Two participants' files whose types differ: value a number or a text, and own keys."""
    root = scratch_dir(spark, "typed-landing")
    odd = F.col("event_id") % 2 == 1
    first = F.struct("event_id", F.col("value").alias("reading"), F.struct("user_id").alias("of"))
    second = F.struct(
        "event_id",
        F.col("event_type").alias("reading"),
        F.struct(F.col("user_id").cast("double").alias("user_id"), F.array("props").alias("props")).alias("of"),
    )
    levels = landing_columns(
        F.lit("2024-01-02").cast("timestamp"),
        source="events",
        user_id=F.when(odd, "001").otherwise("002"),
        version=F.lit("dstu2"),
        model=F.lit(OBSERVATION),
    )
    lines = table(spark, sf_dir, "events").select(
        F.when(odd, F.to_json(first)).otherwise(F.to_json(second)).alias("value"),
        *[c.alias(n) for n, c in levels.items()],
    )
    lines.write.partitionBy(*levels).text(root)
    return root


def write_landing(spark: SparkSession, sf_dir: str) -> str:
    """Events in the raw landing layout, under four participant ids such as ``007``."""
    root = scratch_dir(spark, "landing")
    levels = landing_columns(
        F.col("ts"),
        source="events",
        user_id=F.format_string("%03d", F.col("user_id") % 4),
        version=F.lit("dstu2"),
        model=F.lit(OBSERVATION),
    )
    event = F.struct(
        "event_id", F.date_format("ts", MILLIS_Z).alias("ts"), "event_type", "value"
    )
    lines = table(spark, sf_dir, "events").select(
        F.to_json(event).alias("value"), *[c.alias(n) for n, c in levels.items()]
    )
    levels = (*LANDING_LEVELS, "model")
    lines.hint("rebalance", *levels).write.partitionBy(*levels).text(root)
    return root


LANDING_SCHEMA = _struct(event_id=_LONG, ts=_TEXT, event_type=_TEXT, value=_DOUBLE)


RECORD_LEVELS = ("source", "user_id", "version", "year", "month", "day", "model")
RECORD_DIRECTORY = r"^(.*/model=[^/]+)/"


def record_schema(spark: SparkSession, sf_dir: str, resource_type: str) -> T.StructType:
    """The schema of the records in files, where only the path names the participant."""
    return raw_records(spark, sf_dir, resource_type).drop("user_id").schema


def write_record_files(spark: SparkSession, sf_dir: str) -> str:
    """All four record types in the landing layout, under 15 participants such as ``007``.

    The observations of participant ``003`` have a malformed line. Files are gzip
    text of a rebalanced partition each, a tenth of the bytes on disk.
    """
    root = scratch_dir(spark, "record-files")
    user = F.col("user_id").cast("bigint") % 15
    rows = None
    for resource_type in BUILDERS:
        raw = raw_records(spark, sf_dir, resource_type)
        part = raw.select(
            user.alias("user"),
            F.lit(resource_type).alias("model"),
            F.to_json(F.struct(*[c for c in raw.columns if c != "user_id"])).alias("value"),
        )
        rows = part if rows is None else rows.unionByName(part)
    broken = spark.range(1).select(
        F.lit(3).cast("bigint").alias("user"),
        F.lit(OBSERVATION).alias("model"),
        F.lit(BROKEN_LINE).alias("value"),
    )
    levels = landing_columns(
        F.lit("2024-01-02").cast("timestamp"),
        source="demo",
        user_id=F.format_string("%03d", F.col("user")),
        version=F.lit("dstu2"),
        model=F.col("model"),
    )
    lines = rows.unionByName(broken).select("value", *[c.alias(n) for n, c in levels.items()])
    writer = lines.hint("rebalance", *RECORD_LEVELS).write.option("compression", "gzip")
    writer.partitionBy(*RECORD_LEVELS).text(root)
    return root


# ---- promises and arrivals ----

PROMISE_WAVES = 2
_CLOSING = "2030-01-01"


def promised_files(spark: SparkSession, sf_dir: str, wave: int) -> tuple[DataFrame, DataFrame]:
    """What a wave promises (url, promised_at) and what arrives in it (url, arrived_at).

    Every tenth event is a file. One of three never comes; of the others one of
    seven comes two days late, in the later wave or not at all in time. After
    the last wave both go on far later, so that all promises run out.
    """
    events = table(spark, sf_dir, "events").where(F.col("event_id") % 10 == 0)
    url = F.concat(F.lit("files/"), F.col("event_id").cast("string"))
    late = F.when(F.col("event_id") % 7 == 0, F.expr("INTERVAL 2 DAYS")).otherwise(F.expr("INTERVAL 2 HOURS"))
    files = events.select(
        "event_id",
        url.alias("url"),
        F.col("ts").cast("timestamp").alias("promised_at"),
        (F.col("ts").cast("timestamp") + late).alias("arrived_at"),
    )
    if wave == PROMISE_WAVES:
        end = [("files/end", f"{_CLOSING} 00:00:00")]
        closing = spark.createDataFrame(end, "url string, at string").withColumn("at", F.col("at").cast("timestamp"))
        return (closing.withColumnRenamed("at", c) for c in ("promised_at", "arrived_at"))
    middle = F.lit("2024-01-15").cast("timestamp")

    def of_wave(at: str) -> Column:
        return F.col(at) < middle if wave == 0 else F.col(at) >= middle

    come = files.where((F.col("event_id") % 3 != 0) & of_wave("arrived_at"))
    return files.where(of_wave("promised_at")).select("url", "promised_at"), come.select("url", "arrived_at")


# ---- control rows ----


def manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One export manifest per event, three files each; types repeat within and across."""
    n, kind = F.col("event_id"), F.col("event_type")

    def entry(type_: Column, name: str) -> Column:
        return F.struct(type_.alias("type"), F.concat(F.lit(f"u/{name}/"), n.cast("string")).alias("url"))

    return table(spark, sf_dir, "events").select(
        _text("user_id").alias("user_id"),
        F.element_at(F.array(*[F.lit(v) for v in VERSIONS]), (n % 3 + 1).cast("int")).alias("version"),
        n.alias("export_id"),
        F.array(entry(kind, "a"), entry(F.lit("Patient"), "b"), entry(kind, "c")).alias("output"),
    )


def control_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: source, version and model; status is skip, proceed or null."""
    key, priority, status = F.col("o_orderkey"), F.col("o_orderpriority"), F.col("o_orderstatus")
    model = (
        F.when(priority == "1-URGENT", OBSERVATION)
        .when(priority == "2-HIGH", IMMUNIZATION)
        .when(priority == "3-MEDIUM", CLINICAL_IMPRESSION)
        .when(priority == "4-NOT SPECIFIED", MEDICATION_ORDER)
        .otherwise("Patient")
    )
    version = F.element_at(F.array(*[F.lit(v) for v in VERSIONS]), (key % 3 + 1).cast("int"))
    return table(spark, sf_dir, "orders").select(
        key.alias("input_key"),
        F.when(key % 7 == 0, "archive").otherwise("orders").alias("source"),
        version.alias("version"),
        model.alias("model"),
        F.when(status == "F", "skip").when(status == "O", "proceed").alias("status"),
    )
