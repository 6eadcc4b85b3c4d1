"""The registered queries: every operator, run over the whole given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlake import fixtures
from recordlake.fixtures import AS_OF, raw_records, table
from recordlake.functions.names import camel_to_snake, camel_to_snake_value, snake_case_value
from recordlake.functions.times import MILLIS_Z
from recordlake.operators import control
from recordlake.operators.counts import StageReport
from recordlake.operators.explode import explode_flatten
from recordlake.operators.flatten import flatten
from recordlake.operators.staging import stage
from recordlake.operators.unify import distinct_types, project, unify, unify_mixed
from recordlake.plans.medical_records import medical_records
from recordlake.plans.specs import (
    CLINICAL_IMPRESSION,
    IMMUNIZATION,
    KNOWN_MODELS,
    MEDICATION_ORDER,
    OBSERVATION,
    PRIORITY,
    RECORD_COLUMNS,
    STAGING,
)
from recordlake.plans.stored_chain import medical_records_stored
from recordlake.session import lake_session, scratch_dir
from recordlake.sources import catalog, layout, ndjson, registry, tables, variants
from recordlake.streaming.arrivals import absent_files, write_absent
from recordlake.streaming.incremental import accepted, ingest_new_files, ingest_units

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    """Register ``build`` under its name, run in a session with our settings."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(lake_session(spark), sf_dir.rstrip("/"))

    QUERIES[build.__name__] = run
    return run


def text_of(*names: str) -> list[Column]:
    return [F.col(name).cast("string").alias(name) for name in names]


def listed(name: str, sep: str = "|") -> Column:
    """A list as text, so that results compare across engines."""
    return F.array_join(F.col(name), sep).alias(name)


def staged(spark: SparkSession, sf_dir: str, resource_type: str) -> DataFrame:
    return stage(
        flatten(raw_records(spark, sf_dir, resource_type)),
        STAGING[resource_type],
        participant=F.col("user_id"),
        as_of=AS_OF,
        input_id="user_id",
    )


# ---- staging ----


@query
def stage_observation(spark, sf_dir):
    return staged(spark, sf_dir, OBSERVATION).select(
        "participant_id",
        "id",
        *text_of("issued", "effective_date_time", "value_quantity__value", "meta__last_updated"),
        "value_quantity__unit",
        "value_codeable_concept__text",
        "value_string",
        "medical_last_updated",
    )


@query
def stage_missing_columns(spark, sf_dir):
    flat = flatten(raw_records(spark, sf_dir, OBSERVATION)).select("user_id", "id", "resource_type")
    out = stage(flat, STAGING[OBSERVATION], participant=F.col("user_id"), as_of=AS_OF)
    return out.select(
        "participant_id",
        "id",
        *text_of("issued", "effective_date_time", "value_quantity__value"),
        "value_quantity__unit",
        "value_codeable_concept__text",
        "value_string",
        F.size("reference_range__low").cast("bigint").alias("low_entries"),
        F.get("reference_range__low", F.lit(0))["value"].cast("string").alias("low_value"),
        F.size("reference_range__high").cast("bigint").alias("high_entries"),
        F.get("reference_range__high", F.lit(0))["code"].alias("high_code"),
    )


@query
def stage_immunization(spark, sf_dir):
    return staged(spark, sf_dir, IMMUNIZATION).select(
        "participant_id",
        "id",
        *text_of("date", "expiration_date", "meta__last_updated", "was_not_given"),
        "medical_last_updated",
    )


@query
def stage_clinical_impression(spark, sf_dir):
    return staged(spark, sf_dir, CLINICAL_IMPRESSION).select(
        "participant_id", "id", *text_of("date", "meta__last_updated"), "description", "summary"
    )


@query
def stage_medication_order(spark, sf_dir):
    """One input: the declared schema alone decides on markers."""
    raw = fixtures.medication_orders(table(spark, sf_dir, "orders"), refills=False)
    out = stage(
        flatten(raw), STAGING[MEDICATION_ORDER], participant=F.col("user_id"), as_of=AS_OF
    )
    return out.select(
        "participant_id",
        "id",
        *text_of("date_written", "dispense_request__validity_period__start", "meta__last_updated"),
        "prior_prescription__display",
        "medication_reference__reference",
        "dispense_request__quantity__unit",
    )


@query
def stage_medication_order_per_input(spark, sf_dir):
    return staged(spark, sf_dir, MEDICATION_ORDER).select(
        "participant_id",
        "id",
        *text_of("date_written", "dispense_request__validity_period__start"),
        "prior_prescription__display",
        "medication_reference__reference",
        "dispense_request__quantity__unit",
    )


# ---- unification ----


@query
def unify_observation(spark, sf_dir):
    return project(staged(spark, sf_dir, OBSERVATION), OBSERVATION)


@query
def unify_observation_sparse_ranges(spark, sf_dir):
    """Reference ranges whose lower bounds lack a value in every object of every list."""
    flat = flatten(raw_records(spark, sf_dir, OBSERVATION))
    low = F.transform("reference_range__low", lambda x: F.struct(x["code"].alias("code")))
    out = stage(
        flat.withColumn("reference_range__low", low),
        STAGING[OBSERVATION],
        participant=F.col("user_id"),
        as_of=AS_OF,
    )
    return project(out, OBSERVATION).select(*RECORD_COLUMNS)


@query
def unify_immunization(spark, sf_dir):
    return project(staged(spark, sf_dir, IMMUNIZATION), IMMUNIZATION)


@query
def unify_clinical_impression(spark, sf_dir):
    return project(staged(spark, sf_dir, CLINICAL_IMPRESSION), CLINICAL_IMPRESSION)


@query
def unify_medication_order(spark, sf_dir):
    return project(staged(spark, sf_dir, MEDICATION_ORDER), MEDICATION_ORDER)


@query
def unify_all(spark, sf_dir):
    return unify({t: staged(spark, sf_dir, t) for t in PRIORITY})


def mixed_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All four types in one input table; every type occurs alone in some inputs.

    One hot input holds a third of the immunizations and of the orders.
    """
    who = F.col("participant_id").cast("bigint")
    line = F.split_part("id", F.lit("-"), F.lit(2)).cast("bigint")
    number = {
        OBSERVATION: who * 3,
        IMMUNIZATION: F.when(line % 3 != 0, who * 2),
        CLINICAL_IMPRESSION: who,
        MEDICATION_ORDER: F.when(F.col("id").cast("bigint") % 3 != 0, who),
    }
    rows = None
    for resource_type, n in number.items():
        part = staged(spark, sf_dir, resource_type).withColumns(
            {
                "input_id": F.concat(F.lit("in-"), F.coalesce(n.cast("string"), F.lit("hot"))),
                # text where an input got the marker
                "meta__last_updated": F.col("meta__last_updated").cast("string"),
            }
        )
        rows = part if rows is None else rows.unionByName(part, allowMissingColumns=True)
    return rows


@query
def unify_mixed_input(spark, sf_dir):
    return unify_mixed(mixed_staged(spark, sf_dir))


@query
def unify_first_match(spark, sf_dir):
    return unify_mixed(mixed_staged(spark, sf_dir), mode="first_match", input_id="input_id")


@query
def unify_first_match_shuffled(spark, sf_dir):
    """As for inputs too many to broadcast."""
    return unify_mixed(
        mixed_staged(spark, sf_dir), mode="first_match", input_id="input_id", broadcast_bytes=0
    )


@query
def distinct_resource_types(spark, sf_dir):
    return distinct_types(unify({t: staged(spark, sf_dir, t) for t in PRIORITY}))


# ---- flattening ----


@query
def flatten_struct(spark, sf_dir):
    return flatten(fixtures.nested_records(spark, sf_dir)).select(
        "id",
        "resource_type",
        "meta__last_updated",
        "subject__display_name",
        "subject__address__nation_key",
    )


@query
def flatten_arrays(spark, sf_dir):
    return flatten(fixtures.nested_records(spark, sf_dir)).select(
        "id",
        listed("line_items__part_key"),
        listed("line_items__qty"),
        listed("line_items__note"),
        listed("tags"),
        listed("empty_list"),
    )


@query
def flatten_arrays_aligned(spark, sf_dir):
    flat = flatten(fixtures.nested_records(spark, sf_dir), aligned=True)
    return flat.select(
        "id",
        listed("line_items__part_key"),
        F.array_join("line_items__note", "|", "~").alias("line_items__note"),
    )


@query
def flatten_nested_array(spark, sf_dir):
    coding = F.col("line_items__coding")
    return flatten(fixtures.nested_records(spark, sf_dir)).select(
        "id",
        F.when(coding.isNotNull(), F.size(coding)).cast("bigint").alias("n_lists"),
        F.array_join(F.flatten(coding)["retFlag"], "|").alias("flags"),
    )


@query
def flatten_mixed_lists(spark, sf_dir):
    """A list with a null among its objects, or of objects and scalars, stays whole."""
    return flatten(fixtures.mixed_list_records(spark, sf_dir)).select(
        "id", F.to_json("parts").alias("parts"), listed("parts__part_key"), listed("mixed")
    )


@query
def flatten_collision(spark, sf_dir):
    flat = flatten(fixtures.clashing_records(spark, sf_dir), on_collision="coalesce")
    return flat.select("id", listed("parts__qty"))


@query
def flatten_written_nulls(spark, sf_dir):
    flat = flatten(fixtures.written_null_records(spark, sf_dir), text="text")
    return flat.select("id", listed("items__qty"), F.array_join("items__note", "|", "~").alias("items__note"))


@query
def flatten_last_key(spark, sf_dir):
    """Of names that clash, the key that the record's text has last."""
    flat = flatten(fixtures.ordered_records(spark, sf_dir), text="text", on_collision="last")
    return flat.select("id", "sub_key", "sub__code")


def _path_text(path: str = "path") -> Column:
    keys = F.transform(path, lambda k: F.coalesce(k, F.lit("[]")))
    return F.array_join(keys, ".").alias("path")


@query
def key_census(spark, sf_dir):
    """Every key path of the nested records, with its types."""
    records = variants.read_records(spark, fixtures.undeclared_files(spark, sf_dir))
    return variants.key_census(records).select(_path_text(), "type", "n")


@query
def undeclared_keys(spark, sf_dir):
    """Key paths that occur and that no schema declares."""
    records = variants.read_records(spark, fixtures.undeclared_files(spark, sf_dir))
    census = variants.key_census(records)
    return variants.undeclared(census, fixtures.NESTED_SCHEMA).select(_path_text(), "type", "n")


@query
def flatten_undeclared(spark, sf_dir):
    """Whatever keys occur are flattened, declared or not."""
    records = variants.read_records(spark, fixtures.undeclared_files(spark, sf_dir))
    found = variants.schema_of_census(variants.key_census(records).collect())
    schema = variants.merged(fixtures.NESTED_SCHEMA, found)
    flat = flatten(variants.with_columns(records.select(variants.RECORD), schema))
    return flat.select(
        "id",
        "subject__display_name",
        listed("line_items__part_key"),
        "extra_info__batch_code",
        listed("extra_info__checks__passed"),
        listed("extra_info__checks__score"),
    )


@query
def explode_flatten_dunder(spark, sf_dir):
    nested = fixtures.nested_records(spark, sf_dir).select("id", "subject", "lineItems")
    return explode_flatten(nested, "__", rename=camel_to_snake).select(
        "id",
        "subject__display_name",
        "subject__address__nation_key",
        "line_items__part_key",
        *text_of("line_items__qty"),
        "line_items__note",
        "line_items__coding__ret_flag",
    )


@query
def explode_flatten_cross(spark, sf_dir):
    nested = fixtures.nested_records(spark, sf_dir).select("id", "lineItems", "tags", "emptyList")
    return explode_flatten(nested).select(
        "id", "lineItems_partKey", "lineItems_coding_retFlag", "tags", "emptyList"
    )


# ---- names ----


def _spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with single capitals, runs of capitals and none, and whole documents."""
    parts = table(spark, sf_dir, "part").select(
        F.concat("p_name", "p_type", "p_brand", F.lit("xYz")).alias("value")
    )
    texts = table(spark, sf_dir, "documents").select(F.col("text").alias("value"))
    return parts.unionByName(texts)


@query
def snake_case_values(spark, sf_dir):
    return _spellings(spark, sf_dir).select(
        "value", snake_case_value(F.col("value")).alias("snake")
    )


@query
def camel_to_snake_values(spark, sf_dir):
    return _spellings(spark, sf_dir).select(
        "value", camel_to_snake_value(F.col("value")).alias("snake")
    )


# ---- NDJSON files ----


def _audited(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    root = fixtures.write_event_files(spark, sf_dir)
    lines = ndjson.read_lines(spark, root)
    return root, ndjson.audit_files(lines, unit_pattern=fixtures.BUCKET_DIRECTORY)


@query
def quarantine_good(spark, sf_dir):
    root, audit = _audited(spark, sf_dir)
    records = ndjson.read_ndjson(spark, root, fixtures.EVENT_SCHEMA)
    good = ndjson.keep_good(records, audit, unit_pattern=fixtures.BUCKET_DIRECTORY)
    return good.select("bucket", *fixtures.EVENT_SCHEMA.names)


@query
def quarantine_bad(spark, sf_dir):
    _, audit = _audited(spark, sf_dir)
    return ndjson.rejected_files(audit).select(
        F.regexp_extract("unit", "bucket=(.*)$", 1).alias("bucket"), "n_records", "n_bad"
    )


@query
def quarantine_bad_bytes(spark, sf_dir):
    """Bytes that are no UTF-8 reject their file, as a malformed line does."""
    lines = ndjson.read_lines(spark, fixtures.write_bad_bytes(spark, sf_dir))
    audit = ndjson.audit_files(lines, unit_pattern=fixtures.BUCKET_DIRECTORY)
    return ndjson.rejected_files(audit).select(
        F.regexp_extract("unit", "bucket=(.*)$", 1).alias("bucket"), "n_records", "n_bad"
    )


@query
def file_counts(spark, sf_dir):
    _, audit = _audited(spark, sf_dir)
    return ndjson.count_files(audit)


@query
def missing_files(spark, sf_dir):
    """Orders name the buckets they expect; some of those were never written."""
    root = fixtures.write_event_files(spark, sf_dir)
    bucket = F.regexp_extract("path", "bucket=([^/]+)/", 1).alias("bucket")
    files = layout.list_files(spark, root, "*.txt").select(bucket)
    expected = table(spark, sf_dir, "orders").groupBy(
        (F.col("o_custkey") % 12).cast("string").alias("bucket")
    )
    control = expected.agg(F.count(F.lit(1)).alias("n_orders"))
    return layout.mark_missing(control, files, "bucket").select("bucket", "n_orders", "found")


@query
def listed_files(spark, sf_dir):
    """Events of the buckets a control table lists; one of those was never written."""
    root = fixtures.write_event_files(spark, sf_dir)
    bucket = (F.col("r_regionkey") * 2).cast("string").alias("bucket")
    control_table = spark.read.parquet(f"{sf_dir}/region.parquet").select(bucket)
    events = ndjson.read_ndjson(
        spark, root, fixtures.EVENT_SCHEMA, basePath=root, ignoreMissingFiles="true"
    )
    return layout.listed_only(events, control_table, "bucket").select(
        "bucket", *fixtures.EVENT_SCHEMA.names
    )


@query
def file_lineage(spark, sf_dir):
    root = fixtures.write_landing(spark, sf_dir)
    lines = ndjson.read_lines(spark, root, basePath=root)
    audit = ndjson.audit_files(lines, unit_pattern="^(.*/model=[^/]+)/")
    return layout.describe_files(audit).select(
        F.regexp_extract("path", "/(source=.*)$", 1).alias("path"),
        "source",
        "user_id",
        "version",
        "model",
        "n_records",
    )


@query
def landing_roundtrip(spark, sf_dir):
    root = fixtures.write_landing(spark, sf_dir)
    records = ndjson.read_ndjson(spark, root, fixtures.LANDING_SCHEMA, basePath=root)
    return records.select(*fixtures.LANDING_SCHEMA.names, *layout.LANDING_LEVELS, "model")


@query
def load_parquet(spark, sf_dir):
    """Many landing files, schema inferred, to one partitioned Parquet dataset."""
    root = fixtures.write_landing(spark, sf_dir)
    out = scratch_dir(spark, "loaded")
    records = variants.read_records(spark, root, basePath=root)
    schemas = variants.infer_schemas(records, registry.KEYS)
    loaded = tables.load_records(records, schemas["events", "dstu2", OBSERVATION])
    tables.write_table(loaded, out, layout.LOADED_LEVELS, rebalance=True)
    return tables.read_tables(spark, out, loaded.schema).select(
        *fixtures.LANDING_SCHEMA.names, *layout.LOADED_LEVELS
    )


@query
def load_merged_types(spark, sf_dir):
    """Files that disagree on a type, loaded and registered from one reading of their text."""
    root = fixtures.write_typed_landing(spark, sf_dir)
    records = variants.read_records(spark, root, basePath=root)
    schemas = variants.infer_schemas(records, registry.KEYS)
    known = scratch_dir(spark, "typed-schemas")
    registry.write_schemas(spark, known, schemas)
    schema = registry.schema_of(registry.read_schemas(spark, known), OBSERVATION)
    flat = flatten(tables.load_records(records, schema))
    return flat.select("user_id", "event_id", "reading", "of__user_id", listed("of__props"))


@query
def ndjson_gz_roundtrip(spark, sf_dir):
    out = scratch_dir(spark, "gz")
    events = table(spark, sf_dir, "events")
    events = events.withColumn("ts", F.date_format("ts", MILLIS_Z))
    tables.write_ndjson(events, out, records_per_file=50_000)
    return ndjson.read_ndjson(spark, out, fixtures.EVENT_SCHEMA).drop(ndjson.SOURCE_FILE)


# ---- tables and schemas ----


@query
def parquet_overwrite_roundtrip(spark, sf_dir):
    """Two of five partitions are replaced, the others stay."""
    out = scratch_dir(spark, "overwrite")
    events = table(spark, sf_dir, "events").select("event_id", "value", "event_type")
    tables.write_table(events, out, ["event_type"])
    changed = events.where(F.col("event_type").isin("click", "view"))
    tables.write_table(changed.withColumn("value", F.lit(-1.0)), out, ["event_type"], rebalance=True)
    return tables.read_tables(spark, out, events.schema)


@query
def parquet_merged_scan(spark, sf_dir):
    """Two inputs with different columns, in one scan."""
    first, second = scratch_dir(spark, "merge-a"), scratch_dir(spark, "merge-b")
    events = table(spark, sf_dir, "events")
    even = F.col("event_id") % 2 == 0
    tables.write_table(events.where(even).select("event_id", "value"), first)
    tables.write_table(events.where(~even).select("event_id", "event_type"), second)
    return tables.read_tables(spark, [first, second]).select("event_id", "value", "event_type")


@query
def schema_registry(spark, sf_dir):
    """Schemas inferred from all landing files, stored, and listed by column."""
    landing = fixtures.write_landing(spark, sf_dir)
    records = variants.read_records(spark, landing, basePath=landing)
    root = scratch_dir(spark, "schemas")
    registry.write_schemas(spark, root, variants.infer_schemas(records, registry.KEYS))
    return registry.table_definitions(registry.read_schemas(spark, root))


@query
def schema_files(spark, sf_dir):
    """Schemas in files named by record type, one with nested types; other files are skipped."""
    records, root = scratch_dir(spark, "nested"), scratch_dir(spark, "schema-files")
    fixtures.nested_json(table(spark, sf_dir, "lineitem")).select("value").write.text(records)
    inferred = {
        "Nested": ndjson.read_ndjson(spark, records).drop(ndjson.SOURCE_FILE).schema,
        "orders/Order": table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus").schema,
    }
    registry.write_schema_files(spark, root, inferred)
    table(spark, sf_dir, "region").write.json(f"{root}/other")
    return registry.table_definitions(registry.read_schema_files(spark, root))


def _catalogued(spark: SparkSession, sf_dir: str) -> str:
    """A table made from the registered schema, loaded from the landing files; its name."""
    landing, root = fixtures.write_landing(spark, sf_dir), scratch_dir(spark, "catalogued")
    records = variants.read_records(spark, landing, basePath=landing)
    registry.write_schemas(spark, f"{root}/schemas", variants.infer_schemas(records, registry.KEYS))
    known = registry.read_schemas(spark, f"{root}/schemas")
    wanted = {OBSERVATION: f"observation_{uuid.uuid4().hex}"}
    (name,) = catalog.define_tables(spark, known, wanted, f"{root}/tables")
    loaded = tables.load_records(records, registry.schema_of(known, OBSERVATION))
    catalog.store(loaded, name, rebalance=True)
    return name


@query
def catalog_levels(spark, sf_dir):
    """Two participants of a table whose partitions the catalog holds."""
    name = _catalogued(spark, sf_dir)
    return catalog.read_levels(spark, name, user_id=["001", "003"], source="events")


@query
def catalog_partitions(spark, sf_dir):
    """Partitions that a write recorded, and one written past the catalog and adopted."""
    landing, out = fixtures.write_landing(spark, sf_dir), scratch_dir(spark, "adopted")
    name = f"adopted_{uuid.uuid4().hex}"
    catalog.define_table(spark, name, fixtures.LANDING_SCHEMA, out)
    loaded = tables.load_ndjson(spark, landing, fixtures.LANDING_SCHEMA)
    loaded = loaded.select(*fixtures.LANDING_SCHEMA.names, *layout.LOADED_LEVELS)
    late = F.col("user_id") == "002"
    catalog.store(loaded.where(~late), name, rebalance=True)
    tables.write_table(loaded.where(late), out, layout.LOADED_LEVELS, rebalance=True)
    catalog.adopt(spark, name)
    rows = spark.table(name).groupBy(*layout.LOADED_LEVELS).agg(F.count("*").alias("n_records"))
    return catalog.partitions(spark, name).join(rows, list(layout.LOADED_LEVELS), "left")


# ---- control ----


@query
def manifest_last_wins(spark, sf_dir):
    exports = fixtures.manifests(spark, sf_dir)
    return control.flatten_manifest(exports, ["user_id", "version"], "export_id")


@query
def manifest_all_entries(spark, sf_dir):
    exports = fixtures.manifests(spark, sf_dir)
    return control.flatten_manifest(exports, ["user_id", "version"], "export_id", keep="all")


@query
def route_status(spark, sf_dir):
    known = [("orders", *model) for model in KNOWN_MODELS]
    return control.route(fixtures.control_rows(spark, sf_dir), known)


@query
def active_inputs(spark, sf_dir):
    return control.active(fixtures.control_rows(spark, sf_dir))


# ---- streaming, and everything together ----


def _ingested(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Records and rejects of files that arrive in two waves, one gzipped."""
    landing, out = scratch_dir(spark, "arrivals"), scratch_dir(spark, "ingested")
    checkpoint = scratch_dir(spark, "ingest-checkpoint")
    lines = fixtures.event_lines(spark, sf_dir, broken=True)
    late = F.col("bucket") == 5
    waves = [(lines.where(~late), "none"), (lines.where(late), "gzip")]
    for wave, compression in waves:
        wave.write.mode("append").option("compression", compression).partitionBy("bucket").text(
            landing
        )
        ingest_new_files(
            spark,
            landing,
            fixtures.EVENT_SCHEMA,
            out,
            checkpoint,
            f"{out}-rejects",
            unit_pattern=fixtures.BUCKET_DIRECTORY,
        )
    return out, f"{out}-rejects"


@query
def incremental_ingest(spark, sf_dir):
    """Each file is taken once, or its bucket rejected."""
    out, _ = _ingested(spark, sf_dir)
    return tables.read_tables(spark, out).select("bucket", *fixtures.EVENT_SCHEMA.names)


@query
def incremental_rejects(spark, sf_dir):
    _, rejects = _ingested(spark, sf_dir)
    return tables.read_tables(spark, rejects).select(
        F.regexp_extract("unit", "bucket=(.*)$", 1).alias("bucket"), "n_records", "n_bad"
    )


@query
def incremental_units(spark, sf_dir):
    """Buckets that arrive in two waves; the bad line of one comes in the second."""
    landing, out = scratch_dir(spark, "unit-arrivals"), scratch_dir(spark, "units")
    checkpoint = scratch_dir(spark, "unit-checkpoint")
    lines = fixtures.event_lines(spark, sf_dir, broken=True)
    late = F.xxhash64("value") % 2 == 0
    bad = F.col("value") == fixtures.BROKEN_LINE
    for wave in (lines.where(~late & ~bad), lines.where(late | bad)):
        wave.write.mode("append").partitionBy("bucket").text(landing)
        ingest_units(
            spark, landing, fixtures.EVENT_SCHEMA, out, checkpoint, unit_pattern=fixtures.BUCKET_DIRECTORY
        )
    good = accepted(spark, out, unit_pattern=fixtures.BUCKET_DIRECTORY)
    return good.select("bucket", *fixtures.EVENT_SCHEMA.names)


@query
def absent_arrivals(spark, sf_dir):
    """Files that manifests promised and that did not come in time, over two waves."""
    promises, arrivals = scratch_dir(spark, "promises"), scratch_dir(spark, "file-arrivals")
    out, checkpoint = scratch_dir(spark, "absent"), scratch_dir(spark, "absent-checkpoint")
    for wave in range(fixtures.PROMISE_WAVES + 1):
        promised, arrived = fixtures.promised_files(spark, sf_dir, wave)
        promised.write.mode("append").parquet(promises)
        arrived.write.mode("append").parquet(arrivals)
        streams = [
            spark.readStream.schema(df.schema).parquet(path)
            for df, path in ((promised, promises), (arrived, arrivals))
        ]
        write_absent(absent_files(*streams), out, checkpoint)
    return spark.read.schema(promised.schema).parquet(out).select("url", *text_of("promised_at"))


@query
def stage_counts(spark, sf_dir):
    """How many rows each stage of the record table's making saw."""
    root = fixtures.write_record_files(spark, sf_dir)
    days = "/".join(f"{level}=*" for level in layout.LANDING_LEVELS)
    report = StageReport()
    records = medical_records(
        spark,
        {t: f"{root}/{days}/model={t}" for t in PRIORITY},
        {t: fixtures.record_schema(spark, sf_dir, t) for t in PRIORITY},
        as_of=AS_OF,
        unit_pattern=fixtures.RECORD_DIRECTORY,
        report=report,
    )
    written = report.watch(records, written=F.lit(True))
    tables.write_table(written, scratch_dir(spark, "counted-records"), ["resource_type"])
    return report.rows(spark)


@query
def medical_records_from_files(spark, sf_dir):
    """Raw NDJSON with a rejected file, to the partitioned record table, read back."""
    root = fixtures.write_record_files(spark, sf_dir)
    schemas = scratch_dir(spark, "record-schemas")
    registry.write_schemas(
        spark,
        schemas,
        {("demo", "dstu2", t): fixtures.record_schema(spark, sf_dir, t) for t in PRIORITY},
    )
    known = registry.read_schemas(spark, schemas)
    days = "/".join(f"{level}=*" for level in layout.LANDING_LEVELS)
    records = medical_records(
        spark,
        {t: f"{root}/{days}/model={t}" for t in PRIORITY},
        {t: registry.schema_of(known, t) for t in PRIORITY},
        as_of=AS_OF,
        unit_pattern=fixtures.RECORD_DIRECTORY,
    )
    out = scratch_dir(spark, "medical-records")
    tables.write_table(records, out, ["resource_type"])  # a task has rows of one type
    return tables.read_tables(spark, out, records.schema).select(*RECORD_COLUMNS)


@query
def medical_records_stored_chain(spark, sf_dir):
    """The same table by way of stored NDJSON, loaded Parquet and stored staging."""
    root = fixtures.write_record_files(spark, sf_dir)
    days = "/".join(f"{level}=*" for level in layout.LANDING_LEVELS)
    records = medical_records_stored(
        spark,
        {t: f"{root}/{days}/model={t}" for t in PRIORITY},
        {t: fixtures.record_schema(spark, sf_dir, t) for t in PRIORITY},
        scratch_dir(spark, "chain"),
        source="demo",
        version="dstu2",
        as_of=AS_OF,
        unit_pattern=fixtures.RECORD_DIRECTORY,
    )
    return records.select(*RECORD_COLUMNS)
