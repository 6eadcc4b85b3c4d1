"""Staging rules and the projections onto the twelve-column record table."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordlake.functions.times import DATE_ONLY, MIDNIGHT_SUFFIX, MILLIS_Z, SECONDS_Z
from recordlake.functions.values import first_value, measured_summary, null_of, text
from recordlake.operators.staging import LOAD_STAMP, Rule, StageSpec

# ---- Fixed values: the record types, in the order they are looked for. ----
OBSERVATION = "Observation"
IMMUNIZATION = "Immunization"
CLINICAL_IMPRESSION = "ClinicalImpression"
MEDICATION_ORDER = "MedicationOrder"
PRIORITY = (OBSERVATION, IMMUNIZATION, CLINICAL_IMPRESSION, MEDICATION_ORDER)

# ---- Fixed values: the record versions that are exported. ----
VERSIONS = ("dstu2", "stu3", "r4")

# ---- Fixed values: the columns of the record table, all text. ----
RECORD_COLUMNS = (
    "participant_id",
    "id",
    "date",
    "resource_type",
    "name",
    "lower_bound",
    "upper_bound",
    "actual_value",
    "unit_type",
    "summary",
    "ouh_last_updated",
    "last_updated",
)

# ---- Fixed values: the marker for a missing column, and nested types. ----
MARKER = "----"
QUANTITY_LIST = T.ArrayType(
    T.StructType(
        [
            T.StructField("code", T.StringType()),
            T.StructField("system", T.StringType()),
            T.StructField("unit", T.StringType()),
            T.StructField("value", T.DoubleType()),
        ]
    )
)

_TIME, _TEXT, _NUMBER = T.TimestampType(), T.StringType(), T.DoubleType()

# ---- Fixed values: staging rules per record type. ----
STAGING = {
    OBSERVATION: StageSpec(
        OBSERVATION,
        (
            Rule("effective_date_time", (MILLIS_Z,), absent=_TIME),
            Rule("issued", (MILLIS_Z, SECONDS_Z), absent=_TIME),
            Rule("reference_range__low", absent=QUANTITY_LIST),
            Rule("reference_range__high", absent=QUANTITY_LIST),
            Rule("value_quantity__value", absent=_NUMBER),
            Rule("value_quantity__unit", absent=_TEXT),
            Rule("value_codeable_concept__text", absent=_TEXT),
            Rule("value_string", absent=_TEXT),
            Rule("meta__last_updated", (MILLIS_Z,)),
        ),
    ),
    IMMUNIZATION: StageSpec(
        IMMUNIZATION,
        (
            Rule("date", (MILLIS_Z, DATE_ONLY)),
            Rule("expiration_date", (MILLIS_Z,)),
            Rule("meta__last_updated", (MILLIS_Z,)),
        ),
    ),
    CLINICAL_IMPRESSION: StageSpec(
        CLINICAL_IMPRESSION,
        (
            Rule("date", (MILLIS_Z,)),
            Rule("meta__last_updated", (MILLIS_Z,)),
        ),
    ),
    MEDICATION_ORDER: StageSpec(
        MEDICATION_ORDER,
        (
            Rule("date_written", (MILLIS_Z,), MIDNIGHT_SUFFIX, MARKER),
            Rule("dispense_request__validity_period__start", (MILLIS_Z,), MIDNIGHT_SUFFIX, MARKER),
            Rule("meta__last_updated", (MILLIS_Z,), absent=MARKER),
            Rule("prior_prescription__display", absent=MARKER),
            Rule("medication_reference__reference", absent=MARKER),
            Rule("dispense_request__quantity__unit", absent=MARKER),
        ),
    ),
}

# The transformations that exist; anything else is routed to "skip".
KNOWN_MODELS = tuple(("dstu2", model) for model in PRIORITY)


# ---- Fixed values: the columns that records take and that no rule names. ----
_TAKEN = {
    OBSERVATION: ("code__text", "reference_range__low", "reference_range__high"),
    IMMUNIZATION: ("vaccine_code__text",),
    CLINICAL_IMPRESSION: ("description", "summary"),
    MEDICATION_ORDER: ("medication_reference__display",),
}


def used_columns(resource_type: str) -> set[str]:
    """The flattened columns that staging and the record table look at."""
    rules = {rule.column for rule in STAGING[resource_type].rules}
    return {"id", "resource_type", *_TAKEN[resource_type]} | rules


def projection(resource_type: str) -> dict[str, Column]:
    """The record columns of one staged type, by output name."""
    own = {
        OBSERVATION: _observation,
        IMMUNIZATION: _immunization,
        CLINICAL_IMPRESSION: _clinical_impression,
        MEDICATION_ORDER: _medication_order,
    }[resource_type]()
    shared = {
        "participant_id": F.col("participant_id"),
        "id": F.col("id"),
        "resource_type": F.col("resource_type"),
        "ouh_last_updated": F.col("meta__last_updated"),
        "last_updated": F.col(LOAD_STAMP),
    }
    columns = shared | own
    return {name: text(columns.get(name, null_of(_TEXT))) for name in RECORD_COLUMNS}


def _observation() -> dict[str, Column]:
    value, unit = F.col("value_quantity__value"), F.col("value_quantity__unit")
    return {
        "date": F.coalesce(text(F.col("issued")), text(F.col("effective_date_time"))),
        "name": F.col("code__text"),
        "lower_bound": first_value(F.col("reference_range__low"), "value"),
        "upper_bound": first_value(F.col("reference_range__high"), "value"),
        "actual_value": value,
        "unit_type": unit,
        "summary": measured_summary(
            value, unit, F.col("value_codeable_concept__text"), F.col("value_string")
        ),
    }


def _immunization() -> dict[str, Column]:
    return {
        "date": F.col("date"),
        "name": F.col("vaccine_code__text"),
        "summary": F.col("vaccine_code__text"),
    }


def _clinical_impression() -> dict[str, Column]:
    return {
        "date": F.col("date"),
        "name": F.col("description"),
        "summary": F.concat_ws("", F.col("description"), F.col("summary")),
    }


def _medication_order() -> dict[str, Column]:
    return {
        "date": F.col("dispense_request__validity_period__start"),
        "name": F.col("medication_reference__display"),
        "summary": F.concat_ws(
            " ",
            F.col("prior_prescription__display"),
            F.col("medication_reference__reference"),
            F.col("dispense_request__quantity__unit"),
        ),
    }
