"""For each query, the same result as SQL that DuckDB runs on the tables."""

from __future__ import annotations

AS_OF = "2024-06-01T12:30:45.678Z"


def zms(moment: str) -> str:
    return f"strftime({moment}, '%Y-%m-%dT%H:%M:%S.%gZ')"


def zs(moment: str) -> str:
    return f"strftime({moment}, '%Y-%m-%dT%H:%M:%SZ')"


def day(moment: str) -> str:
    return f"strftime({moment}, '%Y-%m-%d')"


def to_ms(moment: str) -> str:
    """The timestamp cut to milliseconds, as text."""
    return f"cast(date_trunc('millisecond', {moment}) as varchar)"


def to_s(moment: str) -> str:
    return f"cast(date_trunc('second', {moment}) as varchar)"


OBSERVATION = f"""
observation as (
  select cast(user_id as varchar) as participant_id,
    'obs-' || event_id as id,
    case event_id % 3 when 1 then {to_ms('ts')} when 2 then {to_s('ts')} end as issued,
    case when event_id % 5 <> 0 then {to_ms('ts')} end as effective_date_time,
    event_type as code_text,
    case when event_id % 4 <> 0 then value end as quantity,
    case when event_id % 7 <> 0 then 'mg' end as unit,
    case when event_id % 2 = 0 then event_type end as coded,
    'n/a:' || event_type as free_text,
    case when event_id % 6 >= 2 then value end as low,
    case when event_id % 6 >= 2 then cast(event_id % 1000 as double) end as high,
    case when event_id % 11 <> 0 then {to_ms('ts')} end as updated
  from events)"""

IMMUNIZATION = f"""
immunization as (
  select cast(l_suppkey as varchar) as participant_id,
    l_orderkey || '-' || l_linenumber as id,
    {to_ms('l_shipdate')} as date,
    {to_ms('l_shipdate')} as expires,
    cast(l_linenumber % 2 = 0 as varchar) as was_not_given,
    l_returnflag || l_linestatus as code_text,
    case when l_orderkey % 9 <> 0 then {to_ms('l_shipdate')} end as updated
  from lineitem)"""

IMPRESSION = """
impression as (
  select cast(doc_id % 10 as varchar) as participant_id,
    cast(doc_id as varchar) as id,
    cast(timestamp '2024-01-01' + to_days(cast(doc_id as integer)) as varchar) as date,
    case when doc_id % 5 <> 0 then source end as description,
    lang as summary
  from documents)"""

DECLARED_MEDICATION = """
medication as (
  select cast(o_custkey as varchar) as participant_id,
    cast(o_orderkey as varchar) as id,
    cast(date_trunc('day', o_orderdate) as timestamp)::varchar as written,
    case when o_orderkey % 8 <> 0
      then cast(date_trunc('day', o_orderdate) as timestamp)::varchar end as start,
    o_orderpriority as display,
    case when o_orderkey % 4 <> 0 then o_orderstatus end as reference,
    cast(date_trunc('millisecond', o_orderdate) as varchar) as updated
  from orders)"""

def medication(who: str) -> str:
    """Orders of the participants ``who`` names; a column one never fills is marked."""
    return f"""
filled as (
  select {who} as participant_id, cast(o_orderkey as varchar) as id,
    cast(date_trunc('day', o_orderdate) as timestamp)::varchar as written,
    case when o_orderkey % 8 <> 0
      then cast(date_trunc('day', o_orderdate) as timestamp)::varchar end as start,
    o_orderpriority as display,
    case when o_custkey % 3 = 0 and o_orderkey % 2 = 0 then 'prior ' || o_orderpriority end as prior,
    case when o_orderkey % 4 <> 0 then o_orderstatus end as reference,
    case when o_custkey % 5 = 0 and o_orderkey % 2 = 1 then 'tab' end as unit,
    cast(date_trunc('millisecond', o_orderdate) as varchar) as updated
  from orders),
presence as (
  select participant_id, count(prior) > 0 as has_prior, count(reference) > 0 as has_reference,
    count(unit) > 0 as has_unit
  from filled group by participant_id),
medication as (
  select participant_id, id, written, start, display, updated,
    case when has_prior then prior else '----' end as prior,
    case when has_reference then reference else '----' end as reference,
    case when has_unit then unit else '----' end as unit
  from filled join presence using (participant_id))"""


MEDICATION = medication("cast(o_custkey as varchar)")

RECORD_OBSERVATION = f"""
  select participant_id, id, coalesce(issued, effective_date_time) as date,
    'Observation' as resource_type, code_text as name,
    cast(low as varchar) as lower_bound, cast(high as varchar) as upper_bound,
    cast(quantity as varchar) as actual_value, unit as unit_type,
    case when quantity is not null and unit is not null
      then cast(quantity as varchar) || ' ' || unit
      else coalesce(coded, free_text) end as summary,
    updated as ouh_last_updated, '{AS_OF}' as last_updated
  from observation"""

NO_BOUNDS = """cast(null as varchar) as lower_bound, cast(null as varchar) as upper_bound,
    cast(null as varchar) as actual_value, cast(null as varchar) as unit_type"""

RECORD_IMMUNIZATION = f"""
  select participant_id, id, date, 'Immunization' as resource_type, code_text as name,
    {NO_BOUNDS}, code_text as summary,
    updated as ouh_last_updated, '{AS_OF}' as last_updated
  from immunization"""

RECORD_IMPRESSION = f"""
  select participant_id, id, date, 'ClinicalImpression' as resource_type, description as name,
    {NO_BOUNDS}, coalesce(description, '') || summary as summary,
    date as ouh_last_updated, '{AS_OF}' as last_updated
  from impression"""

RECORD_MEDICATION = f"""
  select participant_id, id, start as date, 'MedicationOrder' as resource_type, display as name,
    {NO_BOUNDS},
    concat_ws(' ', prior, reference, unit) as summary,
    updated as ouh_last_updated, '{AS_OF}' as last_updated
  from medication"""

ALL_RECORDS = f"""
records as ({RECORD_OBSERVATION}
  union all {RECORD_IMMUNIZATION}
  union all {RECORD_IMPRESSION}
  union all {RECORD_MEDICATION})"""

FIRST_MATCH = f"""with {OBSERVATION}, {IMMUNIZATION}, {IMPRESSION}, {MEDICATION}, {ALL_RECORDS},
placed as (
  select *, list_position(
      ['Observation', 'Immunization', 'ClinicalImpression', 'MedicationOrder'], resource_type) as place,
    case resource_type
      when 'Observation' then 3 * cast(participant_id as bigint)
      when 'Immunization' then case when cast(split_part(id, '-', 2) as bigint) % 3 <> 0
        then 2 * cast(participant_id as bigint) end
      when 'MedicationOrder' then case when cast(id as bigint) % 3 <> 0
        then cast(participant_id as bigint) end
      else cast(participant_id as bigint) end as input
  from records),
chosen as (select input, min(place) as first from placed group by input)
  select placed.* exclude (place, input)
  from placed join chosen on placed.input is not distinct from chosen.input and place = first"""

ORACLES: dict[str, str] = {
    "stage_observation": f"""with {OBSERVATION}
  select participant_id, id, issued, effective_date_time,
    cast(quantity as varchar) as value_quantity__value, updated as meta__last_updated,
    unit as value_quantity__unit, coded as value_codeable_concept__text,
    free_text as value_string, '{AS_OF}' as medical_last_updated
  from observation""",
    "stage_missing_columns": """
  select cast(user_id as varchar) as participant_id, 'obs-' || event_id as id,
    cast(null as varchar) as issued, cast(null as varchar) as effective_date_time,
    cast(null as varchar) as value_quantity__value, cast(null as varchar) as value_quantity__unit,
    cast(null as varchar) as value_codeable_concept__text, cast(null as varchar) as value_string,
    cast(1 as bigint) as low_entries, cast(null as varchar) as low_value,
    cast(1 as bigint) as high_entries, cast(null as varchar) as high_code
  from events""",
    "stage_immunization": f"""with {IMMUNIZATION}
  select participant_id, id, date, expires as expiration_date, updated as meta__last_updated,
    was_not_given, '{AS_OF}' as medical_last_updated
  from immunization""",
    "stage_clinical_impression": f"""with {IMPRESSION}
  select participant_id, id, date, date as meta__last_updated, description, summary
  from impression""",
    "stage_medication_order": f"""with {DECLARED_MEDICATION}
  select participant_id, id, written as date_written,
    start as dispense_request__validity_period__start, updated as meta__last_updated,
    '----' as prior_prescription__display, reference as medication_reference__reference,
    '----' as dispense_request__quantity__unit
  from medication""",
    "stage_medication_order_per_input": f"""with {MEDICATION}
  select participant_id, id, written as date_written,
    start as dispense_request__validity_period__start, prior as prior_prescription__display,
    reference as medication_reference__reference, unit as dispense_request__quantity__unit
  from medication""",
    "unify_observation": f"with {OBSERVATION} {RECORD_OBSERVATION}",
    "unify_observation_sparse_ranges": f"""with {OBSERVATION}
  select * replace (cast(null as varchar) as lower_bound) from ({RECORD_OBSERVATION})""",
    "unify_immunization": f"with {IMMUNIZATION} {RECORD_IMMUNIZATION}",
    "unify_clinical_impression": f"with {IMPRESSION} {RECORD_IMPRESSION}",
    "unify_medication_order": f"with {MEDICATION} {RECORD_MEDICATION}",
    "unify_all": f"with {OBSERVATION}, {IMMUNIZATION}, {IMPRESSION}, {MEDICATION}, {ALL_RECORDS} "
    "select * from records",
    "unify_mixed_input": f"with {OBSERVATION}, {IMMUNIZATION}, {IMPRESSION}, {MEDICATION}, "
    f"{ALL_RECORDS} select * from records",
    "distinct_resource_types": f"""with {OBSERVATION}, {IMMUNIZATION}, {IMPRESSION}, {MEDICATION},
{ALL_RECORDS} select distinct resource_type from records""",
}

NESTED = f"""
nested as (
  select l_orderkey || '-' || l_linenumber as id, l_linenumber % 3 as kind,
    {zms('l_shipdate')} as updated, 'Supplier ' || l_suppkey as supplier,
    l_suppkey % 25 as nation, l_partkey as part, l_quantity as qty, l_extendedprice as price,
    l_returnflag as flag, l_linestatus as status
  from lineitem)"""

# how often each key path of the nested records occurs, by type
KEY_COUNTS = """
lines as (
  select l_linenumber % 3 as kind, l_linenumber % 4 as extra from lineitem),
paths as (
  select unnest([('resourceType', 'STRING'), ('id', 'STRING'), ('meta', 'OBJECT'),
    ('meta.lastUpdated', 'STRING'), ('subject', 'OBJECT'), ('subject.displayName', 'STRING'),
    ('subject.address', 'OBJECT'), ('subject.address.nationKey', 'BIGINT'), ('lineItems', 'ARRAY'),
    ('tags', 'ARRAY'), ('tags.[]', 'STRING'), ('tags.[]', 'STRING'), ('emptyList', 'ARRAY'),
    ('emptyObj', 'OBJECT')]) as p from lines
  union all
  select unnest([('lineItems.[]', 'OBJECT'), ('lineItems.[].partKey', 'BIGINT'),
    ('lineItems.[].qty', 'DECIMAL'), ('lineItems.[].coding', 'ARRAY'),
    ('lineItems.[].coding.[]', 'OBJECT'), ('lineItems.[].coding.[].retFlag', 'STRING')])
  from lines where kind > 0
  union all
  select unnest([('lineItems.[]', 'OBJECT'), ('lineItems.[].partKey', 'BIGINT'),
    ('lineItems.[].qty', 'DECIMAL'), ('lineItems.[].note', 'STRING'), ('lineItems.[].coding', 'ARRAY'),
    ('lineItems.[].coding.[]', 'OBJECT'), ('lineItems.[].coding.[]', 'OBJECT'),
    ('lineItems.[].coding.[].retFlag', 'STRING'), ('lineItems.[].coding.[].retFlag', 'STRING')])
  from lines where kind = 2
  union all
  select unnest([('extraInfo', 'OBJECT'), ('extraInfo.batchCode', 'STRING'),
    ('extraInfo.checks', 'ARRAY'), ('extraInfo.checks.[]', 'OBJECT'), ('extraInfo.checks.[]', 'OBJECT'),
    ('extraInfo.checks.[].passed', 'BOOLEAN'), ('extraInfo.checks.[].score', 'BIGINT'),
    ('extraInfo.checks.[].score', 'DECIMAL')]) from lines where extra = 0
  union all
  select unnest([('extraInfo', 'OBJECT'), ('extraInfo.batchCode', 'BIGINT')]) from lines where extra = 1
  union all
  select ('extraInfo', 'OBJECT') from lines where extra = 2),
counted as (
  select p[1] as path, p[2] as type, count(*) as n from paths group by all)"""

EVENT_COLUMNS = (
    f"event_id, {zms('ts')} as ts, user_id, event_type, value, props"
)

SPELLINGS = """
spellings as (
  select p_name || p_type || p_brand || 'xYz' as value from part
  union all select text from documents)"""

VERSION = "case {0} % 3 when 0 then 'dstu2' when 1 then 'stu3' else 'r4' end"

ENTRIES = f"""
entries as (
  select cast(user_id as varchar) as user_id, {VERSION.format('event_id')} as version,
    event_id, position, type, url
  from (
    select *, 0 as position, event_type as type, 'u/a/' || event_id as url from events
    union all select *, 1, 'Patient', 'u/b/' || event_id from events
    union all select *, 2, event_type, 'u/c/' || event_id from events))"""

CONTROL = f"""
control_rows as (
  select o_orderkey as input_key, case when o_orderkey % 7 = 0 then 'archive' else 'orders' end as source, {VERSION.format('o_orderkey')} as version,
    case o_orderpriority when '1-URGENT' then 'Observation' when '2-HIGH' then 'Immunization'
      when '3-MEDIUM' then 'ClinicalImpression' when '4-NOT SPECIFIED' then 'MedicationOrder'
      else 'Patient' end as model,
    case o_orderstatus when 'F' then 'skip' when 'O' then 'proceed' end as status
  from orders)"""

LANDING = f"""
landing as (
  select event_id, {zms('ts')} as ts, event_type, value, 'events' as source,
    printf('%03d', user_id % 4) as user_id, 'dstu2' as version, strftime(ts, '%Y') as year,
    strftime(ts, '%m') as month, strftime(ts, '%d') as day, 'Observation' as model
  from events)"""

ORACLES |= {
    "flatten_struct": f"""with {NESTED}
  select id, 'LineRecord' as resource_type, updated as meta__last_updated,
    supplier as subject__display_name, nation as subject__address__nation_key
  from nested""",
    "flatten_arrays": f"""with {NESTED}
  select id,
    case kind when 1 then cast(part as varchar) when 2 then part || '|' || (part + 1) end
      as line_items__part_key,
    case kind when 1 then cast(qty as varchar) when 2 then qty || '|' || price end
      as line_items__qty,
    case kind when 2 then 'note ' || flag end as line_items__note,
    flag || '|' || status as tags, cast(null as varchar) as empty_list
  from nested""",
    "flatten_arrays_aligned": f"""with {NESTED}
  select id,
    case kind when 1 then cast(part as varchar) when 2 then part || '|' || (part + 1) end
      as line_items__part_key,
    case kind when 1 then '~' when 2 then '~|note ' || flag end as line_items__note
  from nested""",
    "flatten_nested_array": f"""with {NESTED}
  select id, cast(nullif(kind, 0) as bigint) as n_lists,
    case kind when 1 then flag when 2 then flag || '|' || status || '|' || flag end as flags
  from nested""",
    "flatten_collision": """
  select l_orderkey || '-' || l_linenumber as id,
    l_quantity || '|' || l_extendedprice as parts__qty
  from lineitem""",
    "flatten_written_nulls": """
  select l_orderkey || '-' || l_linenumber as id,
    l_quantity || '|' || l_extendedprice || '|' || l_quantity as items__qty,
    case when l_linenumber > 1 then 'note ' || l_returnflag || '|'
      when l_orderkey % 2 = 1 then '~|' else '' end
    || case when l_orderkey % 2 = 1 then '~|' else '' end
    || 'note ' || l_returnflag as items__note
  from lineitem""",
    "explode_flatten_dunder": f"""with {NESTED}, exploded as (
  select *, cast(null as bigint) as part_key, cast(null as double) as item_qty,
    cast(null as varchar) as note, cast(null as varchar) as code from nested where kind = 0
  union all select *, part, qty, null, flag from nested where kind > 0
  union all select *, part + 1, price, 'note ' || flag, status from nested where kind = 2
  union all select *, part + 1, price, 'note ' || flag, flag from nested where kind = 2)
  select id, supplier as subject__display_name, nation as subject__address__nation_key,
    part_key as line_items__part_key, cast(item_qty as varchar) as line_items__qty,
    note as line_items__note, code as line_items__coding__ret_flag
  from exploded""",
    "explode_flatten_cross": f"""with {NESTED}, exploded as (
  select *, cast(null as bigint) as part_key, cast(null as varchar) as code
    from nested where kind = 0
  union all select *, part, flag from nested where kind > 0
  union all select *, part + 1, status from nested where kind = 2
  union all select *, part + 1, flag from nested where kind = 2)
  select id, part_key as "lineItems_partKey", code as "lineItems_coding_retFlag",
    unnest([flag, status]) as tags, cast(null as varchar) as "emptyList"
  from exploded""",
    "snake_case_values": f"""with {SPELLINGS}
  select value, ltrim(lower(regexp_replace(value, '(\\p{{Lu}})', '_\\1', 'g')), '_') as snake
  from spellings""",
    "camel_to_snake_values": f"""with {SPELLINGS}
  select value, lower(regexp_replace(
    regexp_replace(value, '(.)([A-Z][a-z]+)', '\\1_\\2', 'g'),
    '([a-z0-9])([A-Z])', '\\1_\\2', 'g')) as snake
  from spellings""",
    "quarantine_good": f"""
  select cast(user_id % 8 as varchar) as bucket, {EVENT_COLUMNS}
  from events where user_id % 8 <> 3""",
    "flatten_last_key": """
  select l_orderkey || '-' || l_linenumber as id,
    case when l_linenumber % 2 = 1 then 'low' || l_partkey
      when l_linenumber % 3 <> 0 then 'high' || l_partkey end as sub_key,
    case when l_linenumber % 2 = 0 then 2 else 1 end::bigint as sub__code
  from lineitem""",
    "incremental_units": f"""
  select cast(user_id % 8 as varchar) as bucket, {EVENT_COLUMNS}
  from events where user_id % 8 <> 3""",
    "absent_arrivals": """
  select 'files/' || event_id as url, regexp_replace(cast(ts as varchar), '[.]?0+$', '') as promised_at
  from events where event_id % 10 = 0 and (event_id % 3 = 0 or event_id % 7 = 0)""",
    "stage_counts": f"""with {OBSERVATION}, {IMMUNIZATION}, {IMPRESSION}, {MEDICATION}, {ALL_RECORDS},
counted as (
  select count(*) as n, count(*) filter (not (resource_type = 'Observation'
    and cast(participant_id as bigint) % 15 = 3)) as good from records)
  select unnest(['read', 'filled', 'bad', 'kept', 'staged', 'written']) as stage,
    unnest([n + 1, n + 1, 1, good, good, good]) as n from counted""",
    "key_census": f"""with {KEY_COUNTS} select * from counted""",
    "undeclared_keys": f"""with {KEY_COUNTS}
  select * from counted where path like 'extraInfo%' or path = 'emptyObj'""",
    "flatten_undeclared": f"""with {NESTED}, extra as (
  select *, line % 4 as k, part % 10 as batch
  from (select *, cast(split_part(id, '-', 2) as bigint) as line from nested))
  select id, supplier as subject__display_name,
    case kind when 1 then cast(part as varchar) when 2 then part || '|' || (part + 1) end
      as line_items__part_key,
    case k when 0 then 'B' || batch when 1 then cast(batch as varchar) end as extra_info__batch_code,
    case k when 0 then 'true' end as extra_info__checks__passed,
    case k when 0 then line || '.0|1.5' end as extra_info__checks__score
  from extra""",
    "load_merged_types": """
  select case when event_id % 2 = 1 then '001' else '002' end as user_id, event_id,
    case when event_id % 2 = 1 then regexp_replace(cast(value as varchar), '[.]0$', '')
      else event_type end as reading,
    cast(user_id as double) as of__user_id,
    case when event_id % 2 = 0 then props end as of__props
  from events""",
    "quarantine_bad_bytes": """
  select cast(b as varchar) as bucket, count(*) + 1 as n_records, cast(1 as bigint) as n_bad
  from (select user_id % 8 as b from events where user_id % 8 in (3, 5)) group by b""",
    "quarantine_bad": """
  select '3' as bucket, count(*) + 1 as n_records, cast(1 as bigint) as n_bad
  from events where user_id % 8 = 3""",
    "file_counts": """
  select count(distinct user_id % 8) as n_files, count(distinct user_id % 8) - 1 as n_files_kept,
    count(*) + 1 as n_records, count(*) filter (user_id % 8 <> 3) as n_records_kept
  from events""",
    "missing_files": """
  select cast(o_custkey % 12 as varchar) as bucket, count(*) as n_orders,
    o_custkey % 12 in (select user_id % 8 from events) as found
  from orders group by o_custkey % 12""",
    "file_lineage": f"""with {LANDING}
  select 'source=' || source || '/user_id=' || user_id || '/version=' || version || '/year=' || year
      || '/month=' || month || '/day=' || day || '/model=' || model as path,
    source, user_id, version, model, count(*) as n_records
  from landing group by all""",
    "landing_roundtrip": f"with {LANDING} select * from landing",
    "load_parquet": f"""with {LANDING}
  select event_id, ts, event_type, value, source, version, model as resource_type, user_id
  from landing""",
    "catalog_levels": f"""with {LANDING}
  select event_id, ts, event_type, value, source, version, model as resource_type, user_id
  from landing where user_id in ('001', '003')""",
    "catalog_partitions": f"""with {LANDING}
  select source, version, model as resource_type, user_id, count(*) as n_records
  from landing group by all""",
    "ndjson_gz_roundtrip": f"select {EVENT_COLUMNS} from events",
    "parquet_overwrite_roundtrip": """
  select event_id, case when event_type in ('click', 'view') then -1.0 else value end as value,
    event_type
  from events""",
    "parquet_merged_scan": """
  select event_id, case when event_id % 2 = 0 then value end as value,
    case when event_id % 2 = 1 then event_type end as event_type
  from events""",
    "schema_registry": """
  select 'events' as source, 'dstu2' as version, 'Observation' as model, position, "column",
    type, true as nullable
  from (values (0, 'event_id', 'long'), (1, 'event_type', 'string'), (2, 'ts', 'string'),
    (3, 'value', 'double')) as t(position, "column", type)""",
    "manifest_last_wins": f"""with {ENTRIES}
  select user_id, version, type, url
  from (select *, row_number() over (partition by user_id, version, type
    order by event_id desc, position desc) as latest from entries)
  where latest = 1""",
    "manifest_all_entries": f"with {ENTRIES} select user_id, version, type, url from entries",
    "route_status": f"""with {CONTROL}
  select input_key, source, version, model,
    case when status is distinct from 'skip' and source = 'orders' and version = 'dstu2'
      and model <> 'Patient' then 'proceed' else 'skip' end as status
  from control_rows""",
    "active_inputs": f"""with {CONTROL}
  select * from control_rows where status is distinct from 'skip'""",
    "incremental_ingest": f"""
  select cast(user_id % 8 as varchar) as bucket, {EVENT_COLUMNS}
  from events where user_id % 8 <> 3""",
    "incremental_rejects": """
  select '3' as bucket, count(*) + 1 as n_records, cast(1 as bigint) as n_bad
  from events where user_id % 8 = 3""",
    "flatten_mixed_lists": """
  select l_orderkey || '-' || l_linenumber as id,
    case when l_linenumber % 3 = 0 then '[null,{"partKey":' || l_partkey || '}]' end as parts,
    case when l_linenumber % 3 <> 0 then cast(l_partkey as varchar) end as parts__part_key,
    '{"flag":"' || l_returnflag || '"}|text|' || l_partkey as mixed
  from lineitem""",
    "listed_files": f"""
  select cast(user_id % 8 as varchar) as bucket, {EVENT_COLUMNS}
  from events where user_id % 8 in (select r_regionkey * 2 from region)""",
    "medical_records_from_files": f"""with {OBSERVATION}, {IMMUNIZATION}, {IMPRESSION},
{medication("printf('%03d', o_custkey % 15)")}, {ALL_RECORDS}
  select * exclude (participant_id), case when resource_type = 'MedicationOrder' then participant_id
      else printf('%03d', cast(participant_id as bigint) % 15) end as participant_id
  from records
  where not (resource_type = 'Observation' and cast(participant_id as bigint) % 15 = 3)""",
    "unify_first_match": FIRST_MATCH,
    "unify_first_match_shuffled": FIRST_MATCH,
}

# the same table, whichever way it is made
ORACLES["medical_records_stored_chain"] = ORACLES["medical_records_from_files"]

_LIST = '{"containsNull":true,"elementType":%s,"type":"array"}'
_FIELD = '{"metadata":{},"name":"%s","nullable":true,"type":%s}'


def _object(**fields: str) -> str:
    """A struct type as Spark's schema JSON writes it."""
    inner = ",".join(_FIELD % field for field in fields.items())
    return '{"fields":[%s],"type":"struct"}' % inner


_ITEM = _object(
    coding=_LIST % _object(retFlag='"string"'), note='"string"', partKey='"long"', qty='"double"'
)
_SUBJECT = _object(address=_object(nationKey='"long"'), displayName='"string"')

ORACLES["schema_files"] = f"""
  select model, position, "column", type, true as nullable
  from (values
    ('Nested', 0, 'emptyList', '{_LIST % '"string"'}'), ('Nested', 1, 'id', 'string'),
    ('Nested', 2, 'lineItems', '{_LIST % _ITEM}'),
    ('Nested', 3, 'meta', '{_object(lastUpdated='"string"')}'),
    ('Nested', 4, 'resourceType', 'string'), ('Nested', 5, 'subject', '{_SUBJECT}'),
    ('Nested', 6, 'tags', '{_LIST % '"string"'}'),
    ('Order', 0, 'o_orderkey', 'long'), ('Order', 1, 'o_orderstatus', 'string')
  ) as t(model, position, "column", type)"""
