"""The same results as plain SQL over the given tables."""

from __future__ import annotations

from acceptance import statements

RUN = "'2024-01-01 00:00:00'"
ARITY_TEXT = "'The record doesnt have enough arguments or filled'"

MAIN_LINES = """
select concat_ws('|', cast(l_orderkey as varchar), cast(l_partkey as varchar),
    case l_linenumber when 3 then '12.7' when 4 then '' else cast(l_suppkey as varchar) end,
    case when l_returnflag = 'R' then 'null' else l_returnflag end,
    case when l_linenumber <> 2 then l_linestatus end) as value
from lineitem
"""

MARKER_LINES = """
select concat_ws('|', cast(l_orderkey as varchar), cast(l_partkey as varchar),
    case l_linenumber when 3 then '1,2.7' when 4 then '' else cast(l_suppkey as varchar) end,
    case when l_linenumber = 5 then 'a,NullException ' || l_returnflag || ',,'
         when l_linenumber = 6 then l_returnflag || 'Excep'
         when l_returnflag = 'R' then 'null' else l_returnflag end,
    case when l_linenumber = 5 then '' when l_linenumber = 6 then 'tion' || l_linestatus
         when l_linenumber <> 2 then l_linestatus end) as value
from lineitem
"""

NUMBER_LINES = """
select concat_ws('||',
    case l_linenumber when 1 then '+' || cast(l_orderkey as varchar)
        when 2 then ' ' || cast(l_orderkey as varchar) else cast(l_orderkey as varchar) end,
    case l_linenumber when 3 then disc || 'f' when 4 then ' q '
        when 5 then ' ' || disc || 'e1 ' else disc end,
    case when l_linenumber = 6 then price || '.' || quantity
        when l_linenumber = 7 and l_linestatus = 'O' then '  '
        when l_linenumber = 7 then 'inf' else price end,
    l_returnflag) as value
from (select *, cast(cast(l_discount as decimal(18, 2)) as varchar) as disc,
             cast(cast(l_quantity as decimal(18, 2)) as varchar) as quantity,
             cast(cast(l_extendedprice as decimal(18, 2)) as varchar) as price from lineitem)
"""


def _bad_integer(field: str) -> str:
    return (
        f"(not regexp_full_match({field}, '[+-]?[0-9]+') or try_cast({field} as integer) is null)"
    )


def _quoted(field: str) -> str:
    return f"'Exception For input string: \"' || {field} || '\"'"


def _classified(lines: str, required: bool = True) -> str:
    """CTEs ``lines``, ``split``, ``checked`` for the five-column main spec."""
    dropped = "when f[4] = '' or lower(f[4]) = 'null' then 'required'" if required else ""
    reasons = " ".join(f"when {_bad_integer(f'f[{i}]')} then {_quoted(f'f[{i}]')}" for i in (1, 2, 3))
    return f"""
with lines as ({lines}),
split as (select value, string_split(value, '|') as f from lines),
judged as (select *, case when len(f) = 5 then case {reasons} end end as reason from split),
checked as (select *, case when len(f) <> 5 then 'arity' {dropped}
    when reason is not null then 'convert' else 'ok' end as status from judged),
marks as (select *, status = 'ok' and contains(f[4] || f[5], 'Exception') as marked,
    regexp_replace(concat_ws(',', cast(try_cast(f[1] as integer) as varchar),
        cast(try_cast(f[2] as integer) as varchar), cast(try_cast(f[3] as integer) as varchar),
        f[4], f[5]), ',+$', '') as joined from checked),
src as (select cast(f[1] as integer) as ok, cast(f[2] as integer) as pk,
    cast(f[3] as integer) as sk, f[4] as rf, f[5] as ls from checked where status = 'ok'),
part_dim as (select cast(p_partkey as integer) as partkey, p_brand as brand,
    upper(p_type) as kind from part),
supplier_dim as (select cast(s_suppkey as integer) as suppkey,
    cast(s_nationkey as integer) as nation from supplier)
"""


MAIN = _classified(MAIN_LINES)
FACT = _classified(MAIN_LINES, required=False)
MARKER = _classified(MARKER_LINES)
FACT_MARKER = _classified(MARKER_LINES, required=False)

FLOATING = r"[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?[fFdD]?"


def _bad_number(field: str) -> str:
    return f"not regexp_full_match(trim({field}), '{FLOATING}')"


def _number_reason(field: str) -> str:
    return (
        f"when {_bad_number(field)} then case when trim({field}) = '' then 'Exception empty String' "
        f"when regexp_matches(trim({field}), '^[+-]?[0-9]*\\.[0-9]*\\.') "
        f"then 'Exception multiple points' else {_quoted(f'trim({field})')} end"
    )


NUMBERS = f"""
with lines as ({NUMBER_LINES}),
split as (select string_split(value, '||') as f from lines),
judged as (select f, case when {_bad_integer('f[1]')} then {_quoted('f[1]')}
    {_number_reason('f[2]')} {_number_reason('f[3]')} end as reason from split)
"""


def _plain(field: str) -> str:
    return f"regexp_replace(trim({field}), '[fFdD]$', '')"


SPEC_LINES = """
with settings as (select o_orderkey as line_no,
    case o_orderstatus when 'O' then 'MetaData' when 'F' then 'FactJoin' else 'Other' end as section,
    'c' || cast(o_custkey as varchar) as key,
    case o_orderpriority when '1-URGENT' then 'IntegerType' when '2-HIGH' then 'FloatType]'
        when '3-MEDIUM' then 'DoubleType' when '5-LOW' then 'StringType'
        else 'DateType' end as value,
    case when o_orderstatus = 'F' then 'x' || cast(o_orderkey as varchar) end as extra
    from orders)
"""

STAMPS = (
    f"{RUN} as lets_ld_dt, '' as lets_ld_upd_dt, 'B1' as lets_ld_bch_id, "
    f"'' as \"lets_ld_upd_ bch_id\", {RUN} as lets_eff_strt_dt, '' as lets_eff_end_dt, "
    "'Y' as lets_atv_flg"
)
# Empty text is written as nothing, which a dimension scan reads as null.
READ_STAMPS = STAMPS.replace("''", "cast(null as varchar)")

REJECT = f"select 'B1' as batch_id, 'A1' as activity_id, %s as record_key, {RUN} as error_ts, %s as message"
MARK_KEY = "string_split(joined, ',')[1]"
MARK_TEXT = "string_split(joined, ',')[-1]"
ARITY_LINE = f"select concat_ws(',', 'B1', 'A1', f[1], {RUN}, {ARITY_TEXT}) as line from marks where status = 'arity'"
CONVERT_LINE = (
    f"select concat_ws(',', 'B1', 'A1', string_split(f[1], ',')[1], {RUN}, "
    "string_split(reason, ',')[-1]) as line from marks where status = 'convert'"
)
MARKER_LINE = (
    f"select concat_ws(',', 'B1', 'A1', {MARK_KEY}, {RUN}, {MARK_TEXT}) as line "
    "from marks where marked"
)
REQUIRED_LINE = (
    f"select concat_ws(',', 'B1', 'A1', f[1], {RUN}, 'A required field is empty') as line "
    "from marks where status = 'required'"
)
LOG = f"{ARITY_LINE} union all {CONVERT_LINE} union all {MARKER_LINE}"

COUNTS = f"""
select count(*) as records_read,
    count(*) filter (where status in ('arity', 'convert') or marked) as records_rejected,
    count(*) filter (where status = 'ok') as accepted,
    count(*) filter (where status = 'arity') as arity,
    count(*) filter (where status = 'required') as required,
    count(*) filter (where status = 'convert') as convert,
    count(*) filter (where marked) as marked,
    (select count(*) from ({statements.FACT_JOIN}) w) as records_written
from marks
"""
RECORD = (
    f"select concat_ws(',', 'B1', 'A1', '2', {RUN}, {RUN}, cast(records_read as varchar), "
    "cast(records_written as varchar), cast(records_rejected as varchar)) as line "
    f"from ({COUNTS}) c"
)
MANIFEST = " union all ".join(
    f"select '{name}' as name, count(*) as record_count, {RUN} as counted_at from {name}"
    for name in ("customer", "part", "supplier")
)


FIRST_LOAD, SECOND_LOAD = "'2024-01-01 00:00:00'", "'2024-02-01 00:00:00'"


def _history_row(source: str, load: str, batch: str, changed: str) -> str:
    """A row opened by ``load``; where ``changed``, the second load has closed it."""
    return f"""
select {source}.custkey, {source}.segment, {source}.orders, {source}.name, {load} as lets_ld_dt,
    case when {changed} then {SECOND_LOAD} else '' end as lets_ld_upd_dt, '{batch}' as lets_ld_bch_id,
    case when {changed} then 'B2' else '' end as "lets_ld_upd_ bch_id", {load} as lets_eff_strt_dt,
    case when {changed} then {SECOND_LOAD} else '' end as lets_eff_end_dt,
    case when {changed} then 'N' else 'Y' end as lets_atv_flg"""


CHANGED = "b2.custkey is not null and b1.segment is distinct from b2.segment"
HISTORY = f"""
with rows as (
    select cast(c_custkey as integer) as custkey, c_nationkey as nation, c_mktsegment as segment, c_name as name,
        count(o_orderkey) as every, count(o_orderkey) filter (where o_orderstatus = 'O') as open
    from customer left join orders on c_custkey = o_custkey group by all),
b1 as (select custkey, case when nation = 5 then null else segment end as segment,
    cast(open as integer) as orders, name from rows where segment <> 'MACHINERY'),
b2 as (select custkey, case when nation in (5, 6) then null when nation = 9 then 'ZED'
        when nation < 4 then 'NEW' else segment end as segment,
    cast(every + case when nation = 9 then 1000 else 0 end as integer) as orders, name
    from rows where nation <> 3)
{_history_row("b1", FIRST_LOAD, "B1", CHANGED)} from b1 left join b2 using (custkey)
union all
{_history_row("b2", SECOND_LOAD, "B2", "false")} from b2 left join b1 using (custkey)
where b1.custkey is null or b1.segment is distinct from b2.segment
"""


def _kept(order: str) -> str:
    """The accepted main lines with their place, one of each order."""
    places = MAIN_LINES.replace("as value", "as value, l_orderkey, l_linenumber")
    return f"""
select ok, pk, sk * 100 as sk100, rf, concat(rf, '-', ls) as flags from (
    select cast(f[1] as integer) as ok, cast(f[2] as integer) as pk, cast(f[3] as integer) as sk,
        f[4] as rf, f[5] as ls from (
        select f, value, l_orderkey, l_linenumber from checked join (
            select distinct value, l_orderkey, l_linenumber from ({places}) p) using (value)
        where status = 'ok'
        qualify row_number() over (partition by l_orderkey order by {order}) = 1) o) src
"""


MARKED_REJECTS = f"""
select * from ({REJECT % ("f[1]", ARITY_TEXT)} from marks where status = 'arity'
union all {REJECT % ("f[1]", "reason")} from marks where status = 'convert'
union all {REJECT % (MARK_KEY, MARK_TEXT)} from marks where marked) r, (select 'SAP' as lets_src_sys_nm) s
"""


def _texts(names: list[str], source: str) -> str:
    columns = ", ".join(f"cast({name} as varchar) as {name}" for name in names)
    return f"select {columns}, {READ_STAMPS} from ({source}) t"


def oracle_statements() -> dict[str, str]:
    statements_by_name = {
        "raw_scan": MAIN_LINES,
        "field_split": MAIN
        + "select len(f) as n, f[1] as f0, f[2] as f1, f[3] as f2, f[4] as f3, f[5] as f4 from split",
        "dim_scan": "select cast(p_partkey as varchar) as p_partkey, p_name, "
        "nullif(p_brand, 'Brand#1') as p_brand, p_type from part",
        "spec_sections": SPEC_LINES
        + "select section, key, min(line_no) as first_line, arg_max(value, line_no) as value, "
        "case section when 'FactJoin' then arg_max(extra, line_no) end as extra, "
        "cast(null as bigint) as bad_value, "
        "min(line_no) filter (where section = 'MetaData') as bad_extra "
        "from settings where section in ('MetaData', 'FactJoin') group by section, key",
        "spec_sections_contains": SPEC_LINES
        + ", hits as (select 'Data' as section, * exclude section from settings where section = 'MetaData' "
        "union all select 'Fact' as section, * exclude section from settings where section = 'FactJoin' "
        "union all select 'x1' as section, * exclude section from settings where contains(extra, 'x1')) "
        "select section, key, min(line_no) as first_line, arg_max(value, line_no) as value, "
        "case when section <> 'Data' then arg_max(extra, line_no) end as extra "
        "from hits group by section, key",
        # The looked-up token keeps its blanks.
        "spec_lookup": SPEC_LINES
        + "select ' ' || arg_max(key, line_no) || ' ' as value from settings where section = 'MetaData'",
        "declared_schema": SPEC_LINES
        + "select key as name, min(line_no) as place, case arg_max(value, line_no) "
        "when 'IntegerType' then 'int' when 'FloatType]' then 'float' "
        "when 'DoubleType' then 'double' else 'string' end as type_name "
        "from settings where section = 'MetaData' group by key",
        "typed_convert": NUMBERS
        + f"select cast(f[1] as integer) as ok, cast(cast({_plain('f[2]')} as float) as double) as disc, "
        f"cast({_plain('f[3]')} as double) as price, f[4] as note from judged where reason is null",
        "convert_errors": NUMBERS
        + "select f[1] as record_key, reason as message from judged where reason is not null",
        "line_status": MAIN + "select status, count(*) as lines from checked group by status",
        "arity_filter": MAIN + "select value as line from split where len(f) = 5",
        "arity_mismatch": MAIN + "select value as line from split where len(f) <> 5",
        "required_filter": MAIN
        + "select value as line from split where len(f) = 5 and f[4] <> '' and lower(f[4]) <> 'null'",
        "empty_key_probe": "select '|' || cast(n_chars as varchar) || '|' || source as line "
        "from documents where lang = 'en' and not contains(source, '|')",
        "dim_project": "select cast(p_partkey as integer) as partkey, p_brand as brand, "
        "upper(p_type) as kind from part",
        "fact_join": MAIN + statements.FACT_JOIN,
        "integrated_fact": MAIN + f"select *, {STAMPS} from ({statements.FACT_JOIN}) t",
        "audit_stamp": MAIN + f"select ok, pk, sk, rf, {STAMPS} from src",
        "reject_arity": MAIN + REJECT % ("f[1]", ARITY_TEXT) + " from checked where status = 'arity'",
        "reject_convert": MAIN + REJECT % ("f[1]", "reason") + " from checked where status = 'convert'",
        "reject_marker": MARKER + REJECT % (MARK_KEY, MARK_TEXT) + " from marks where marked",
        "reject_log": MARKER + LOG,
        "reject_log_strict": MARKER + f"{ARITY_LINE} union all {CONVERT_LINE} union all {REQUIRED_LINE}",
        "run_counts": MAIN + COUNTS,
        "audit_record": MAIN + RECORD,
        "folder_manifest": MANIFEST,
        "manifest_log": "select concat_ws('|', name, cast(record_count as varchar), counted_at) "
        f"as line from ({MANIFEST}) m",
        "data_sink": MARKER
        + _texts(["ok", "pk", "sk", "rf", "ls"], "select ok, pk, sk, trim(rf) as rf, nullif(ls, '') as ls from src"),
        "log_sink": MARKER + LOG,
        "fact_load": FACT + _texts(["brand", "n", "ssk", "nations"], statements.FACT_JOIN),
        "two_folder_load": FACT
        + _texts(["brand", "n", "ssk", "nations"], statements.FACT_JOIN),
        "double_separator_load": FACT
        + _texts(["brand", "n", "ssk", "nations"], statements.FACT_JOIN),
        "manifest_load": "select concat_ws('|', name, cast(n as varchar), "
        f"{RUN}) as line from (select 'dims' as name, count(*) as n from part "
        "union all select 'dims', count(*) from supplier union all select 'all', "
        "(select count(*) from part) + (select count(*) from supplier) + "
        "(select count(*) from customer)) m",
        "fact_load_audit": FACT + RECORD,
        "fact_load_errors": FACT_MARKER + LOG,
        "dimension_load": MAIN
        + _texts(["ok", "pk", "sk100", "rf", "flags"], statements.PROJECT),
        "dimension_load_errors": MARKER + LOG,
    }
    columns = ["ok", "pk", "sk100", "rf", "flags"]
    broken = f"select case when contains(value, '|1,2.7|') then '\"a, \\' else '' end || value as value from ({MARKER_LINES}) m"
    statements_by_name |= {
        "scd2_merge": HISTORY,
        "keep_one": FACT + _texts(columns, _kept("l_linenumber desc, value")),
        "keep_one_last": MAIN + _texts(columns, _kept("l_linenumber, value desc")),
        "source_column": FACT
        + _texts(
            ["system", "n", "spk"],
            "select case length(value) % 3 when 0 then 'SAP' when 1 then 'CRM' end as system, "
            "count(*) as n, cast(sum(cast(f[2] as bigint)) as bigint) as spk "
            "from checked where status = 'ok' group by all",
        ),
        "reject_csv": _classified(broken, required=False) + MARKED_REJECTS,
        "ordered_sink": FACT + "select pk, ok, sk, ls, true as in_order from src",
        "dimension_fanout": "select 'part_dim' as dimension, "
        "'{\"brand\":\"' || p_brand || '\",\"kind\":\"' || upper(p_type) || '\"}' as key, "
        "cast(count(*) as varchar) as rows from part group by p_brand, upper(p_type) having count(*) > 1 "
        "union all select 'supplier_dim', '{\"nation\":' || cast(s_nationkey as varchar) || '}', "
        "cast(count(*) as varchar) from supplier group by s_nationkey having count(*) > 1",
    }
    for name, sql in statements.ACCEPTANCE.items():
        statements_by_name[name] = MAIN + sql
    return statements_by_name
