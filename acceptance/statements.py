"""Integration statements a spec may carry, in the SQL both engines read."""

from __future__ import annotations

PROJECT = "select ok, pk, sk * 100 as sk100, rf, concat(rf, '-', ls) as flags from src"

FACT_JOIN = (
    "select d.brand, count(*) as n, cast(sum(s.sk) as bigint) as ssk, "
    "count(distinct u.nation) as nations "
    "from src s join part_dim d on s.pk = d.partkey "
    "join supplier_dim u on s.sk = u.suppkey "
    "where s.ls = 'O' group by d.brand"
)

# What a user reaches through the statement: one of each kind, not one per SQL feature.
ACCEPTANCE = {
    "sql_project": PROJECT,
    "sql_filter": "select ok, pk, sk from src where ls = 'F' and sk between 10 and 60 and rf <> 'N'",
    "sql_left_join": (
        "select s.ok, s.pk, d.brand from src s "
        "left join part_dim d on s.pk = d.partkey and d.kind = 'PROMO'"
    ),
    "sql_semi_anti": (
        "select s.ok, s.pk, s.sk from src s "
        "where exists (select 1 from part_dim d where d.partkey = s.pk and d.kind = 'SMALL') "
        "and not exists (select 1 from supplier_dim u where u.suppkey = s.sk and u.nation < 10)"
    ),
    "sql_group_agg": (
        "select sk, rf, count(*) as n, cast(sum(pk) as bigint) as spk, min(ok) as lo, "
        "max(ok) as hi, count(distinct pk) as parts from src group by sk, rf having count(*) > 1"
    ),
    "sql_rollup": (
        "select rf, ls, cast(grouping(rf) + grouping(ls) as int) as level, count(*) as n "
        "from src group by rollup(rf, ls)"
    ),
    # The rank limit lets each task keep three rows per supplier before the shuffle.
    "sql_window": (
        "select sk, ok, pk, ls, rn from (select sk, ok, pk, ls, "
        "cast(row_number() over (partition by sk order by ok, pk, ls) as int) as rn from src) t "
        "where rn <= 3"
    ),
    "sql_topk": (
        "select pk, n from (select pk, count(*) as n from src group by pk) t "
        "order by n desc, pk limit 20"
    ),
    # Each side is made distinct first, so a hot key is one row before the sides meet.
    "sql_set_ops": (
        "(select distinct pk from src where ls = 'O' "
        "intersect select distinct pk from src where ls = 'F') "
        "union all (select distinct sk as pk from src except select nation as pk from supplier_dim)"
    ),
}


def spec_text(home: str, query: str, dims: dict[str, tuple[str, str]]) -> str:
    """A spec for the main lines, with files below ``home``."""
    lines = [
        "MetaData:=ok:=IntegerType",
        "MetaData:=pk:=IntegerType",
        "MetaData:=sk:=IntegerType]",
        "MetaData:=rf:=StringType",
        "MetaData:= ls := Text ",
        "Data:=Sep:=|",
        "Query:=Temp_Table:=src",
        f"Query:=Main_Query:={query}",
        "DATAQUALITY:=BatchId:=B1",
        "DATAQUALITY:=ActivityId:=A1",
        "NonNullable:=rf:=3",
        f"ERRORSCHEMA:=Path:={home}/error",
        f"AUDITSCHEMA:=Path:={home}/audit",
    ]
    for name, (folder, select_list) in dims.items():
        lines.append(f"FactJoin:={name}:={home}/{folder}:={select_list}")
    return "\n".join(lines)


def history_spec(batch_id: str) -> str:
    """A spec whose result goes into a history of customers."""
    return "\n".join(
        [
            "MetaData:=custkey:=IntegerType",
            "MetaData:=segment:=StringType",
            "MetaData:=orders:=IntegerType",
            "MetaData:=name:=StringType",
            "Data:=Sep:=|",
            "Query:=Temp_Table:=src",
            "Query:=Main_Query:=select custkey, nullif(segment, 'NONE') as segment, orders, name from src",
            f"DATAQUALITY:=BatchId:={batch_id}",
            "DATAQUALITY:=ActivityId:=A1",
            "SCD:=JoinID:=custkey",
            "SCD:=Columns:=segment",
            "SCD:=Order:=orders",
        ]
    )
