"""Views, the integration statement and the load stamps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.origin import SOURCE_SYSTEM
from millrace.sources.dimension import project_dimension, read_dimension
from millrace.sources.spec import JobSpec

# Fixed values of an open, current record.
NOT_SET = ""
ACTIVE = "Y"


def register_source(accepted: DataFrame, spec: JobSpec) -> None:
    accepted.createOrReplaceTempView(spec.view)


def register_dimensions(spark: SparkSession, spec: JobSpec) -> None:
    """Every configured dimension file as a projected view, in spec order."""
    for dim in spec.dimensions:
        project_dimension(spark, read_dimension(spark, dim.path), dim.name, dim.select_list)


def integrate(
    spark: SparkSession, accepted: DataFrame, spec: JobSpec, dimensions: bool = True
) -> DataFrame:
    """Run the spec's statement over the accepted rows and its dimensions.

    ``dimensions=False`` leaves the dimension views as the caller has registered them.

    Join strategies are left to Catalyst: it broadcasts a dimension only below its size
    threshold and otherwise sorts and merges, where adaptive execution splits hot keys.
    """
    register_source(accepted, spec)
    if dimensions:
        register_dimensions(spark, spec)
    return spark.sql(spec.query)


def columns_read(
    spark: SparkSession, spec: JobSpec, further: Sequence[str] = ()
) -> frozenset[int]:
    """Analyse the statement before any data is touched: the source positions it reads.

    The source also has the text columns ``further``, at positions behind the declared ones.

    The source view stands for a table without rows that the optimizer knows nothing about, so an
    unknown column, a syntax error or a missing dimension fails here. A position counts as read if
    the optimized plan mentions it anywhere above the source. A node of several inputs that is not
    a join (``UNION``, a recursion) takes their columns by place: its own output names those of the
    first input alone, and every column of each input counts as mentioned.
    """
    schema = T.StructType([*spec.schema, *[T.StructField(c, T.StringType()) for c in further]])
    source = spark.createDataFrame(spark.sparkContext.emptyRDD(), schema)
    plan = integrate(spark, source, spec)._jdf.queryExecution().optimizedPlan()
    leaves, mentioned = [], set()

    def ids(attributes) -> list[int]:
        return [attributes.apply(i).exprId().id() for i in range(attributes.size())]

    def walk(node) -> None:
        for inner in (node.children(), node.subqueries()):
            for i in range(inner.size()):
                walk(inner.apply(i))
        inputs = node.children()
        if inputs.size() > 1 and "Join" not in node.nodeName():
            for i in range(inputs.size()):
                mentioned.update(ids(inputs.apply(i).output()))
        if node.nodeName() == "LogicalRDD" or "ExistingRDD" in node.nodeName():
            leaves.append(ids(node.output()))
        else:
            mentioned.update(ids(node.references().toSeq()))

    walk(plan)
    mentioned.update(ids(plan.output()))
    return frozenset(i for leaf in leaves for i, name in enumerate(leaf) if name in mentioned)


def stamp(
    integrated: DataFrame, load_time: str, batch_id: str, system: str | None = None
) -> DataFrame:
    """Add the seven load columns, with ``system`` an eighth for the one system all rows are from.

    A column of the same name is replaced in its place.
    """
    # Fixed column names, in output order. One of them holds a blank.
    origin = {} if system is None else {SOURCE_SYSTEM: F.lit(system)}
    return integrated.withColumns(
        {
            "lets_ld_dt": F.lit(load_time),
            "lets_ld_upd_dt": F.lit(NOT_SET),
            "lets_ld_bch_id": F.lit(batch_id),
            "lets_ld_upd_ bch_id": F.lit(NOT_SET),
            "lets_eff_strt_dt": F.lit(load_time),
            "lets_eff_end_dt": F.lit(NOT_SET),
            **origin,
            "lets_atv_flg": F.lit(ACTIVE),
        }
    )
