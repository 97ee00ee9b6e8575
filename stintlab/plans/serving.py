"""Views over written tables, named reports, and read-only SQL."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from stintlab.operators import reports
from stintlab.sources.tables import path_exists

VIEWS = ("lap_features", "baselines", "replay_events")

# Named reports: the view each one reads, and its query.
REPORTS: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "driver_pace": ("lap_features", reports.driver_pace),
    "compound_temp": ("lap_features", reports.compound_temp),
    "top_anomalies": ("replay_events", reports.top_anomalies),
    "stint_lengths": ("lap_features", reports.stint_lengths),
    "risk_by_compound": ("replay_events", reports.risk_by_compound),
    "wet_dry": ("lap_features", reports.wet_dry),
}

DEFAULT_SQL = "SELECT compound, count(*) AS laps FROM lap_features WHERE clean_lap GROUP BY compound"


def register_views(spark: SparkSession, paths: dict[str, str], views: Sequence[str] = VIEWS) -> list[str]:
    """Temporary views over written tables; replay_events may be missing, the others may not."""
    made = []
    for view in views:
        if view == "replay_events" and not path_exists(spark, paths[view]):
            continue
        spark.read.parquet(paths[view]).createOrReplaceTempView(view)
        made.append(view)
    return made


def run_report(spark: SparkSession, name: str) -> DataFrame:
    view, query = REPORTS[name]
    return query(spark.table(view))


# What a read-only query may consist of, by the name of the parsed node. Commands, writes,
# scripts and external programs are other nodes and thus refused.
_READ_NODES = {
    "Aggregate", "AsOfJoin", "Deduplicate", "Distinct", "Except", "Expand", "Filter", "Generate",
    "GlobalLimit", "Intersect", "Join", "LateralJoin", "LocalLimit", "LocalRelation", "Offset",
    "OneRowRelation", "OneRowRelation$", "PipeOperator", "Pivot", "Project", "RepartitionByExpression", "Sample",
    "Sort", "SubqueryAlias", "Tail", "Union", "UnresolvedHaving", "UnresolvedHint",
    "UnresolvedInlineTable", "UnresolvedRelation", "UnresolvedSubqueryColumnAliases",
    "UnresolvedTVFAliases", "UnresolvedWith", "Unpivot", "WithWindowDefinition",
}
_TABLE_FUNCTIONS = {"range", "explode", "explode_outer", "posexplode", "posexplode_outer", "inline", "inline_outer", "stack"}
# What the registry says of functions that must not be called: code of others, files and paths, and the
# inside of the running application.
_FOREIGN_CLASSES = (
    "CallMethodViaReflection", "TryReflect", "JavaMethod", "InputFileName", "InputFileBlockStart", "InputFileBlockLength",
    "Protobuf", "Avro", "UDF", "Udf", "UserDefined",
)
# The group of functions that show or steer the application; this one does neither.
_INNER_GROUP, _PLAIN_INNER = "misc_funcs", {"typeof"}
# Rows a query may make up by itself, and bytes of pairs it may form without an equality.
_MOST_MADE_UP, _MOST_PAIRS = 100_000_000, 1 << 46
# What an analysed plan may end in, apart from the views themselves.
_LEAVES = {"OneRowRelation", "OneRowRelation$", "LocalRelation", "Range", "CTERelationRef", "UnionLoopRef"}
_FOREIGN_CODE = ("Reflect", "UDF", "UserDefined", "Udf")


class RefusedQuery(ValueError):
    """A statement that is not a plain read of the known views."""


def _items(seq) -> list:
    return [seq.apply(i) for i in range(seq.size())]


def _kind(node) -> str:
    return node.getClass().getSimpleName()


def _may_be_called(spark: SparkSession, name: str) -> bool:
    """Whether the registry knows a function as one of Spark's own that neither calls other code nor looks inside."""
    made = spark._jvm.org.apache.spark.sql.catalyst.FunctionIdentifier(name.lower())
    state = spark._jsparkSession.sessionState()
    found = state.functionRegistry().lookupFunction(made)
    if found.isEmpty():
        return False
    info = found.get()
    if info.getSource() != "built-in" or any(x in info.getClassName() for x in _FOREIGN_CLASSES):
        return False
    return info.getGroup() != _INNER_GROUP or name.lower() in _PLAIN_INNER


def _walk(spark: SparkSession, plan, views: set[str]) -> None:
    kind = _kind(plan)
    if kind == "UnresolvedTableValuedFunction":
        if _items(plan.name())[-1].lower() not in _TABLE_FUNCTIONS:
            raise RefusedQuery("table function not allowed")
    elif kind not in _READ_NODES:
        raise RefusedQuery(f"not allowed in a read-only query: {kind}")
    if kind == "UnresolvedWith":
        # A name counts as a view after its own query, which may only use it if it is recursive.
        for name, relation in map(_items_of_pair, _items(plan.cteRelations())):
            within = views | {name.lower()} if plan.allowRecursion() else views
            _walk(spark, relation, within)
            views = views | {name.lower()}
    if kind == "UnresolvedRelation":
        parts = _items(plan.multipartIdentifier())
        if len(parts) != 1 or parts[0].lower() not in views:
            raise RefusedQuery(f"unknown table: {'.'.join(parts)}")
    for expression in _items(plan.expressions().toSeq()):
        _walk_expression(spark, expression, views)
    for child in _items(plan.children().toSeq()):
        _walk(spark, child, views)


def _items_of_pair(pair) -> tuple[str, object]:
    return pair.productElement(0), pair.productElement(1)


def _walk_expression(spark: SparkSession, expression, views: set[str]) -> None:
    kind = _kind(expression)
    if "Identifier" in kind:
        raise RefusedQuery("names must be written out")
    if kind == "UnresolvedFunction":
        parts = _items(expression.nameParts())
        if len(parts) != 1 or not _may_be_called(spark, parts[0]):
            raise RefusedQuery(f"function not allowed: {'.'.join(parts)}")
    if "SubqueryExpression" in _base_names(expression):
        _walk(spark, expression.plan(), views)
    for child in _items(expression.children().toSeq()):
        _walk_expression(spark, child, views)


def _check_analysed(plan, views: set[str]) -> None:
    """What names resolved to: nothing but the views, and no code from outside Spark's own."""
    kind, children = _kind(plan), _items(plan.children().toSeq())
    if kind == "View" and plan.desc().identifier().table().lower() in views:
        return
    if not children and kind not in _LEAVES:
        raise RefusedQuery(f"reads more than the known views: {kind}")
    for expression in _items(plan.expressions().toSeq()):
        _check_code(expression, views)
    for child in children:
        _check_analysed(child, views)
    if kind == "WithCTE":
        for definition in _items(plan.cteDefs()):
            _check_analysed(definition, views)


def _check_code(expression, views: set[str]) -> None:
    if any(x in _kind(expression) for x in _FOREIGN_CODE):
        raise RefusedQuery(f"not allowed in a read-only query: {_kind(expression)}")
    if "SubqueryExpression" in _base_names(expression):
        _check_analysed(expression.plan(), views)
    for child in _items(expression.children().toSeq()):
        _check_code(child, views)


def _has_equality(condition) -> bool:
    if _kind(condition) in ("EqualTo", "EqualNullSafe"):
        return True
    return _kind(condition) == "And" and any(_has_equality(c) for c in _items(condition.children().toSeq()))


def _check_cost(plan) -> None:
    """What the optimised plan's statistics say: no query may make up, or pair, more than a set amount.

    An equality makes a join of pairs a join by key, whose cost is that of its sides.
    """
    kind, children = _kind(plan), _items(plan.children().toSeq())
    if kind == "Range" and int(str(plan.numElements())) > _MOST_MADE_UP:
        raise RefusedQuery("makes up too many rows")
    if kind == "Join" and (plan.condition().isEmpty() or not _has_equality(plan.condition().get())):
        left, right = (int(str(c.stats().sizeInBytes())) for c in children)
        if left * right > _MOST_PAIRS:
            raise RefusedQuery("pairs too many rows without an equality")
    for child in children:
        _check_cost(child)


def _base_names(node) -> list[str]:
    names, kind = [], node.getClass()
    while kind is not None:
        names.append(kind.getSimpleName())
        kind = kind.getSuperclass()
    return names


def read_only_sql(spark: SparkSession, text: str, views: tuple[str, ...] = VIEWS) -> DataFrame:
    """Run one SELECT over the views.

    Spark's own parser turns the text into a plan, and the plan is checked before anything runs,
    so words inside names or strings do no harm and statements cannot hide behind a WITH. What the
    names then resolve to is checked once more on the analysed plan.
    """
    text = text.strip().rstrip(";")
    known = {v.lower() for v in views}
    _walk(spark, spark._jsparkSession.sessionState().sqlParser().parsePlan(text), known)
    out = spark.sql(text)
    _check_analysed(out._jdf.queryExecution().analyzed(), known)
    _check_cost(out._jdf.queryExecution().optimizedPlan())
    return out


def refused(spark: SparkSession, text: str) -> bool:
    try:
        read_only_sql(spark, text)
    except RefusedQuery:
        return True
    return False
