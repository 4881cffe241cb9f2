"""Read side: registered views, statistics and a SELECT-only SQL door."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators.aggregate import count_by

#: Parsed plan nodes that a query may hold; commands and writes are of other kinds.
ALLOWED = {
    "Project", "Aggregate", "Sort", "Filter", "Join", "GlobalLimit", "LocalLimit", "Offset", "Distinct", "Union", "Intersect", "Except", "SubqueryAlias", "UnresolvedRelation", "UnresolvedWith",
    "OneRowRelation", "UnresolvedInlineTable", "UnresolvedHaving", "Generate", "LateralJoin", "WithWindowDefinition", "UnresolvedSubqueryColumnAliases", "Pivot", "Unpivot", "Window", "Tail", "LocalRelation", "ResolvedInlineTable", "UnresolvedTableValuedFunction", "Range",
}


#: Groups of built-in functions that a query may call; what reaches beyond the data is in the group left out (miscellaneous).
FUNCTION_GROUPS = {
    "agg_funcs", "array_funcs", "bitwise_funcs", "collection_funcs", "conditional_funcs", "conversion_funcs", "csv_funcs", "datetime_funcs", "date_funcs", "generator_funcs", "hash_funcs", "json_funcs", "lambda_funcs", "map_funcs", "math_funcs", "predicate_funcs", "string_funcs", "struct_funcs", "url_funcs", "window_funcs",
}
#: Expressions that tell of the session, whether or not they are written as calls.
SESSION = {"CurrentUser", "CurrentDatabase", "CurrentCatalog", "CallMethodViaReflection", "InputFileName", "InputFileBlockStart", "InputFileBlockLength", "SparkVersion"}
#: Table functions a query may call.
TABLE_FUNCTIONS = {"range", "explode", "explode_outer", "posexplode", "posexplode_outer", "inline", "inline_outer", "stack", "json_tuple"}


class NotAQuery(ValueError):
    """The text is not a plain query over the registered relations."""


def _items(seq) -> list:
    it, out = seq.iterator(), []
    while it.hasNext():
        out.append(it.next())
    return out


def _tree(spark: SparkSession, plan, scope: frozenset[str] = frozenset()):
    """(node, whether it is a plan, common table expressions in its scope) of plans, expressions and the plans within these.

    The names that a WITH defines hold below it alone, each of them for those after it and for the main query.
    """
    kind = lambda name: spark._jvm.java.lang.Class.forName("org.apache.spark.sql.catalyst." + name)
    node, query, subquery = kind("trees.TreeNode"), kind("plans.QueryPlan"), kind("expressions.PlanExpression")
    todo = [(plan, scope)]
    while todo:
        at, held = todo.pop()
        yield at, query.isInstance(at), held
        if query.isInstance(at) and at.nodeName() == "UnresolvedWith":
            for defined in _items(at.cteRelations()):
                name = frozenset([defined._1().lower()])
                todo.append((defined._2(), held | name if at.allowRecursion() else held))
                held |= name
            todo += [(child, held) for child in _items(at.children())]
            continue
        groups = [at.children(), at.innerChildren()] + ([at.expressions()] if query.isInstance(at) else [])
        todo += [(child, held) for group in groups for child in _items(group) if not isinstance(child, str) and node.isInstance(child)]
        if subquery.isInstance(at):
            todo.append((at.plan(), held))


def _group(spark: SparkSession, parts: list[str]) -> str | None:
    """Group of a built-in function, None of any other."""
    if [p.lower() for p in parts[:-1]] not in ([], ["builtin"], ["system", "builtin"]):
        return None
    name = spark._jvm.org.apache.spark.sql.catalyst.FunctionIdentifier(parts[-1].lower())
    found = spark._jvm.org.apache.spark.sql.catalyst.analysis.FunctionRegistry.builtin().lookupFunction(name)
    temporary = spark._jsparkSession.sessionState().catalog().isTemporaryFunction(name)
    return found.get().getGroup() if found.isDefined() and not temporary else None


def guarded_sql(spark: SparkSession, text: str, relations: Collection[str] | None = None) -> DataFrame:
    """Run a query over ``relations`` (all temporary views if None).

    Every node of its parsed plan must be of an allowed kind, every relation one of these or a common
    table expression in whose scope it stands, every function a built-in of an allowed group; what is analysed must
    not tell of the session either.
    """
    known = {r.lower() for r in (relations if relations is not None else (t.name for t in spark.catalog.listTables() if t.isTemporary))}
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(text)
    for node, is_plan, scope in _tree(spark, plan):
        name = node.nodeName()
        if is_plan and name not in ALLOWED:
            raise NotAQuery(f"{name} is not allowed")
        if name == "UnresolvedRelation":
            parts = _items(node.multipartIdentifier())
            if len(parts) != 1 or parts[0].lower() not in known | scope:
                raise NotAQuery(f"{'.'.join(parts)} is not a registered relation")
        if name == "UnresolvedTableValuedFunction" and (len(_items(node.name())) != 1 or _items(node.name())[0].lower() not in TABLE_FUNCTIONS):
            raise NotAQuery("this table function is not allowed")
        if "UnresolvedFunction" in node.getClass().getName() and _group(spark, _items(node.nameParts())) not in FUNCTION_GROUPS:
            raise NotAQuery(f"{'.'.join(_items(node.nameParts()))} is not an allowed function")
    made = spark.sql(text)
    for node, _, _ in _tree(spark, made._jdf.queryExecution().analyzed()):
        if node.getClass().getSimpleName() in SESSION:
            raise NotAQuery(f"{node.nodeName()} is not allowed")
    return made


def register(sites: DataFrame, phases: DataFrame, sources: DataFrame, raw: DataFrame | None = None) -> None:
    for name, df in (("sites", sites), ("phases", phases), ("sources", sources), ("raw_records", raw)):
        if df is not None:
            df.createOrReplaceTempView(name)


def stats(sites: DataFrame) -> dict[str, DataFrame]:
    return {k: count_by(sites, k) for k in ("type_site", "pays")} | {"periode": count_by(sites.select(F.explode("phases.periode").alias("periode")), "periode")}
