"""What an ad-hoc statement may consist of (H1): listed relations, operators and functions, nothing else.

The statement is looked at twice, as Spark's own trees, never as text:

- as parsed, before anything of it is analysed, because analysis already evaluates constant rows and opens files: every
  function must be a built-in one of the admitted groups, every relation one of the given views or a
  common table expression, and no function may stand where a table does;
- as analysed, when names are resolved: every operator and expression must be of a listed class, and every
  leaf one of the given views, constant rows or a reference to a common table expression. So a name that the
  session binds to something else (a user's function, another view, a catalog table) is found here.

The inside of an admitted view is the library's own plan and is not looked at. Admitted function groups come from the
registry's documentation of the built-in functions; what reaches outside a query (reflection, files, the
session, raised errors) is documented in other groups.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

from pyspark.sql import SparkSession

GROUPS = frozenset(f"{g}_funcs" for g in (
    "agg", "array", "bitwise", "collection", "conditional", "conversion", "datetime", "generator", "hash", "json", "lambda", "map", "math",
    "predicate", "string", "struct", "window"))

_EXPRESSIONS = "org.apache.spark.sql.catalyst.expressions."
_PLANS = "org.apache.spark.sql.catalyst.plans.logical."

#: Operators of a query, and its leaves besides views.
OPERATORS = frozenset(
    "Aggregate CTERelationDef CTERelationRef Deduplicate Distinct Except Expand Filter Generate GlobalLimit Intersect Join LateralJoin "
    "LocalLimit LocalRelation Offset OneRowRelation Project ResolvedHint Sample Sort SubqueryAlias Union Window WithCTE".split())

#: Expressions that are no functions: names, constants, casts, orders, windows, subqueries, access to parts.
STRUCTURE = frozenset(
    "Alias AttributeReference Literal TypedNullLiteral Cast SortOrder NullOrdering WindowExpression WindowSpecDefinition SpecifiedWindowFrame "
    "UnboundedPreceding$ UnboundedFollowing$ CurrentRow$ aggregate.AggregateExpression ScalarSubquery ListQuery Exists InSubquery LateralSubquery "
    "OuterReference LambdaFunction NamedLambdaVariable CaseWhen In InSet Not And Or GetStructField GetArrayItem GetArrayStructFields GetMapValue "
    "OuterScopeReference CreateNamedStruct UnaryMinus UnaryPositive Grouping GroupingID ToPrettyString CheckOverflow EvalMode GeneratorOuter "
    "DateAddInterval TimeAdd TimestampAddInterval DatetimeSub SubtractDates SubtractTimestamps DateAddYMInterval TimestampAddYMInterval".split())

#: Classes of admitted functions that the registry names by their builders, and what operators are resolved to.
BUILT = frozenset(
    "StringLPad StringRPad BinaryPad Explode PosExplode Inline Ceil RoundCeil Floor RoundFloor Contains StartsWith EndsWith StringDecode Mask "
    "MakeTimestamp MakeTimestampNTZ MakeTimestampLTZ ParseToTimestamp ParseToDate Hour Minute Second CurrentDate TimestampAdd TimestampDiff "
    "ExtractANSIIntervalDays aggregate.Mode aggregate.PercentileCont aggregate.PercentileDisc aggregate.PivotFirst".split())

#: What an admitted function is made of, where Spark replaces it by others.
INSIDE = frozenset("With CommonExpressionRef CommonExpressionDef objects.StaticInvoke objects.Invoke KnownNotNull KnownNullable".split())


class Refused(ValueError):
    """The statement holds something that a query over the marts does not need."""


@functools.lru_cache(maxsize=1)
def _functions(spark: SparkSession) -> tuple[frozenset[str], frozenset[str]]:
    """Names and classes of the admitted built-in functions; a class that any other group has too is out."""
    infos = [(i.getName(), i.getClassName(), i.getGroup()) for i in spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.listBuiltinFunctionInfos()]
    others = {c for _, c, g in infos if g not in GROUPS}
    inside = [(n, c) for n, c, g in infos if g in GROUPS and c not in others]
    return frozenset(n for n, _ in inside), frozenset(c for _, c in inside)


def _items(seq) -> Iterator:
    return (seq.apply(i) for i in range(seq.size()))


def _class(node) -> str:
    return node.getClass().getName()


def _walk_expression(e) -> Iterator:
    yield e
    for child in _items(e.children()):
        yield from _walk_expression(child)


def _subplans(e) -> Iterator:
    """The plan of a subquery expression."""
    if _class(e).removeprefix(_EXPRESSIONS) in ("ScalarSubquery", "ListQuery", "Exists", "LateralSubquery"):
        yield e.plan()


def check_parsed(spark: SparkSession, sql: str, views) -> None:
    """Refuse by names, before analysis. Syntax errors are raised as they are."""
    names, _ = _functions(spark)
    known = {v.lower() for v in views}

    def tables(plan) -> Iterator[str]:
        if _class(plan).endswith(".UnresolvedWith"):
            yield from (pair._1().lower() for pair in _items(plan.cteRelations()))
        for part in _parts(plan):
            yield from tables(part)

    def look(plan) -> None:
        kind = _class(plan).rsplit(".", 1)[-1]
        if kind == "UnresolvedRelation":
            parts = list(_items(plan.multipartIdentifier()))
            if len(parts) > 1 or parts[0].lower() not in known:
                raise Refused(f"unknown table {'.'.join(parts)}")
        elif "TableValuedFunction" in kind or kind == "UnresolvedTableArgPlanId":
            raise Refused("a function cannot be a table here")
        for e in _items(plan.expressions()):
            for x in _walk_expression(e):
                kind = _class(x).rsplit(".", 1)[-1]
                if kind == "UnresolvedFunction":
                    named = [n.lower() for n in _items(x.nameParts())]
                    if len(named) > 1 or named[0] not in names:
                        raise Refused(f"function {'.'.join(named)} is not admitted")
                elif kind == "UnresolvedGenerator":
                    name = x.name().funcName().lower()
                    if name not in names:
                        raise Refused(f"function {name} is not admitted")
        for part in _parts(plan):
            look(part)

    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql)
    known |= set(tables(plan))
    look(plan)


def _parts(plan) -> Iterator:
    """Children, common table expressions and subqueries of a parsed plan."""
    yield from _items(plan.children())
    if _class(plan).endswith(".UnresolvedWith"):
        for pair in _items(plan.cteRelations()):
            yield pair._2()
    for e in _items(plan.expressions()):
        for x in _walk_expression(e):
            yield from _subplans(x)


def check_analysed(spark: SparkSession, plan, views) -> None:
    """Refuse by the classes of a resolved plan."""
    _, classes = _functions(spark)
    known = {v.lower() for v in views}

    def expression(e, inside: bool) -> None:
        name = _class(e)
        short = name.removeprefix(_EXPRESSIONS)
        if name in classes or short in BUILT:
            inside = True
        elif short not in STRUCTURE and not (inside and short in INSIDE):
            raise Refused(f"{short} is not admitted in a query")
        for sub in _subplans(e):
            look(sub)
        for child in _items(e.children()):
            expression(child, inside)

    def look(node) -> None:
        short = _class(node).removeprefix(_PLANS)
        if short == "View":
            if not node.isTempView() or node.desc().identifier().table().lower() not in known:
                raise Refused("only the marts can be read")
            return
        if short not in OPERATORS:
            raise Refused(f"{short} is not admitted in a query")
        for e in _items(node.expressions()):
            expression(e, False)
        for child in _items(node.children()):
            look(child)

    look(plan)
