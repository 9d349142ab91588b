"""H6: field rules of requests, as data compiled into one pass.

A kind of request has an ordered list of rules.  All rules of the first
stage that a request breaks are reported; a rule of a later stage is asked
only when the request breaks none of an earlier one (an e-mail without '@'
is told of only when all lengths fit).  A missing optional field breaks
nothing; a missing required field breaks only its ``required`` rule.  Text
lengths count characters; NaN is in no range.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """``check`` of ``field``: required, min_length, max_length, above, at_least or contains."""
    field: str
    check: str
    bound: int | str | None = None
    stage: int = 1


def text(field: str, least: int | None, most: int, optional: bool = False) -> list[Rule]:
    rules = [] if optional else [Rule(field, "required")]
    if least is not None:
        rules.append(Rule(field, "min_length", least))
    return [*rules, Rule(field, "max_length", most)]


def number(field: str, check: str | None = None, bound: int | None = None, optional: bool = False) -> list[Rule]:
    rules = [] if optional else [Rule(field, "required")]
    return [*rules, Rule(field, check, bound)] if check else rules


# Fields and bounds of the requests.
RULES: dict[str, list[Rule]] = {
    "register": [*text("name", 2, 120), *text("email", 6, 255), *text("password", 6, 200), *text("phone", None, 20, optional=True),
                 Rule("email", "contains", "@", stage=2)],
    "login": [*text("email", 6, 255), *text("password", 6, 200)],
    "cart_add": [*number("product_id"), *number("quantity", "above", 0)],
    "cart_add_for_user": [*number("user_id"), *number("product_id"), *number("quantity", "above", 0)],
    "cart_update": number("quantity", "above", 0),
    "product": [*number("category_id", "above", 0), *text("sku", 3, 60), *text("product_name", 2, 160),
                *text("description", None, 2000, optional=True), *number("price", "above", 0), *number("stock_qty", "at_least", 0),
                *number("reorder_level", "at_least", 0, optional=True)],
    "search": [*text("search", None, 120, optional=True), *number("min_price", "at_least", 0, optional=True),
               *number("max_price", "at_least", 0, optional=True)],
}

# What a broken rule says.
MESSAGES = {
    "required": "{field} is required",
    "min_length": "{field} must have at least {bound} characters",
    "max_length": "{field} must have at most {bound} characters",
    "above": "{field} must be greater than {bound}",
    "at_least": "{field} must be at least {bound}",
    "contains": "{field} must contain {bound}",
}


def _broken(rule: Rule, requests: DataFrame) -> Column:
    value = F.col(rule.field)
    if rule.check == "required":
        return value.isNull()
    if rule.check == "contains":
        broken = ~F.contains(value, F.lit(rule.bound))
    elif rule.check in ("min_length", "max_length"):
        size = F.length(value)
        broken = size < rule.bound if rule.check == "min_length" else size > rule.bound
    else:
        broken = value <= rule.bound if rule.check == "above" else value < rule.bound
        if requests.schema[rule.field].dataType.typeName() in ("double", "float"):
            broken = broken | F.isnan(value)
    return F.coalesce(broken, F.lit(False))


def with_broken_rules(requests: DataFrame, kind: str, rules: dict[str, list[Rule]] = RULES, out: str = "broken") -> DataFrame:
    """``requests`` with the broken rules of their earliest stage, in order: place, field, rule, message."""
    by_stage: dict[int, list[Column]] = {}
    for place, rule in enumerate(rules[kind], 1):
        message = MESSAGES[rule.check].format(field=rule.field, bound=rule.bound)
        told = F.struct(F.lit(place).alias("place"), F.lit(rule.field).alias("field"), F.lit(rule.check).alias("rule"), F.lit(message).alias("message"))
        by_stage.setdefault(rule.stage, []).append(F.when(_broken(rule, requests), told))
    found = None
    for stage in sorted(by_stage, reverse=True):
        here = F.array_compact(F.array(*by_stage[stage]))
        found = here if found is None else F.when(F.size(here) > 0, here).otherwise(found)
    return requests.withColumn(out, found)


def broken_rules(requests: DataFrame, kind: str, key: str, rules: dict[str, list[Rule]] = RULES) -> DataFrame:
    """One row for each broken rule: request_kind, request_id, place, field, rule, message."""
    told = with_broken_rules(requests, kind, rules, out="__broken")
    return told.select(F.lit(kind).alias("request_kind"), F.col(key).cast("long").alias("request_id"), F.inline("__broken"))


def accepted(requests: DataFrame, kind: str, rules: dict[str, list[Rule]] = RULES) -> DataFrame:
    """The requests that break no rule."""
    told = with_broken_rules(requests, kind, rules, out="__broken")
    return told.filter(F.size("__broken") == 0).drop("__broken")
