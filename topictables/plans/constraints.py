"""The constraints of a JSON Schema as one predicate over decoded rows."""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from topictables.plans.schema import load_json, pointer

Rule = Callable[[Column, object], Column]


def _number(value: object) -> Column:
    return F.lit(Decimal(str(value)))


# The keywords that hold for a value by itself, each with when a value breaks it.
RULES: dict[str, Rule] = {
    "minimum": lambda c, bound: c < _number(bound),
    "maximum": lambda c, bound: c > _number(bound),
    "exclusiveMinimum": lambda c, bound: c <= _number(bound),
    "exclusiveMaximum": lambda c, bound: c >= _number(bound),
    "multipleOf": lambda c, step: c % _number(step) != 0,
    "minLength": lambda c, n: F.length(c) < n,
    "maxLength": lambda c, n: F.length(c) > n,
    "pattern": lambda c, text: ~c.rlike(text),
    "minItems": lambda c, n: F.size(c) < n,
    "maxItems": lambda c, n: F.size(c) > n,
    "uniqueItems": lambda c, on: (F.size(F.array_distinct(c)) < F.size(c)) if on else F.lit(False),
}
# Keywords that say what a value is, not what it must keep to, and those that are compiled below.
DESCRIPTIONS = (
    "$schema $id id $defs definitions $comment title description default examples type format "
    "contentEncoding contentMediaType readOnly writeOnly deprecated"
).split()
STRUCTURE = "properties items required dependentRequired enum const allOf anyOf oneOf not $ref".split()


def json_schema_violation(schema: str | dict, record: Column) -> Column:
    """What a decoded record breaks first, as `place: keyword`, or null if it keeps to the schema.

    The tree of the schema, with its references, is compiled to one expression: objects within objects,
    every item of an array, `allOf`, `anyOf` and `not` of constraints. A null value is one that is not
    there: it breaks `required` and nothing else. Whether the types are right is for the decoder. A
    keyword that cannot be checked on decoded rows is refused.
    """
    root = load_json(schema) if isinstance(schema, str) else schema
    return _first(_violations(root, root, record, "", frozenset()))


def _first(violations: list[Column]) -> Column:
    return F.coalesce(*violations) if violations else F.lit(None).cast("string")


def _violations(root: dict, node: dict, value: Column, place: str, seen: frozenset) -> list[Column]:
    """Columns that are a text where the value breaks a part of the node."""
    if "$ref" in node:
        if node["$ref"] in seen:
            raise ValueError(f"{node['$ref']} contains itself")
        return _violations(root, pointer(root, node["$ref"]), value, place, seen | {node["$ref"]})
    unknown = set(node) - set(RULES) - set(DESCRIPTIONS) - set(STRUCTURE)
    if node.get("additionalProperties", True) is True:
        unknown -= {"additionalProperties"}
    if unknown:
        raise ValueError(f"{place or 'the schema'}: cannot check {', '.join(sorted(unknown))}")

    def breaks(keyword: str, condition: Column) -> Column:
        return F.when(value.isNotNull() & condition, F.lit(f"{place or 'message'}: {keyword}"))

    found = []
    for name in node.get("required") or []:
        if name not in node.get("properties", {}):
            raise ValueError(f"{name} is required but has no type")
        missing = value.isNotNull() & value.getField(name).isNull()
        found.append(F.when(missing, F.lit(f"{_inside(place, name)}: required")))
    for name, others in node.get("dependentRequired", {}).items():
        missing = reduce(lambda a, b: a | b, [value.getField(o).isNull() for o in others], F.lit(False))
        found.append(breaks("dependentRequired", value.getField(name).isNotNull() & missing))
    for keyword, bound in _bounds(node).items():
        found.append(breaks(keyword, RULES[keyword](value, bound)))
    for keyword in ("enum", "const"):
        if keyword in node:
            allowed = [v for v in (node["enum"] if keyword == "enum" else [node["const"]]) if v is not None]
            if any(isinstance(v, (dict, list)) for v in allowed):
                raise ValueError(f"{place}: {keyword} of objects or arrays")
            literals = [_number(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else F.lit(v) for v in allowed]
            found.append(breaks(keyword, ~value.isin(literals) if literals else F.lit(True)))
    for name, child in node.get("properties", {}).items():
        found += _violations(root, child, value.getField(name), _inside(place, name), seen)
    if isinstance(node.get("items"), dict) and _violations(root, node["items"], value, place, seen):
        inner = F.transform(value, lambda item: _first(_violations(root, node["items"], item, f"{place}[]", seen)))
        found.append(F.get(F.filter(inner, lambda v: v.isNotNull()), F.lit(0)))
    for child in node.get("allOf", []):
        found += _violations(root, child, value, place, seen)
    if "anyOf" in node:
        every = reduce(lambda a, b: a & b, [_broken(root, c, value, seen) for c in node["anyOf"]])
        found.append(breaks("anyOf", every))
    if "not" in node:
        found.append(breaks("not", ~_broken(root, node["not"], value, seen)))
    if "oneOf" in node:  # a choice of null and one other type
        for child in node["oneOf"]:
            if child.get("type") != "null":
                found += _violations(root, child, value, place, seen)
    return found


def _broken(root: dict, node: dict, value: Column, seen: frozenset) -> Column:
    return _first(_violations(root, node, value, "", seen)).isNotNull()


def _inside(place: str, name: str) -> str:
    return f"{place}.{name}" if place else name


def _bounds(node: dict) -> dict[str, object]:
    """The simple rules of a node; in older schemas the exclusive bounds are marks on the others."""
    rules = {k: v for k, v in node.items() if k in RULES}
    for bound, exclusive in (("minimum", "exclusiveMinimum"), ("maximum", "exclusiveMaximum")):
        if isinstance(rules.get(exclusive), bool):
            if rules.pop(exclusive) and bound in rules:
                rules[exclusive] = rules.pop(bound)
    return rules
