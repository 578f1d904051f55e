"""Document-style metadata filters compiled to Column predicates over VARIANT.

``{"lang": "en", "score": {"$gte": 2}}`` means both conditions. Keys are
dotted paths. A condition on an array field holds when some element meets it.
A missing path fails equality and ranges and meets ``$ne`` and ``$nin``; every
predicate is true or false, never null.

What filters need of a path (its kind, its value as a string, its elements, ...)
is read once per row into a struct, whatever the number of literals and filters;
the conditions then compare typed fields. They are put together as SQL text, as
a plan of many small Columns takes longer to build than to run.
"""

from __future__ import annotations

import json
import operator
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_RANGE = {"$gt": ">", "$gte": ">=", "$lt": "<", "$lte": "<="}
_COMPARE = {"$gt": operator.gt, "$gte": operator.ge, "$lt": operator.lt, "$lte": operator.le}
_TYPED = {"boolean": "boolean", "string": "string", "whole": "decimal(38,0)", "real": "double"}


def variant_path(dotted: str) -> str:
    """``owner.name`` as a VARIANT path."""
    steps = []
    for key in dotted.split("."):
        quote = '"' if "'" in key else "'"
        steps.append(f"[{quote}{key}{quote}]")
    return "$" + "".join(steps)


def _at(metadata: Column, path: str, kind: str = "variant") -> Column:
    return F.try_variant_get(metadata, path, kind)


def _literal(value) -> str:
    """A scalar as SQL; text in hexadecimal digits, so that no character of it can be read as SQL."""
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, str):
        return f"CAST(X'{value.encode().hex()}' AS STRING)"
    if isinstance(value, int):
        return f"({value})"
    if isinstance(value, float):
        return f"double('{value!r}')"
    raise ValueError(f"cannot compare metadata with {type(value).__name__}")


def _true(condition: str) -> str:
    return f"coalesce({condition}, false)"


def _not(condition: str) -> str:
    return f"(NOT {condition})"


def _all(conditions: list[str]) -> str:
    return f"({' AND '.join(conditions)})" if conditions else "true"


def _any(conditions: list[str]) -> str:
    return f"({' OR '.join(conditions)})" if conditions else "false"


def _one_of(value: str, literals: list) -> str:
    return f"{value} IN ({', '.join(map(_literal, literals))})"


def _facet(value: str, path: str, name: str) -> str:
    """One thing to know of the value at a path."""
    there = f"try_variant_get({value}, {_literal(path)}, '{_TYPED.get(name, 'variant')}')"
    form = {"kind": "schema_of_variant({})", "null": "is_variant_null({})", "json": "to_json({})", "there": "{} IS NOT NULL"}
    return form.get(name, "{}").format(there)


class _Value:
    """The facets of a value that ``name`` holds in a struct; those asked for are noted."""

    def __init__(self, name: str):
        self.name = name
        self.wanted: dict[str, None] = {}

    def __getitem__(self, facet: str) -> str:
        self.wanted.setdefault(facet)
        return f"{self.name}.{facet}"

    def fields(self, value: str, path: str) -> list[str]:
        return [f"'{facet}', {_facet(value, path, facet)}" for facet in self.wanted]


class _Place(_Value):
    """The value at a path, which can be an array of further values."""

    def __init__(self, name: str):
        super().__init__(name)
        self.inner = _Value("x")
        self.listed = False

    @property
    def elements(self) -> str:
        """The elements of an array; null when it is none."""
        self.listed = True
        return f"{self.name}.elements"

    def some(self, test: Callable[[_Value], str]) -> str:
        """Whether an element meets ``test``."""
        return _true(f"exists({self.elements}, x -> {test(self.inner)})")

    def struct(self, value: str, path: str) -> str:
        fields = self.fields(value, path)
        if self.listed:
            inside = ", ".join(self.inner.fields("x", "$") or ["'there', true"])
            fields.append(f"'elements', transform(try_variant_get({value}, {_literal(path)}, 'array<variant>'), x -> named_struct({inside}))")
        return f"named_struct({', '.join(fields)})"


class _Places(dict):
    """Path to place, in the order in which filters name them."""

    def __missing__(self, path: str) -> _Place:
        self[path] = _Place(f"r.p{len(self)}")
        return self[path]

    def over(self, metadata: Column, result: str) -> Column:
        """``result``, an expression over the places, for one computation of ``metadata`` and of each facet."""
        if not self:
            return F.expr(result)
        row = ", ".join(f"'p{i}', {place.struct('m', path)}" for i, (path, place) in enumerate(self.items()))
        body = f"m -> get(transform(array(named_struct({row})), r -> {result}), 0)"
        return F.get(F.call_function("transform", F.array(metadata), F.expr(body)), F.lit(0))


def _is_real(kind: str) -> str:
    return f"({kind} IN ('DOUBLE', 'FLOAT') OR startswith({kind}, 'DECIMAL'))"


def _scalar_compare(value: _Value, literal, op: str) -> str:
    """Compare a value with a literal of the same kind; other kinds fail."""
    kind, given = value["kind"], _literal(literal)
    if isinstance(literal, bool):
        return _true(f"{kind} = 'BOOLEAN' AND {value['boolean']} {op} {given}")
    if isinstance(literal, str):
        return _true(f"{kind} = 'STRING' AND {value['string']} {op} {given}")
    if isinstance(literal, int):
        # BIGINT values compare as integers, so that large ids stay exact
        return _true(f"CASE WHEN {kind} = 'BIGINT' THEN {value['whole']} {op} {given} "
                     f"WHEN {_is_real(kind)} THEN {value['real']} {op} {_literal(float(literal))} END")
    return _true(f"({kind} = 'BIGINT' OR {_is_real(kind)}) AND {value['real']} {op} {given}")


def _matches(place: _Place, literal, op: str) -> str:
    """Scalar compare, or any element of an array."""
    return _any([_scalar_compare(place, literal, op), place.some(lambda x: _scalar_compare(x, literal, op))])


def _equals(place: _Place, literal) -> str:
    if literal is None:
        return _any([_not(place["there"]), _true(place["null"]), place.some(lambda x: x["null"])])
    if isinstance(literal, (list, tuple, dict)):
        text = _literal(json.dumps(literal, sort_keys=True, separators=(",", ":"), ensure_ascii=False))
        return _any([_true(f"{place['json']} = {text}"), place.some(lambda x: f"{x['json']} = {text}")])
    return _matches(place, literal, "=")


def _by_kind(literals: list) -> tuple[list, list, list, list, list]:
    """Booleans, strings, integers, floats, and those that are compared one by one."""
    kinds: tuple[list, list, list, list, list] = ([], [], [], [], [])
    for x in literals:
        kinds[0 if isinstance(x, bool) else 1 if isinstance(x, str) else 2 if isinstance(x, int) else 3 if isinstance(x, float) else 4].append(x)
    return kinds


def _among(place: _Place, literals: list) -> str:
    """Whether a value, or an element of an array, equals one of the literals: one set test per type."""
    booleans, strings, whole, real, rest = _by_kind(literals)

    def one_of(value: _Value) -> str:
        kind, tests = value["kind"], []
        if booleans:
            tests.append(f"{kind} = 'BOOLEAN' AND {_one_of(value['boolean'], booleans)}")
        if strings:
            tests.append(f"{kind} = 'STRING' AND {_one_of(value['string'], strings)}")
        if whole:
            tests.append(f"{kind} = 'BIGINT' AND {_one_of(value['whole'], whole)}")
        if real:
            tests.append(f"{kind} = 'BIGINT' AND {_one_of(value['real'], real)}")
        if whole or real:
            tests.append(f"{_is_real(kind)} AND {_one_of(value['real'], [float(x) for x in whole + real])}")
        return _any([_true(t) for t in tests])

    plain = [one_of(place), place.some(one_of)] if len(rest) < len(literals) else []
    return _any([*plain, *[_equals(place, x) for x in rest]])


def _every(place: _Place, literals: list) -> str:
    """Whether each literal is the value, or an element of the array.

    Strings are one set test however many there are; numbers, which are equal
    across types, booleans and nested values are compared one by one.
    """
    if not literals:
        return "false"
    strings = sorted({x for x in literals if isinstance(x, str)})
    tests = [_equals(place, x) for x in literals if not isinstance(x, str)]
    if len(strings) == 1:
        tests.append(_equals(place, strings[0]))
    elif strings:
        inner = place.inner
        held = f"transform({place.elements}, x -> CASE WHEN {inner['kind']} = 'STRING' THEN {inner['string']} END)"
        tests.append(_true(f"size(array_except(array({', '.join(map(_literal, strings))}), {held})) = 0"))
    return _all(tests)


def _sequence(op: str, argument) -> list:
    if not isinstance(argument, (list, tuple)):
        raise ValueError(f"{op} takes a list")
    return list(argument)


def _operator(place: _Place, op: str, argument) -> str:
    if op == "$eq":
        return _equals(place, argument)
    if op == "$ne":
        return _not(_equals(place, argument))
    if op in _RANGE:
        return _matches(place, argument, _RANGE[op])
    if op == "$in":
        return _among(place, _sequence(op, argument))
    if op == "$nin":
        return _not(_among(place, _sequence(op, argument)))
    if op == "$all":
        return _every(place, _sequence(op, argument))
    if op == "$exists":
        return place["there"] if argument else _not(place["there"])
    if op == "$size":
        return _true(f"size({place.elements}) = {_literal(argument)} AND {place.elements} IS NOT NULL")
    if op == "$not":
        return _not(_field(place, argument))
    raise ValueError(f"unknown filter operator {op!r}")


def _field(place: _Place, condition) -> str:
    if isinstance(condition, dict) and any(str(k).startswith("$") for k in condition):
        return _all([_operator(place, op, arg) for op, arg in condition.items()])
    return _equals(place, condition)


def _conditions(filters: dict | None, places: _Places) -> str:
    if filters is None:
        return "true"
    if not isinstance(filters, dict):
        raise ValueError("a filter is a document of field conditions")
    conditions = []
    for key, value in filters.items():
        if key in ("$and", "$or", "$nor"):
            parts = [_conditions(part, places) for part in _sequence(key, value)]
            joined = _all(parts) if key == "$and" else _any(parts)
            conditions.append(_not(joined) if key == "$nor" else joined)
        elif key.startswith("$"):
            raise ValueError(f"unknown filter operator {key!r}")
        else:
            conditions.append(_field(places[variant_path(key)], value))
    return _all(conditions)


def compile_filter(filters: dict | None, metadata: Column) -> Column:
    """A filter document as a boolean Column; ``None`` or ``{}`` keeps every row."""
    places = _Places()
    return places.over(metadata, _conditions(filters, places))


def compile_filters(filters: list[dict | None], metadata: Column) -> Column:
    """Several filters as one array of booleans; what they share is read once."""
    places = _Places()
    return places.over(metadata, f"array({', '.join([_conditions(f, places) for f in filters])})")


def _promoted_guard(promoted: tuple[Column, str], condition) -> Column | None:
    """A plain predicate on a promoted column that no matching row fails.

    The column is null unless the metadata value is a scalar of the promoted
    type, so null rows always pass; what remains can be pushed to the scan.
    """
    column, kind = promoted

    def simple(v) -> bool:
        if isinstance(v, bool):
            return False
        return isinstance(v, str) if kind == "string" else isinstance(v, (int, float))

    tests = []
    if isinstance(condition, dict):
        for op, argument in condition.items():
            if op == "$eq" and simple(argument):
                tests.append(column == F.lit(argument))
            elif op in _RANGE and simple(argument):
                tests.append(_COMPARE[op](column, F.lit(argument)))
            elif op == "$in" and argument and all(simple(v) for v in argument):
                tests.append(column.isin(list(argument)))
    elif simple(condition):
        tests.append(column == F.lit(condition))
    return (column.isNull() | reduce(operator.and_, tests)) if tests else None


PROMOTABLE = ("string", "bigint", "double")


def promote(metadata: Column, path: str, kind: str) -> Column:
    """The value at ``path`` as a typed column; null unless it is a scalar of that type."""
    if kind not in PROMOTABLE:
        raise ValueError(f"metadata columns are one of {', '.join(PROMOTABLE)}, got {kind!r}")
    value = _at(metadata, variant_path(path))
    shape = F.schema_of_variant(value)
    fits = {"string": shape == "STRING", "bigint": shape == "BIGINT"}.get(kind)
    if fits is None:
        fits = (shape == "BIGINT") | shape.isin("DOUBLE", "FLOAT") | shape.startswith("DECIMAL")
    return F.when(fits, _at(value, "$", kind))


def pushed_filter(filters: dict | None, promoted: dict[str, tuple[Column, str]]) -> Column:
    """The part of a filter that a file scan can use.

    ``promoted`` maps paths to (typed column, type name) that repeat a metadata
    value. Every row that ``compile_filter`` keeps passes; the two are combined.
    """
    guards = []
    for key, value in (filters or {}).items():
        if key == "$and":
            guards.extend(pushed_filter(part, promoted) for part in _sequence(key, value))
        elif key in promoted:
            guard = _promoted_guard(promoted[key], value)
            guards.extend([guard] if guard is not None else [])
    return reduce(operator.and_, guards, F.lit(True))
