"""Comparison of a Spark result with a DuckDB result: names, order and types of columns, and values."""

from __future__ import annotations

import math


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def canon(rows):
    return sorted((tuple(map(norm, r)) for r in rows), key=repr)


def kind(name):
    """A type's family, for engines that name and size types differently."""
    name = str(name).lower()
    if name.endswith("[]") or name.startswith("array"):
        return "array"
    for family, words in (("text", ("varchar", "string")), ("real", ("double", "float", "decimal")),
                          ("boolean", ("boolean",)), ("whole", ("hugeint", "bigint", "integer", "int", "long", "smallint"))):
        if any(name.startswith(w) for w in words):
            return family
    return name


def schema(columns):
    """(name, family of type) of (name, type) pairs, in order."""
    return [(n, kind(t)) for n, t in columns]
