"""Band expressions: a small arithmetic language compiled to columns; nothing is ever executed as Python."""

from __future__ import annotations

import ast
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The ranges of the integer raster types.
RANGES = {"uint8": (0, 255), "int8": (-128, 127), "int16": (-32768, 32767), "uint16": (0, 65535), "int32": (-2147483648, 2147483647), "uint32": (0, 4294967295)}

_BINARY = {ast.Add: lambda a, b: a + b, ast.Sub: lambda a, b: a - b, ast.Mult: lambda a, b: a * b, ast.Div: lambda a, b: F.try_divide(a.cast("double"), b.cast("double")), ast.Pow: lambda a, b: F.pow(a, b)}
_COMPARE = {ast.Eq: lambda a, b: a == b, ast.NotEq: lambda a, b: a != b, ast.Lt: lambda a, b: a < b, ast.LtE: lambda a, b: a <= b, ast.Gt: lambda a, b: a > b, ast.GtE: lambda a, b: a >= b}


def to_column(text: str, names: dict[str, Column]) -> Column:
    """Numbers, the given names, + - * / **, unary minus, comparisons, and, or, not, parentheses; a zero divisor gives null."""

    def walk(n: ast.AST) -> Column:
        if isinstance(n, ast.Expression):
            return walk(n.body)
        if isinstance(n, ast.Constant) and type(n.value) in (int, float, bool):
            return F.lit(n.value)
        if isinstance(n, ast.Name) and n.id in names:
            return names[n.id]
        if isinstance(n, ast.BinOp) and type(n.op) in _BINARY:
            return _BINARY[type(n.op)](walk(n.left), walk(n.right))
        if isinstance(n, ast.UnaryOp) and isinstance(n.op, ast.USub):
            return -walk(n.operand)
        if isinstance(n, ast.UnaryOp) and isinstance(n.op, (ast.Not, ast.Invert)):
            return ~walk(n.operand)
        if isinstance(n, ast.BoolOp):
            return reduce((lambda a, b: a & b) if isinstance(n.op, ast.And) else (lambda a, b: a | b), map(walk, n.values))
        if isinstance(n, ast.BinOp) and isinstance(n.op, (ast.BitAnd, ast.BitOr)):
            return walk(n.left) & walk(n.right) if isinstance(n.op, ast.BitAnd) else walk(n.left) | walk(n.right)
        if isinstance(n, ast.Compare) and all(type(o) in _COMPARE for o in n.ops):
            sides = [walk(x) for x in (n.left, *n.comparators)]
            return reduce(lambda a, b: a & b, [_COMPARE[type(o)](a, b) for o, a, b in zip(n.ops, sides, sides[1:], strict=False)])
        raise ValueError(f"not allowed in an expression: {ast.unparse(n)}")

    return walk(ast.parse(text.strip(), mode="eval"))


def clamp(c: Column, data_type: str) -> Column:
    low, high = RANGES[data_type]
    return F.when(c.isNotNull(), F.least(F.greatest(c.cast("double"), F.lit(float(low))), F.lit(float(high))))


def index_band(text: str, names: dict[str, Column], data_type: str = "int16") -> Column:
    """A band expression clamped to the type's range and cut towards 0; null where any input is null or a divisor is 0."""
    return clamp(to_column(text, names), data_type).cast("long")


#: The usual vegetation indices over 0..10000 reflectances.
NDVI = "10000. * ((nir - red) / (nir + red))"
EVI = "10000. * 2.5 * (nir - red) / (nir + 6. * red - 7.5 * blue + 10000.)"


def rescale(v: Column, mult: float, add: float, new_scale: float, data_type: str = "int16") -> Column:
    """v * mult + add, clamped, over new_scale, clamped again and cut towards 0."""
    physical = clamp(v.cast("double") * F.lit(mult) + F.lit(add), data_type)
    return clamp(physical / F.lit(new_scale), data_type).cast("long")


def linear_scale(v: Column, low: float, high: float, out_low: float = 0.0, out_high: float = 255.0) -> Column:
    """v cut to [low, high] and mapped to [out_low, out_high]."""
    cut = F.least(F.greatest(v.cast("double"), F.lit(float(low))), F.lit(float(high)))
    return F.when(v.isNotNull(), (cut - F.lit(float(low))) / F.lit(float(high) - low) * F.lit(float(out_high) - out_low) + F.lit(float(out_low)))


def quicklook(v: Column, high: float = 10000.0, low: float | None = None) -> Column:
    """A display byte: v over the high limit times 255, cut to 0..255; null and values of at most ``low`` (or 0) are 0."""
    byte = F.least(F.greatest(v.cast("double") / F.lit(float(high)) * 255, F.lit(0.0)), F.lit(255.0))
    return F.when(v > F.lit(low or 0), byte).otherwise(F.lit(0.0)).cast("long")
