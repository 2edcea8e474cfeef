"""Canonical JSON text of nested values, as SQL that Spark runs in the JVM: fixed member order, indents of two spaces, every member present.

A renderer is made from a type once. Texts keep all characters but quotes, backslashes and controls; floats are written as the shortest decimal
in plain form from 1e-4 up to below 1e16 and with an exponent of two or more digits beyond; empty lists and objects stand on one line.
Null values at any depth are null. Numbers that may be whole or not come as the text of the number (see NUMBER).
"""

from __future__ import annotations

from pyspark.sql.types import ArrayType, BooleanType, DataType, DoubleType, LongType, MapType, StringType, StructType

#: Name of a member whose text is a number's; members are told by their dotted path.
NUMBER = "number"
_RARE = r"[\x0B\x0E\x0F\x1A-\x1F]"  # controls that to_json writes with upper-case digits


def _text(v: str, c: str) -> str:
    plain = f"substring(to_json(array({v})), 2, length(to_json(array({v}))) - 2)"
    each = f"if({c} rlike r'{_RARE}', concat(r'\\u00', lower(hex({c}))), substring(to_json(array({c})), 3, length(to_json(array({c}))) - 4))"
    return f"if({v} rlike r'{_RARE}', concat('\"', concat_ws('', transform(split({v}, ''), {c} -> {each})), '\"'), {plain})"


def _float(v: str, s: str) -> str:
    """A double's text: Java's in its plain range, else moved out of, or into, the form with an exponent."""
    part = lambda k: f"regexp_extract({s}, r'^(-?)(\\d)\\.(\\d+)E(-?\\d+)$', {k})"
    exponent, digits = f"cast({part(4)} as int)", f"if({part(3)} = '0', '', {part(3)})"
    far = f"concat({part(1)}, {part(2)}, if({part(3)} = '0', '', concat('.', {part(3)})), 'e', if({exponent} < 0, '-', '+'), if(abs({exponent}) < 10, '0', ''), abs({exponent}))"
    small = f"concat({part(1)}, '0.', repeat('0', -{exponent} - 1), {part(2)}, {digits})"
    large = f"concat({part(1)}, {part(2)}, rpad(left({digits}, {exponent}), {exponent}, '0'), '.', if(length({digits}) > {exponent}, substring({digits}, {exponent} + 1), '0'))"
    moved = f"if({exponent} >= 16 or {exponent} < -4, {far}, if({exponent} < 0, {small}, {large}))"
    return f"get(transform(array(cast({v} as string)), {s} -> if({s} like '%E%', {moved}, {s})), 0)"


def rendered(value: str, kind: DataType, *, numbers: frozenset[str] = frozenset(), path: str = "", level: int = 0, depth: int = 0) -> str:
    """SQL for the JSON text of a value of a type, indented for so many levels. numbers: dotted paths of texts that are numbers."""
    v, inner = f"v{depth}", {"numbers": numbers, "level": level + 1, "depth": depth + 2}
    pad, outer = "  " * (level + 1), "  " * level
    if isinstance(kind, StringType):
        said = f"if({v} rlike r'^-?\\d+$', if({v} = '-0', '0', {v}), {_float(f'cast({v} as double)', f's{depth}')})" if path in numbers else _text(v, f"c{depth}")
    elif isinstance(kind, (LongType, BooleanType)):
        said = f"cast({v} as string)"
    elif isinstance(kind, DoubleType):
        said = _float(v, f"s{depth}")
    elif isinstance(kind, ArrayType):
        item, x = rendered(f"x{depth}", kind.elementType, path=path, **inner), f"x{depth}"
        said = f"if(size({v}) = 0, '[]', concat('[\\n{pad}', array_join(transform({v}, {x} -> {item}), ',\\n{pad}'), '\\n{outer}]'))"
    elif isinstance(kind, MapType):
        e = f"e{depth}"
        pair = f"concat({_text(f'{e}.key', f'c{depth}')}, ': ', {rendered(f'{e}.value', kind.valueType, path=path, **inner)})"
        said = f"if(size({v}) = 0, '{{}}', concat('{{\\n{pad}', array_join(transform(map_entries({v}), {e} -> {pair}), ',\\n{pad}'), '\\n{outer}}}'))"
    elif isinstance(kind, StructType):
        members = [f"'\"{f.name}\": ', " + rendered(f"{v}.`{f.name}`", f.dataType, path=f"{path}.{f.name}".lstrip("."), **inner) for f in kind]
        said = f"concat('{{\\n{pad}', {f", ',\\n{pad}', ".join(members)}, '\\n{outer}}}')"
    else:
        raise TypeError(f"no canonical form for {kind.simpleString()}")
    return f"get(transform(array({value}), {v} -> if({v} is null, 'null', {said})), 0)"
