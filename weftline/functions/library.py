"""Scalar functions of the SQL transform: each gives a Spark SQL expression and its type.

Arguments arrive as (expression, type, literal); the literal is the Python
value where the argument is one, else None.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import types as T

from weftline.plans.types import BOOLEAN, DATE, DOUBLE, INT, LONG, STRING, TIMESTAMP, SqlError, integral, numeric


class Expr(NamedTuple):
    sql: str
    type: T.DataType
    literal: object = None


def quote(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def cast(e: Expr, to: T.DataType) -> str:
    return e.sql if e.type == to else f"cast({e.sql} as {to.simpleString()})"


Builder = Callable[[list[Expr]], Expr]
FUNCTIONS: dict[str, tuple[int, int, Builder]] = {}


def _add(names: str, low: int, high: int, build: Builder) -> None:
    for name in names.split():
        FUNCTIONS[name] = (low, high, build)


def _plain(names: str, count: int, template: str, kind: T.DataType) -> None:
    """A template over {0}, {1}, …, cast where Spark's own type differs."""
    made = "cast(" + template + f" as {kind.simpleString()})" if kind in (INT, LONG) else template
    _add(names, count, count, lambda a: Expr(made.format(*[x.sql for x in a]), kind))


def _text(e: Expr) -> str:
    return cast(e, STRING)


def _flags(e: Expr | None) -> str:
    """Inline flags of a regular expression: i and c set case, the last wins; n lets a dot match a line end; m is multi-line."""
    if e is None or e.literal is None:
        return ""
    on = ""
    case = ""
    for c in str(e.literal):
        if c == "i":
            case = "i"
        elif c == "c":
            case = ""
        elif c == "n":
            on += "s"
        elif c == "m":
            on += "m"
        else:
            raise SqlError(f"unknown regular expression flag {c}")
    return f"(?{case}{on})" if case + on else ""


def _pattern(e: Expr, flags: Expr | None = None) -> str:
    f = _flags(flags)
    if isinstance(e.literal, str):
        return quote(f + e.literal)
    return f"concat({quote(f)}, {e.sql})" if f else e.sql


# Strings
_plain("ASCII", 1, "ascii({0})", INT)
_add("BIT_LENGTH", 1, 1, lambda a: Expr(f"cast(bit_length({a[0].sql}) as bigint)", LONG))
_plain("CHAR_LENGTH LENGTH", 1, "char_length({0})", LONG)
_plain("OCTET_LENGTH", 1, "octet_length({0})", LONG)
_add("CHAR CHR", 1, 1, lambda a: Expr(f"decode(unhex(lpad(hex(cast({a[0].sql} as int)), 8, '0')), 'UTF-32')", STRING))
_add("CONCAT", 1, 99, lambda a: Expr(f"concat_ws('', {', '.join(map(_text, a))})", STRING))
_add("CONCAT_WS", 2, 99, lambda a: Expr(f"concat_ws(coalesce({_text(a[0])}, ''), {', '.join(map(_text, a[1:]))})", STRING))
_plain("HEXTORAW", 1, "decode(unhex({0}), 'UTF-16BE')", STRING)
_add("RAWTOHEX", 1, 1, lambda a: Expr(f"hex({a[0].sql})" if isinstance(a[0].type, T.BinaryType) else f"hex(encode({a[0].sql}, 'UTF-16BE'))", STRING))
_plain("INSERT", 4, "overlay({0} placing {3} from {1} for {2})", STRING)
_plain("LOWER LCASE", 1, "lower({0})", STRING)
_plain("UPPER UCASE", 1, "upper({0})", STRING)
_plain("LEFT", 2, "left({0}, {1})", STRING)
_plain("RIGHT", 2, "right({0}, {1})", STRING)
_add("LPAD", 2, 3, lambda a: Expr(f"lpad({', '.join(x.sql for x in a)})", STRING))
_add("RPAD", 2, 3, lambda a: Expr(f"rpad({', '.join(x.sql for x in a)})", STRING))
for _name, _side in (("LTRIM", "LEADING"), ("RTRIM", "TRAILING"), ("TRIM", "BOTH")):
    _add(_name, 1, 2, lambda a, side=_side: Expr(f"trim({side} {a[1].sql if len(a) > 1 else quote(' ')} FROM {a[0].sql})", STRING))


def _locate(sub: Expr, text: Expr, start: Expr | None) -> Expr:
    """1-based place of `sub`, 0 if absent; a negative start searches backwards from the end."""
    if start is None:
        return Expr(f"locate({sub.sql}, {text.sql})", INT)
    back = f"(case when locate(reverse({sub.sql}), reverse({text.sql}), -({start.sql})) = 0 then 0 else char_length({text.sql}) - locate(reverse({sub.sql}), reverse({text.sql}), -({start.sql})) - char_length({sub.sql}) + 2 end)"
    if isinstance(start.literal, int):
        return Expr(f"locate({sub.sql}, {text.sql}, {start.literal or 1})" if start.literal >= 0 else back, INT)
    return Expr(f"(case when {start.sql} < 0 then {back} else locate({sub.sql}, {text.sql}, greatest(1, {start.sql})) end)", INT)


_add("LOCATE POSITION", 2, 3, lambda a: _locate(a[0], a[1], a[2] if len(a) > 2 else None))
_add("INSTR", 2, 3, lambda a: _locate(a[1], a[0], a[2] if len(a) > 2 else None))
_add("REGEXP_REPLACE", 3, 4, lambda a: Expr(f"regexp_replace({a[0].sql}, {_pattern(a[1], a[3] if len(a) > 3 else None)}, {a[2].sql})", STRING))
_add("REGEXP_LIKE", 2, 3, lambda a: Expr(f"regexp_like({a[0].sql}, {_pattern(a[1], a[2] if len(a) > 2 else None)})", BOOLEAN))


def _regexp_substr(a: list[Expr]) -> Expr:
    place = a[2].sql if len(a) > 2 else "1"
    nth = a[3].sql if len(a) > 3 else "1"
    group = a[5].sql if len(a) > 5 else "0"
    return Expr(f"try_element_at(regexp_extract_all(substr({a[0].sql}, {place}), {_pattern(a[1], a[4] if len(a) > 4 else None)}, {group}), {nth})", STRING)


_add("REGEXP_SUBSTR", 2, 6, _regexp_substr)
_plain("REPEAT", 2, "repeat({0}, {1})", STRING)
_add("REPLACE", 2, 3, lambda a: Expr(f"replace({a[0].sql}, {a[1].sql}, {a[2].sql if len(a) > 2 else quote('')})", STRING))
_plain("SOUNDEX", 1, "soundex({0})", STRING)
_plain("SPACE", 1, "space({0})", STRING)
_add("SUBSTRING SUBSTR", 2, 3, lambda a: Expr(f"substring({', '.join(x.sql for x in a)})", STRING))


def _to_char(a: list[Expr]) -> Expr:
    if len(a) == 1:
        return Expr(_text(a[0]), STRING)
    if numeric(a[0].type):
        return Expr(f"to_char({cast(a[0], T.DecimalType(38, 6)) if not isinstance(a[0].type, T.DecimalType) else a[0].sql}, {a[1].sql})", STRING)
    return Expr(f"date_format({a[0].sql}, {a[1].sql})", STRING)


_add("TO_CHAR", 1, 2, _to_char)
_plain("TRANSLATE", 3, "translate({0}, {1}, {2})", STRING)
# Trailing empty parts go, as a split without a limit does on the JVM.
_add("SPLIT", 2, 2, lambda a: Expr(f"(case when {a[0].sql} = '' then array('') else split(regexp_replace({a[0].sql}, concat('(?:', {_pattern(a[1])}, ')+$'), ''), {_pattern(a[1])}) end)", T.ArrayType(STRING)))

# Numbers
_add("ABS", 1, 1, lambda a: Expr(f"abs({a[0].sql})", a[0].type))
for _name in "ACOS ASIN ATAN COS COSH COT SIN SINH TAN TANH EXP LN LOG10 RADIANS SQRT".split():
    _plain(_name, 1, _name.lower() + "({0})", DOUBLE)
_plain("ATAN2", 2, "atan2({0}, {1})", DOUBLE)
_add("LOG", 1, 2, lambda a: Expr(f"log({a[0].sql}, {a[1].sql})" if len(a) > 1 else f"ln({a[0].sql})", DOUBLE))
_add("MOD", 2, 2, lambda a: Expr(f"cast({a[0].sql} % {a[1].sql} as {a[1].type.simpleString()})", a[1].type))
_plain("CEIL CEILING", 1, "ceil({0})", INT)
_plain("FLOOR", 1, "floor({0})", INT)
_add("PI", 0, 0, lambda a: Expr("pi()", DOUBLE))
_plain("POWER", 2, "power({0}, {1})", DOUBLE)
_add("RAND RANDOM", 0, 1, lambda a: Expr(f"rand({a[0].sql if a else ''})", DOUBLE))
_add("ROUND", 1, 2, lambda a: Expr(f"cast(round({a[0].sql}, {a[1].sql if len(a) > 1 else 0}) as {a[0].type.simpleString()})", a[0].type))
_add("SIGN", 1, 1, lambda a: Expr(f"cast(signum(nanvl(cast({a[0].sql} as double), 0D)) as int)", INT))
_add("TRUNC TRUNCATE", 1, 2, lambda a: Expr("(signum({0}) * floor(abs(cast({0} as double)) * power(10D, {1})) / power(10D, {1}))".format(a[0].sql, a[1].sql if len(a) > 1 else 0), DOUBLE))
_add("ARRAY_MAX", 1, 1, lambda a: Expr(f"array_max({a[0].sql})", a[0].type.elementType))
_add("ARRAY_MIN", 1, 1, lambda a: Expr(f"array_min({a[0].sql})", a[0].type.elementType))

# Dates and times
_add("CURRENT_DATE", 0, 0, lambda a: Expr("current_date()", DATE))
_add("CURRENT_TIMESTAMP NOW", 0, 0, lambda a: Expr("cast(current_timestamp() as timestamp_ntz)", TIMESTAMP))
_add("CURRENT_TIME", 0, 0, lambda a: Expr("current_time()", T.TimeType()))
_UNITS = {"YEAR", "QUARTER", "MONTH", "WEEK", "DAY", "HOUR", "MINUTE", "SECOND", "MILLISECOND", "MICROSECOND"}


def _unit(e: Expr | None) -> str:
    unit = str(e.literal).upper() if e is not None and e.literal is not None else "DAY"
    if unit not in _UNITS:
        raise SqlError(f"unknown date field {unit}")
    return unit


def _dateadd(a: list[Expr]) -> Expr:
    unit = _unit(a[2] if len(a) > 2 else None)
    fine = unit in {"HOUR", "MINUTE", "SECOND", "MILLISECOND", "MICROSECOND"}
    to = TIMESTAMP if fine and isinstance(a[0].type, T.DateType) else a[0].type
    return Expr(f"cast(timestampadd({unit}, {a[1].sql}, {a[0].sql}) as {to.simpleString()})", to)


_add("DATEADD TIMESTAMPADD", 2, 3, _dateadd)


def _datediff(a: list[Expr]) -> Expr:
    """Boundaries of the unit crossed from the first to the second."""
    unit, (x, y) = _unit(a[2] if len(a) > 2 else None), (a[0].sql, a[1].sql)
    months = f"((year({y}) - year({x})) * 12 + month({y}) - month({x}))"
    if unit == "DAY":
        out = f"datediff({y}, {x})"
    elif unit == "MONTH":
        out = months
    elif unit == "YEAR":
        out = f"(year({y}) - year({x}))"
    elif unit == "QUARTER":
        out = f"((year({y}) - year({x})) * 4 + quarter({y}) - quarter({x}))"
    elif unit == "WEEK":
        out = f"(datediff(date_trunc('WEEK', {y}), date_trunc('WEEK', {x})) div 7)"
    else:
        out = f"timestampdiff({unit}, date_trunc('{unit}', {x}), date_trunc('{unit}', {y}))"
    return Expr(f"cast({out} as bigint)", LONG)


_add("DATEDIFF", 2, 3, _datediff)
_add("DATE_TRUNC", 2, 2, lambda a: Expr(f"cast(date_trunc({quote(_unit(a[1]))}, {a[0].sql}) as timestamp_ntz)", TIMESTAMP))
_plain("DAYNAME", 1, "date_format({0}, 'EEEE')", STRING)
_plain("MONTHNAME", 1, "date_format({0}, 'MMMM')", STRING)
_plain("DAY_OF_MONTH", 1, "dayofmonth({0})", INT)
_plain("DAY_OF_WEEK", 1, "weekday({0}) + 1", INT)
_plain("DAY_OF_YEAR", 1, "dayofyear({0})", INT)
for _name in "HOUR MINUTE MONTH QUARTER SECOND YEAR".split():
    _plain(_name, 1, _name.lower() + "({0})", INT)
_plain("WEEK", 1, "weekofyear({0})", INT)
_add("FORMATDATETIME", 2, 2, lambda a: Expr(f"date_format({a[0].sql}, {a[1].sql})", STRING))
_plain("IS_DATE", 2, "(try_to_timestamp({0}, {1}) is not null)", BOOLEAN)


def _parse(a: list[Expr]) -> Expr:
    """TIMESTAMP, DATE or TIME, by what the literal pattern holds."""
    pattern = str(a[1].literal)
    if "yy" in pattern and "mm" in pattern:
        return Expr(f"to_timestamp_ntz({a[0].sql}, {a[1].sql})", TIMESTAMP)
    if "yy" in pattern:
        return Expr(f"to_date({a[0].sql}, {a[1].sql})", DATE)
    if "mm" in pattern:
        return Expr(f"to_time({a[0].sql}, {a[1].sql})", T.TimeType())
    raise SqlError(f"the pattern {pattern} has neither a date nor a time")


_add("PARSEDATETIME TO_DATE", 2, 2, _parse)
_add("FROM_UNIXTIME", 2, 3, lambda a: Expr(f"date_format(from_utc_timestamp(timestamp_seconds({a[0].sql}), {a[2].sql if len(a) > 2 else quote('UTC')}), {a[1].sql})", STRING))


def extract(field: str, e: Expr) -> Expr:
    f = field.upper()
    if f == "EPOCH":
        return Expr(f"cast(unix_timestamp({e.sql}) as int)", INT)
    names = {"DOW": "weekday({0}) + 1", "ISODOW": "weekday({0}) + 1", "MILLISECOND": "extract(SECOND FROM {0}) * 1000"}
    return Expr(f"cast({names.get(f, f'extract({f} FROM {{0}})').format(e.sql)} as int)", INT)


# Nulls and arrays
_add("COALESCE IFNULL", 2, 99, lambda a: Expr(f"cast(coalesce({', '.join(x.sql for x in a)}) as {a[0].type.simpleString()})", a[0].type))
_add("NULLIF", 2, 2, lambda a: Expr(f"nullif({a[0].sql}, {a[1].sql})", a[0].type))
_add("UUID", 0, 0, lambda a: Expr("uuid()", STRING))


def _array(a: list[Expr]) -> Expr:
    kinds = {x.type for x in a if not isinstance(x.type, T.NullType)}
    if all(integral(k) for k in kinds) and kinds:
        to = LONG if LONG in kinds else INT
    elif all(numeric(k) for k in kinds) and kinds:
        to = DOUBLE
    else:
        to = STRING
    return Expr(f"array({', '.join(f'cast({x.sql} as {to.simpleString()})' for x in a)})", T.ArrayType(to))


_add("ARRAY", 1, 999, _array)

#: Functions registered by users, looked up after the built-in ones: name to (result type rule, name in Spark).
USER: dict[str, tuple[Callable[[list[T.DataType]], T.DataType], str]] = {}


def register(spark, name: str, fn: Callable, result_type: Callable[[list[T.DataType]], T.DataType] | T.DataType) -> None:
    """Register a user-defined function; a plain one gets its values by Arrow batches, a pandas_udf takes them whole."""
    rule = result_type if callable(result_type) else (lambda _, t=result_type: t)
    inner = f"weftline_{name.lower()}"
    if hasattr(fn, "returnType"):
        spark.udf.register(inner, fn)
    else:
        from pyspark.sql.functions import udf

        spark.udf.register(inner, udf(fn, rule([]), useArrow=True))
    USER[name.upper()] = (rule, inner)


def call(name: str, args: list[Expr]) -> Expr:
    upper = name.upper()
    if upper in FUNCTIONS:
        low, high, build = FUNCTIONS[upper]
        if not low <= len(args) <= high:
            raise SqlError(f"{upper} takes {low} to {high} arguments, not {len(args)}")
        return build(args)
    if upper in USER:
        rule, inner = USER[upper]
        return Expr(f"{inner}({', '.join(a.sql for a in args)})", rule([a.type for a in args]))
    raise SqlError(f"Unsupported function: {name}")
