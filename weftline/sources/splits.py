"""Split points of a table's key, so that the ranges between them hold about as many rows each.

Numbers and dates that are spread evenly, as their distribution factor
(MAX - MIN + 1) / COUNT and the counts of PROBES parts of their range say, are
cut into equal ranges.  Others are cut at the
quantiles of a sample of their values, which Spark reads and sorts.  Texts are
cut where the database's own order has every n-th of them, as its collation
need not be Spark's.  A value that many rows share is never cut.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SIZE = 8096
#: Distribution factors of even keys; splits beyond which texts are cut more coarsely; one value of so many is sampled.
LOWER, UPPER, THRESHOLD, RATE = 0.05, 100.0, 1000, 1000
#: Parts of an even key's range that are counted; none holds more than twice its share.
PROBES = 32
#: Sampled values in a split, which keep its size near the mean.
SAMPLED = 64


def _number(value):
    if isinstance(value, dt.datetime):
        return value.timestamp()
    return value.toordinal() if isinstance(value, dt.date) else value


def even(low, high, n: int, size: int, lower: float = LOWER, upper: float = UPPER) -> list | None:
    """Points that cut [low, high] into equal ranges of about `size` of `n` rows; None where the key is not even."""
    factor = float(_number(high) - _number(low) + 1) / n
    if not lower <= factor <= upper:
        return None
    step = max(1, math.ceil(size * factor))
    if isinstance(low, dt.datetime):
        return [low + dt.timedelta(seconds=step * i) for i in range(1, math.ceil((_number(high) - _number(low)) / step) + 1) if low + dt.timedelta(seconds=step * i) <= high]
    if isinstance(low, dt.date):
        return [low + dt.timedelta(days=i) for i in range(step, (high - low).days + 1, step)]
    return [low + i for i in range(step, int(high - low) + 1, step)]


def sampled(keys: DataFrame, n: int, size: int, rate: int = RATE, seed: int = 7) -> list:
    """Points at the quantiles of a sample of the one column of `keys`; at least SAMPLED values a split are in it."""
    part = 1 / min(rate, max(1, size // SAMPLED))
    got = [r[0] for r in keys.where(F.col(keys.columns[0]).isNotNull()).sample(part, seed).orderBy(keys.columns[0]).collect()]
    each = max(1, round(size * part))
    return sorted(set(got[each::each]))


def walked(after: Callable[[object, int, bool], object], size: int) -> list:
    """Points that `after(last, n, past)` gives in the database's order: the value n rows after the first `last`, or, with `past`, after the last; None at the end.

    A value of more than `size` rows is followed by the next one.
    """
    found: list = []
    at = after(None, size, False)
    while at is not None:
        found.append(at)
        following = after(at, size, False)
        at = after(at, 0, True) if following == at else following
    return found


def literal(value) -> str:
    """A value in a statement; dates and times as JDBC escapes, which every driver reads."""
    if isinstance(value, dt.datetime):
        return f"{{ts '{value:%Y-%m-%d %H:%M:%S.%f}'}}"
    if isinstance(value, dt.date):
        return f"{{d '{value.isoformat()}'}}"
    return str(value) if isinstance(value, (int, float, decimal.Decimal)) else "'" + str(value).replace("'", "''") + "'"


def predicates(column: str, points: list) -> list[str]:
    """Conditions of the ranges between the points: each row, also one without a key, meets one of them."""
    if not points:
        return ["1 = 1"]
    ends = list(map(literal, points))
    first = f"({column} < {ends[0]} OR {column} IS NULL)"
    return [first, *[f"{column} >= {a} AND {column} < {b}" for a, b in zip(ends, ends[1:], strict=False)], f"{column} >= {ends[-1]}"]


def divisible(kind: T.DataType) -> bool:
    return isinstance(kind, (T.IntegralType, T.DecimalType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType))


def points(spark: SparkSession, made: dict[str, str], column: str, kind: T.DataType, options: dict, offset: Callable[[str, int], str]) -> list:
    """Split points of a column of what the JDBC options `made` name; `offset(query, n)` is a query's row after n."""
    ask = lambda query: spark.read.format("jdbc").options(**{**made, "dbtable": f"({query}) b"}).load()
    size = int(options.get("split.size", SIZE))
    low, high, n = ask(f"SELECT MIN({column}) AS lo, MAX({column}) AS hi, COUNT(*) AS n FROM {made['dbtable']}").first()
    if low is None or n <= size or low == high:
        return []
    threshold = int(options.get("split.sample-sharding.threshold", THRESHOLD))
    if isinstance(kind, T.StringType):
        size = max(size, -(-n // threshold))

        def after(last, rows: int, past: bool):
            where = f" WHERE {column} IS NOT NULL" if last is None else f" WHERE {column} {'>' if past else '>='} {literal(last)}"
            row = ask(offset(f"SELECT {column} AS k FROM {made['dbtable']}{where} ORDER BY {column}", rows)).first()
            return row[0] if row else None

        return walked(after, size)
    lower, upper = float(options.get("split.even-distribution.factor.lower-bound", LOWER)), float(options.get("split.even-distribution.factor.upper-bound", UPPER))
    found = even(low, high, n, size, lower, upper)
    if found and len(found) > 1:
        probes = found[:: -(-len(found) // PROBES)]
        sums = ", ".join(f"SUM(CASE WHEN {column} < {literal(p)} THEN 1 ELSE 0 END) AS c{i}" for i, p in enumerate(probes))
        below = [0, *map(int, ask(f"SELECT {sums} FROM {made['dbtable']}").first()), n]
        share = n * (-(-len(found) // PROBES)) / (len(found) + 1)
        if max(b - a for a, b in zip(below, below[1:], strict=False)) > 2 * share:
            found = None
    if found is None:
        found = sampled(ask(f"SELECT {column} AS k FROM {made['dbtable']}"), n, size, int(options.get("split.inverse-sampling.rate", RATE)))
    most = int(options.get("partition_num", 1 << 14))
    return found if len(found) < most else found[:: -(-(len(found) + 1) // most)][1:]
