"""Splits of skewed, sparse and text keys hold about as many rows each, and every row once."""

from __future__ import annotations

import datetime as dt
import random
import uuid
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.plans import job
from weftline.sources import jdbc, splits

DERBY = "org.apache.derby.iapi.jdbc.AutoloadedDriver"
N, SIZE = 3000, 250


def keys(kind):
    rng = random.Random(4)
    return {
        "even": [i * 3 for i in range(N)],
        "skewed": [int(1.004**i * 1000) + i for i in range(N)],
        "sparse": [rng.randrange(1 << 60) for _ in range(N)],
        "text": ["".join(rng.choice("abcXYZ'") for _ in range(rng.randrange(3, 12))) for _ in range(N)],
        "date": [(dt.date(1970, 1, 1) + dt.timedelta(days=int(rng.expovariate(0.001)))).isoformat() for _ in range(N)],
        "decimal": [Decimal(rng.randrange(1, 10**6) ** 2) / 4 for _ in range(N)],
    }[kind]


@pytest.mark.parametrize("kind", ["even", "skewed", "sparse", "text", "date", "decimal"])
def test_sizes(spark, kind):
    sql = {"text": "string", "date": "date", "decimal": "decimal(20,2)"}.get(kind, "bigint")
    values = keys(kind)
    df = spark.createDataFrame([(str(v) if v is not None else None, i) for i, v in enumerate([*values, *([] if kind == "text" else [None])])], "k string, i long").select(F.col("k").cast(sql).alias("k"), "i")
    options = {"url": f"jdbc:derby:memory:s{uuid.uuid4().hex};create=true", "driver": DERBY}
    df.write.format("jdbc").options(**options, dbtable="t", createTableColumnTypes="`k` VARCHAR(20)" if kind == "text" else "`i` BIGINT").save()
    read = jdbc.read(spark, {**options, "table_path": "t", "partition_column": "K", "split.size": SIZE})
    got = read.select(F.col("i").alias("I"), F.spark_partition_id().alias("p")).collect()
    assert sorted(r.I for r in got) == list(range(N + (kind != "text")))
    sizes = [sum(r.p == p for r in got) for p in {r.p for r in got}]
    assert N / SIZE / 2 <= len(sizes) <= 2 * N / SIZE and max(sizes) <= 2 * SIZE, sizes


def test_a_heavy_text_and_a_limit_of_walks(spark):
    values = sorted(["a"] * 500 + ["b"] * 10 + ["c"] * 300 + ["d", "e"])

    def after(last, n, past):
        left = [v for v in values if last is None or v > last or (v == last and not past)]
        return left[n] if n < len(left) else None

    assert splits.walked(after, 100) == ["a", "b", "c", "d"]
    assert splits.walked(lambda *_: None, 5) == []


def test_points_and_conditions():
    assert splits.even(0, 99, 100, 30) == [30, 60, 90] and splits.even(1, 10**9, 100, 10) is None and splits.even(5, 5, 1000, 10) is None
    assert splits.even(dt.date(2020, 1, 1), dt.date(2020, 1, 10), 10, 4) == [dt.date(2020, 1, 5), dt.date(2020, 1, 9)]
    assert len(splits.even(dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 1, 0, 10), 600, 100)) == 5
    assert splits.predicates("k", ["a'b", "c"]) == ["(k < 'a''b' OR k IS NULL)", "k >= 'a''b' AND k < 'c'", "k >= 'c'"]
    assert splits.predicates("k", []) == ["1 = 1"]
    assert splits.literal(dt.datetime(2020, 1, 2, 3, 4, 5)) == "{ts '2020-01-02 03:04:05.000000'}" and splits.literal(Decimal("1.5")) == "1.5"
    assert splits.divisible(T.StringType()) and not splits.divisible(T.BinaryType())


def test_tables_by_a_pattern(spark):
    options = {"url": f"jdbc:derby:memory:s{uuid.uuid4().hex};create=true", "driver": DERBY}
    for name in ("part_1", "part_2", "other"):
        spark.range(3).write.format("jdbc").options(**options, dbtable=name).save()
    now = job.run_job(spark, {"source": [{"plugin_name": "Jdbc", **options, "table_pattern": "(?i)(app\\.)?part_.*", "plugin_output": "x"}], "sink": [{"plugin_name": "Console"}]})
    assert [p.split(".")[-1].lower() for p in now.datasets["x"]] == ["part_1", "part_2"] and all(df.count() == 3 for df in now.datasets["x"].values())
    with pytest.raises(job.JobError, match="no table matches"):
        job.run_job(spark, {"source": [{"plugin_name": "Jdbc", **options, "table_pattern": "nothing"}], "sink": [{"plugin_name": "Console"}]})
