"""Named queries over the test tables, with their SQL."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.functions.datetimes import parse_time
from weftline.operators import transforms as tr
from weftline.plans.sql import sql
from weftline.sources import buckets, capture, cdc, changes, formats, jdbc, shared
from weftline.streaming import evolving

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sql(name: str, source: str, query: str, oracle: str) -> None:
    QUERIES[name] = lambda spark, d: sql(table(spark, d, source), query)
    ORACLES[name] = oracle


def _add(name: str, build: Query, oracle: str | None) -> None:
    QUERIES[name] = build
    if oracle:
        ORACLES[name] = oracle


# Relational operators and predicates
_sql("sql_project_filter", "orders", "SELECT o_orderkey, CONCAT(o_orderpriority,'_',o_orderstatus) AS tag, o_custkey+1 AS k FROM dual WHERE o_totalprice > 100000", "SELECT o_orderkey, concat(o_orderpriority,'_',o_orderstatus) AS tag, o_custkey+1 AS k FROM orders WHERE o_totalprice > 100000")
_sql("sql_star_plus_expr", "nation", "SELECT *, n_nationkey * 2 AS twice FROM nation", "SELECT *, CAST(n_nationkey * 2 AS INTEGER) AS twice FROM nation")
_sql("sql_case_searched", "lineitem", "SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity > 40 THEN 'high' WHEN l_quantity > 20 THEN 'mid' ELSE 'low' END AS band FROM t", "SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity > 40 THEN 'high' WHEN l_quantity > 20 THEN 'mid' ELSE 'low' END AS band FROM lineitem")
_sql("sql_case_simple", "orders", "SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'F' THEN 2 ELSE 3000000000 END AS code FROM t", "SELECT o_orderkey, CAST(CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'F' THEN 2 ELSE 3000000000 END AS BIGINT) AS code FROM orders")
_sql("sql_cast_all", "part", "SELECT p_partkey, CAST(p_size AS STRING) AS s, CAST(p_size AS BIGINT) AS b, CAST(p_size AS DOUBLE) AS d, CAST(p_partkey AS INT) AS i, CAST('2024-02-03' AS DATE) AS dt, CAST('2024-02-03 04:05:06' AS TIMESTAMP) AS ts FROM t", "SELECT p_partkey, CAST(p_size AS VARCHAR) AS s, CAST(p_size AS BIGINT) AS b, CAST(p_size AS DOUBLE) AS d, CAST(p_partkey AS INTEGER) AS i, DATE '2024-02-03' AS dt, TIMESTAMP '2024-02-03 04:05:06' AS ts FROM part")
_sql("sql_cast_decimal", "part", "SELECT p_partkey, CAST(p_retailprice AS DECIMAL(12, 2)) AS price FROM t", "SELECT p_partkey, CAST(p_retailprice AS DECIMAL(12,2)) AS price FROM part")
_sql("sql_arith_int_div", "part", "SELECT p_partkey, p_size / 7 AS q, p_size % 7 AS r, p_size * 3 - 1 AS x FROM t", "SELECT p_partkey, CAST(p_size // 7 AS INTEGER) AS q, CAST(p_size % 7 AS INTEGER) AS r, CAST(p_size * 3 - 1 AS INTEGER) AS x FROM part")
_sql("sql_arith_double", "lineitem", "SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS net FROM t", "SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS net FROM lineitem")
_sql("sql_neq_null", "orders", "SELECT o_orderkey FROM t WHERE NULLIF(o_orderstatus, 'O') <> 'F'", "SELECT o_orderkey FROM orders WHERE nullif(o_orderstatus, 'O') IS DISTINCT FROM 'F'")
_sql("sql_in_list", "orders", "SELECT o_orderkey FROM t WHERE o_orderstatus IN ('O', 'P') AND o_custkey NOT IN (1, 2, 3)", "SELECT o_orderkey FROM orders WHERE o_orderstatus IN ('O','P') AND o_custkey NOT IN (1,2,3)")
_sql("sql_not_in_null", "orders", "SELECT o_orderkey FROM t WHERE NULLIF(o_orderstatus, 'O') NOT IN (NULL, 'F')", "SELECT o_orderkey FROM orders WHERE CASE WHEN o_orderstatus = 'O' THEN true ELSE o_orderstatus <> 'F' END")
_sql("sql_like_prefix", "part", "SELECT p_partkey, p_name FROM t WHERE p_type LIKE 'S%'", "SELECT p_partkey, p_name FROM part WHERE p_type LIKE 'S%'")
_sql("sql_like_suffix", "part", "SELECT p_partkey FROM t WHERE p_type NOT LIKE '%L'", "SELECT p_partkey FROM part WHERE p_type NOT LIKE '%L'")
_sql("sql_like_underscore", "orders", "SELECT o_orderkey FROM t WHERE o_orderpriority LIKE '_-%'", "SELECT o_orderkey FROM orders WHERE o_orderpriority LIKE '_-%'")
_sql("sql_is_null", "orders", "SELECT o_orderkey FROM t WHERE NULLIF(o_orderstatus, 'O') IS NULL OR (o_custkey = 1 AND o_orderstatus IS NOT NULL)", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O' OR o_custkey = 1")
_sql("sql_boolean_function", "customer", "SELECT c_custkey FROM t WHERE REGEXP_LIKE(c_mktsegment, 'BUILD|auto', 'i')", "SELECT c_custkey FROM customer WHERE regexp_matches(c_mktsegment, '(?i)BUILD|auto')")
_sql("sql_concat_operator", "orders", "SELECT o_orderkey, o_orderstatus || '-' || NULLIF(o_orderpriority, '1-URGENT') AS tag FROM t", "SELECT o_orderkey, concat(o_orderstatus, '-', nullif(o_orderpriority, '1-URGENT')) AS tag FROM orders")
_sql("sql_unary_minus", "customer", "SELECT c_custkey, -c_acctbal AS minus FROM t WHERE -c_acctbal < 0", "SELECT c_custkey, -c_acctbal AS minus FROM customer WHERE -c_acctbal < 0")
_sql("sql_explode_split", "orders", "SELECT o_orderkey, SPLIT(o_orderpriority, '-') AS parts FROM t LATERAL VIEW EXPLODE(parts) AS part", "SELECT o_orderkey, string_split(o_orderpriority, '-') AS parts, unnest(string_split(o_orderpriority, '-')) AS part FROM orders")
QUERIES["sql_explode_split"] = lambda spark, d: sql(table(spark, d, "orders"), "SELECT o_orderkey, SPLIT(o_orderpriority, '-') AS parts FROM t LATERAL VIEW EXPLODE(parts) AS part").drop("parts")
ORACLES["sql_explode_split"] = "SELECT o_orderkey, unnest(string_split(o_orderpriority, '-')) AS part FROM orders"
_add("sql_explode_outer", lambda spark, d: sql(table(spark, d, "orders"), "SELECT o_orderkey, o_orderstatus, ARRAY(NULLIF(o_orderstatus, 'O'), o_orderpriority) AS a FROM t LATERAL VIEW OUTER EXPLODE(a) AS e").drop("a"), "SELECT o_orderkey, o_orderstatus, unnest([nullif(o_orderstatus,'O'), o_orderpriority]) AS e FROM orders")
_add("sql_explode_drop_null", lambda spark, d: sql(table(spark, d, "orders"), "SELECT o_orderkey, o_orderstatus, ARRAY(NULLIF(o_orderstatus, 'O'), o_orderpriority) AS a FROM t LATERAL VIEW EXPLODE(a) AS e").drop("a"), "SELECT * FROM (SELECT o_orderkey, o_orderstatus, unnest([nullif(o_orderstatus,'O'), o_orderpriority]) AS e FROM orders) WHERE e IS NOT NULL")
_add("sql_map_access", lambda spark, d: sql(table(spark, d, "nation").withColumn("m", F.create_map(F.lit("k"), F.col("n_name"))), "SELECT n_nationkey, m.k AS v, m.missing AS w FROM t"), "SELECT n_nationkey, n_name AS v, CAST(NULL AS VARCHAR) AS w FROM nation")
_add("sql_struct_access", lambda spark, d: sql(table(spark, d, "nation").withColumn("s", F.struct(F.struct(F.col("n_name").alias("name")).alias("inner"))), "SELECT n_nationkey, s.inner.name AS v FROM t WHERE s.inner.name LIKE 'NATION_1%'"), "SELECT n_nationkey, n_name AS v FROM nation WHERE n_name LIKE 'NATION!_1%' ESCAPE '!'")
_add("sql_decimal_division", lambda spark, d: sql(table(spark, d, "part").withColumn("p", F.col("p_retailprice").cast("decimal(12,2)")), "SELECT p_partkey, p / p_size AS q FROM t"), "SELECT p_partkey, CAST(sign(x) * ceil(abs(x) * 100) / 100 AS DECIMAL(12,2)) AS q FROM (SELECT p_partkey, CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS DOUBLE) / p_size AS x FROM part)")

_sql("sql_like_raw_regex", "customer", "SELECT c_custkey FROM t WHERE c_name LIKE '%#0+1[0-5]'", "SELECT c_custkey FROM customer WHERE regexp_full_match(c_name, '.*#0+1[0-5]')")
_sql("sql_like_column", "part", "SELECT p_partkey FROM t WHERE p_name LIKE CONCAT(LEFT(p_type, 0), 's%') AND p_brand NOT LIKE CONCAT('%', RIGHT(p_name, 1))", "SELECT p_partkey FROM part WHERE p_name LIKE 's%' AND NOT ends_with(p_brand, right(p_name, 1))")
_sql("sql_like_two_underscores", "orders", "SELECT o_orderkey FROM t WHERE o_orderpriority LIKE '__-%' OR o_orderpriority LIKE '_-%T'", "SELECT o_orderkey FROM orders WHERE regexp_full_match(o_orderpriority, '._-.*') OR regexp_full_match(o_orderpriority, '.-%T')")
_sql("sql_like_second_underscore", "orders", "SELECT o_orderkey, o_orderpriority FROM t WHERE o_orderpriority LIKE '__URGENT' OR o_orderpriority LIKE '_-HIG_'", "SELECT o_orderkey, o_orderpriority FROM orders WHERE regexp_full_match(o_orderpriority, '._URGENT') OR regexp_full_match(o_orderpriority, '.-HIG.')")
_sql("sql_double_by_zero", "part", "SELECT p_partkey, CAST(p_retailprice / (p_size - p_size) AS STRING) AS q, CAST(-p_retailprice / (p_retailprice - p_retailprice) AS STRING) AS r FROM t", "SELECT p_partkey, 'Infinity' AS q, '-Infinity' AS r FROM part")
_sql("sql_null_arithmetic", "orders", "SELECT o_orderkey, NULLIF(o_custkey, 1) + 1 AS a, 2.5 * NULLIF(o_totalprice, 0) AS b FROM t WHERE NULLIF(o_custkey, 1) + 1 IS NULL OR o_custkey < 50", "SELECT o_orderkey, nullif(o_custkey, 1) + 1 AS a, 2.5::DOUBLE * nullif(o_totalprice, 0) AS b FROM orders WHERE o_custkey < 50")
_sql("sql_equal_across_classes", "orders", "SELECT o_orderkey FROM t WHERE o_orderstatus = 1 OR o_orderpriority <> 5", "SELECT o_orderkey FROM orders WHERE o_orderpriority IS NOT NULL")
QUERIES["sql_column_case"] = lambda spark, d: sql(table(spark, d, "nation").withColumnRenamed("n_name", "N_Name"), "SELECT `N_Name` AS a, LoWer(N_Name) AS b FROM t WHERE n_nationkey > 3")
ORACLES["sql_column_case"] = "SELECT n_name AS a, lower(n_name) AS b FROM nation WHERE n_nationkey > 3"

_codes = "regexp_replace(translate(upper(c_mktsegment), 'AEIOUYBFPVCGJKQSXZDTLMNR', '000000111122222222334556'), '[HW]', '', 'g')"
for _d in "0123456":
    _codes = f"regexp_replace({_codes}, '{_d}+', '{_d}', 'g')"
_SOUNDEX = f"left(c_mktsegment, 1) || rpad(left(replace(substr({_codes}, 2), '0', ''), 3), 3, '0')"

# Scalar functions: (name, table, key, expression here, expression in the oracle)
_O, _P, _C, _L, _E = ("orders", "o_orderkey"), ("part", "p_partkey"), ("customer", "c_custkey"), ("lineitem", "l_orderkey, l_linenumber"), ("events", "event_id")
_FUNCTIONS = [
    ("ascii", _C, "ASCII(c_name)", "CAST(ascii(c_name) AS INTEGER)"),
    ("bit_length", _C, "BIT_LENGTH(c_name)", "CAST(bit_length(c_name) AS BIGINT)"),
    ("char_length", _C, "CHAR_LENGTH(c_name)", "CAST(length(c_name) AS BIGINT)"),
    ("octet_length", _C, "OCTET_LENGTH(c_name)", "CAST(strlen(c_name) AS BIGINT)"),
    ("chr", _P, "CHR(p_size + 8300)", "chr(p_size + 8300)"),
    ("concat", _O, "CONCAT(o_orderstatus, NULLIF(o_orderpriority, '5-LOW'), 'x')", "concat(o_orderstatus, nullif(o_orderpriority, '5-LOW'), 'x')"),
    ("concat_ws", _O, "CONCAT_WS('/', o_orderstatus, NULLIF(o_orderpriority, '5-LOW'))", "concat_ws('/', o_orderstatus, nullif(o_orderpriority, '5-LOW'))"),
    ("hextoraw", _C, "HEXTORAW(RAWTOHEX(c_name))", "c_name"),
    ("rawtohex", _C, "RAWTOHEX(c_mktsegment)", "(SELECT string_agg('00' || hex(x), '' ORDER BY i) FROM (SELECT unnest(string_split(c_mktsegment, '')) AS x, generate_subscripts(string_split(c_mktsegment, ''), 1) AS i))"),
    ("insert", _C, "INSERT(c_name, 2, 3, '##')", "substr(c_name, 1, 1) || '##' || substr(c_name, 5)"),
    ("lower", _C, "LOWER(c_mktsegment)", "lower(c_mktsegment)"),
    ("upper", _C, "UCASE(c_name)", "upper(c_name)"),
    ("left", _C, "LEFT(c_name, 4)", "left(c_name, 4)"),
    ("right", _C, "RIGHT(c_name, 4)", "right(c_name, 4)"),
    ("locate", _C, "LOCATE('0', c_name)", "CAST(instr(c_name, '0') AS INTEGER)"),
    ("locate_back", _C, "LOCATE('0', c_name, -1)", "CAST(CASE WHEN instr(reverse(c_name), '0') = 0 THEN 0 ELSE length(c_name) - instr(reverse(c_name), '0') + 1 END AS INTEGER)"),
    ("instr", _C, "INSTR(c_mktsegment, 'I')", "CAST(instr(c_mktsegment, 'I') AS INTEGER)"),
    ("lpad", _P, "LPAD(p_brand, 12, '*')", "lpad(p_brand, 12, '*')"),
    ("rpad", _P, "RPAD(p_brand, 12, '*')", "rpad(p_brand, 12, '*')"),
    ("ltrim", _P, "LTRIM(p_brand, 'B')", "ltrim(p_brand, 'B')"),
    ("rtrim", _P, "RTRIM(p_brand, '1')", "rtrim(p_brand, '1')"),
    ("trim", _P, "TRIM(CONCAT('  ', p_brand, ' '))", "trim('  ' || p_brand || ' ')"),
    ("regexp_replace", _O, "REGEXP_REPLACE(o_orderpriority, '[0-9]-', 'p')", "regexp_replace(o_orderpriority, '[0-9]-', 'p', 'g')"),
    ("regexp_like", _O, "REGEXP_LIKE(o_orderpriority, 'high', 'i')", "regexp_matches(o_orderpriority, '(?i)high')"),
    ("regexp_substr", _O, "REGEXP_SUBSTR(o_orderpriority, '[A-Z]+')", "nullif(regexp_extract(o_orderpriority, '[A-Z]+'), '')"),
    ("repeat", _O, "REPEAT(o_orderstatus, 3)", "repeat(o_orderstatus, 3)"),
    ("replace", _C, "REPLACE(c_name, '0', 'o')", "replace(c_name, '0', 'o')"),
    ("space", _P, "CONCAT('a', SPACE(p_size), 'b')", "'a' || repeat(' ', p_size) || 'b'"),
    ("substring", _C, "SUBSTRING(c_name, 3, 5)", "substr(c_name, 3, 5)"),
    ("substring_negative", _C, "SUBSTR(c_name, -4)", "right(c_name, 4)"),
    ("to_char", _O, "TO_CHAR(o_orderdate, 'yyyy/MM/dd')", "strftime(o_orderdate, '%Y/%m/%d')"),
    ("translate", _C, "TRANSLATE(c_name, '0123', 'abcd')", "translate(c_name, '0123', 'abcd')"),
    ("abs", _C, "ABS(c_acctbal)", "abs(c_acctbal)"),
    ("mod", _P, "MOD(p_partkey, 7)", "CAST(p_partkey % 7 AS INTEGER)"),
    ("ceil", _C, "CEIL(c_acctbal)", "CAST(ceil(c_acctbal) AS INTEGER)"),
    ("floor", _C, "FLOOR(c_acctbal)", "CAST(floor(c_acctbal) AS INTEGER)"),
    ("pi", _P, "ROUND(PI() * p_size, 6)", "round(pi() * p_size, 6)"),
    ("sqrt", _P, "SQRT(p_size)", "sqrt(p_size)"),
    ("round", _C, "ROUND(c_acctbal)", "round(c_acctbal)"),
    ("sign", _C, "SIGN(c_acctbal)", "CAST(sign(c_acctbal) AS INTEGER)"),
    ("trunc", _C, "TRUNC(c_acctbal)", "trunc(c_acctbal)"),
    ("array_max", _P, "ARRAY_MAX(ARRAY(p_size, 7, 30))", "greatest(p_size, 7, 30)"),
    ("array_min", _P, "ARRAY_MIN(ARRAY(p_size, 7, 30))", "least(p_size, 7, 30)"),
    ("dateadd", _O, "DATEADD(o_orderdate, 3, 'MONTH')", "o_orderdate + INTERVAL 3 MONTH"),
    ("datediff_day", _O, "DATEDIFF(CAST('1995-01-31' AS DATE), o_orderdate, 'DAY')", "date_diff('day', DATE '1995-01-31', CAST(o_orderdate AS DATE))"),
    ("datediff_month", _O, "DATEDIFF(CAST('1995-01-31' AS DATE), o_orderdate, 'MONTH')", "date_diff('month', DATE '1995-01-31', CAST(o_orderdate AS DATE))"),
    ("datediff_hour", _E, "DATEDIFF(CAST('2024-01-01 00:30:00' AS TIMESTAMP), ts, 'HOUR')", "date_diff('hour', TIMESTAMP '2024-01-01 00:30:00', ts)"),
    ("date_trunc", _E, "DATE_TRUNC(ts, 'HOUR')", "CAST(date_trunc('hour', ts) AS TIMESTAMP)"),
    ("dayname", _O, "DAYNAME(o_orderdate)", "dayname(o_orderdate)"),
    ("monthname", _O, "MONTHNAME(o_orderdate)", "monthname(o_orderdate)"),
    ("day_of_month", _O, "DAY_OF_MONTH(o_orderdate)", "CAST(day(o_orderdate) AS INTEGER)"),
    ("day_of_week", _O, "DAY_OF_WEEK(o_orderdate)", "CAST(isodow(o_orderdate) AS INTEGER)"),
    ("day_of_year", _O, "DAY_OF_YEAR(o_orderdate)", "CAST(dayofyear(o_orderdate) AS INTEGER)"),
    ("extract", _E, "EXTRACT(MINUTE FROM ts)", "CAST(extract(minute FROM ts) AS INTEGER)"),
    ("extract_epoch", _O, "EXTRACT(EPOCH FROM o_orderdate)", "CAST(epoch(o_orderdate) AS INTEGER)"),
    ("formatdatetime", _E, "FORMATDATETIME(ts, 'yyyy-MM-dd HH:mm')", "strftime(ts, '%Y-%m-%d %H:%M')"),
    ("hour", _E, "HOUR(ts)", "CAST(hour(ts) AS INTEGER)"),
    ("minute", _E, "MINUTE(ts)", "CAST(minute(ts) AS INTEGER)"),
    ("second", _E, "SECOND(ts)", "CAST(second(ts) AS INTEGER)"),
    ("month", _O, "MONTH(o_orderdate)", "CAST(month(o_orderdate) AS INTEGER)"),
    ("quarter", _O, "QUARTER(o_orderdate)", "CAST(quarter(o_orderdate) AS INTEGER)"),
    ("week", _O, "WEEK(o_orderdate)", "CAST(week(o_orderdate) AS INTEGER)"),
    ("year", _O, "YEAR(o_orderdate)", "CAST(year(o_orderdate) AS INTEGER)"),
    ("is_date", _O, "IS_DATE(CASE WHEN o_orderstatus = 'O' THEN FORMATDATETIME(o_orderdate, 'yyyy-MM-dd') ELSE o_orderpriority END, 'yyyy-MM-dd')", "o_orderstatus = 'O'"),
    ("hextoraw_literal", _C, "HEXTORAW('004100E90042')", "'A\u00e9B'"),
    ("dateadd_day", _O, "DATEADD(o_orderdate, -40, 'DAY')", "o_orderdate - INTERVAL 40 DAY"),
    ("dateadd_year", _O, "TIMESTAMPADD(o_orderdate, 2, 'YEAR')", "o_orderdate + INTERVAL 2 YEAR"),
    ("dateadd_hour", _E, "DATEADD(ts, 30, 'HOUR')", "ts + INTERVAL 30 HOUR"),
    ("soundex", _C, "SOUNDEX(c_mktsegment)", _SOUNDEX),
    ("rand_range", _C, "FLOOR(RAND(3))", "0"),
    ("uuid_length", _C, "CHAR_LENGTH(UUID())", "CAST(36 AS BIGINT)"),
    ("current_year", _C, "YEAR(CURRENT_DATE) - YEAR(NOW())", "0"),
    ("current_once", _C, "DATEDIFF(CURRENT_TIMESTAMP, NOW(), 'SECOND')", "CAST(0 AS BIGINT)"),
    ("current_time", _C, "CASE WHEN CHAR_LENGTH(CAST(CURRENT_TIME AS STRING)) >= 5 THEN 1 ELSE 0 END", "1"),
    ("parsedatetime", _O, "PARSEDATETIME(FORMATDATETIME(o_orderdate, 'yyyy-MM-dd HH:mm:ss'), 'yyyy-MM-dd HH:mm:ss')", "CAST(date_trunc('second', o_orderdate) AS TIMESTAMP)"),
    ("to_date", _O, "TO_DATE(FORMATDATETIME(o_orderdate, 'yyyy-MM-dd'), 'yyyy-MM-dd')", "CAST(o_orderdate AS DATE)"),
    ("from_unixtime", _P, "FROM_UNIXTIME(p_partkey * 1000, 'yyyy-MM-dd HH:mm:ss', 'UTC+6')", "strftime(to_timestamp(p_partkey * 1000 + 21600) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S')"),
    ("coalesce", _O, "COALESCE(NULLIF(o_orderstatus, 'O'), o_orderpriority)", "coalesce(nullif(o_orderstatus, 'O'), o_orderpriority)"),
    ("ifnull", _O, "IFNULL(NULLIF(o_orderstatus, 'O'), 'none')", "ifnull(nullif(o_orderstatus, 'O'), 'none')"),
    ("nullif", _O, "NULLIF(o_orderstatus, 'O')", "nullif(o_orderstatus, 'O')"),
]
for _f in "acos asin atan cos cosh cot sin sinh tan tanh exp".split():
    _FUNCTIONS.append((_f, _L, f"ROUND({_f.upper()}(l_discount + 0.01), 9)", f"round({_f}(l_discount + 0.01), 9)"))
for _f in "ln log10 radians".split():
    _FUNCTIONS.append((_f, _P, f"ROUND({_f.upper()}(p_retailprice), 9)", f"round({_f}(p_retailprice), 9)"))
_FUNCTIONS += [
    ("log", _P, "ROUND(LOG(2, p_retailprice), 9)", "round(log2(p_retailprice), 9)"),
    ("power", _P, "POWER(p_size, 2)", "power(CAST(p_size AS DOUBLE), 2)"),
    ("atan2", _L, "ROUND(ATAN2(l_discount, l_quantity), 9)", "round(atan2(l_discount, l_quantity), 9)"),
]
for _n, (_t, _k), _ours, _theirs in _FUNCTIONS:
    _sql(f"fn_{_n}", _t, f"SELECT {_k}, {_ours} AS v FROM t", f"SELECT {_k}, {_theirs} AS v FROM {_t}")
# Random, or of the moment: rows only.
QUERIES["fn_rand_uuid"] = lambda spark, d: sql(table(spark, d, "nation"), "SELECT n_nationkey, RAND(1) AS r, UUID() AS u FROM t")
QUERIES["fn_current"] = lambda spark, d: sql(table(spark, d, "nation"), "SELECT n_nationkey, CURRENT_DATE AS d, CURRENT_TIMESTAMP() AS ts, NOW() AS n FROM t")

def _named(tables: dict[str, DataFrame]) -> DataFrame:
    """All tables' rows with the path of their table."""
    frames = [df.select("n_nationkey", "n_name", F.lit(path).alias("path")) for path, df in tables.items()]
    return frames[0].unionByName(frames[1])


# Transforms
_add("t_field_mapper", lambda s, d: tr.field_mapper(table(s, d, "nation"), {"n_name": "name", "n_nationkey": "id"}), "SELECT n_name AS name, n_nationkey AS id FROM nation")
_add("t_filter_include", lambda s, d: tr.filter_fields(table(s, d, "orders"), include_fields=["o_orderkey", "o_orderstatus"]), "SELECT o_orderkey, o_orderstatus FROM orders")
_add("t_filter_exclude", lambda s, d: tr.filter_fields(table(s, d, "nation"), exclude_fields=["n_regionkey"]), "SELECT n_nationkey, n_name FROM nation")
_add("t_replace_literal", lambda s, d: tr.replace(table(s, d, "nation"), "n_name", "A", "[.]"), "SELECT n_nationkey, replace(n_name, 'A', '[.]') AS n_name, n_regionkey FROM nation")
_add("t_replace_regex", lambda s, d: tr.replace(table(s, d, "nation"), "n_name", "[AEIOU]", "_", is_regex=True), "SELECT n_nationkey, regexp_replace(n_name, '[AEIOU]', '_', 'g') AS n_name, n_regionkey FROM nation")
_add("t_replace_first", lambda s, d: tr.replace(table(s, d, "nation"), "n_name", "[AEIOU]", "_", is_regex=True, replace_first=True), "SELECT n_nationkey, regexp_replace(n_name, '[AEIOU]', '_') AS n_name, n_regionkey FROM nation")
_add("t_split", lambda s, d: tr.split(table(s, d, "part").select("p_partkey", "p_name"), " ", "p_name", ["a", "b"]), "SELECT p_partkey, p_name, split_part(p_name, ' ', 1) AS a, CASE WHEN instr(p_name, ' ') > 0 THEN substr(p_name, instr(p_name, ' ') + 1) END AS b FROM part")
_add("t_copy", lambda s, d: tr.copy(table(s, d, "nation"), {"name2": "n_name", "key2": "n_nationkey"}), "SELECT *, n_name AS name2, n_nationkey AS key2 FROM nation")
_add("t_jsonpath_events", lambda s, d: tr.json_path(table(s, d, "events").select("event_id", "props"), [{"src_field": "props", "path": "$.k", "dest_field": "k", "dest_type": "int"}]), "SELECT event_id, props, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
_add("t_jsonpath_skip_row", lambda s, d: tr.json_path(table(s, d, "events").select("event_id", F.when(F.col("event_id") % 3 == 0, "{}").otherwise(F.col("props")).alias("props")), [{"src_field": "props", "path": "$.k", "dest_field": "k", "dest_type": "int"}], row_error_handle_way="SKIP"), "SELECT event_id, props, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events WHERE event_id % 3 <> 0")
_add("t_field_rename", lambda s, d: tr.field_rename(table(s, d, "nation"), convert_case="UPPER", prefix="x_", specific=[{"field_name": "n_name", "target_name": "label"}]), 'SELECT n_nationkey AS "X_N_NATIONKEY", n_name AS label, n_regionkey AS "X_N_REGIONKEY" FROM nation')
_add("t_table_rename", lambda s, d: _named(tr.table_rename({"db.nation": table(s, d, "nation"), "db.region": table(s, d, "region").select(F.col("r_regionkey").alias("n_nationkey"), F.col("r_name").alias("n_name"))}, prefix="t_", convert_case="UPPER")), "SELECT n_nationkey, n_name, 'db.T_NATION' AS path FROM nation UNION ALL SELECT r_regionkey, r_name, 'db.T_REGION' FROM region")
_add("t_table_merge", lambda s, d: tr.table_merge({"a.x": table(s, d, "nation"), "b.y": table(s, d, "nation")}, "all")["all"], "SELECT * FROM nation UNION ALL SELECT * FROM nation")
_add("t_metadata", lambda s, d: tr.metadata(table(s, d, "nation").withColumns({"_table": F.lit("db.nation"), "_row_kind": F.lit("+I")}), {"Database": "db", "Table": "tbl", "RowKind": "kind"}).drop("_table", "_row_kind"), "SELECT *, 'db' AS db, 'nation' AS tbl, '+I' AS kind FROM nation")


def _times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times of day in texts, a third of them with milliseconds and a third no times."""
    at = F.col("ts").cast("timestamp")
    text = F.when(F.col("event_id") % 3 == 0, F.date_format(at, "HH:mm:ss")).when(F.col("event_id") % 3 == 1, F.date_format(at, "HH:mm:ss.SSS")).otherwise(F.date_format(at, "HH:mm"))
    time = parse_time(text)
    return table(spark, sf_dir, "events").select("event_id", (F.extract(F.lit("HOUR"), time) * 3600000 + F.extract(F.lit("MINUTE"), time) * 60000 + (F.extract(F.lit("SECOND"), time) * 1000).cast("long")).cast("long").alias("ms"))


_add("fn_parse_time", _times, "SELECT event_id, CASE event_id % 3 WHEN 0 THEN CAST(hour(ts) * 3600000 + minute(ts) * 60000 + second(ts) * 1000 AS BIGINT) WHEN 1 THEN CAST(hour(ts) * 3600000 + minute(ts) * 60000 AS BIGINT) + millisecond(ts) END AS ms FROM events")


def changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as changes of a table keyed by user."""
    kind = F.when(F.col("event_type") == "signup", "+I").when(F.col("event_type") == "error", "-D").when(F.col("event_type") == "click", "-U").otherwise("+U")
    return table(spark, sf_dir, "events").withColumn("_row_kind", kind)


_KIND = "CASE event_type WHEN 'signup' THEN '+I' WHEN 'error' THEN '-D' WHEN 'click' THEN '-U' ELSE '+U' END"
_add("t_rowkind_filter", lambda s, d: tr.filter_row_kind(changelog(s, d), exclude_kinds=["DELETE", "-U"]).select("event_id", F.col("_row_kind").alias("kind")), f"SELECT event_id, {_KIND} AS kind FROM events WHERE {_KIND} NOT IN ('-D', '-U')")
_add("t_rowkind_extract", lambda s, d: tr.row_kind_extractor(changelog(s, d), transform_type="FULL").select("event_id", "row_kind", F.col("_row_kind").alias("kind")), "SELECT event_id, CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'error' THEN 'DELETE' WHEN 'click' THEN 'UPDATE_BEFORE' ELSE 'UPDATE_AFTER' END AS row_kind, '+I' AS kind FROM events")


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changelog with both images of each update: they share their time, and a shuffle parts them."""
    rows = changelog(spark, sf_dir).select("user_id", "value", "event_type", "ts", "event_id", "_row_kind")
    update = F.array(F.struct(F.lit("-U").alias("k"), F.lit("before").alias("t"), (-F.col("value")).alias("v")), F.struct(F.lit("+U").alias("k"), F.col("event_type").alias("t"), F.col("value").alias("v")))
    other = F.array(F.struct(F.col("_row_kind").alias("k"), F.col("event_type").alias("t"), F.col("value").alias("v")))
    both = rows.withColumn("i", F.explode(F.when(F.col("_row_kind") == "+U", update).otherwise(other)))
    return both.select("user_id", F.col("i.v").alias("value"), F.col("i.t").alias("event_type"), "ts", "event_id", F.col("i.k").alias("_row_kind")).repartition(8, "_row_kind", "value")


_IMAGES = f"(SELECT user_id, value, event_type, ts, event_id, {_KIND} AS k FROM events UNION ALL SELECT user_id, -value, 'before', ts, event_id, '-U' FROM events WHERE {_KIND} = '+U')"
_add("cdc_collapse", lambda s, d: cdc.collapse(images(s, d), ["user_id"], ["ts", "event_id"]), f"SELECT user_id, value, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC, CASE k WHEN '+U' THEN 4 WHEN '+I' THEN 3 WHEN '-D' THEN 2 ELSE 1 END DESC) AS r FROM {_IMAGES}) WHERE r = 1 AND k NOT IN ('-D', '-U')")

_NATION = T.StructType([T.StructField("n_nationkey", T.IntegerType()), T.StructField("n_name", T.StringType())])


def _debezium(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = lambda name: F.struct("n_nationkey", name.alias("n_name"))
    message = F.struct(F.lit("u").alias("op"), row(F.col("n_name")).alias("before"), row(F.lower("n_name")).alias("after"))
    return cdc.debezium(table(spark, sf_dir, "nation").select(F.to_json(message).alias("value")), _NATION).select("n_nationkey", "n_name", F.col("_row_kind").alias("kind"))


_add("cdc_debezium", _debezium, "SELECT n_nationkey, n_name, '-U' AS kind FROM nation UNION ALL SELECT n_nationkey, lower(n_name), '+U' FROM nation")


def _canal(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = F.struct(F.col("n_nationkey").cast("string").alias("n_nationkey"), F.lower("n_name").alias("n_name"))
    message = F.struct(F.lit("UPDATE").alias("type"), F.lit("db").alias("database"), F.lit("nation").alias("table"), F.array(data).alias("data"), F.array(F.struct("n_name")).alias("old"))
    return cdc.canal(table(spark, sf_dir, "nation").select(F.to_json(message).alias("value")), _NATION, "db", "nation").select("n_nationkey", "n_name", F.col("_row_kind").alias("kind"))


_add("cdc_canal", _canal, ORACLES["cdc_debezium"])


def _maxwell(spark: SparkSession, sf_dir: str) -> DataFrame:
    message = F.struct(F.lit("update").alias("type"), F.struct("n_nationkey", F.lower("n_name").alias("n_name")).alias("data"), F.struct("n_name").alias("old"))
    return cdc.maxwell(table(spark, sf_dir, "nation").select(F.to_json(message).alias("value")), _NATION).select("n_nationkey", "n_name", F.col("_row_kind").alias("kind"))


_add("cdc_maxwell", _maxwell, ORACLES["cdc_debezium"])


def _ogg(spark: SparkSession, sf_dir: str) -> DataFrame:
    message = F.struct(F.lit("db.nation").alias("table"), F.lit("D").alias("op_type"), F.struct("n_nationkey", "n_name").alias("before"))
    return cdc.ogg(table(spark, sf_dir, "nation").select(F.to_json(message).alias("value")), _NATION).select("n_nationkey", "n_name", F.col("_row_kind").alias("kind"))


_add("cdc_ogg", _ogg, "SELECT n_nationkey, n_name, '-D' AS kind FROM nation")


def _round_trip(format: str) -> Query:
    """The changelog as messages and back; images of updates come back as rows taken away and added."""
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType())])

    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        messages = cdc.ENCODERS[format](changelog(spark, sf_dir).select("event_id", "user_id", "event_type", "_row_kind"))
        return cdc.DECODERS[format](messages, schema).select("event_id", "user_id", "event_type", F.col("_row_kind").alias("kind"))

    return build


for _f in cdc.ENCODERS:
    _add(f"cdc_encode_{_f.removesuffix('_json')}", _round_trip(_f), f"SELECT event_id, user_id, event_type, CASE WHEN {_KIND} IN ('-D', '-U') THEN '-D' ELSE '+I' END AS kind FROM events")


def _connect(spark: SparkSession, sf_dir: str) -> DataFrame:
    payload = F.struct("n_nationkey", "n_name")
    enveloped = F.to_json(F.struct(F.struct(F.lit("struct").alias("type")).alias("schema"), payload.alias("payload")))
    text = F.when(F.col("n_nationkey") % 2 == 0, enveloped).otherwise(F.to_json(payload))
    return cdc.kafka_connect(table(spark, sf_dir, "nation").select(text.alias("value")), _NATION).select("n_nationkey", "n_name")


_add("cdc_kafka_connect", _connect, "SELECT n_nationkey, n_name FROM nation")


# Written and read back
def _folder(spark: SparkSession) -> str:
    return shared.folder(spark, "catalogue")


def _two_batches(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The changelog of users in two batches, one after the other in time; rows without a time come first."""
    rows = images(spark, sf_dir)
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    early = F.coalesce(at <= F.lit(rows.agg(F.percentile_approx(at, 0.5)).first()[0]), F.lit(True))
    return [rows.filter(early), rows.filter(~early)]


def _upsert_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _folder(spark)
    for batch in _two_batches(spark, sf_dir):
        changes.upsert_files(batch, path, ["user_id"], order=["ts", "event_id"])
    return spark.read.parquet(path).select("user_id", "value", "event_type")


def _upsert_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _folder(spark)
    for i, batch in enumerate(_two_batches(spark, sf_dir)):
        for _ in range(2):  # a batch that is given again is passed over
            buckets.upsert(batch, path, ["user_id"], ["ts", "event_id"], writer="q", batch=i)
    return buckets.read(spark, path).select("user_id", "value", "event_type")


def _upsert_jdbc(spark: SparkSession, sf_dir: str) -> DataFrame:
    options = {"url": f"jdbc:derby:memory:c{uuid.uuid4().hex};create=true", "driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver", "primary_keys": ["user_id"], "order_by": ["ts", "event_id"], "table_path": "users"}
    for batch in _two_batches(spark, sf_dir):
        jdbc.prepare(batch, options, "users")
        jdbc.write(batch, options, "users")
    return jdbc.read(spark, options).select("user_id", "value", "event_type")


_add("cdc_upsert_files", _upsert_files, ORACLES["cdc_collapse"])
_add("cdc_upsert_buckets", _upsert_buckets, ORACLES["cdc_collapse"])
_add("cdc_upsert_jdbc", _upsert_jdbc, ORACLES["cdc_collapse"])


# Tables and their logs
_USER = T.StructType([T.StructField("user_id", T.LongType()), T.StructField("value", T.DoubleType()), T.StructField("event_type", T.StringType())])


def _log(spark: SparkSession, sf_dir: str, path: str, low: int, high: int) -> None:
    """Appends the events with low < event_id <= high to a log of a table of users: signups add a row, errors take it away, others change it."""
    row = F.struct("user_id", F.col("value").cast("double").alias("value"), "event_type")
    before = F.struct("user_id", F.lit(-1.0).alias("value"), F.lit("before").alias("event_type"))
    op = F.when(F.col("event_type") == "signup", "c").when(F.col("event_type") == "error", "d").otherwise("u")
    source = F.struct(F.lit("shop").alias("db"), F.lit("users").alias("table"), F.format_string("bin.%06d", F.floor(F.col("event_id") / 1000)).alias("file"), F.col("event_id").alias("pos"), F.unix_millis(F.col("ts").cast("timestamp")).alias("ts_ms"))
    message = F.struct(op.alias("op"), F.when(op != "c", before).alias("before"), F.when(op != "d", row).alias("after"), source.alias("source"))
    table(spark, sf_dir, "events").filter((F.col("event_id") > low) & (F.col("event_id") <= high)).select(F.to_json(message)).write.mode("append").text(path)


def _captured(spark: SparkSession, sf_dir: str, whole: bool) -> DataFrame:
    """The users' table, read while its log goes on: each user as of another event; with `whole`, and all later changes."""
    folder = _folder(spark)
    log, last = f"{folder}/log", table(spark, sf_dir, "events").agg(F.max("event_id")).first()[0] or 0
    low, high = last * 4 // 10, last * 7 // 10

    def read() -> DataFrame:
        _log(spark, sf_dir, log, low, high)
        seen = F.col("event_id") <= low + F.pmod(F.xxhash64("user_id"), F.lit(high - low + 1))
        rows = table(spark, sf_dir, "events").filter(seen).groupBy("user_id").agg(F.max_by(F.struct(F.col("value").cast("double").alias("value"), "event_type"), "event_id").alias("r"))
        return rows.filter("r.event_type <> 'error'").select("user_id", "r.value", "r.event_type")

    _log(spark, sf_dir, log, -1, low)
    now = capture.capture(spark, log, _USER, ["user_id"], {}, folder, read, "shop.users")
    if whole:
        _log(spark, sf_dir, log, high, last)
        now = capture.capture(spark, log, _USER, ["user_id"], {}, folder, read, "shop.users")  # goes on from its marks
    return cdc.collapse(now, ["user_id"], [])


def _between(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changes of a stretch of the log, one by one."""
    folder, last = _folder(spark), table(spark, sf_dir, "events").agg(F.max("event_id")).first()[0] or 0
    _log(spark, sf_dir, f"{folder}/log", -1, last)
    places = {f"{w}.specific-offset.{k}": v for w, at in (("startup", last // 3), ("stop", last // 2)) for k, v in (("file", f"bin.{at // 1000:06d}"), ("pos", at))}
    df = capture.capture(spark, f"{folder}/log", _USER, ["user_id"], {"startup.mode": "specific", "stop.mode": "specific", **places}, folder, table="users")
    return df.select("user_id", "value", "event_type", F.col("_at.pos").alias("event_id"), F.col("_row_kind").alias("kind"))


def _users(until: str) -> str:
    return f"SELECT user_id, CAST(value AS DOUBLE) AS value, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r FROM events WHERE event_id <= {until}) WHERE r = 1 AND event_type <> 'error'"


_LAST = "(SELECT max(event_id) FROM events)"
_STRETCH = f"event_id >= {_LAST} // 3 AND event_id <= {_LAST} // 2"
_add("cdc_hand_over", lambda s, d: _captured(s, d, False), _users(f"{_LAST} * 7 // 10"))
_add("cdc_initial", lambda s, d: _captured(s, d, True), _users(_LAST))
_add("cdc_specific", _between, f"SELECT user_id, CAST(value AS DOUBLE) AS value, event_type, event_id, CASE event_type WHEN 'signup' THEN '+I' ELSE '+U' END AS kind FROM events WHERE event_type <> 'error' AND {_STRETCH} UNION ALL SELECT user_id, -1.0, 'before', event_id, CASE event_type WHEN 'error' THEN '-D' ELSE '-U' END FROM events WHERE event_type <> 'signup' AND {_STRETCH}")


def _evolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream whose columns change twice: one renamed and one added; one widened and one dropped."""
    folder, events = _folder(spark), table(spark, sf_dir, "events")
    last = events.agg(F.max("event_id")).first()[0] or 0
    cuts = (-1, last // 3, last * 2 // 3, last)
    place = lambda pos: F.struct(F.lit("b").alias("file"), pos.cast("long").alias("pos"))
    score, kind, note = F.col("event_id") % 1000, F.col("event_type").alias("kind"), F.lit("n").alias("note")
    shapes = [["user_id", score.alias("score"), note], ["user_id", score.alias("points"), note, kind], ["user_id", (F.col("event_id") * 10**10).alias("points"), kind]]
    made = [[{"kind": "rename", "name": "score", "to": "points"}, {"kind": "add", "name": "kind", "type": "string"}], [{"kind": "modify", "name": "points", "type": "bigint"}, {"kind": "drop", "name": "note"}]]
    for i, shape in enumerate(shapes):
        rows = events.filter((F.col("event_id") > cuts[i]) & (F.col("event_id") <= cuts[i + 1]))
        op = F.when(F.col("event_type") == "error", "d").otherwise("c")
        row = F.struct(*shape)
        rows.select(F.to_json(F.struct(op.alias("op"), F.when(op == "d", row).alias("before"), F.when(op == "c", row).alias("after"), place(F.col("event_id")).alias("source")))).write.mode("append").text(f"{folder}/log")
        if i < 2:
            told = {"op": "schema", "changes": made[i], "source": {"file": "b", "pos": cuts[i + 1]}}
            spark.createDataFrame([(json.dumps(told),)], "value string").coalesce(1).write.mode("append").text(f"{folder}/log")
    target = evolving.BucketTarget(spark, f"{folder}/table", ["user_id"], "q", 8)
    first = T.StructType([T.StructField("user_id", T.LongType()), T.StructField("score", T.IntegerType()), T.StructField("note", T.StringType())])
    evolving.follow(spark, f"{folder}/log", first, f"{folder}/marks", target, f"{folder}/checkpoint").awaitTermination()
    return buckets.read(spark, f"{folder}/table")


_add("cdc_schema_changes", _evolved, f"SELECT user_id, CASE WHEN event_id > {_LAST} * 2 // 3 THEN event_id * 10000000000 ELSE event_id % 1000 END AS points, CASE WHEN event_id > {_LAST} // 3 THEN event_type END AS kind FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r FROM events) WHERE r = 1 AND event_type <> 'error'")


def _format(kind: str) -> Query:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        path, df = _folder(spark), table(spark, sf_dir, "part")
        formats.WRITERS[kind](df, path, "append", {})
        return formats.READERS[kind](spark, path, df.schema, {"skip_header_row_number": 1})

    return build


for _f in ("avro", "excel"):
    _add(f"format_{_f}", _format(_f), "SELECT * FROM part")
