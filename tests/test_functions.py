from __future__ import annotations

import datetime as dt
import hashlib
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from countermill.functions import counters as C
from countermill.functions import hashing as H
from countermill.functions import text as X
from countermill.functions import times as TM
from countermill.functions import types as TY


def value(spark, column, **inputs):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in inputs.items()] or [F.lit(1)])
    return row.select(column).first()[0]


LISTS = "array('A','B','A','C') AS mt, array(named_struct('_p',0L,'_VALUE','1'), named_struct('_p',1L,'_VALUE','2'), " \
        "named_struct('_p',2L,'_VALUE','3'), named_struct('_p',9L,'_VALUE','4'), named_struct('_p',1L,'_VALUE',CAST(NULL AS STRING))) AS r"


def test_counter_map_last_wins_and_drops_unknown_index(spark):
    df = spark.sql(f"SELECT {LISTS}")
    assert df.select(C.counter_map("mt", "r")).first()[0] == {"A": "3", "B": None}


def test_counter_map_index_base_one(spark):
    df = spark.sql(f"SELECT {LISTS}")
    # p 0 lies before the list, p 1 is the first name.
    assert df.select(C.counter_map("mt", "r", 1)).first()[0] == {"A": None, "B": "3"}


def test_counter_map_empty_and_null_lists(spark):
    df = spark.sql("SELECT CAST(array() AS array<string>) mt, array(named_struct('_p',0L,'_VALUE','1')) r")
    assert df.select(C.counter_map("mt", "r")).first()[0] == {}
    df = spark.sql("SELECT array('A') mt, CAST(NULL AS array<struct<_p:bigint,_VALUE:string>>) r")
    assert df.select(C.counter_map("mt", "r")).first()[0] is None


def test_indexed_counter_map(spark):
    df = spark.sql(
        "SELECT array(named_struct('_p',1L,'_VALUE','a'), named_struct('_p',2L,'_VALUE','b'), named_struct('_p',2L,'_VALUE','c')) n,"
        " array(named_struct('_p',1L,'_VALUE',5L), named_struct('_p',2L,'_VALUE',6L), named_struct('_p',7L,'_VALUE',8L),"
        " named_struct('_p',1L,'_VALUE',9L)) r"
    )
    assert df.select(C.indexed_counter_map("n", "r")).first()[0] == {"a": "9", "c": "6"}


@pytest.mark.parametrize("text, expected", [("1,2,3", 1), ("7", 7), ("", None), ("x,1", None), (None, None), ("-4", -4)])
def test_first_integer(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(C.first_integer("t")).first()[0] == expected


def test_names(spark):
    moid = F.lit("ManagedElement=1,Func=1,CellFDD=c1")
    assert value(spark, X.rdn_class(moid)) == "CellFDD"
    assert value(spark, X.last_value(F.lit("SubNetwork=X,MeContext=N1"))) == "N1"
    assert value(spark, X.column_name(F.lit("pm-A.b"))) == "pm_a_b"
    assert value(spark, X.table_name(F.lit("PM-A.B"))) == "PM_A_B"
    assert value(spark, X.split_suffix_removed(F.lit("E_12"))) == "E"
    assert value(spark, X.is_split(F.lit("E_12"))) and not value(spark, X.is_split(F.lit("E_x")))
    assert value(spark, X.store_path(F.lit("PM_A_B"), F.lit("R1"), F.lit("CELL"))) == "/PM/A/B/R1/CELL"
    assert value(spark, X.version_text(F.lit("a_b_C"), F.lit("2"), F.lit("7"))) == "C.2.7"
    assert value(spark, X.last_word(F.lit("node of L17B"))) == "L17B"


def test_config_map(spark):
    assert value(spark, X.config_map(F.lit("a=1::b=x=y::c::a=2::d="))) == {"a": "2", "b": "x", "d": ""}
    assert value(spark, X.config_text(F.create_map(F.lit("b"), F.lit("2"), F.lit("a"), F.lit("1")))) == "a=1::b=2"


def test_delimited_fields(spark):
    line = F.lit("2024-01-01 10:15:30 INFO x: Exported SI_CUID: c1, SI_ID: 11, SI_NAME: n1, SI_KIND: k")
    assert [value(spark, X.delimited_field(line, i)) for i in (4, 5, 6, 7, 8)] == ["c1", "11", "n1", "k", None]
    assert value(spark, X.last_field(F.lit("a:b: some message "))) == "some message"


def test_markup(spark):
    text = 'a<b>&"c"\x96\xa0›\x85'
    assert value(spark, X.escape_xml(F.lit(text))) == "a&lt;b&gt;&amp;&quot;c&quot;  ..."
    assert value(spark, X.unescape_xml(F.lit("&lt;&amp;lt;&apos;"))) == "<&lt;'"
    assert value(spark, X.unescape_xml(F.lit(None).cast("string"))) == ""


@pytest.mark.parametrize(
    "mts, instant, wall",
    [
        ("20240101101500+0100", (9, 15), (10, 15)),
        ("20240101101500+0530", (4, 45), (10, 15)),
        ("20240101101500Z", (10, 15), (10, 15)),
    ],
)
def test_period_end(spark, mts, instant, wall):
    assert value(spark, TM.rop_instant(F.lit(mts))) == dt.datetime(2024, 1, 1, *instant)
    assert value(spark, TM.rop_wall_clock(F.lit(mts))) == dt.datetime(2024, 1, 1, *wall)


def test_day_follows_the_written_clock(spark):
    mts = F.lit("20240101003000+0200")
    assert value(spark, TM.date_id_of_text(mts)) == "20240101"
    assert value(spark, TM.rop_instant(mts)) == dt.datetime(2023, 12, 31, 22, 30)
    assert value(spark, TM.rop_instant(F.lit("nonsense"))) is None


def test_durations_and_dates(spark):
    assert value(spark, TM.duration_seconds(F.lit("PT900S"))) == "900"
    assert value(spark, TM.duration_seconds(F.lit("PT86400S"))) == "86400"
    assert value(spark, TM.duration_seconds(F.lit("900"))) is None
    assert value(spark, TM.is_date(F.lit("2024-02-29")))
    assert not value(spark, TM.is_date(F.lit("2023-02-29")))
    assert not value(spark, TM.is_date(F.lit("continuation")))
    assert value(spark, TM.iso_wall_clock(F.lit("2024-01-01T10:15:00+02:00"))) == dt.datetime(2024, 1, 1, 10, 15)


def test_key_hash_matches_md5(spark):
    keys = [f"SubNetwork=X,MeContext=N{i}" for i in range(50)]
    got = spark.createDataFrame([(k,) for k in keys], "k string").select("k", H.key_hash("k"), H.hash_slice("k")).collect()
    for key, hashed, part in got:
        expected = int.from_bytes(hashlib.md5(key.encode()).digest()[:4], "big", signed=True)
        assert hashed == expected
        assert part == (expected + 2**31) * 200 // 2**32
    assert {p for *_, p in got} != {0}


def test_type_names(spark):
    assert TY.spark_type("ARRAY<BIGINT>:7") == T.ArrayType(T.LongType())
    assert TY.spark_type("VARCHAR(255)") == T.StringType()
    assert TY.hot_store_type("ARRAY<BIGINT>:7") == "BIGINT []"
    assert [TY.hot_store_type(t) for t in ("DOUBLE", "REAL", "FLOAT", "INT", "TINYINT", "CHAR", "BIGINT")] == [
        "DOUBLE PRECISION", "DOUBLE PRECISION", "REAL", "INTEGER", "SMALLINT", "VARCHAR", "BIGINT",
    ]


@pytest.mark.parametrize(
    "names, expected",
    [
        (["INT", "BIGINT"], "BIGINT"),
        (["BIGINT", "INT", "MISSING"], "BIGINT"),
        (["INT", "FLOAT"], "DOUBLE"),
        (["BIGINT", "DOUBLE"], "DOUBLE"),
        (["DOUBLE", "STRING"], "VARCHAR"),
        (["ARRAY<INT>:4", "ARRAY<DOUBLE>:8"], "ARRAY<DOUBLE>"),
        (["TIMESTAMP", "TIMESTAMP"], "TIMESTAMP"),
        (["TIMESTAMP", "INT"], "VARCHAR"),
        (["MISSING"], "MISSING"),
    ],
)
def test_widening(names, expected):
    assert TY.widened(names) == expected


def test_random_lists_equal_a_plain_fold(spark):
    random.seed(11)
    cases = []
    for i in range(400):
        names = [random.choice("abcde") + random.choice(["", "1"]) for _ in range(random.randrange(7))]
        results = [(random.randrange(-1, 9), random.choice(["1", "2,3", "", None])) for _ in range(random.randrange(9))]
        numbered = [(random.randrange(5), random.choice("abc")) for _ in range(random.randrange(6))]
        cases.append((i, names, results, numbered))
    df = spark.createDataFrame(
        cases,
        "i int, names array<string>, results array<struct<_p: bigint, _VALUE: string>>, numbered array<struct<_p: bigint, _VALUE: string>>",
    )
    got = df.select("i", C.counter_map("names", "results", 1).alias("m"), C.indexed_counter_map("numbered", "results").alias("j"))
    for row in got.collect():
        _, names, results, numbered = cases[row["i"]]
        positional = {names[p - 1]: v for p, v in results if 1 <= p <= len(names)}
        lookup = dict(numbered)
        assert row["m"] == positional
        assert row["j"] == {lookup[p]: v for p, v in results if p in lookup}
