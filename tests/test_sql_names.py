"""Every SQL name against the column expression it is made from, on the rows of the tables and on odd ones."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from trailmark.functions import scalars as fn
from trailmark.plans import registry

SF = "/root/testdata/sf0.001"
ODD = (None, "", " ", "/", "https://a.example/C/12/x?utm_source=a%20b%zz&utm%5Fterm=q#z", "[1.0, '2'", r"['it\'s', "+'"x,y", 3, None]', "(GMT+05:30) Asia/Kolkata", "Mozilla bot", '{"1":{"click":{}},"0":{"page_viewed":{}}}', "a\\b\n'c'", "click")


@pytest.fixture(scope="module")
def texts(spark):
    fn.register(spark)
    rows = registry.Plans(spark, SF).rows
    found = rows.select(F.explode(F.array("url", "product_id", "product_title", "user_agent", "event_name")).alias("a")).distinct()
    odd = spark.createDataFrame([(x,) for x in ODD], "a string")
    out = found.union(odd).select("a", F.reverse("a").alias("b"))
    return out.withColumns({"n": F.length("a").cast("double"), "d": (F.crc32("a") % 7).cast("double"), "names": F.split("a", "[/,]")})


@pytest.mark.parametrize("name", sorted(fn.SQL_FUNCTIONS))
def test_sql_name_equals_its_expression(spark, texts, name):
    parameters, kind, build = fn.SQL_FUNCTIONS[name]
    types = [p.split()[1] for p in parameters.split(", ")]
    columns = {"STRING": iter("ab"), "DOUBLE": iter("nd"), "ARRAY<STRING>": iter(["names"])}
    args = [next(columns[t]) for t in types]
    if name == "tm_utm":
        texts = texts.withColumn("b", F.lit("utm_source"))
    made = build(*[F.col(c) for c in args])
    if kind.startswith("TABLE"):
        want = texts.select("a", F.inline(made))
        got = spark.sql(f"SELECT t.a, u.* FROM {{t}} t, LATERAL {name}({', '.join(f't.{c}' for c in args)}) u", t=texts)
    else:
        want, got = texts.select("a", made), spark.sql(f"SELECT a, {name}({', '.join(args)}) FROM {{t}}", t=texts)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, map(tuple, want.collect())))
