"""Scalar functions against plain Python and the reference's boundary values."""

from __future__ import annotations

import ast
import random
import re
import urllib.parse
import uuid

from pyspark.sql import functions as F

from trailmark.functions import scalars as fn
from trailmark.sources import adapter


def values(spark, rows, schema, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def test_rounding_equals_python(spark):
    draw = random.Random(5)
    xs = [2.675, 0.125, 0.375, 7.225, 1.005, 0.0, 100.0, 99.995, 1 / 3, 8.5 * 0.85] + [draw.randint(0, 100_000) / 1000 for _ in range(3000)] + [draw.random() * 100 for _ in range(3000)]
    for digits in (2, 4):
        assert values(spark, [(x,) for x in xs], "x double", fn.rounded(F.col("x"), digits)) == [round(x, digits) for x in xs]
    assert values(spark, [(None,)], "x double", fn.rounded(F.col("x"), 2)) == [None]


def test_cart_items(spark):
    carts = [("[10.0, 20.0, 10.0]", "['A', \"B's\", 'C']"), ("[1.0, 2.0", "['A', 'B']"), ("[1.0, x, 3.0]", "['A', 'B']"), ("[]", None), ("7", "['A']"), (None, None), ("[5.0]", "nonsense")]
    got = values(spark, carts, "p string, t string", fn.cart_items(F.col("p"), F.col("t")))
    plain = [None if x is None else [tuple(i) for i in x] for x in got]
    assert plain == [[("10", "A"), ("20", "B's")], [("1", None)], [("1", "A"), ("3", "B")], [], None, None, [("5", None)]]
    assert [str(x) for x in ast.literal_eval(carts[0][1])][:2] == ["A", "B's"]


def test_stored_paths(spark):
    texts = [None, "", "{}", "nonsense", "[1]", '{"2": {"click": {}}, "1": {"page_viewed": {"id": "x"}}, "10": {"scroll_depth": {}}, "3": {"click": {}}}', "{" + ", ".join(f'"{i}": {{"e{i}": {{}}}}' for i in range(20)) + "}"]
    got = values(spark, [(t,) for t in texts], "t string", fn.stored_path(F.col("t")))
    assert got == ["(empty)"] * 3 + ["(invalid)"] * 2 + ["page_viewed>click>scroll_depth", ">".join(f"e{i}" for i in range(15)) + ">..."]
    assert values(spark, [(texts[5],)], "t string", fn.journey(fn.stored_names(F.col("t")))) == ["PV > CL > SC"]


def test_click_targets(spark):
    rows = [(" A ", None, None, None, "https://x.y/Products/5?q", "  Buy\n now " + "z" * 300), ("INPUT", "i", "n", "text", None, "typed"), (None, None, None, None, "", "")]
    target = fn.click_target(*[F.col(c) for c in "abcdef"])
    got = [tuple(x) for x in values(spark, rows, "a string, b string, c string, d string, e string, f string", target)]
    import hashlib

    cleaned = [("a", "", "", "", "/products/:id", ("buy now " + "z" * 60)[:60]), ("input", "i", "n", "text", "", ""), ("",) * 6]
    assert got == [(*c, hashlib.md5("|".join(c).encode()).hexdigest()) for c in cleaned]


def test_utm_boundaries(spark):
    urls = ["http://x/?UTM_Source=Mail%20a+b&utm_source=second", "http://x/?utm_source=&utm_source=x", "http://x/#a?utm_source=late", "http://[bad", None, "http://x/?utm_source=" + "y" * 400, "http://x/?utm_source=%zz"]
    assert values(spark, [(u,) for u in urls], "u string", fn.utm(F.col("u"), "utm_source")) == ["Mail a b", None, "late", None, None, "y" * 255, "%zz"]


def test_clock_offset_and_zone(spark):
    rows = [("2024-01-01 05:30:10", "2024-01-01 00:00:00"), ("2024-01-01 00:07:00", "2024-01-01 00:00:00"), ("2023-12-31 19:00:00", "2024-01-01 00:00:00")]
    df = spark.createDataFrame(rows, "a string, b string").select(fn.clock_offset(F.col("a").cast("timestamp_ntz"), F.col("b").cast("timestamp_ntz")))
    assert [r[0] for r in df.collect()] == [19800, 0, -18000]
    assert values(spark, [("(GMT+05:30) Asia/Kolkata",), ("UTC",), ("??",)], "z string", fn.zone_name(F.col("z"))) == ["Asia/Kolkata", "UTC", "UTC"]


def test_store_clock(spark):
    row = spark.range(1).select(F.timestamp_diff("MINUTE", F.localtimestamp(), fn.store_now(F.lit("(GMT+05:30) Asia/Kolkata"))).alias("m")).first()
    assert row.m == 330


def test_sql_names(spark):
    fn.register(spark)
    row = spark.sql("SELECT tm_page_type(tm_raw_path('/products/1?x=1#y')), tm_product_id(' \\'12.0\\' '), tm_safe_ratio(1, 0)").first()
    assert tuple(row) == ("pdp", "12", None)


def test_sources(spark, tmp_path):
    bounded = adapter.kafka_options("s", "a,b", False, until_ms={"a": {"0": 17}})
    assert bounded["endingOffsetsByTimestamp"] == '{"a": {"0": 17}}' and "maxOffsetsPerTrigger" not in bounded
    assert adapter.kafka_options("s", "a", True)["maxOffsetsPerTrigger"] == "2000"
    assert adapter.table_if_there(spark, "no_such_table") is None
    plan = adapter.activity(spark, "/root/testdata/sf0.001", "2024-01-08 00:00:00", "2024-01-09 00:00:00")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts,2024-01-08" in plan and "LessThan(ts,2024-01-09" in plan


def test_cart_titles_equal_python_on_generated_literals(spark):
    draw = random.Random(11)
    chars = ["a", "B", " ", ",", "'", '"', "\\", "\n", "\t", "[", "]", "(", ")", "é", "ß", "’", "\x07", "x41", "0"]
    made = [[draw.choice(["".join(draw.choices(chars, k=draw.randint(0, 8))), 7, -3, 1.5, None, True]) for _ in range(draw.randint(0, 6))] for _ in range(400)]
    texts = [repr(x if k % 3 else tuple(x)) for k, x in enumerate(made)] + [f" {m!r}\n" for m in made[:20]]
    texts += [r"['it\'s', 'b']", r"""["a\"b", 'c\\', 'd\x41é\q']""", "['a' 'b'", "['a',]", "('a')", "('a',)", "a", "", "['a'] x", "[1, [2, 3]]", "[01]", None]
    expected = []
    for t in texts:
        try:
            held = ast.literal_eval((t or "").strip())
            expected.append([str(x) for x in held] if isinstance(held, (list, tuple)) else None)
        except (ValueError, SyntaxError):
            expected.append(None)
    assert values(spark, [(t,) for t in texts], "t string", fn.cart_titles(F.col("t"))) == expected


def test_utm_equals_a_plain_parser_on_generated_urls(spark):
    draw = random.Random(12)
    bits = ["utm_source", "UTM_Source", "utm%5Fsource", "utm_term", "=", "=", "&", "&", "a", "b", "%20", "%zz", "%", "+", "%C3%A9", " ", "\t", " ", "#", "?", "%26", "x"]
    urls = ["https://shop.example/p?" + "".join(draw.choices(bits, k=draw.randint(0, 12))) for _ in range(500)]
    urls += ["/p?utm_source=a%20b%zz", "/p?utm%5Fsource=q", " /p?utm_source=x ", "/p#/r?utm_source=f", "/p?utm_source=&utm_source=b", "/p?a=1", None, "", f"/p?utm_source={'y' * 300}"]

    def plain(url):
        url = "" if url is None else re.sub("[\t\r\n]", "", url.strip())
        main, _, fragment = url.partition("#")
        found = {}
        for query in (main.partition("?")[2], fragment.partition("?")[2]):
            for name, value in urllib.parse.parse_qsl(query, keep_blank_values=True):
                found.setdefault(name.strip().lower(), value.strip()[:255] or None)
        return found.get("utm_source")

    assert values(spark, [(u,) for u in urls], "u string", fn.utm(F.col("u"), "utm_source")) == [plain(u) for u in urls]


def test_page_path_without_white_space_at_its_ends(spark):
    urls = ["https://x.example/A/ \n", "\t/b/12/", " /c ", "/d e"]
    assert values(spark, [(u,) for u in urls], "u string", fn.page_path(F.col("u"))) == ["/a", "/b/:id", "/c", "/d e"]


def test_session_uuid_is_the_name_based_one(spark):
    names = ["b|u1|e1", "", "é|x", None]
    assert values(spark, [(n,) for n in names], "n string", fn.session_uuid(F.col("n"))) == [None if n is None else str(uuid.uuid5(uuid.UUID(fn.SESSION_SPACE), n)) for n in names]
