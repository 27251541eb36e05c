"""What a row costs: each step of a message, a URL and a session is computed once, and gives what plain code gives."""

from __future__ import annotations

import json
import random
import re

from pyspark.sql import functions as F
from test_hot_visitors import drawn
from test_sessions import frame

from trailmark.functions import scalars as fn
from trailmark.operators import scoring as sc
from trailmark.operators import sessions as ss
from trailmark.plans import registry
from trailmark.streaming import contract

SF = "/root/testdata/sf0.001"
SOUND = {"schema_version": 1, "type": "event", "brand_id": "b", "event_id": "e1", "event_name": "page_viewed", "occurred_at": "2024-01-01T00:00:00Z"}


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_each_field_of_a_message_is_taken_once(spark):
    records = spark.createDataFrame([("t", "{}")], "topic string, value string")
    text = plan(contract.parsed(records))
    assert text.count("try_variant_get(") <= 45 and text.count("tryParseJson") + text.count("try_parse_json") <= 1


def test_objects_of_a_message_are_known_by_their_kind(spark):
    odd = [None, {}, {"a": {"b": [1]}}, {"product_id": "p"}, {"product_id": {"x": 1}}, [], [{}], "x", "{}", 1, 1.5, True]
    values = [json.dumps(SOUND | {f: o}) for f in contract.OBJECTS for o in odd] + [f" \t\r\n{json.dumps(SOUND)}", "[{}]", ' "x"', "1", "null", ""]
    got = contract.parsed(spark.createDataFrame(list(enumerate(values)), "seq int, value string")).orderBy("seq").collect()
    want = [None if o is None or isinstance(o, dict) else f"{f} must be an object" for f in contract.OBJECTS for o in odd]
    assert [r.reject_reason for r in got] == want + [None, *["payload must be a JSON object"] * 4, "payload is not valid JSON"]


def test_repeated_adds_are_counted_not_listed(spark):
    text = plan(ss.with_sessions(frame(spark, drawn(3))))
    assert "collect_" not in text and "count(__claim" in text


def test_health_puts_events_in_sessions_once(spark, monkeypatch):
    calls, real = [], ss.with_sessions
    monkeypatch.setattr(ss, "with_sessions", lambda *a, **how: calls.append(1) or real(*a, **how))
    assert registry.queries()["dq_health"](spark, SF).count() == 1 and len(calls) == 1


def test_utm_values_of_event_rows_come_from_one_reading_of_the_url(spark):
    records = spark.createDataFrame([(json.dumps(SOUND | {"url": "/p?utm_term=%20a&UTM_source=b"}),)], "value string")
    rows = contract.event_rows(contract.messages(contract.parsed(records)))
    assert rows.first().utm_term == "a" and rows.first().utm_source == "b" and rows.first().utm_medium is None
    assert plan(rows).count("split(") == 1


def test_a_page_path_reads_each_step_once(spark):
    assert str(fn.page_path(F.col("the_url"))).count("the_url") <= 3
    events = registry.Plans(spark, SF).inside()
    facts = plan(ss.session_rows(sc.with_page_types(events), sc.enrichments(), names=False))
    assert not any("regexp_replace" in line for line in facts.splitlines() if line.lstrip(" +-:|").startswith("Aggregate"))


def test_page_paths_equal_plain_code_on_generated_urls(spark):
    draw = random.Random(13)
    bits = ["/", "/", "/", "?", "#", "://", "http", "x.y", "12", "0", "abcdef0123456789", "deadbeef-1234-1234-1234-123456789abc", "A", "é", " ", "\n", "\r\n", "\x85", "\u2028", "\xa0", "\u3000", "\u200b", "$", "products"]
    urls = ["".join(draw.choices(bits, k=draw.randint(0, 10))) for _ in range(3000)] + [None, "", "/", "///", "a", "x://", "/1/2/3"]
    blank, end = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u2028\u3000", r"(?:\r\n|[\n\r\x85\u2028\u2029])?\Z"

    def plain(url):
        if not url:
            return "(unknown)"
        path = re.sub(r"^[^\n\r\x85\u2028\u2029]*?://[^/]*", "", url.strip(blank).split("?")[0].split("#")[0])
        path = (path if path.startswith("/") else "/" + path).lower()
        path = re.sub(f"/+(?={end})", "", path)
        dynamic = rf"(?:[0-9]+|[0-9a-f]{{8}}-[0-9a-f]{{4}}-[0-9a-f]{{4}}-[0-9a-f]{{4}}-[0-9a-f]{{12}}|[0-9a-f]{{16,}}){end}"
        return ("/".join(":id" if re.match(dynamic, s) else s for s in path.split("/")) or "/")[:255]

    got = [r[0] for r in spark.createDataFrame([(u,) for u in urls], "u string").select(fn.page_path(F.col("u"))).collect()]
    assert [(u, g) for u, g in zip(urls, got, strict=True) if g != plain(u)] == []
