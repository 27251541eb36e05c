"""Scalar functions of the clickstream domain as column expressions: no Python runs per row."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: User-agent parts of known crawlers and automation tools.
BOTS = (
    "googlebot", "bingbot", "ahrefsbot", "semrushbot", "mj12bot", "petalbot", "yandexbot", "bytespider", "duckduckbot", "baiduspider", "applebot",
    "curl/", "wget/", "python-requests", "scrapy", "headlesschrome", "phantomjs", "selenium", "puppeteer", "playwright",
)
#: Parameter names, and path segments (a line break at their end included) that stand for ids.
UTM = ("utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content")
DYNAMIC = r"(?<=/)(?:[0-9]+|[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}|[0-9a-f]{16,})(?:\r\n|[\n\r\x{85}\x{2028}\x{2029}])?(?=/|\z)"


#: Fixed value: the name space of session ids.
SESSION_SPACE = "9d0c5a1e52b75f4e8c317a60d2f4b815"


def session_uuid(name: Column) -> Column:
    """The name-based UUID (version 5) of ``name`` in the name space of sessions: the same name has the same id in any run and on any day."""
    h = F.sha1(F.concat(F.unhex(F.lit(SESSION_SPACE)), F.encode(name, "utf-8")))
    part = lambda at, n: F.substring(h, at, n)
    variant = F.translate(part(17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat(part(1, 8), F.lit("-"), part(9, 4), F.lit("-5"), part(14, 3), F.lit("-"), variant, part(18, 3), F.lit("-"), part(21, 12))


#: What is taken off the ends of URLs, names and values: white space of any alphabet.
BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def stripped(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def rounded(x: Column, digits: int) -> Column:
    """``x`` to ``digits`` decimals by its exact binary value, ties to even: 2.675 (a little less in binary) gives 2.67, 0.125 gives 0.12.

    ``x`` times the scale is taken as a sum of two doubles without any error (the high and low half of ``x`` by Veltkamp's split).
    """
    scale = float(10**digits)
    parts = F.array(F.struct(x.cast("double").alias("x")))
    half = lambda s: 134217729.0 * s["x"] - (134217729.0 * s["x"] - s["x"])

    def to_even(s: Column) -> Column:
        product = s["x"] * scale
        error = (half(s) * scale - product) + (s["x"] - half(s)) * scale
        below = F.floor(product).cast("double")
        over = (product - below - 0.5) + error
        up = F.when(over > 0, 1.0).when(over < 0, 0.0).otherwise(below % 2)
        return (below + up) / scale

    return F.get(F.transform(parts, to_even), F.lit(0))


def raw_path(url: Column) -> Column:
    return F.substring_index(F.substring_index(url, "?", 1), "#", 1)


def page_path(url: Column) -> Column:
    """A page's canonical path: no scheme, host, query or fragment; lower case; ids become ``:id``; ``(unknown)`` if empty.

    Each step reads the one before it once: an expression that stands twice in the next one is computed twice, and so on with every step.
    """
    path = F.regexp_replace(raw_path(stripped(url)), r"^.*?://[^/]*", "")
    path = F.lower(F.regexp_replace(path, "^(?!/)", "/"))
    path = F.regexp_replace(path, r"/+$", "")
    path = F.regexp_replace(F.regexp_replace(path, DYNAMIC, ":id"), r"^\z", "/")
    return F.when(url.isNull() | (url == ""), "(unknown)").otherwise(F.left(path, F.lit(255)))


def page_type(path: Column) -> Column:
    return (
        F.when(path == "/", "home")
        .when(F.startswith(path, F.lit("/products/")), "pdp")
        .when(F.startswith(path, F.lit("/collections/")), "collection")
        .when(F.startswith(path, F.lit("/checkout")), "checkout")
        .otherwise("other")
    )


def product_id(raw: Column) -> Column:
    """Trimmed, unquoted, without a trailing ``.0``."""
    return F.regexp_replace(F.regexp_replace(F.trim(raw), "^['\"]+|['\"]+$", ""), r"\.0$", "")


def _list_items(raw: Column) -> Column:
    """The texts between commas of a list-shaped string; blank ones are no items, and one cut off before its bracket loses its last, partial item."""
    items = F.filter(F.transform(F.split(F.regexp_replace(F.trim(raw), r"^[\[\]]+|[\[\]]+$", ""), ","), lambda x: F.trim(x)), lambda x: x != "")
    return F.when(F.endswith(F.trim(raw), F.lit("]")), items).otherwise(F.slice(items, 1, F.greatest(F.size(items) - 1, F.lit(0))))


#: An item of a list literal: a text in either quote, a number, a constant, or a list that is taken as it is written.
_TEXTS = r"""'[^'\\\n]*(?:\\[\s\S][^'\\\n]*)*'|"[^"\\\n]*(?:\\[\s\S][^"\\\n]*)*\""""
_ITEM = rf"(?:{_TEXTS}|-?(?:0|[1-9][0-9]*)(?:[.][0-9]+)?|None|True|False|\[[^\[\]'\"]*\])"
_LIST = rf"^\s*(?:\[\s*(?:{_ITEM}\s*(?:,\s*{_ITEM}\s*)*,?\s*)?\]|\(\s*(?:{_ITEM}\s*,\s*(?:{_ITEM}\s*(?:,\s*{_ITEM}\s*)*,?\s*)?)?\))\s*$"
#: What a letter after a backslash stands for; any other one stays with its backslash, but for quotes and the backslash itself.
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r", "a": "\a", "b": "\b", "f": "\f", "v": "\v", "\\": "\\", "'": "'", '"': '"', "\n": ""}


def _unescaped(body: Column) -> Column:
    """A quoted text's characters, its escapes resolved."""
    parts = F.regexp_extract_all(body, F.lit(r"\\(?:x[0-9a-fA-F]{2}|u[0-9a-fA-F]{4}|[\s\S])|[^\\]+"), F.lit(0))
    table = F.create_map(*[F.lit(x) for k, v in _ESCAPES.items() for x in ("\\" + k, v)])
    point = lambda p: F.decode(F.unhex(F.lpad(F.substring(p, 3, 4), 4, "0")), "UTF-16BE")
    plain = F.transform(parts, lambda p: F.when(p.rlike(r"^\\[xu][0-9a-fA-F]{2}"), point(p)).otherwise(F.coalesce(F.try_element_at(table, p), p)))
    return F.array_join(plain, "")


def cart_titles(raw: Column) -> Column:
    """The items of a list or tuple literal as texts: quoted ones with their escapes resolved, numbers, constants and inner lists as they are written; null if it is none."""
    items = F.regexp_extract_all(F.regexp_extract(raw, r"^\s*[\[(]([\s\S]*)[\])]\s*$", 1), F.lit(_ITEM), F.lit(0))
    plain = F.transform(items, lambda t: F.when(t.rlike("^['\"]"), _unescaped(F.substring(t, F.lit(2), F.length(t) - 2))).when(t.rlike("^-?[0-9]+[.]"), t.try_cast("double").cast("string")).otherwise(t))
    return F.when(raw.rlike(_LIST), plain)


def cart_items(ids: Column, titles: Column) -> Column:
    """Products of a cart as (id, title), the first of each id; titles count only if there is one for each id."""
    found = F.when(F.startswith(F.trim(ids), F.lit("[")), F.filter(F.transform(_list_items(ids), product_id), lambda x: x.rlike("^[0-9]+$")))
    named = F.when(F.size(cart_titles(titles)) == F.size(found), cart_titles(titles))
    both = F.transform(found, lambda x, i: F.struct(x.alias("product_id"), F.get(named, i).alias("product_title")))
    return F.filter(both, lambda x, i: F.array_position(found, x["product_id"]) == i + 1)


def cart_products(raw: Column) -> Column:
    """Distinct product ids of a cart string, in order."""
    return F.coalesce(F.transform(cart_items(raw, F.lit(None).cast("string")), lambda x: x["product_id"]), F.array().cast("array<string>"))


def device(agent: Column) -> Column:
    a = F.lower(agent)
    has = lambda s: F.coalesce(F.contains(a, F.lit(s)), F.lit(False))
    tablet = has("ipad") | has("tablet") | (has("android") & ~has("mobile"))
    return F.when(tablet, "tablet").when(has("mobile") | has("iphone") | has("android"), "mobile").otherwise("desktop")


def is_bot(agent: Column) -> Column:
    a = F.lower(agent)
    return F.coalesce(a.rlike("|".join(BOTS)) | a.rlike(r"\bbot\b"), F.lit(False))


def _decoded(part: Column) -> Column:
    """Percent codes and plus signs resolved; a percent sign that begins no code stays."""
    return F.url_decode(F.regexp_replace(part, "%(?![0-9A-Fa-f]{2})", "%25"))


def utm_pairs(url: Column) -> Column:
    """The utm parameters of the query, then after the fragment sign, in order: names decoded and in small letters, values as they are written. Null if the URL can have none."""
    plain = F.regexp_replace(stripped(url), r"[\t\r\n]", "")
    query = F.concat_ws("&", F.when(F.contains(plain, F.lit("?")), F.regexp_extract(plain, r"^[^#?]*\?([^#]*)", 1)), F.regexp_extract(plain, r"^[^#]*#[^?]*\?(.*)$", 1))
    named = lambda p: F.lower(stripped(_decoded(F.substring_index(p, "=", 1))))
    pairs = F.transform(F.split(query, "&"), lambda p: F.struct(named(p).alias("name"), F.regexp_replace(p, "^[^=]*=?", "").alias("value")))
    return F.when(F.contains(url, F.lit("?")) & F.contains(url, F.lit("=")), F.filter(pairs, lambda p: p["name"].isin(*UTM)))


def utm_of(pairs: Column, name: str) -> Column:
    """The first value of a utm parameter among ``utm_pairs``: decoded, trimmed, at most 255 characters."""
    value = F.get(F.filter(pairs, lambda p: p["name"] == name), F.lit(0))["value"]
    return F.left(F.nullif(stripped(_decoded(value)), F.lit("")), F.lit(255))


def utm(url: Column, name: str) -> Column:
    """The first value of a utm parameter in the query, then after the fragment sign; names decoded and in any case, values decoded, trimmed, at most 255 characters."""
    return utm_of(utm_pairs(url), name)


def topic(name: Column) -> Column:
    n = F.lower(name)
    return (
        F.when(n.isin("checkout_started", "checkout_completed"), "intent.checkout")
        .when(F.contains(n, F.lit("add_to_cart")) | F.contains(n, F.lit("added_to_cart")), "intent.atc")
        .when(n == "click", "intent.click")
        .otherwise("intent.other")
    )


def safe_ratio(n: Column, d: Column) -> Column:
    return rounded(n / F.nullif(d, F.lit(0)), 4)


def percent(n: Column, d: Column) -> Column:
    """Share in percent to two decimals; 0 of nothing."""
    return F.coalesce(rounded(100.0 * n / F.nullif(d, F.lit(0)), 2), F.lit(0.0))


def sequence_path(names: Column, most: int = 15) -> Column:
    """Step names without consecutive repeats, joined by ``>``, at most ``most`` of them and 500 characters."""
    kept = F.filter(names, lambda x, i: (i == 0) | (x != F.get(names, i - 1)))
    text = F.array_join(F.slice(kept, 1, most), ">")
    return F.left(F.when(F.size(kept) == 0, "(empty)").when(F.size(kept) > most, F.concat(text, F.lit(">..."))).otherwise(text), F.lit(500))


def stored_names(text: Column) -> Column:
    """Event names of a stored sequence (JSON object of steps by number, each holding name: details), in the order of the numbers; null if it is none."""
    steps = F.from_json(text, "map<string,map<string,string>>")
    ordered = F.array_sort(F.transform(F.map_entries(steps), lambda e: F.struct(e["key"].try_cast("long").alias("at"), F.get(F.map_keys(e["value"]), F.lit(0)).alias("name"))))
    return F.transform(F.filter(ordered, lambda s: s["name"].isNotNull()), lambda s: s["name"])


def stored_path(text: Column) -> Column:
    """``sequence_path`` of a stored sequence; ``(empty)`` without one, ``(invalid)`` if it is no JSON object of steps."""
    blank = text.isNull() | (F.trim(text) == "") | (F.trim(text) == "{}")
    return F.when(blank, "(empty)").otherwise(F.coalesce(sequence_path(stored_names(text)), F.lit("(invalid)")))


#: How journey patterns abbreviate event names.
SHORT = {"page_viewed": "PV", "product_viewed": "PDV", "product_added_to_cart": "ATC", "checkout_started": "CO", "click": "CL", "scroll_depth": "SC"}


def journey(names: Column) -> Column:
    """Abbreviated step names without consecutive repeats, joined by `` > ``."""
    table = F.create_map(*[F.lit(x) for pair in SHORT.items() for x in pair])
    short = F.transform(names, lambda n: F.coalesce(F.try_element_at(table, n), n))
    return F.array_join(F.filter(short, lambda x, i: (i == 0) | (x != F.get(short, i - 1))), " > ")


def clock_offset(db: Column, wall: Column) -> Column:
    """Seconds by which a database clock runs ahead of a wall clock, to the nearest quarter of an hour (half to even)."""
    seconds = F.timestamp_diff("SECOND", wall, db)
    return (F.bround(seconds / 900.0, 0) * 900).cast("long")


def zone_name(label: Column) -> Column:
    """The IANA zone of a label such as ``(GMT+05:30) Asia/Kolkata``; UTC if it has none."""
    return F.coalesce(F.nullif(F.regexp_extract(label, r"^\s*(?:\([^)]*\)\s*)?([A-Za-z_]+(?:/[A-Za-z0-9_+-]+)*)\s*$", 1), F.lit("")), F.lit("UTC"))


def store_now(label: Column) -> Column:
    """The wall clock of a store's zone, as a time without zone."""
    return F.convert_timezone(F.current_timezone(), zone_name(label), F.localtimestamp())


def click_target(tag: Column, element_id: Column, name: Column, kind: Column, href: Column, value: Column) -> Column:
    """A click's target as its six cleaned fields and their MD5; links are page paths, typed-in values of form fields are left out."""
    clean = lambda c: F.lower(F.trim(F.coalesce(c, F.lit(""))))
    shown = F.left(F.lower(F.trim(F.regexp_replace(F.coalesce(F.left(value, F.lit(200)), F.lit("")), r"\s+", " "))), F.lit(60))
    shown = F.when(clean(tag).isin("input", "textarea", "select"), "").otherwise(shown)
    link = F.when(page_path(href) == "(unknown)", "").otherwise(page_path(href))
    fields = {"tag": clean(tag), "element_id": clean(element_id), "element_name": clean(name), "element_type": clean(kind), "href": link, "value": shown}
    return F.struct(*[c.alias(n) for n, c in fields.items()], F.md5(F.concat_ws("|", *fields.values())).alias("target_hash"))


def _sql_text(c: Column) -> str:
    """A column expression as SQL text; operators, which print as functions, are quoted so that they parse as such."""
    parts = re.split(r"('(?:[^'\\]|\\[\s\S])*')", c._jc.node().sql())  # texts stand at odd places
    return "".join(part if i % 2 else re.sub(r"(?<![\w`])([=<>+*/%-]+|and|or|not)\(", r"`\1`(", part) for i, part in enumerate(parts))


def _inlined(items: Column) -> str:
    return f"SELECT * FROM inline({_sql_text(items)})"


def _utm_values(url: Column) -> Column:
    return F.filter(F.array(*[F.struct(F.lit(n).alias("name"), utm(url, n).alias("value")) for n in UTM]), lambda x: x["value"].isNotNull())


_NAMES = "ARRAY<STRING>"
#: SQL name: (parameters, type, the function that makes the expression of them). Those of a type TABLE give rows, for lateral joins.
SQL_FUNCTIONS = {
    "tm_raw_path": ("url STRING", "STRING", raw_path),
    "tm_page_path": ("url STRING", "STRING", page_path),
    "tm_page_type": ("path STRING", "STRING", page_type),
    "tm_product_id": ("raw STRING", "STRING", product_id),
    "tm_cart_titles": ("raw STRING", _NAMES, cart_titles),
    "tm_cart_products": ("raw STRING", _NAMES, cart_products),
    "tm_utm": ("url STRING, name STRING", "STRING", utm),
    "tm_device": ("agent STRING", "STRING", device),
    "tm_is_bot": ("agent STRING", "BOOLEAN", is_bot),
    "tm_topic": ("event STRING", "STRING", topic),
    "tm_safe_ratio": ("n DOUBLE, d DOUBLE", "DOUBLE", safe_ratio),
    "tm_percent": ("n DOUBLE, d DOUBLE", "DOUBLE", percent),
    "tm_sequence_path": ("names ARRAY<STRING>", "STRING", sequence_path),
    "tm_stored_path": ("stored STRING", "STRING", stored_path),
    "tm_journey": ("names ARRAY<STRING>", "STRING", journey),
    "tm_zone_name": ("label STRING", "STRING", zone_name),
    "tm_session_uuid": ("name STRING", "STRING", session_uuid),
    "tm_cart_items": ("ids STRING, titles STRING", "TABLE (product_id STRING, product_title STRING)", cart_items),
    "tm_utm_values": ("url STRING", "TABLE (name STRING, value STRING)", _utm_values),
}


def register(spark) -> None:
    """The domain's functions under SQL names, each from its one definition above: plans stay free of Python."""
    for name, (parameters, kind, build) in SQL_FUNCTIONS.items():
        made = build(*[F.col(p.split()[0]) for p in parameters.split(", ")])
        body = _inlined(made) if kind.startswith("TABLE") else _sql_text(made)
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {kind} RETURN {body}")
