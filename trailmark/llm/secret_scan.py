"""Secret scans: fixed patterns, and strings that a public vocabulary needs many tokens for."""

from __future__ import annotations

import base64
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release

KINDS = ("assign", "access", "hex", "random")
#: The base patterns. Matches too short are dropped after matching.
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
#: Lengths of hexadecimal digests in common use (MD5, SHA-1, SHA-224, SHA-256, SHA-384, SHA-512).
DIGESTS = (32, 40, 56, 64, 96, 128)
UUID = re.compile(r"[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}")
WORD = re.compile("[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
HEXES = np.array([chr(b) in "0123456789abcdef" for b in range(256)])
STRINGS = np.array([chr(b) in "+/_=-." or (b < 128 and chr(b).isalnum()) for b in range(256)])


def runs(raw: np.ndarray, table: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes in ``table``, ``least`` long or more."""
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = table[raw]
    edges = np.flatnonzero(np.diff(inside))
    begins, ends = edges[::2], edges[1::2]
    some = ends - begins >= least
    return list(zip(begins[some].tolist(), ends[some].tolist(), strict=True))


class TokenEfficiency:
    """Tells random strings from words by the characters a vocabulary's token covers in them."""

    def __init__(self, path: str, pattern: str, least: int = 20, most_chars_per_token: float = 2.2):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.least, self.most = least, most_chars_per_token

    def words(self, s: str) -> bool:
        """Whether the letters of ``s``, cut at capitals and other characters and put in lower case, make words: no fewer characters a token than the threshold."""
        found = WORD.findall(s)
        return sum(map(len, found)) >= self.most * sum(len(self.encoding.encode_ordinary(w.lower())) for w in found)

    def known(self, s: str) -> bool:
        """Digests and UUIDs, and identifiers: parts of letters only, digits only or letters and a short number, joined by marks or capitals, whose letters are words."""
        if UUID.fullmatch(s) or (len(s) in DIGESTS and re.fullmatch("[0-9a-f]+|[0-9A-F]+", s)):
            return True
        parts = re.split(r"[-_/+=.]+", s.strip("-_/+=."))
        return all(p.isalpha() or p.isdigit() or re.fullmatch("[A-Za-z]+[0-9]{1,6}", p) for p in parts) and self.words(s)

    def random(self, s: str) -> bool:
        return len(s) < self.most * len(self.encoding.encode_ordinary(s)) and not self.known(s)


class Offsets:
    """Code points before rising byte places of a text: each stretch is decoded once."""

    def __init__(self, raw: bytes, ascii_only: bool):
        self.raw, self.ascii, self.byte, self.point = raw, ascii_only, 0, 0

    def at(self, byte: int) -> int:
        if self.ascii:
            return byte
        self.point += len(self.raw[self.byte : byte].decode())
        self.byte = byte
        return self.point


class Taken:
    """Spans that stand already, asked whether one of them meets another span: of those that begin before its end, the one that ends last tells."""

    def __init__(self, spans: list[tuple[int, int]]):
        spans = sorted(spans)
        self.starts, self.ends = [s for s, _ in spans], list(accumulate((e for _, e in spans), max))

    def meets(self, start: int, end: int) -> bool:
        at = bisect_left(self.starts, end)
        return at > 0 and self.ends[at - 1] > start


def base_spans(text: str, raw: bytes, points: np.ndarray) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points of ``text``; ``raw`` and ``points`` are its UTF-8 bytes."""
    out = []
    lowered = raw.lower()
    if any(k in lowered for k in KEYWORDS):
        out += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if b"AKIA" in raw:
        out += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    shift = Offsets(raw, len(raw) == len(text))
    for a, b in runs(points, HEXES, 32):
        start = shift.at(a)
        out.append(("hex", start, start + b - a))
    return out


def candidates(text: str, start: int, end: int, least: int) -> list[tuple[int, int]]:
    """A run of string characters without full stops at its ends, and if it has others, the parts between them: those of ``least`` characters or more."""
    whole = text[start:end]
    start += len(whole) - len(whole.lstrip("."))
    whole = whole.strip(".")
    out, at = [(start, start + len(whole))], start
    if "." in whole:
        for part in whole.split("."):
            out.append((at, at + len(part)))
            at += len(part) + 1
    return [(a, b) for a, b in out if b - a >= least]


def scan_secrets(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", least: int = 20, most_chars_per_token: float = 2.2) -> DataFrame:
    """One row per document: id and ``spans`` (kind, start, end in code points, end exclusive; by start, then kind in the order of ``KINDS``).

    Kinds "assign", "access" and "hex" are fixed patterns, leftmost and without overlaps of their own kind. "random" are strings of
    ``least`` characters or more of the base64 and URL alphabets (full stops join them) of which a token covers fewer than
    ``most_chars_per_token``, known digests and identifiers left out, that no other span holds; where the whole string is none, its parts between
    full stops are tested. Whole texts, in Arrow batches, without a shuffle.

    Null or empty text: no spans. Null and repeated ids are carried as they are. An empty table gives no rows; other columns are ignored.
    """

    def scan(parts: Iterator) -> Iterator:
        import pyarrow as pa

        efficiency = TokenEfficiency(vocabulary, pattern, least, most_chars_per_token)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for part in parts:
            out = []
            for value in part.column(1):
                text = value.as_py() or ""
                raw = text.encode("utf-8", "replace")
                points = np.frombuffer(raw, np.uint8)
                spans = base_spans(text, raw, points)
                shift = Offsets(raw, len(raw) == len(text))
                taken = Taken([x[1:] for x in spans])
                for a, b in runs(points, STRINGS, least):
                    begin = shift.at(a)
                    for start, end in candidates(text, begin, begin + b - a, least):
                        if not taken.meets(start, end) and efficiency.random(text[start:end]):
                            spans.append(("random", start, end))
                            if "." in text[start:end]:
                                break  # the whole string: its parts are in it
                spans.sort(key=lambda x: (x[1], KINDS.index(x[0])))
                out.append([dict(zip(("kind", "start", "end"), x, strict=True)) for x in spans])
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(out, kind)], ["id", "spans"])
        release()

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(scan, "id long, spans array<struct<kind:string,start:long,end:long>>").withColumnRenamed("id", id_col)
