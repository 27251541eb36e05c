"""License scans: exact phrases by words, and fuzzy search for short notices (exact seeds, then bounded-error matching)."""

from __future__ import annotations

import bisect
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release

#: Phrases found word by word, and their labels.
PHRASES = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))
#: Short notices searched with errors, and their labels.
NOTICES = (
    ("licensed under the apache license, version 2.0", "apache-2.0"),
    ("licensed under the gnu general public license, version 3", "gpl-3.0"),
    ("licensed under the gnu general public license, version 2", "gpl-2.0"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("released under the mit license", "mit"),
    ("permission is hereby granted, free of charge, to any person", "mit"),
    ("redistribution and use in source and binary forms", "bsd"),
    ("mozilla public license, version 2.0", "mpl-2.0"),
    ("licensed under cc by-nc 4.0", "cc-by-nc-4.0"),
    ("licensed under cc by-sa 4.0", "cc-by-sa-4.0"),
    ("creative commons attribution 4.0 international", "cc-by-4.0"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
)

RESULT = "n_words long, base array<struct<label:string,word:long>>, matches array<struct<label:string,start:long,end:long,edits:int,score:double>>"
#: Bytes that stand in words after lowering A-Z; all others part words.
WORDS = bytes(b if 48 <= b < 58 or 97 <= b < 123 or b > 127 else b + 32 if 65 <= b < 91 else 32 for b in range(256))
#: A-Z lowered and ASCII blanks made spaces, byte by byte, so that places stay where they are.
FLAT = bytes(b + 32 if 65 <= b < 91 else 32 if 9 <= b < 14 else b for b in range(256))


def phrase_places(words: list[bytes], phrases: list[tuple[list[bytes], str]]) -> list[tuple[str, int]]:
    """(label, index of the first word) of all places where a phrase's words stand consecutively."""
    out = []
    for phrase, label in phrases:
        at = -1
        for _ in range(words.count(phrase[0])):
            at = words.index(phrase[0], at + 1)
            if words[at : at + len(phrase)] == phrase:
                out.append((label, at))
    return out


class NoticeSearch:
    """Finds notices with at most one edit per ``letters_per_edit`` letters.

    A notice with k edits allowed is split into k + 1 pieces; one of them must stand in the text unchanged. An Aho-Corasick automaton finds
    all pieces in one pass; around each, the regex library looks for the whole notice with at most k edits.
    """

    def __init__(self, notices=NOTICES, letters_per_edit: int = 10):
        import ahocorasick
        import regex

        self.notices, self.exact, self.seeds = [], [], ahocorasick.Automaton()
        pieces: dict[str, list[tuple[int, int]]] = {}
        for i, (notice, label) in enumerate(notices):
            k = len(notice) // letters_per_edit
            self.exact.append(notice)
            self.notices.append((regex.compile(f"(?b)(?:{regex.escape(notice)}){{e<={k}}}"), len(notice), k, label))
            cuts = [len(notice) * j // (k + 1) for j in range(k + 2)]
            for a, b in zip(cuts, cuts[1:]):
                pieces.setdefault(notice[a:b], []).append((i, a))
        for piece, places in pieces.items():
            self.seeds.add_word(piece, (len(piece), places))
        self.seeds.make_automaton()

    def _around(self, text: str, i: int, a: int, b: int, found: set) -> None:
        """Matches of notice ``i`` inside a window no longer than itself and twice its errors: the best one, then what stands before and after it."""
        pattern, length, k, label = self.notices[i]
        parts = [(a, min(b, len(text)))]
        while parts:
            a, b = parts.pop()
            if b - a < length - k:
                continue
            at = text.find(self.exact[i], a, b)
            if at >= 0:
                start, end, edits = at, at + length, 0
            else:
                m = pattern.search(text, a, b)
                if not m:
                    continue
                start, end, edits = m.start(), m.end(), sum(m.fuzzy_counts)
            found.add((label, start, end, edits, 1 - edits / length))
            parts += [(a, start), (end, b)]

    def find(self, text: str) -> list[tuple[str, int, int, int, float]]:
        """(label, start, end, edits, score) in code points of ``text`` (already lower case, blanks flattened).

        Each seed is searched in its own window, so time grows with the number of seeds and not with its square. Of overlapping matches the best
        stays (fewest edits for its length, then the first, then the shorter, then the label in order).
        """
        found: set[tuple[str, int, int, int, float]] = set()
        done: set[tuple[int, int]] = set()
        for end, (size, places) in self.seeds.iter(text):
            for i, offset in places:
                start = end + 1 - size - offset
                if (i, start) not in done:
                    done.add((i, start))
                    _, length, k, _ = self.notices[i]
                    self._around(text, i, max(0, start - k), start + length + k, found)
        kept: list[tuple[int, int, tuple]] = []  # disjoint, by start
        for one in sorted(found, key=lambda x: (-x[4], x[1], x[2], x[0])):
            at = bisect.bisect_left(kept, (one[1],))
            if (at == 0 or kept[at - 1][1] <= one[1]) and (at == len(kept) or kept[at][0] >= one[2]):
                kept.insert(at, (one[1], one[2], one))
        return [one for _, _, one in kept]


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``n_words``, ``base`` (label and first word of each phrase place), ``matches`` (label, span, edits, score of each notice).

    Whole texts, in Arrow batches, without a shuffle. Null or empty text: no words, nothing found. Null and repeated ids are carried as
    they are. An empty table gives no rows; other columns are ignored.
    """
    phrases = [(p.encode().split(), label) for p, label in PHRASES]

    def scan(parts: Iterator) -> Iterator:
        import pyarrow as pa

        search = NoticeSearch()
        kinds = (pa.int64(), pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64())])), pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("edits", pa.int32()), ("score", pa.float64())])))
        for part in parts:
            counts, places, matches = [], [], []
            for text in part.column(1):
                raw = (text.as_py() or "").encode("utf-8", "replace")
                words = raw.translate(WORDS).split()
                counts.append(len(words))
                places.append([{"label": a, "word": b} for a, b in phrase_places(words, phrases)])
                flat = raw.translate(FLAT).decode()
                matches.append([dict(zip(("label", "start", "end", "edits", "score"), m, strict=True)) for m in search.find(flat)])
            yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array(v, t) for v, t in zip((counts, places, matches), kinds, strict=True)]], ["id", "n_words", "base", "matches"])
        release()

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(scan, f"id long, {RESULT}").withColumnRenamed("id", id_col)
