"""Token ids of whole texts under a public tokenizer, one library call per distinct piece of text.

A byte-pair tokenizer never merges across the borders its pre-tokenizer draws, and both vocabularies used here draw one
before every run of white space that follows something else, and one between a letter and a mark such as a full stop. So a
text is cut there, each distinct piece is encoded by the tokenizers library, and the pieces' ids are joined. The result
equals encoding the whole text (tests compare them).
"""

from __future__ import annotations

import operator
import os
import re
from collections.abc import Iterator

#: The code points with Unicode's White_Space property, which the tokenizers' ``\\s`` stands for.
SPACE = "\t-\r \x85\xa0  -     　"
LETTERS, MARKS = "A-Za-zÀ-ÖØ-öø-ÿ", ".,!?;:|&$%*#"
PIECE = re.compile(rf"[{SPACE}]*[{LETTERS}]+(?=[{MARKS}{SPACE}]|\Z)|[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
#: Where cutting before every blank might cut inside a run of white space; begins with a literal, which is searched fast.
RUNS = re.compile(rf" (?:[{SPACE}]|\Z)")
#: Pieces that the pre-tokenizers leave whole (and normalizers as they are), so that the library's model can take them at once: of the
#: vocabulary where spaces matter, and of the one of lower-case words.
WHOLE = {True: re.compile(rf" ?(?:[{LETTERS}]+|[0-9]+)"), False: re.compile("[a-zß-öø-ÿ]+")}
#: What a remembered piece takes beside its characters and ids (two objects and a place in a table), and the longest piece remembered.
ENTRY_BYTES, LONGEST = 220, 64


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def token_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def byte_letters() -> dict[int, str]:
    """The letter by which byte-level vocabularies write each byte: printable ones as themselves, all others by the letters from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(others)}


class Memo:
    """Ids by piece in two generations of about ``most`` bytes each: a full young one becomes the old one, and what is met again moves back.

    So memory is bounded by bytes on any corpus, and frequent pieces stay.
    """

    def __init__(self, most: int):
        self.most, self.bytes = most, 0
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def add(self, found: dict[str, bytes]) -> None:
        short = found if not found or max(map(len, found)) <= LONGEST else {p: ids for p, ids in found.items() if len(p) <= LONGEST}
        more = ENTRY_BYTES * len(short) + sum(map(len, short)) + sum(map(len, short.values()))
        if self.bytes + more > self.most:
            self.old, self.young, self.bytes = self.young, {}, 0
        self.young |= short
        self.bytes += more

    def get(self, pieces: list[str]) -> dict[str, bytes]:
        """Those of ``pieces`` that are known."""
        found = {p: ids for p, ids in zip(pieces, map(self.young.get, pieces), strict=True) if ids is not None}
        older = {p: ids for p, ids in zip(pieces, map(self.old.get, pieces), strict=True) if ids is not None and p not in found} if self.old else {}
        self.add(older)
        return found | older


class Words:
    """Ids of words in flat arrays, found by a 128-bit hash of the word: some 45 bytes a word, so that a worker remembers millions of them.

    Beyond ``most`` bytes it starts anew (``begin``), so memory is bounded on any corpus.
    """

    KEYS = (("0 inside a text 1", "0 inside a text 2"), ("1 first in text 1", "1 first in text 2"))

    def __init__(self, most: int):
        self.most = most
        self.clear()

    def clear(self) -> None:
        import numpy as np

        self.n, self.used = 0, 0
        self.slots = np.full(1 << 16, -1, np.int32)
        self.keys = np.zeros((2, 1 << 15), np.uint64)
        self.starts, self.lengths = np.zeros(1 << 15, np.int64), np.zeros(1 << 15, np.int32)
        self.ids = np.zeros(1 << 17, np.uint32)

    def begin(self) -> None:
        if sum(x.nbytes for x in (self.slots, self.keys, self.starts, self.lengths, self.ids)) > self.most:
            self.clear()

    def hashed(self, words, kind: int):
        """Both halves of the hash of each word (an array of strings); words of another ``kind`` are others though they are spelt alike."""
        import numpy as np
        from pandas.util import hash_array

        return np.stack([hash_array(words, hash_key=key[-16:], categorize=False) for key in self.KEYS[kind]])

    def find(self, keys):
        """The place of each key, or -1."""
        import numpy as np

        mask = np.uint64(len(self.slots) - 1)
        found = np.full(keys.shape[1], -1, np.int32)
        open_ = np.arange(keys.shape[1])
        slot = (keys[0] & mask).astype(np.int64)
        while len(open_):
            entry = self.slots[slot[open_]]
            some = entry >= 0
            open_, entry = open_[some], entry[some]
            same = (self.keys[0][entry] == keys[0][open_]) & (self.keys[1][entry] == keys[1][open_])
            found[open_[same]] = entry[same]
            open_ = open_[~same]
            slot[open_] = (slot[open_] + 1) & int(mask)
        return found

    def _place(self, first: int) -> None:
        """Puts the entries from number ``first`` on into slots."""
        import numpy as np

        mask = len(self.slots) - 1
        entries = np.arange(first, self.n, dtype=np.int32)
        slot = (self.keys[0][first : self.n] & np.uint64(mask)).astype(np.int64)
        while len(entries):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = entries[free]  # of several, the last one gets it
            left = self.slots[slot] != entries
            entries, slot = entries[left], (slot[left] + 1) & mask

    def add(self, keys, ids: list[bytes]):
        """Takes in words that are not known, all different; gives their places."""
        import numpy as np

        first, more = self.n, len(ids)
        flat = np.frombuffer(b"".join(ids), np.uint32)
        lengths = np.array(list(map(len, ids)), np.int32) // 4
        while self.n + more > self.keys.shape[1]:
            self.keys = np.concatenate([self.keys, np.zeros_like(self.keys)], axis=1)
            self.starts, self.lengths = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.lengths))
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.n += more
        self.keys[:, first : self.n] = keys
        self.lengths[first : self.n] = lengths
        self.starts[first : self.n] = self.used + np.cumsum(lengths) - lengths
        self.ids[self.used : self.used + len(flat)] = flat
        self.used += len(flat)
        if 2 * self.n > len(self.slots):
            self.slots = np.full(1 << (4 * self.n).bit_length() - 1, -1, np.int32)
            self._place(0)
        else:
            self._place(first)
        return np.arange(first, self.n, dtype=np.int32)

    def joined(self, places, ends) -> list[bytes]:
        """The ids of words in the given order, as one byte string for each range between two ``ends``."""
        import numpy as np

        lengths = self.lengths[places].astype(np.int64)
        upto = np.concatenate([[0], np.cumsum(lengths)])
        data = self.ids[np.repeat(self.starts[places] - upto[:-1], lengths) + np.arange(upto[-1])].astype("<u4").tobytes()
        cuts = (4 * upto[ends]).tolist()
        return [data[i:j] for i, j in zip(cuts, cuts[1:], strict=False)]


ID = operator.attrgetter("id")


class Encoder:
    """``ids(texts)``: for each text its ids as little-endian unsigned 32-bit bytes, as ``encode(text, add_special_tokens=False)`` gives them.

    Words are looked up first, then their pieces, and only unknown pieces go to the library: plain words to its model, which saves the
    normalizer, the pre-tokenizer and the records that these make, all others of a batch to one call. ``spaces_matter`` is false for a vocabulary of
    lower-case words that drops white space. A text that holds the string of a special token, in any case of its letters, is encoded whole: the
    library makes one id of it wherever it stands as it is, and ordinary ids where its case differs. With ``special_as_text`` such strings are
    ordinary text.
    """

    def __init__(self, path: str, spaces_matter: bool, special_as_text: bool = False, memo_bytes: int = 100_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        self.special = [] if special_as_text else [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.prefix = re.match("[^A-Za-z]*", os.path.commonprefix(self.special))[0]  # searched fast
        self.any_case = re.compile("|".join(map(re.escape, self.special)), re.IGNORECASE | re.ASCII)
        self.spaces_matter = spaces_matter
        self.model, self.letters, self.whole = self.tokenizer.model, byte_letters(), WHOLE[spaces_matter].fullmatch
        self.memo, self.known = Memo(memo_bytes // 8), Words(memo_bytes * 3 // 2)

    def plain(self, pieces: list[str]) -> list[bytes]:
        from array import array

        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    def plain_words(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces that ``WHOLE`` takes: a blank at most at the beginning, then letters or digits."""
        from array import array

        letters, tokens = self.letters, self.model.tokenize
        blank = letters[32]
        spelt = [(blank + p[1:] if p[0] == " " else p) if p.isascii() else p.encode().decode("latin-1").translate(letters) for p in pieces]
        flat, ends = array("I"), [0]
        for piece in spelt:
            flat.extend(map(ID, tokens(piece)))
            ends.append(len(flat))
        data = flat.tobytes()
        return [data[4 * i : 4 * j] for i, j in zip(ends, ends[1:], strict=False)]

    def learn(self, unknown: list[str]) -> dict[str, bytes]:
        """Ids of words that are not known, all of which are then."""
        whole = self.whole
        words = [w for w in unknown if whole(w)]
        found = dict(zip(words, self.plain_words(words), strict=True))
        cut = {w: PIECE.findall(w) for w in unknown if w not in found}
        pieces = list(dict.fromkeys(p for some in cut.values() for p in some))
        parts = self.memo.get(pieces)
        new = [p for p in pieces if p not in parts]
        words = [p for p in new if whole(p)]
        made = dict(zip(words, self.plain_words(words), strict=True))
        others = [p for p in new if p not in made]
        made |= dict(zip(others, self.plain(others), strict=True))
        parts |= made
        found |= {w: b"".join([parts[p] for p in some]) for w, some in cut.items()}
        self.memo.add(made)
        return found

    def words(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words, in their order, by the memo of pieces."""
        found = self.memo.get(words)
        found |= self.learn([w for w in words if w not in found])
        return list(map(found.__getitem__, words))

    def places(self, words, kind: int):
        """Places among the known words of an array of distinct ones; unknown ones are learnt. ``kind`` is 1 for words without a space before them."""
        import numpy as np

        keys = self.known.hashed(words, kind)
        place = self.known.find(keys)
        new = np.flatnonzero(place < 0)
        if len(new):
            names = [f" {w}" for w in words[new]] if self.spaces_matter and not kind else words[new].tolist()
            found = self.learn(names)
            place[new] = self.known.add(keys[:, new], [found[w] for w in names])
        return place

    def cut_at_spaces(self, texts: list[str]) -> list[bytes]:
        """Ids of texts by Arrow's kernels: cut into words, number the distinct ones, look these up, and put their ids in the places of the words."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        self.known.begin()
        column = pa.array(texts, pa.large_string())
        lists = pc.split_pattern(column, " ") if self.spaces_matter else pc.ascii_split_whitespace(pc.ascii_lower(column))
        ends = lists.offsets.to_numpy()
        coded = lists.flatten().dictionary_encode()
        place = self.places(coded.dictionary.to_numpy(zero_copy_only=False), 0)[coded.indices.to_numpy()]
        if self.spaces_matter:  # all but a text's first word have a space before them
            first = coded.take(pa.array(ends[:-1])).dictionary_decode().dictionary_encode()
            place[ends[:-1]] = self.places(first.dictionary.to_numpy(zero_copy_only=False), 1)[first.indices.to_numpy()]
        return self.known.joined(place, ends)

    def ids(self, texts: list[str]) -> list[bytes]:
        out: list = [None] * len(texts)
        plain = []
        for k, text in enumerate(texts):
            if self.special and self.prefix in text and self.any_case.search(text):
                (out[k],) = self.plain([text])
            elif self.spaces_matter and RUNS.search(text):
                words = PIECE.findall(text)
                kinds = list(dict.fromkeys(words))
                of = dict(zip(kinds, self.words(kinds), strict=True))
                out[k] = b"".join(map(of.__getitem__, words))
            else:
                plain.append(k)
        if plain:
            for k, ids in zip(plain, self.cut_at_spaces([texts[k] for k in plain]), strict=True):
                out[k] = ids
        return out


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(path: str, spaces_matter: bool, special_as_text: bool = False, memo_bytes: int = 100_000_000) -> Encoder:
    """One encoder a Python worker, whatever the number of its tasks; only the one asked for last is kept."""
    key = (path, spaces_matter, special_as_text, memo_bytes)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(*key)
    return _ENCODERS[key]


def batches(texts: list[str], chars: int = 4_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about ``chars`` characters each (a longer text is a range of its own)."""
    begin = total = 0
    for i, text in enumerate(texts):
        total += len(text)
        if total >= chars:
            yield begin, i + 1
            begin, total = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)
