"""Token counts by byte-pair merging over a heap and a linked list; no identifiers come out.

The vocabulary file is that of a lower-casing BPE with word ends. A text is cut at the
special strings (one token each), brought to composed form, lower-cased and cut into
pieces. Within a piece the adjacent pair of lowest rank is merged again and again: a heap
holds the pairs, two arrays link the symbols that are left. The count of a piece is its
number of bytes less its merges. Counts of pieces are kept in a dictionary of bounded size.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StructField, StructType

from hushline.llm.arrowtext import appended, chunks
from hushline.llm.storage import free_name

#: Pieces whose count a worker remembers.
REMEMBERED = 400_000
WORD_END = "</w>"
#: Letters, numbers and white space of the first 256 signs, for texts which have no others.
FEW_LETTERS, FEW_NUMBERS, FEW_SPACES = "a-zA-Z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r \x85\xa0"
#: Letters and numbers that are newer than the tokenizer's tables, which has them as signs.
NEWER = (
    "558 58B-58C 88F C5C CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959 "
    "10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 11DF1 1246F 12475-1247F 12550-12686 16EA0-16EB8 "
    "16EBB-16ED3 16FF2-16FF3 16FF4-16FF6 187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 "
    "1B123-1B128 1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 "
    "1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F "
)
_SHORT = "'s|'t|'re|'ve|'m|'ll|'d"
#: White space as the tokenizer's patterns see it.
SPACES = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


def byte_signs() -> list[str]:
    """The sign which stands for each byte in the vocabulary: printable ones themselves, others from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


#: A heap entry is one number: rank of the pair above PLACE bits, place of its first symbol below.
PLACE = 40


class Merges:
    """Ranks of symbol pairs; symbols are numbers, pairs one number, a byte's symbol is the byte."""

    def __init__(self, merges: list):
        ids: dict[str, int] = {}
        number = lambda s: ids.setdefault(s, len(ids))
        signs = byte_signs()
        for end in ("", WORD_END):
            for sign in signs:
                number(sign + end)
        #: By the left symbol: the right one to the pair's rank, shifted as in the heap; by rank: the symbol made.
        self.made: list[int] = []
        found = []
        for pair in merges:
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            found.append((number(a), number(b)))
            self.made.append(number(a + b))
        self.right: list[dict[int, int]] = [{} for _ in ids]
        for rank, (a, b) in enumerate(found):
            self.right[a][b] = rank << PLACE

    def count(self, piece: bytes) -> int:
        """Symbols left when no adjacent pair has a rank."""
        n = len(piece)
        if n < 2:
            return n
        right = self.right
        symbol = list(piece)
        symbol[-1] += 256
        #: By place of its first symbol: the heap entry of a pair that is still there.
        current = []
        for i, two in enumerate(symbol[1:]):
            rank = right[symbol[i]].get(two)
            current.append(-1 if rank is None else rank | i)
        heap = [entry for entry in current if entry >= 0]
        if not heap:
            return n
        current.append(-1)
        made_by, mask = self.made, (1 << PLACE) - 1
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heapify(heap)
        left = n
        while heap:
            entry = heappop(heap)
            i = entry & mask
            if current[i] != entry:
                continue
            j = after[i]
            symbol[i] = made = made_by[entry >> PLACE]
            current[i] = current[j] = -1
            left -= 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                rank = right[made].get(symbol[k])
                if rank is not None:
                    current[i] = entry = rank | i
                    heappush(heap, entry)
            h = before[i]
            if h >= 0:
                rank = right[symbol[h]].get(made)
                if rank is None:
                    current[h] = -1
                else:
                    current[h] = entry = rank | h
                    heappush(heap, entry)
        return left


class _Remembered(dict):
    """Counts of pieces in two generations: what was asked for since the last change outlives the next."""

    def __init__(self, merges: Merges, limit: int):
        self.merges, self.half, self.older = merges, max(limit // 2, 1), {}

    def __missing__(self, piece: str) -> int:
        if len(self) >= self.half:
            self.older = dict(self)
            self.clear()
        n = self.older.get(piece)
        if n is None:
            n = self.merges.count(piece.encode("utf-8", "surrogatepass"))
        self[piece] = n
        return n


class Counter:
    """Token counts of texts for one vocabulary file."""

    def __init__(self, vocabulary: bytes, remembered: int = REMEMBERED):
        spec = json.loads(vocabulary)
        if spec["model"].get("end_of_word_suffix") != WORD_END:
            raise ValueError("a BPE vocabulary with word ends is asked for")
        specials = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.specials = regex.compile("|".join(map(regex.escape, specials))) if specials else None
        self.pieces = regex.compile(rf"{_SHORT}|\p{{L}}+|\p{{N}}|[^{SPACES}\p{{L}}\p{{N}}]+")
        newer = "".join("-".join(rf"\U{int(end, 16):08X}" for end in part.split("-")) for part in NEWER.split())
        self.newer = re.compile(f"[{newer}]")
        self.careful = regex.compile(rf"(?V1){_SHORT}|[\p{{L}}--[{newer}]]+|[\p{{N}}--[{newer}]]|(?:[^{SPACES}\p{{L}}\p{{N}}]|[{newer}])+")
        self.few = re.compile(rf"{_SHORT}|[{FEW_LETTERS}]+|[{FEW_NUMBERS}]|[^{FEW_SPACES}{FEW_LETTERS}{FEW_NUMBERS}]+")
        self.counts = _Remembered(Merges(spec["model"]["merges"]), remembered)

    def count(self, text: str) -> int:
        if self.specials and "<|" in text:
            parts = self.specials.split(text)
            return len(parts) - 1 + sum(map(self._count, parts))
        return self._count(text)

    def _count(self, text: str) -> int:
        few = text.isascii()
        if not few:
            text = unicodedata.normalize("NFC", text)
        # Sign by sign, as the tokenizer does: no special form of sigma at a word's end.
        text = text.lower() if "Σ" not in text else "".join(map(str.lower, text))
        pieces = self.few if few or _is_latin(text) else self.careful if self.newer.search(text) else self.pieces
        return sum(map(self.counts.__getitem__, pieces.findall(text)))


def _is_latin(text: str) -> bool:
    """All signs are among the first 256."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


_COUNTERS: dict[int, Counter] = {}


def counter_of(vocabulary: bytes) -> Counter:
    """One counter a worker and vocabulary."""
    key = hash(vocabulary)
    if key not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[key] = Counter(vocabulary)
    return _COUNTERS[key]


def with_token_counts(
    docs: DataFrame, vocabulary_path: str, text: str = "text", limit: int = 2048,
    names: tuple[str, str, str] = ("n_bytes", "n_tokens", "over_limit"), keep: list[str] | None = None,
) -> DataFrame:
    """The rows (columns `keep`, or all) with UTF-8 bytes, tokens, and whether they exceed the limit.

    Null and empty texts have 0 tokens. Rows are handled one by one: repeated rows each get
    their count, an empty table gives an empty table, and a text of any length is counted
    whole. A column of `names` that is there already is lengthened by underscores.
    """
    with open(vocabulary_path, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())
    kept = docs.columns if keep is None else keep
    source = docs.select(*dict.fromkeys([*kept, text]))
    base = docs.select(*kept)
    fields = []
    for name, kind in zip(names, ("long", "long", "boolean")):
        fields.append((free_name(base, name), kind))
    out = StructType([*base.schema.fields]).add(StructField(fields[0][0], LongType())).add(fields[1][0], "long").add(fields[2][0], "boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(shared.value)
        for chunk in chunks(batches, text):
            n = np.fromiter(
                (counter.count(chunk.text(i).decode("utf-8", "replace")) for i in range(len(chunk))), np.int64, len(chunk)
            )
            yield appended(chunk.rows.select(kept), {
                fields[0][0]: np.diff(chunk.offsets), fields[1][0]: n, fields[2][0]: n > limit,
            })

    return source.mapInArrow(run, out)
