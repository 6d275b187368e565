"""Byte-level BPE by a lazily built finite-state transducer, and streaming decoding.

The encoding of a text is the only sequence of tokens in which each adjacent pair is
compatible: merging the bytes of the two tokens alone gives these two tokens again. That
makes encoding a finite-state task. A nondeterministic machine holds pairs (token before,
place in the trie of tokens); after each byte exactly one of its paths ends a token. The
machine is made deterministic on demand: a state is the set of live paths, each with the
tokens on which not all paths agree yet. Tokens are put out as soon as all live paths agree
on them, at the latest after as many bytes as the longest token has. States are built when a
text first needs them, kept in a table of bounded size, and dropped together when it is full.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from hushline.llm.arrowtext import appended, chunks
from hushline.llm.storage import free_name

#: Bounds of what a worker keeps: deterministic states, compatible pairs, encoded pieces.
STATES, PAIRS, PIECES = 300_000, 1_000_000, 400_000
#: Bytes given to the streaming decoder at a time.
DECODE_BYTES = 1 << 16


def read_ranks(content: bytes) -> dict[bytes, int]:
    """Ranks from lines of base64 token and rank."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines()) if a}


class Transducer:
    """Encodes byte strings by the merges of a rank table."""

    def __init__(self, ranks: dict[bytes, int], states: int = STATES, pairs: int = PAIRS):
        self.ranks, self.max_states, self.max_pairs = ranks, states, pairs
        self.token_of = {r: t for t, r in ranks.items()}
        self.compatible_pairs: dict[tuple[int, int], bool] = {}
        # Trie of the tokens which merging can reach: children by byte, token that ends at a node.
        self.children: list[dict[int, int]] = [{}]
        self.ends: list[int] = [-1]
        for token, rank in ranks.items():
            if len(token) > 1 and self.merged(token) != [rank]:
                continue
            node = 0
            for b in token:
                following = self.children[node].get(b)
                if following is None:
                    following = len(self.children)
                    self.children.append({})
                    self.ends.append(-1)
                    self.children[node][b] = following
                node = following
            self.ends[node] = rank
        self.reset()

    def reset(self) -> None:
        #: Configurations (token before, place in the trie), numbered; what each does on a byte.
        self.configs: list[tuple[int, int]] = []
        self.config_numbers: dict[tuple[int, int], int] = {}
        self.moves: dict[int, tuple[int, int, int]] = {}
        #: A state: its live paths, each the tokens not put out yet and its configuration, earliest first.
        start = (((), self._config(-1, 0)),)
        self.numbers = {start: 0}
        self.states = [start]
        self.steps: list[dict[int, tuple[int, tuple[int, ...]]]] = [{}]

    def _config(self, before: int, node: int) -> int:
        key = (before, node)
        number = self.config_numbers.get(key)
        if number is None:
            number = self.config_numbers[key] = len(self.configs)
            self.configs.append(key)
        return number

    def _move(self, config: int, byte: int) -> tuple[int, int, int]:
        """The longer configuration (or -1), the token that may end here (or -1) and the configuration after it."""
        before, node = self.configs[config]
        following = self.children[node].get(byte)
        longer = token = fresh = -1
        if following is not None:
            if self.children[following]:
                longer = self._config(before, following)
            ends = self.ends[following]
            if ends >= 0 and self.compatible(before, ends):
                token, fresh = ends, self._config(ends, 0)
        known = self.moves[config << 8 | byte] = (longer, token, fresh)
        return known

    def merged(self, piece: bytes) -> list[int]:
        """Plain merging of a short string: the lowest rank first, the leftmost among equals."""
        parts = [piece[i:i + 1] for i in range(len(piece))]
        ranks = self.ranks
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                rank = ranks.get(parts[i] + parts[i + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [ranks[p] for p in parts]

    def compatible(self, left: int, right: int) -> bool:
        if left < 0:
            return True
        key = (left, right)
        known = self.compatible_pairs.get(key)
        if known is None:
            if len(self.compatible_pairs) >= self.max_pairs:
                self.compatible_pairs.clear()
            known = self.merged(self.token_of[left] + self.token_of[right]) == [left, right]
            self.compatible_pairs[key] = known
        return known

    def step(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        """The next state and the tokens put out; built on first use."""
        live: list[tuple[tuple[int, ...], int]] = []
        moves = self.moves
        for tokens, config in self.states[state]:
            longer, token, fresh = moves.get(config << 8 | byte) or self._move(config, byte)
            if longer >= 0:
                live.append((tokens, longer))
            if token >= 0:
                live.append(((*tokens, token), fresh))
        out: tuple[int, ...] = ()
        if live[0][0]:
            agreed = _common([tokens for tokens, _ in live])
            if agreed:
                out = live[0][0][:agreed]
                live = [(tokens[agreed:], config) for tokens, config in live]
        key = tuple(live)
        number = self.numbers.get(key)
        if number is None:
            number = self.numbers[key] = len(self.states)
            self.states.append(key)
            self.steps.append({})
        self.steps[state][byte] = (number, out)
        return number, out

    def encode(self, piece: bytes) -> list[int]:
        """Tokens of one piece; a piece that is itself a token is that token."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(self.states) > self.max_states or len(self.moves) > self.max_pairs:
            self.reset()
        steps, state, out = self.steps, 0, []
        for byte in piece:
            known = steps[state].get(byte)
            state, tokens = known if known is not None else self.step(state, byte)
            if tokens:
                out += tokens
        # At the end, the path which stands at the root holds the rest.
        for tokens, config in reversed(self.states[state]):
            if not self.configs[config][1]:
                out += tokens
                break
        return out


def _common(sequences: list[tuple[int, ...]]) -> int:
    """Length of the common beginning."""
    low, high = min(sequences), max(sequences)
    n = min(len(low), len(high))
    for i in range(n):
        if low[i] != high[i]:
            return i
    return n


#: Lead bytes: how many bytes follow, and the range of the first of these (as the Unicode standard's table 3-7).
_FOLLOW = {b: (1, 0x80, 0xBF) for b in range(0xC2, 0xE0)} | {b: (2, 0x80, 0xBF) for b in range(0xE1, 0xF0)}
_FOLLOW |= {b: (3, 0x80, 0xBF) for b in range(0xF1, 0xF4)}
_FOLLOW |= {0xE0: (2, 0xA0, 0xBF), 0xED: (2, 0x80, 0x9F), 0xF0: (3, 0x90, 0xBF), 0xF4: (3, 0x80, 0x8F)}


class Utf8Stream:
    """Incremental decoding: signs come out as soon as their last byte is in.

    The state is the unfinished sign at the end of what came in, at most three bytes, found
    by the lead byte's count of following bytes and the range of the first of these. What
    can't be UTF-8 becomes U+FFFD.
    """

    def __init__(self):
        self.pending = b""

    def feed(self, data: bytes) -> str:
        data = self.pending + data
        cut = len(data) - self._unfinished(data)
        self.pending = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def finish(self) -> str:
        rest, self.pending = self.pending, b""
        return rest.decode("utf-8", "replace")

    @staticmethod
    def _unfinished(data: bytes) -> int:
        for back in range(1, min(3, len(data)) + 1):
            b = data[-back]
            if 0x80 <= b < 0xC0:
                continue
            n, low, high = _FOLLOW.get(b, (0, 0, 0))
            if n >= back and (back == 1 or low <= data[-back + 1] <= high):
                return back
            return 0
        return 0


class _Encoded(dict):
    """Identifiers of pieces as little-endian unsigned 32-bit integers."""

    def __init__(self, transducer: Transducer, limit: int):
        self.transducer, self.limit = transducer, limit

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= self.limit:
            self.clear()
        ids = self[piece] = np.array(self.transducer.encode(piece.encode("utf-8", "surrogatepass")), "<u4").tobytes()
        return ids


class Codec:
    def __init__(self, content: bytes, pattern: str, pieces: int = PIECES):
        ranks = read_ranks(content)
        self.pattern = regex.compile(pattern)
        self.encoded = _Encoded(Transducer(ranks), pieces)
        self.vocabulary = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.vocabulary[rank] = token

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.encoded.__getitem__, self.pattern.findall(text))), "<u4")

    def decode(self, ids: np.ndarray) -> Iterator[str]:
        """The text in parts."""
        stream, vocabulary = Utf8Stream(), self.vocabulary
        for low in range(0, len(ids), DECODE_BYTES):
            part = stream.feed(b"".join(map(vocabulary.__getitem__, ids[low:low + DECODE_BYTES].tolist())))
            if part:
                yield part
        part = stream.finish()
        if part:
            yield part


_CODECS: dict[int, Codec] = {}


def codec_of(content: bytes, pattern: str) -> Codec:
    """One codec a worker and vocabulary."""
    key = hash((content, pattern))
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(content, pattern)
    return _CODECS[key]


def _rank_file(df: DataFrame, path: str):
    with open(path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encoded(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", column: str = "ids") -> DataFrame:
    """The rows, with an array of token identifiers in place of the text.

    Null and empty texts give an empty array; rows are handled one by one, so repeated
    rows, null keys and empty tables are no special case. A clashing column name is
    lengthened by underscores. Texts are encoded whole.
    """
    shared = _rank_file(docs, ranks_path)
    kept = [c for c in docs.columns if c != text]
    column = free_name(docs.select(*kept), column)
    out = StructType([*docs.select(*kept).schema.fields]).add(column, ArrayType(LongType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(shared.value, pattern)
        for chunk in chunks(batches, text):
            ids = [codec.encode(chunk.text(i).decode("utf-8", "replace")) for i in range(len(chunk))]
            ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            flat = np.concatenate(ids).astype(np.int64) if ids else np.zeros(0, np.int64)
            yield appended(chunk.rows.select(kept), {column: pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))})

    return docs.mapInArrow(run, out)


def decoded(rows: DataFrame, ranks_path: str, pattern: str, ids: str = "ids", column: str = "text") -> DataFrame:
    """The rows, with the text in place of the identifiers; null arrays give an empty text."""
    shared = _rank_file(rows, ranks_path)
    kept = [c for c in rows.columns if c != ids]
    column = free_name(rows.select(*kept), column)
    out = StructType([*rows.select(*kept).schema.fields]).add(column, "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(shared.value, pattern)
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(ids))
            texts = ["".join(codec.decode(np.array(x.as_py() or [], np.int64))) for x in lists]
            yield appended(batch.select(kept), {column: pa.array(texts, pa.string())})

    return rows.mapInArrow(run, out)


def round_trip(
    docs: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row a document: key, n_tokens, SHA-256 of the identifiers and of the bytes decoded from them.

    Encoding and decoding run in one pass over the text. Null texts count as empty; null
    keys and repeated rows keep their own rows.
    """
    shared = _rank_file(docs, ranks_path)
    source = docs.select(docs[key], docs[text])
    out = StructType([
        source.schema[key], StructField("n_tokens", LongType()), StructField("ids_sha256", StringType()),
        StructField("decoded_sha256", StringType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(shared.value, pattern)
        for chunk in chunks(batches, text):
            counts, ids_digests, text_digests = [], [], []
            for i in range(len(chunk)):
                ids = codec.encode(chunk.text(i).decode("utf-8", "replace"))
                back = hashlib.sha256()
                for part in codec.decode(ids):
                    back.update(part.encode())
                counts.append(len(ids))
                ids_digests.append(hashlib.sha256(ids).hexdigest())
                text_digests.append(back.hexdigest())
            yield appended(chunk.rows.select([key]), {
                "n_tokens": np.array(counts, np.int64), "ids_sha256": pa.array(ids_digests, pa.string()),
                "decoded_sha256": pa.array(text_digests, pa.string()),
            })

    return source.mapInArrow(run, out)
