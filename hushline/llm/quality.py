"""Quality rules as a bitmask ledger.

Each text is measured once and every rule is evaluated once: the ledger holds the
measurements and one integer whose bit k says that rule k failed. Policies are named sets
of rules, that is masks; applying a new version of a policy, or asking what a policy would
keep without one of its rules, is bit arithmetic on the ledger and reads no text again.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from hushline.llm.arrowtext import UPPER, WHITE, Chunk, Hasher, WindowHasher, appended, chunks, mix, words
from hushline.llm.storage import free_name

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_same_next", "n_letters",
    "n_upper", "n_exclamations",
)
WINDOW = 5

_SYMBOL = np.zeros(256, bool)
_SYMBOL[np.frombuffer(b"#*$%&|<>", np.uint8)] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(0xC0, 0x100)]] = True
_WORD_HASHER, _WINDOW_HASHER = Hasher(3), WindowHasher(3)


def _repeated(keys: np.ndarray) -> np.ndarray:
    """Whether each key occurs twice or more."""
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    flags = np.zeros(len(keys), bool)
    flags[order[1:][same]] = True
    flags[order[:-1][same]] = True
    return flags


def _dup_lines(text: bytes) -> tuple[int, int]:
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return len(lines), len(lines) - len(set(lines))


def measured(chunk: Chunk) -> dict[str, np.ndarray]:
    """The measurements of the texts of a chunk."""
    data = chunk.data
    found = words(chunk, _WORD_HASHER)
    owner = found.owner()
    at = found.window_starts(WINDOW)
    keys = _WINDOW_HASHER.windows(found.hashes, at, WINDOW) ^ mix(owner[at].astype(np.uint64) + np.uint64(1))
    again = at[_repeated(keys)]
    edges = np.zeros(len(found.starts) + 1, np.int64)
    np.add.at(edges, again, 1)
    np.add.at(edges, again + WINDOW, -1)
    total = np.zeros(len(found.starts) + 1, np.int64)
    np.cumsum(np.cumsum(edges[:-1]) > 0, out=total[1:])
    same = np.zeros(len(found.starts) + 1, np.int64)
    if len(owner):
        np.cumsum((found.hashes[1:] == found.hashes[:-1]) & (owner[1:] == owner[:-1]), out=same[1:-1])
        same[-1] = same[-2]
    per_word = lambda sums: sums[found.first[1:]] - sums[found.first[:-1]]
    lines = np.array([_dup_lines(chunk.text(i)) for i in range(len(chunk))], np.int64).reshape(-1, 2)
    return {
        "n_words": found.counts.astype(np.int64),
        "word_chars": chunk.per_text(((data & 0xC0) != 0x80) & ~WHITE[data]),
        "n_symbols": chunk.per_text(_SYMBOL[data]),
        "n_lines": lines[:, 0],
        "n_dup_lines": lines[:, 1],
        "n_repeat_words": per_word(total),
        "n_same_next": per_word(same),
        "n_letters": chunk.per_text(_LETTER[data]),
        "n_upper": chunk.per_text(UPPER[data]),
        "n_exclamations": chunk.per_text(data == ord("!")),
    }


def with_measures(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> tuple[DataFrame, dict[str, str]]:
    """The rows with one column a measurement, and the names these columns got."""
    kept = docs.columns if keep is None else keep
    base = docs.select(*kept)
    names = {m: free_name(base, m) for m in MEASURES}
    out = StructType([*base.schema.fields, *(StructField(names[m], LongType()) for m in MEASURES)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, text):
            yield appended(chunk.rows.select(kept), {names[m]: v for m, v in measured(chunk).items()})

    return docs.select(*dict.fromkeys([*kept, text])).mapInArrow(run, out), names


@dataclass(frozen=True)
class Rule:
    """A rule fails where share * n_percent_of < 100 * n (a whole-number comparison), or below a least count."""

    name: str
    measure: str
    of: str | None = None
    above_percent: int | None = None
    below: int | None = None

    def failed(self, names: dict[str, str]) -> Column:
        value = F.col(names[self.measure])
        if self.of is None:
            return value < self.below
        return 100 * value > self.above_percent * F.col(names[self.of])


#: The bit of a rule is its place here; new rules are added at the end only.
RULES = (
    Rule("few_words", "n_words", below=10),
    Rule("repeated_windows", "n_repeat_words", "n_words", above_percent=20),
    Rule("symbols", "n_symbols", "n_words", above_percent=10),
    Rule("repeated_lines", "n_dup_lines", "n_lines", above_percent=40),
    Rule("stuttering", "n_same_next", "n_words", above_percent=20),
    Rule("capitals", "n_upper", "n_letters", above_percent=50),
    Rule("exclamations", "n_exclamations", "n_words", above_percent=30),
)
BASE = ("few_words", "repeated_windows")
#: Versions are never changed, only added.
POLICIES = {
    "v1": BASE,
    "v2": tuple(r.name for r in RULES),
}
CURRENT = "v2"


def mask(rules: tuple[str, ...]) -> int:
    names = [r.name for r in RULES]
    return sum(1 << names.index(r) for r in rules)


def with_failures(rows: DataFrame, names: dict[str, str], column: str = "failed") -> DataFrame:
    """Adds the integer of failure bits."""
    bits = F.lit(0).cast("long")
    for k, rule in enumerate(RULES):
        bits = bits.bitwiseOR(F.when(rule.failed(names), F.lit(1 << k)).otherwise(F.lit(0)).cast("long"))
    return rows.withColumn(column, bits)


def fails(failed: Column, rules: tuple[str, ...]) -> Column:
    """Whether any of the rules failed."""
    return failed.bitwiseAND(F.lit(mask(rules)).cast("long")) != 0


def ledger(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a document: key, measurements, `failed`.

    Null and empty texts have no words and so fail few_words. Null keys and repeated rows
    stay as they are, row by row. An empty table gives an empty ledger. Texts are measured whole.
    """
    rows, names = with_measures(docs.select(F.col(key), F.col(text)), text, keep=[key])
    return with_failures(rows, names)


def verdicts(rows: DataFrame, version: str = CURRENT, failed: str = "failed") -> DataFrame:
    """Adds base_failed and kept by a version of the policy."""
    bits = F.col(failed)
    return rows.withColumn("base_failed", fails(bits, BASE)).withColumn(
        "kept", ~fails(bits, BASE) & ~fails(bits, POLICIES[version])
    )


def ablations(rows: DataFrame, version: str = CURRENT, failed: str = "failed") -> DataFrame:
    """For each rule of a policy: documents that fail it, and those kept if it alone were dropped.

    Counts by bit pattern come first (at most two to the number of rules), so no rule reads the documents again.
    """
    patterns = rows.groupBy(F.col(failed).bitwiseAND(F.lit(mask(POLICIES[version])).cast("long")).alias("bits")).agg(
        F.count(F.lit(1)).alias("n")
    )
    rules = F.array(*(
        F.struct(F.lit(name).alias("rule"), F.lit(mask((name,))).cast("long").alias("bit")) for name in POLICIES[version]
    ))
    each = patterns.select("bits", "n", F.inline(rules))
    hit = F.col("bits").bitwiseAND(F.col("bit")) != 0
    return each.groupBy("rule").agg(
        F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("bits") == F.col("bit"), F.col("n")).otherwise(0)).alias("n_only_this"),
        F.sum("n").alias("n_documents"),
    )


def keep_good(docs: DataFrame, text: str = "text", version: str = CURRENT) -> DataFrame:
    """The documents which the policy keeps, columns unchanged.

    Nulls in other columns, repeated rows and columns named like measurements pass through;
    null and empty texts are rejected (no words).
    """
    rows, names = with_measures(docs, text)
    flag = free_name(rows, "failed")
    rows = with_failures(rows, names, flag)
    return rows.where(~fails(F.col(flag), BASE) & ~fails(F.col(flag), POLICIES[version])).select(*docs.columns)
