"""Spelling variants: words that differ by one sign, found by asymmetric q-chunks.

The longer word of a pair (either one, if they are equally long) contributes two disjoint
chunks, its halves; the other contributes its positional grams of the chunks' lengths. One
edit leaves one half as it is, and moves the other by one place at most, so grams within a
shift of one are all that can meet a chunk: those at the begin, and those that end with the
word. One half of a short word is shared by very many words, so the half with the edit is
halved once more in the same way: one of its parts is kept as well, and the join is on the
kept half and the kept part together. What a group's words do not share is then a quarter of
the word. Pairs are verified by their edit distance, and counted at the quarter in which
their first difference lies, so that none comes twice.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from hushline.llm.arrowtext import chunks
from hushline.llm.storage import written

#: Least signs and occurrences of a word; how many times as frequent its form has to be.
LEAST_LENGTH, LEAST_COUNT, FORM_TIMES = 7, 2, 10
#: A run whose checksum this divides loses one sign.
DAMAGED = 31
#: Distinct words that a task counts before it sends the counts on, and bytes of a text cut at a time.
HELD, PIECE = 300_000, 1 << 20

_LETTER = rb"A-Za-z\xc0-\xff"


def _pieces(signs: bytes) -> Iterator[bytes]:
    """Parts of a text which begin and end at no letter's cost."""
    low, gap = 0, re.compile(rb"[^" + _LETTER + rb"]")
    while len(signs) - low > PIECE:
        found = gap.search(signs, low + PIECE)
        if not found:
            break
        yield signs[low:found.start()]
        low = found.start()
    yield signs[low:]


def runs(text: bytes, least: int) -> Iterator[bytes]:
    """Runs of A-Z a-z and U+00C0 to U+00FF with `least` signs or more, A-Z lower-cased, one byte a sign."""
    # Signs beyond one byte become a question mark, which is no letter.
    signs = text if text.isascii() else text.decode("utf-8", "replace").encode("latin-1", "replace")
    pattern = re.compile(rb"[" + _LETTER + rb"]{%d,}" % least)
    for piece in _pieces(signs):
        yield from pattern.findall(piece.lower())


def damaged(run: bytes, start: int) -> bytes:
    """The run without one sign if the checksum of `<key>:<run>` is a multiple of DAMAGED; start is that of `<key>:`."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
    if h % DAMAGED:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST_LENGTH) -> DataFrame:
    """(word, n): the words of all texts and how often they come.

    Words are summed inside a task first, in a table of bounded size. A null key counts as
    an empty one, a null text as none.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            words = pa.array([w.decode("latin-1") for w in held], pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(held.values(), pa.int64())], names=["word", "n"])

        for chunk in chunks(batches, "text"):
            keys = chunk.rows.column(chunk.rows.schema.get_field_index("key")).to_pylist()
            for i, name in enumerate(keys):
                start = zlib.crc32(f"{name}:".encode())
                for found, times in Counter(runs(chunk.text(i), least)).items():
                    word = damaged(found, start)
                    if len(word) >= least:
                        held[word] += times
                if len(held) > HELD:
                    yield out()
                    held.clear()
        if held:
            yield out()

    named = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"), F.col(text).alias("text"))
    return named.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _quarters(length: Column) -> list[tuple[Column, Column]]:
    """Begin and end of the four parts of a word: its halves, halved."""
    half = F.floor(length / 2)
    first, third = F.floor(half / 2), half + F.floor((length - half) / 2)
    ends = [F.lit(0), first, half, third, length]
    return [(a.cast("int"), b.cast("int")) for a, b in zip(ends, ends[1:])]


def _kept(word: Column, length: Column, longer: int) -> Column:
    """What is kept around each quarter of a word with `longer` more signs, as (quarter, length, hash)."""
    whole = (length + longer).cast("int")
    return F.array(*(
        F.struct(
            F.lit(i).alias("quarter"), low.alias("low"), high.alias("high"),
            F.xxhash64(
                F.lit(i), whole, F.substring(word, F.lit(1), low), F.substring(word, high + 1 - longer, whole - high)
            ).alias("kept"),
        )
        for i, (low, high) in enumerate(_quarters(whole))
    ))


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, n, other, other_n): each pair one edit apart once, the longer or the lesser word first.

    words: distinct (word, n). Words of four signs and more.
    """
    length = F.length("word")
    chunk = words.select("word", "n", F.explode(_kept(F.col("word"), length, 0)).alias("k")).select(
        "word", "n", F.col("k.low").alias("low"), F.col("k.high").alias("high"), F.col("k.kept").alias("kept")
    )
    grams = F.concat(_kept(F.col("word"), length, 0), _kept(F.col("word"), length, 1))
    gram = words.select(
        F.col("word").alias("other"), F.col("n").alias("other_n"), F.explode(F.transform(grams, lambda k: k["kept"])).alias("kept")
    )
    word, other, low, high = (F.col(c) for c in ("word", "other", "low", "high"))
    # The first difference lies in this quarter: the same up to it, not the same with it.
    first_here = (F.substring(word, F.lit(1), low) == F.substring(other, F.lit(1), low)) & (
        F.substring(word, F.lit(1), high) != F.substring(other, F.lit(1), high)
    )
    ordered = (F.length(word) > F.length(other)) | (word < other)
    return chunk.join(gram, "kept").where(ordered & first_here & (F.levenshtein(word, other, 1) == 1)).select(
        "word", "n", "other", "other_n"
    )


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): forms followed to the last, twice as far in each round.

    A form is FORM_TIMES as frequent as its word, so chains are as short as the digits of a count.
    """
    reached = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = written(reached.join(ahead, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
        ), "roots")
        reached = step.drop("moved")
        if step.where("moved").isEmpty():
            return reached


def variants(
    docs: DataFrame, key: str = "doc_id", text: str = "text",
    least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, times: int = FORM_TIMES,
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each word of the texts.

    Words are runs of letters after the damage of `damaged`, with at least `least_length`
    (four or more) signs and `least_count` occurrences over all rows. form is the near word
    that comes most often (ties: the first in code-point order) if it comes `times` as often
    as the word, else null; root the last of the chain of forms, the word itself without one.

    Null and empty texts have no words; an empty table, or one without such words, gives no
    rows. Repeated rows count as often as they come; rows with a null key count as those of
    an empty key. Texts of any length are cut whole, in pieces between words. Other columns
    of docs, whatever their names, are not looked at.
    """
    if least_length < 4:
        raise ValueError("words of at least four signs are asked for")
    words = written(word_counts(docs, key, text, least_length).where(F.col("n") >= least_count), "words")
    pairs = written(near_pairs(words), "near")
    ways = pairs.unionByName(pairs.select(
        F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")
    ))
    best = ways.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.max("n").alias("own"), F.min(F.struct((-F.col("other_n")).alias("minus"), "other")).alias("best")
    )
    enough = -F.col("best.minus") >= times * F.col("own")
    best = written(best.select(
        "word", "n_near", F.when(enough, F.col("best.other")).alias("form"), F.when(enough, -F.col("best.minus")).alias("form_n")
    ), "best")
    last = roots(best.where("form is not null"))
    out = words.join(best, "word", "left").join(last, "word", "left")
    return out.select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n"
    )
