"""Names from a table, and spans from a user's model."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from hushline.functions.rows import explode_items
from hushline.functions.spans import locate_all
from hushline.functions.text import MARK, MARK_STAND_IN, fold, let, pattern
from hushline.rules import DEFAULT_RULES, SPOKEN_SCORE, Rules

DETECTION_TYPE = "entity string, start int, end int, matched string, score double, detector string"

#: A word with inner hyphens and apostrophes, and the blanks after it. Words with nothing
#: but blanks between them are then neighbours, and punctuation parts them.
_BARE_WORD = r"(?<![\p{L}\p{N}])\p{L}++(?:['’-]\p{L}++)*+(?![\p{L}\p{N}])"
_WORD = _BARE_WORD + r"[\s\x1c-\x1f]*+"


def _plain(word: Column) -> Column:
    """Folded, with straight apostrophes and no blanks at the end."""
    bare = F.regexp_replace(word, r"(?U)[\s\x1c-\x1f]+\z", "")
    return let(bare, lambda w: F.replace(fold(w), F.lit("’"), F.lit("'")))


def name_table(names: DataFrame, column: str = "name") -> DataFrame:
    """Distinct folded names: the first word, and the words after it.

    Names may have several words, hyphens and apostrophes, and be as short as one letter.
    """
    words = F.filter(F.split(_plain(F.trim(F.col(column))), r"(?U)[\s\x1c-\x1f]+"), lambda w: w != "")
    folded = names.select(words.alias("_words")).where(F.size("_words") > 0).distinct()
    return folded.select(
        F.get("_words", F.lit(0)).alias("_first"), F.slice("_words", F.lit(2), F.size("_words")).alias("_rest")
    )


def _folded_words(text: Column) -> Column:
    """The words of a text in order, folded. Folding keeps every letter one letter, so the folded text falls into the same words."""
    straight = let(text, lambda t: F.replace(fold(t), F.lit("’"), F.lit("'")))
    marked = F.regexp_replace(straight, F.lit(pattern(_BARE_WORD)), F.lit(f"{MARK}$0{MARK}"))
    return F.filter(F.split(marked, MARK), lambda _, i: i % 2 == 1)


#: Bits of the screen before the join with the names: 1 MB, whatever the number of names.
SCREEN_BITS = 1 << 23


def _place(words: Column) -> Column:
    """The bit of a row of words."""
    return F.pmod(F.xxhash64(words), F.lit(SCREEN_BITS))


def _screen(names: DataFrame) -> Column:
    """Of a table of names (``_name``, arrays of words), as a subquery: the numbers of words they have, and a bit set for
    each name and its first one and two words."""
    name = F.col("_name")
    begins = F.array_distinct(F.array(F.slice(name, 1, 1), F.slice(name, 1, 2), name))
    places = names.select(F.size(name).alias("n"), F.explode(begins).alias("_words")).select("n", _place(F.col("_words")).alias("place"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("place") % 64).cast("int"))
    slots = places.groupBy(F.shiftright("place", 6).alias("id")).agg(F.bit_or(bit).alias("bits"), F.collect_set("n").alias("lengths"))
    slots = names.sparkSession.range(SCREEN_BITS // 64).join(slots, "id", "left")
    bits = F.array_sort(F.collect_list(F.struct("id", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))))
    return slots.agg(F.struct(
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("lengths")))).alias("lengths"),
        F.transform(bits, lambda s: s["bits"]).alias("bits"),
    ).alias("screen")).scalar()


def _no_gap(words: Column) -> Column:
    """Each word starts where the one before ends."""
    return F.forall(
        F.sequence(F.lit(1), F.greatest(F.size(words) - 1, F.lit(1))),
        lambda i: F.coalesce(F.get(words, i)["start"] == F.get(words, i - 1)["end"], F.lit(True)),
    )


def _forms(word: Column) -> Column:
    """A genitive also stands for the name itself."""
    return F.when(word.endswith("'S"), F.array(word, F.substring(word, F.lit(1), F.length(word) - 2))).otherwise(F.array(word))


def _said(content: Column, screen: Column, rules: Rules) -> Column:
    """Rows of words which may be a name: start, text as written, and the words folded.

    Words at which no name begins are passed over by one look at the screen; what is left is cut
    from the text with as many words as the names have. Nothing is left out that is a name, but
    for those which begin with a deny word: they would be dropped later all the same.
    """
    def may_be(words: Column) -> Column:
        return let(_place(words), lambda at: F.getbit(F.get(screen["bits"], F.shiftright(at, 6).cast("int")), (at % 64).cast("int")) == 1)

    def begins(word: Column) -> Column:
        return F.exists(_forms(word), lambda f: may_be(F.array(f))) & ~word.isin(*rules.deny_words)

    def of_line(line: Column, n: Column) -> Column:
        first, last, rest = F.get(line, F.lit(0)), F.get(line, n - 1), F.slice(line, F.lit(2), n - 1)
        text = F.array_join(F.transform(line, lambda w: w["raw"]), "")
        text = F.regexp_replace(text, r"(?U)[\s\x1c-\x1f]+\z", "")
        known = F.transform(F.slice(rest, F.lit(1), F.greatest(n - 2, F.lit(0))), lambda w: w["word"])

        def one(name: Column, cut: Column) -> Column:
            # A genitive's ending is no part of the name, unless the table has it.
            return F.struct(
                first["start"].alias("start"), F.substring(text, F.lit(1), F.length(text) - cut).alias("matched"), name.alias("name")
            )

        def all_of(form: Column) -> Column:
            ends = F.transform(_forms(last["word"]), lambda e: one(F.concat(F.array(form), known, F.array(e)), F.length(last["word"]) - F.length(e)))
            # What a longer name goes on with has its bit as well.
            longer = F.when(n == 2, F.lit(True)).otherwise(may_be(F.array(form, F.get(line, F.lit(1))["word"])))
            return F.when(n == 1, F.array(one(F.array(form), F.length(first["word"]) - F.length(form)))).when(longer, ends)

        found = F.flatten(F.filter(F.transform(_forms(first["word"]), all_of), lambda x: x.isNotNull()))
        return F.when((F.size(line) == n) & _no_gap(line), F.filter(found, lambda x: may_be(x["name"])))

    def at_word(words: Column, i: Column) -> Column:
        lengths = F.filter(screen["lengths"], lambda n: n <= F.size(words) - i)
        lines = F.transform(lengths, lambda n: let(F.slice(words, i + 1, n), lambda line: of_line(line, n)))
        return F.flatten(F.filter(lines, lambda x: x.isNotNull()))

    def cut(text: Column, folded: Column) -> Column:
        hits = locate_all(text, pattern(_WORD), "PERSON", "gazetteer", SPOKEN_SCORE)
        words = F.transform(hits, lambda h, i: F.struct(
            h["start"].alias("start"), h["end"].alias("end"), h["matched"].alias("raw"), F.get(folded, i).alias("word")
        ))
        return let(words, lambda ws: F.flatten(F.filter(
            F.transform(ws, lambda w, i: F.when(begins(w["word"]), at_word(ws, i))), lambda x: x.isNotNull()
        )))

    def search(text: Column) -> Column:
        return let(_folded_words(text), lambda folded: F.when(F.exists(folded, begins), cut(text, folded)))

    return let(F.translate(content, MARK, MARK_STAND_IN), search)


def gazetteer_detections(
    turns: DataFrame, names: DataFrame, *keys: str, content: str = "content", rules: Rules = DEFAULT_RULES,
) -> DataFrame:
    """PERSON spans of the names in ``names`` (made by ``name_table``).

    The turns are read once. Inside its row each text is cut into words, and only rows of words
    whose bits are set in a screen of the names become rows; they are joined with the names on all
    their words at once, so many names which begin alike do not multiply. The screen is a
    subquery of bounded size inside the plan, so no job runs while it is built. A very long name
    costs only where its first two words are said.

    Spark picks the join by the measured sizes; where both sides are shuffled, the words of
    the turns are the side which adaptive execution splits when one name is very frequent.
    """
    names = names.select(F.concat(F.array("_first"), F.col("_rest")).alias("_name"))
    said = let(F.col("_screen"), lambda screen: _said(F.col(content), screen, rules))
    # A subquery may not be named inside a lambda. It is used once, so both selects become one and no row holds it.
    screened = turns.where(F.col(content).isNotNull()).select(*keys, "turn", "role", content, _screen(names).alias("_screen"))
    rows = explode_items(screened.select(*keys, "turn", "role", said.alias("_said")), F.col("_said"), *keys, "turn", "role")
    rows = rows.select(*keys, "turn", "role", "_item.start", "_item.matched", F.col("_item.name").alias("_name"))
    return rows.join(names, "_name").select(
        *keys, "turn", "role", F.lit("PERSON").alias("entity"), "start",
        (F.col("start") + F.length("matched")).alias("end"), "matched",
        F.lit(SPOKEN_SCORE).alias("score"), F.lit("gazetteer").alias("detector"),
    )


Model = Callable[[Sequence[str]], Sequence[Sequence[tuple[str, int, int, float]]]]


def model_detections(
    turns: DataFrame, load: Callable[[], Model], *keys: str, content: str = "content"
) -> DataFrame:
    """Spans of a user's own model: ``load`` runs once per task, the model once per batch.

    The model takes texts and gives (entity, start, end, score) for each.
    """
    chosen = turns.where(F.col(content).isNotNull()).select(*keys, "turn", "role", F.col(content).alias("_text"))
    fields = [f"{f.name} {f.dataType.simpleString()}" for f in chosen.schema if f.name != "_text"]

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        model = load()
        for batch in batches:
            rows = [
                (*head, entity, start, end, text[start:end], score, "model")
                for head, text, spans in zip(
                    batch.drop(columns="_text").itertuples(index=False, name=None),
                    batch["_text"], model(list(batch["_text"])),
                )
                for entity, start, end, score in spans
            ]
            columns = [c for c in batch.columns if c != "_text"]
            yield pd.DataFrame(
                rows, columns=[*columns, "entity", "start", "end", "matched", "score", "detector"]
            )

    return chosen.mapInPandas(run, ", ".join([*fields, DETECTION_TYPE]))
