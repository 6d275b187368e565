"""Spans: where a pattern matches, how spans merge, how text is replaced.

A span is half open, in characters of the turn's text. Nothing here uses a UDF.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from hushline.functions.text import MARK, either, let
from hushline.rules import LABEL_ORDER, UNMAPPED_PLACEHOLDER

SPAN_TYPE = (
    "struct<start:int,end:int,entity:string,matched:string,score:double,detector:string>"
)
SPANS_TYPE = f"array<{SPAN_TYPE}>"
BLOCK_TYPE = "struct<start:int,end:int,entity:string>"
BLOCKS_TYPE = f"array<{BLOCK_TYPE}>"


def no_spans() -> Column:
    return F.array().cast(SPANS_TYPE)


def joined(*arrays: Column) -> Column:
    """Arrays of spans one after the other. A ``concat`` of arrays costs many times that where nothing is compiled (in lambdas)."""
    return F.flatten(F.array(*arrays))


def locate_all(
    text: Column, regex: str, entity: str, detector: str, score: float, group: bool = False
) -> Column:
    """Spans of all matches of ``regex`` in folded ``text``, in order.

    Spark returns matched strings but not where they are. One replace puts a mark
    on both sides of each match; splitting at the mark gives gaps and matches in
    turn, and running lengths give the offsets. With ``group`` the pattern must be
    ``(before)(wanted)`` and only the second group is reported.
    """
    template = f"$1{MARK}$2{MARK}" if group else f"{MARK}$0{MARK}"
    pieces = F.split(F.regexp_replace(text, F.lit(regex), F.lit(template)), MARK)

    walk = F.expr(_WALK.format(entity=_sql(entity), detector=_sql(detector), score=float(score)))
    keep = F.expr("(acc, x) -> acc")
    return F.call_function("aggregate", F.array().cast("array<int>"), pieces, keep, walk)


def _sql(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _sql_span(start: str, matched: str) -> str:
    return (
        f"cast(named_struct('start', {start}, 'end', {start} + length({matched}), 'entity', {{entity}}, "
        f"'matched', {matched}, 'score', {{score}}D, 'detector', {{detector}}) as {SPAN_TYPE})"
    )


#: From pieces (gap, match, gap, ...) to spans; one match is the usual case. Many pieces
#: are walked in blocks of about the root of their number, as an array that grows by one
#: is copied each time; the blocks' spans are then moved to their places. One SQL
#: lambda: built node by node from Python it costs a hundred calls into the JVM for
#: each pattern.
_WALK_BLOCK = f"""aggregate(
    {{pieces}},
    named_struct('at', 0, 'inside', false, 'spans', cast(array() as {SPANS_TYPE})),
    (acc, part) -> named_struct(
      'at', acc.at + length(part),
      'inside', not acc.inside,
      'spans', if(acc.inside, concat(acc.spans, array({_sql_span("acc.at", "part")})), acc.spans)))"""
_WALK = f"""parts ->
  if(size(parts) < 3, cast(array() as {SPANS_TYPE}),
  if(size(parts) = 3, array({_sql_span("length(parts[0])", "parts[1]")}),
  if(size(parts) <= 65, {_WALK_BLOCK.format(pieces="parts", entity="{entity}", detector="{detector}", score="{score}")}.spans,
  aggregate(
    transform(
      sequence(0, (size(parts) - 1) div (2 * int(sqrt(size(parts))))),
      b -> {_WALK_BLOCK.format(
          pieces="slice(parts, b * 2 * int(sqrt(size(parts))) + 1, 2 * int(sqrt(size(parts))))",
          entity="{entity}", detector="{detector}", score="{score}")}),
    named_struct('at', 0, 'spans', cast(array() as array<{SPANS_TYPE}>)),
    (acc, x) -> named_struct(
      'at', acc.at + x.at,
      'spans', concat(acc.spans, array(transform(x.spans, s -> cast(named_struct(
        'start', s.start + acc.at, 'end', s.end + acc.at, 'entity', s.entity, 'matched', s.matched,
        'score', s.score, 'detector', s.detector) as {SPAN_TYPE}))))),
    acc -> flatten(acc.spans)))))"""


def locate_first(text: Column, regex: str, entity: str, detector: str, score: float) -> Column:
    """The leftmost match only, as an array of at most one span."""
    return F.slice(locate_all(text, regex, entity, detector, score), 1, 1)


def whole(text: Column, entity: str, detector: str, score: float) -> Column:
    """The whole text as one span."""
    return F.array(_span(F.lit(0), F.length(text), text, entity, detector, score)).cast(SPANS_TYPE)


def _span(start: Column, end: Column, matched: Column, entity: str, detector: str, score: float) -> Column:
    fields = (start, end, F.lit(entity), matched, F.lit(score), F.lit(detector))
    return F.struct(*fields).cast(SPAN_TYPE)


def _lookup(mapping: dict[str, object], key: Column, default: object) -> Column:
    entries = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*entries), key), F.lit(default))


def merged(spans: Column, ordered: bool = False) -> Column:
    """Merge spans which overlap (touching is not overlapping) into blocks.

    ``ordered``: the spans are sorted already and bound to a name.

    A block takes the label of its longest span, then of the best score, then of
    the fixed label order, then by name.
    """
    ranks = {name: i for i, name in enumerate(LABEL_ORDER)}

    def claim(s: Column) -> Column:
        # Smaller is better, field by field.
        return F.struct(
            (s["start"] - s["end"]).alias("length"),
            (-s["score"]).alias("score"),
            _lookup(ranks, s["entity"], len(ranks)).alias("rank"),
            s["entity"].alias("entity"),
        )

    claim_type = "struct<length:int,score:double,rank:int,entity:string>"

    def block(start: Column, end: Column, best: Column) -> Column:
        return F.struct(
            start.alias("start"), end.alias("end"), best.cast(claim_type).alias("best")
        )

    open_type = f"struct<start:int,end:int,best:{claim_type}>"

    def step(acc: Column, s: Column) -> Column:
        last = F.get(acc, F.size(acc) - 1)

        def extend() -> Column:
            best = either(claim(s).cast(claim_type) < last["best"], claim(s).cast(claim_type), last["best"])
            grown = block(
                last["start"], F.greatest(last["end"], s["end"]), best
            )
            return F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(grown))

        fresh = F.concat(acc, F.array(block(s["start"], s["end"], claim(s))))
        return either((F.size(acc) > 0) & (s["start"] < last["end"]), extend(), fresh)

    def simple(s: Column) -> Column:
        return F.struct(s["start"].alias("start"), s["end"].alias("end"), s["entity"].alias("entity"))

    def inner(part: Column) -> Column:
        return F.aggregate(part, F.array().cast(f"array<{open_type}>"), step)

    def join(acc: Column, found: Column) -> Column:
        """Add the blocks of the next part; those which begin inside the open block go into it."""
        at = acc["open"]
        first = F.get(found, F.lit(0))
        eaten = F.filter(found, lambda x: x["start"] < at["end"])
        left = F.filter(found, lambda x: x["start"] >= at["end"])
        grown = block(
            at["start"],
            F.greatest(at["end"], F.coalesce(F.array_max(eaten["end"]), at["end"])),
            F.array_min(F.concat(F.array(at["best"]), eaten["best"])),
        ).cast(open_type)
        closed = F.concat(F.array(grown), F.slice(left, F.lit(1), F.greatest(F.size(left) - 1, F.lit(0))))
        going_on = either(
            F.size(left) == 0, F.struct(acc["done"].alias("done"), grown.alias("open")),
            F.struct(F.concat(acc["done"], F.array(closed)).alias("done"), F.get(left, F.size(left) - 1).alias("open")),
        )

        fresh = F.struct(
            F.concat(acc["done"], F.array(F.slice(found, F.lit(1), F.size(found) - 1))).alias("done"),
            F.get(found, F.size(found) - 1).alias("open"),
        )
        return either(first.isNull(), acc, either(at.isNull(), fresh, going_on))

    def in_parts(sorted_spans: Column) -> Column:
        zero = F.struct(
            F.array().cast(f"array<array<{open_type}>>").alias("done"), F.lit(None).cast(open_type).alias("open")
        )
        return F.aggregate(
            F.transform(parts(sorted_spans), inner), zero, join,
            lambda acc: F.concat(F.flatten(acc["done"]), F.array(acc["open"])),
        )

    def found_in(sorted_spans: Column) -> Column:
        return either(F.size(sorted_spans) <= FEW, inner(sorted_spans), in_parts(sorted_spans))

    found = found_in(spans) if ordered else let(F.array_sort(spans), found_in)
    many = F.transform(
        found,
        lambda b: F.struct(
            b["start"].alias("start"), b["end"].alias("end"), b["best"]["entity"].alias("entity")
        ),
    ).cast(BLOCKS_TYPE)
    return either(F.size(spans) < 2, F.transform(spans, simple).cast(BLOCKS_TYPE), many)


#: Up to this many spans are handled one after the other; more of them in parts, which give the same.
FEW = 32


def parts(items: Column) -> Column:
    """An array of more than no items cut into about the root of their number of parts."""
    width = F.ceil(F.sqrt(F.size(items))).cast("int")
    return F.transform(
        F.sequence(F.lit(0), F.floor((F.size(items) - 1) / width).cast("int")),
        lambda k: F.slice(items, k * width + 1, width),
    )


def as_written(text: Column, spans: Column) -> Column:
    """The spans, in order of their starts, with the text they cover.

    A cut walks the text from its beginning; so each part of many spans is cut out once,
    and its spans from that.
    """

    def cut(source: Column, base: Column | int, s: Column) -> Column:
        return s.withField("matched", F.substring(source, s["start"] - base + 1, s["end"] - s["start"]))

    def one(part: Column) -> Column:
        base = F.get(part, F.lit(0))["start"]
        reach = F.array_max(F.transform(part, lambda s: s["end"]))
        piece = F.substring(text, base + 1, reach - base)
        return F.struct(part.alias("part"), base.alias("base"), piece.alias("piece"))

    pieces = F.transform(parts(spans), one)
    return either(
        F.size(spans) <= FEW, F.transform(spans, lambda s: cut(text, F.lit(0), s)),
        F.flatten(F.transform(pieces, lambda c: F.transform(c["part"], lambda s: cut(c["piece"], c["base"], s)))),
    )


def replaced(text: Column, blocks: Column, placeholders: dict[str, str]) -> Column:
    """Put the placeholder of each block in place of its characters (F1)."""

    def pieces(source: Column, base: Column | int, part: Column) -> Column:
        def one(b: Column, k: Column) -> Column:
            before = F.coalesce(F.get(part, k - 1)["end"], base)
            gap = F.substring(source, before - base + 1, b["start"] - before)
            return F.concat(gap, _lookup(placeholders, b["entity"], UNMAPPED_PLACEHOLDER))

        return F.array_join(F.transform(part, one), "")

    last = F.get(blocks, F.size(blocks) - 1)["end"]
    rest = F.substring(text, last + 1, F.length(text))

    def in_parts(ps: Column) -> Column:
        def cut(part: Column, k: Column) -> Column:
            earlier = F.get(ps, k - 1)
            base = F.coalesce(F.get(earlier, F.size(earlier) - 1)["end"], F.lit(0))
            end = F.get(part, F.size(part) - 1)["end"]
            piece = F.substring(text, base + 1, end - base)
            return F.struct(part.alias("part"), base.alias("base"), piece.alias("piece"))

        return F.array_join(F.transform(F.transform(ps, cut), lambda c: pieces(c["piece"], c["base"], c["part"])), "")

    few = F.concat(pieces(text, F.lit(0), blocks), rest)
    many = F.concat(let(parts(blocks), in_parts), rest)
    return either(F.size(blocks) == 0, text, either(F.size(blocks) <= FEW, few, many))
