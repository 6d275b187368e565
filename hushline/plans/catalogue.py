"""The registered queries: name to a function of (session, data folder)."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from hushline.functions.rows import explode_items
from hushline.functions.spans import SPANS_TYPE, merged
from hushline.functions.text import fold
from hushline.operators import analytics, audit
from hushline.operators.context import elements_context, flag_columns, with_context
from hushline.operators.filters import (
    apply_filters, combined_filter, conversational_filter, conversational_share, deny_filter, looks_conversational,
)
from hushline.operators.lookups import gazetteer_detections, name_table
from hushline.operators.redaction import (
    flat_transcript, redact_text, redact_transcripts, redact_turns, redacted_turns, transcript_json, turn_spans,
)
from hushline.operators.registry import SPOKEN
from hushline.operators.spoken import Turn
from hushline.plans.job import observed_counts, redact_with_lookups
from hushline.rules import DEFAULT_RULES, Rules
from hushline.sources.calls import QUESTIONS, SCENARIOS, call_transcripts, call_turns, dealt
from hushline.sources.scratch import shared_path
from hushline.sources.sinks import output_rows, write_rows
from hushline.sources.transcripts import (
    assemble_transcripts, explode_turns, parse_transcripts, quarantined, select_rows,
)

Query = Callable[[SparkSession, str], DataFrame]

#: The given conversations hold none of the default trigger phrases; these they do hold.
CONVERSATION_RULES = Rules(indicators={
    "reference_number": ("CODE",), "bank_digits": ("NUMBER",), "card_digits": ("CARD",),
    "name": ("WHO",), "address": ("WHERE",), "postcode": ("WHAT",), "email": ("HOW",),
    "password": ("THE",), "phone_number": ("HELP",),
})

def _key() -> Column:
    return F.col("transaction_id").cast("long").alias("conv_id")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select("doc_id", "text")


def _conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "conversations").withColumnRenamed("text", "content")


def _parsed_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_transcripts(call_transcripts(spark, sf_dir))


def _redacted_calls(spark: SparkSession, sf_dir: str, rules: Rules = DEFAULT_RULES) -> DataFrame:
    return redact_transcripts(_parsed_calls(spark, sf_dir), rules)


# -- reading and parsing ------------------------------------------------------

def scan_where(spark, sf_dir):
    return select_rows(
        _table(spark, sf_dir, "documents"), ("doc_id", "lang", "n_chars"), "lang = 'en' and n_chars > 500"
    )


def sample_ordered(spark, sf_dir):
    return select_rows(
        call_transcripts(spark, sf_dir).withColumn("key", F.col("transaction_id").cast("long")),
        ("key", "transaction_id", "transcription"), "file_date >= date'1996-01-01'", limit=100,
    )


def sample_all(spark, sf_dir):
    """The published production cap, which no table here reaches: all rows."""
    return select_rows(
        call_transcripts(spark, sf_dir), ("transaction_id", "file_date"), limit=999_999_999, order_by="transaction_id"
    )


def messy_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transcripts of every shape that can go wrong, one per order."""
    key = F.col("o_orderkey")
    shown = key.cast("string")
    turn = F.concat(F.lit('{"role":"agent","content":"CALL '), shown, F.lit('"}'))
    shapes = (
        F.concat(F.lit("["), turn, F.lit(',{"content":"NO ROLE"}]')),
        F.lit(None).cast("string"),
        F.concat(F.lit("NOT JSON "), shown),
        turn,
        F.concat(F.lit('["A BARE STRING",{"note":'), shown, F.lit("},"), turn, F.lit("]")),
        F.lit("[]"),
        F.concat(F.lit("["), turn),
        F.concat(F.lit('[{"role":"agent","content":null},{"role":"customer","content":'), shown, F.lit("}]")),
        F.concat(F.lit("["), turn, F.lit("] ["), turn, F.lit("]")),
        F.concat(F.lit("["), turn, F.lit("] junk [1]")),
        F.concat(F.lit("["), turn, F.lit("]] junk [["), turn, F.lit("]")),
        F.concat(F.lit("["), turn, F.lit("]] , [["), turn, F.lit("]")),
        F.concat(F.lit('[{"role":"agent","content":"A ] IN \\"QUOTES\\" [ '), shown, F.lit('"},[["]",[]],'), shown, F.lit("]]")),
    )
    text = None
    for i, shape in enumerate(shapes):
        text = F.when(key % 13 == i, shape) if text is None else text.when(key % 13 == i, shape)
    orders = dealt(_table(spark, sf_dir, "orders").select("o_orderkey"))
    return orders.select(key.alias("conv_id"), text.alias("transcription"))


def parse_status(spark, sf_dir):
    parsed = parse_transcripts(messy_transcripts(spark, sf_dir))
    return parsed.select(
        "conv_id", "status", F.coalesce(F.size("elements"), F.lit(-1)).alias("elements"),
        F.size(F.filter("elements", lambda e: e["is_turn"])).alias("turns"),
    )


def parse_turns(spark, sf_dir):
    return explode_turns(parse_transcripts(messy_transcripts(spark, sf_dir)), "conv_id")


def quarantine(spark, sf_dir):
    return quarantined(parse_transcripts(messy_transcripts(spark, sf_dir)), "conv_id")


def non_turns_kept(spark, sf_dir):
    done = redact_transcripts(parse_transcripts(messy_transcripts(spark, sf_dir)))
    return done.select("conv_id", transcript_json(F.col("redacted")).alias("transcription"))


def json_bytes(spark, sf_dir):
    """Published JSON byte for byte: signs beyond ASCII and the basic plane, control characters, backslashes."""
    key = F.col("c_custkey").cast("string")
    said = F.concat(
        F.lit("STRASSE Straße "), key, F.lit(" 😀 "), F.chr(F.lit(31)), F.lit('\t"QUOTE" \\ \\u001F '), F.chr(F.lit(127)), F.col("c_name")
    )
    turn = F.struct(F.lit("agent").alias("role"), said.alias("content"))
    rows = dealt(_table(spark, sf_dir, "customer").select("c_custkey", "c_name")).select(
        "c_custkey", F.concat(F.lit("["), F.to_json(turn), F.lit(',"ÄÖ 𝄞"]')).alias("transcription")
    )
    done = redact_transcripts(parse_transcripts(rows, keep_original=None))
    published = transcript_json(F.col("redacted"))
    return done.select("c_custkey", published.alias("transcription"), F.sha2(published, 256).alias("sha256"))


def json_roundtrip(spark, sf_dir):
    """Turn rows to JSON transcripts and back: nothing is lost or reordered."""
    whole = assemble_transcripts(_conversations(spark, sf_dir))
    return explode_turns(parse_transcripts(whole), "conv_id")


def flatten_transcript(spark, sf_dir):
    return assemble_transcripts(_conversations(spark, sf_dir)).select(
        "conv_id", "part", "turns", F.col("flat").alias("redacted_transcript")
    )


# -- context -----------------------------------------------------------------

def turns_with_context(spark, sf_dir):
    known = with_context(call_turns(spark, sf_dir))
    return known.select("conv_id", "turn", "role", *flag_columns(F.col("context")))


def transcript_context(spark, sf_dir):
    bits = elements_context(F.col("elements"), DEFAULT_RULES)
    rows = explode_items(_parsed_calls(spark, sf_dir), bits, _key(), position="turn")
    return rows.select("conv_id", "turn", *flag_columns(F.col("_item")))


def context_flag_counts(spark, sf_dir):
    flags = turns_with_context(spark, sf_dir)
    names = [c for c in flags.columns if c.startswith("expects_")]
    return flags.agg(F.count("*").alias("turns"), *[F.count_if(n).alias(n) for n in names])


def conversation_context(spark, sf_dir):
    known = with_context(_conversations(spark, sf_dir), CONVERSATION_RULES)
    return known.select("conv_id", "turn", "role", *flag_columns(F.col("context")))


def sparse_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as turns numbered by microseconds: two of three are one conversation."""
    key = F.col("event_id")
    phrase = F.element_at(F.array(*[F.lit(q) for q in QUESTIONS]), (key % SCENARIOS + 1).cast("int"))
    return _table(spark, sf_dir, "events").select(
        F.when(key % 3 == 0, F.col("user_id") + 1).otherwise(0).cast("long").alias("conv_id"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("turn"), key.alias("event_id"), phrase.alias("content"),
    )


def context_sparse(spark, sf_dir):
    known = with_context(sparse_turns(spark, sf_dir))
    return known.select("conv_id", "event_id", *flag_columns(F.col("context")))


# -- detection ---------------------------------------------------------------

def _found(turns: DataFrame, spans: Column) -> DataFrame:
    return audit.detections(turns.select("conv_id", "turn", "role", spans.alias("spans")), "conv_id")


def _call_turns_with_bits(spark, sf_dir) -> DataFrame:
    """Turn rows of parsed transcripts with their context: no shuffle."""
    bits = elements_context(F.col("elements"), DEFAULT_RULES)
    pairs = F.arrays_zip(F.col("elements").alias("element"), bits.alias("context"))
    rows = explode_items(_parsed_calls(spark, sf_dir), pairs, _key(), position="turn")
    return rows.select("conv_id", "turn", "_item.element.role", "_item.element.content", "_item.context")


def detect_kind(kind: str, spark, sf_dir):
    turns = _call_turns_with_bits(spark, sf_dir)
    return _found(turns, turn_spans(F.col("content"), F.col("context"), only=kind))


def _document_spans(spark, sf_dir, names: tuple[str, ...], rules: Rules = DEFAULT_RULES) -> DataFrame:
    parts = [turn_spans(F.col("text"), F.lit(0), rules, only=n) for n in names]
    return explode_items(_documents(spark, sf_dir), F.concat(*parts), "doc_id").select(
        "doc_id", "_item.entity", "_item.start", "_item.end", "_item.matched", "_item.score"
    )


def detect_written(name: str, spark, sf_dir):
    return _document_spans(spark, sf_dir, (name,)).drop("entity", "score")


def detect_written_iban(spark, sf_dir):
    """Account numbers made from the customer table, every second one with wrong check digits."""
    key = F.col("c_custkey")
    body = F.concat(F.lit("HUSH"), F.lpad(key.cast("string"), 14, "0"))
    # 98 minus the remainder of the number with check digits 00, letters as 10 to 35.
    digits = F.concat(F.lit("17302817"), F.lpad(key.cast("string"), 14, "0"), F.lit("161100"))
    remainder = F.pmod(digits.cast("decimal(38,0)"), F.lit(97).cast("decimal(38,0)")).cast("int")
    check = F.lpad(F.pmod(F.lit(98) - remainder + F.when(key % 2 == 1, 1).otherwise(0), F.lit(100)).cast("string"), 2, "0")
    text = F.concat(F.lit("pay to GB"), check, body, F.lit(" today"))
    rows = dealt(_table(spark, sf_dir, "customer").select("c_custkey")).select("c_custkey", text.alias("text"))
    spans = turn_spans(F.col("text"), F.lit(0), only="iban")
    return explode_items(rows, spans, "c_custkey").select(
        "c_custkey", "_item.start", "_item.end", F.length("_item.matched").alias("length")
    )


def detect_age_money(spark, sf_dir):
    """Ages and amounts, which the job leaves alone unless asked."""
    text = F.concat(
        F.lit("She is "), F.col("c_custkey") % 90, F.lit(" years old and owes £"),
        F.col("c_custkey").cast("string"), F.lit(".50 or "), (F.col("c_custkey") % 7).cast("string"), F.lit(" pounds"),
    )
    rows = dealt(_table(spark, sf_dir, "customer").select("c_custkey")).select("c_custkey", text.alias("text"))
    spans = F.concat(*[turn_spans(F.col("text"), F.lit(0), only=n) for n in ("age", "money")])
    return explode_items(rows, spans, "c_custkey").select(
        "c_custkey", "_item.entity", "_item.start", "_item.end", "_item.matched"
    )


def _introduced(spark, sf_dir) -> DataFrame:
    """Names which agents introduced themselves with."""
    introduced = turn_spans(F.col("content"), F.lit(0), only="person")
    names = explode_items(call_turns(spark, sf_dir), introduced).select(F.col("_item.matched").alias("name"))
    return name_table(names)


def _lookup_detections(spark, sf_dir) -> DataFrame:
    """These names, looked up in every turn."""
    return gazetteer_detections(call_turns(spark, sf_dir), _introduced(spark, sf_dir), "conv_id")


def detect_gazetteer_names(spark, sf_dir):
    return _lookup_detections(spark, sf_dir).drop("score")


def _customer_names(spark, sf_dir) -> DataFrame:
    """A name a customer, in seven forms: short, hyphened, with apostrophe, of several words."""
    key = F.col("c_custkey")
    own = F.translate(key.cast("string"), "0123456789", "ABCDEFGHIJ")
    forms = (
        own, F.concat(F.lit("Zel"), own), F.concat(F.lit("Jean-"), own), F.concat(F.lit("O'"), own),
        F.concat(F.lit("Mary "), own), F.concat(F.lit("Van  der "), own), F.concat(F.lit("Q "), own, F.lit(" Third")),
    )
    name = None
    for i, form in enumerate(forms):
        name = F.when(key % 7 == i, form) if name is None else name.when(key % 7 == i, form)
    return _table(spark, sf_dir, "customer").select("c_custkey", name.alias("name"))


def detect_names_forms(spark, sf_dir):
    """Each customer's name between punctuation, before a genitive, and where it is none."""
    rows = _customer_names(spark, sf_dir)
    said = F.concat(
        F.lit("this is "), F.col("name"), F.lit(", x"), F.col("name"), F.lit(" met ("), F.upper("name"), F.lit(")'s and "),
        F.col("name"), F.lit("'s."),
    )
    turns = rows.select("c_custkey", F.lit(0).alias("turn"), F.lit("agent").alias("role"), said.alias("content"))
    found = gazetteer_detections(turns, name_table(rows), "c_custkey", rules=DEFAULT_RULES.with_(deny_words=("~",)))
    # Other customers' names may be among the words as well: each one's own name only.
    own = found.join(rows, "c_custkey").where(fold(F.col("matched")) == fold(F.col("name")))
    return own.select("c_custkey", "start", "end", "matched")


def filter_lookups(spark, sf_dir):
    """Every hit of a table of names and small talk, and which filter would let it pass."""
    turns = _call_turns_with_bits(spark, sf_dir)
    names = ("DAMIEN", "GRACE", "ROSEMARY", "IT IS WRITTEN DOWN", "THAT IS FINE", "MILTON DRIVE")
    listed = spark.createDataFrame([(n,) for n in names], "name string")
    hits = gazetteer_detections(turns, name_table(listed), "conv_id", rules=DEFAULT_RULES.with_(deny_words=("~",)))
    known = hits.join(turns.select("conv_id", "turn", "context"), ["conv_id", "turn"])
    span = F.struct("start", "end", "entity", fold(F.col("matched")).alias("matched"), "score", "detector")
    one, turn = F.array(span).cast(SPANS_TYPE), Turn(F.lit(""), F.col("context"), DEFAULT_RULES)
    return known.select(
        "conv_id", "turn", "start", "matched",
        (F.size(deny_filter(one, DEFAULT_RULES)) > 0).alias("not_denied"),
        (F.size(combined_filter(one, turn.combined)) > 0).alias("not_in_an_address"),
        (F.size(conversational_filter(one, turn)) > 0).alias("not_small_talk"),
    )


# -- filters and spans --------------------------------------------------------

def filter_person_deny(spark, sf_dir):
    """Every name hit before the filters, and whether the filters keep it."""
    turns = _call_turns_with_bits(spark, sf_dir)
    content, bits = F.col("content"), F.col("context")
    spans = turn_spans(content, bits, only="person", filtered=False)
    raw = explode_items(turns, spans, "conv_id", "turn", "context")
    kept = F.size(apply_filters(F.array("_item").cast(SPANS_TYPE), Turn(F.lit(""), bits, DEFAULT_RULES))) > 0
    return raw.select("conv_id", "turn", "_item.start", "_item.end", "_item.matched", kept.alias("kept"))


def filter_score(spark, sf_dir):
    """Only spans scored strictly above the threshold stay: those with full confidence."""
    strict = DEFAULT_RULES.with_(min_score=0.85)
    found = _document_spans(spark, sf_dir, ("written_email", "written_card", "money"), strict)
    return found.groupBy("entity").agg(F.count("*").alias("spans"), F.countDistinct("doc_id").alias("docs"))


def conversational_ratio(spark, sf_dir):
    folded = fold(F.col("content"))
    return _conversations(spark, sf_dir).select(
        "conv_id", "turn",
        F.round(conversational_share(folded, DEFAULT_RULES), 6).alias("share"),
        looks_conversational(folded, DEFAULT_RULES).alias("conversational"),
    )


def merge_spans(spark, sf_dir):
    """Six spans per order, overlapping by chance, merged into blocks."""
    key = F.col("o_orderkey")
    labels = F.array(*[F.lit(x) for x in ("PERSON", "LOCATION", "EMAIL_ADDRESS", "OTHER_B", "OTHER_A", "PASSWORD")])

    def span(i: int) -> Column:
        start = ((key * (7 + i) + i * i * 13) % 60).cast("int")
        length = ((key * (3 + i) + i) % 12 + 1).cast("int")
        return F.struct(
            start.alias("start"), (start + length).alias("end"),
            F.element_at(labels, ((key + i) % 6 + 1).cast("int")).alias("entity"),
            F.lit("").alias("matched"),
            F.when((key + i) % 3 == 0, 1.0).otherwise(0.85).cast("double").alias("score"),
            F.lit("made").alias("detector"),
        )

    spans = F.array(*[span(i) for i in range(6)]).cast(SPANS_TYPE)
    orders = _table(spark, sf_dir, "orders").select("o_orderkey")
    return explode_items(dealt(orders), merged(spans), key.alias("conv_id")).select(
        "conv_id", "_item.start", "_item.end", "_item.entity"
    )


# -- redaction and audit -------------------------------------------------------

def redact_calls(spark, sf_dir):
    """The flagship: transcripts in, redacted transcripts and audit out."""
    done = _redacted_calls(spark, sf_dir)
    return done.select(
        _key(), flat_transcript(F.col("redacted")).alias("redacted_transcript"),
        audit.audit_string(F.col("redacted")).alias("redacted_entity"),
    )


def redact_calls_with_names(spark, sf_dir):
    """The flagship with a name table: callers' names are found wherever they are said."""
    done = redact_with_lookups(_parsed_calls(spark, sf_dir), names=_introduced(spark, sf_dir))
    return done.select(
        _key(), flat_transcript(F.col("redacted")).alias("redacted_transcript"),
        F.size(F.flatten(F.transform("redacted", lambda e: e["spans"]))).alias("spans"),
    )


def redact_parts(spark, sf_dir):
    """Turn rows to transcripts in parts of three turns, redacted: answers just after a border too."""
    parts = assemble_transcripts(call_turns(spark, sf_dir), part_turns=3, rules=DEFAULT_RULES)
    done = redact_transcripts(parse_transcripts(parts, keep_original=None))
    return done.select("conv_id", "part", flat_transcript(F.col("redacted")).alias("redacted_transcript"))


def redact_turn_rows(spark, sf_dir):
    done = redact_turns(call_turns(spark, sf_dir))
    return done.select("conv_id", "turn", "role", "redacted", "status")


def redact_turns_with_lookups(spark, sf_dir):
    """Turn rows redacted with the name table next to the detectors."""
    return redact_turns(
        call_turns(spark, sf_dir), lookups=_lookup_detections(spark, sf_dir)
    ).select("conv_id", "turn", "redacted")


def redact_conversations(spark, sf_dir):
    done = redact_turns(_conversations(spark, sf_dir))
    return done.select("conv_id", "turn", "role", "redacted", F.size("spans").alias("spans"))


def redact_documents(spark, sf_dir):
    text = F.col("text")
    names = ("written_email", "written_card")
    spans = F.concat(*[turn_spans(text, F.lit(0), only=n) for n in names])
    return _documents(spark, sf_dir).withColumn("spans", spans).select(
        "doc_id", redact_text(text, F.col("spans")).alias("redacted")
    )


def audit_rows(spark, sf_dir):
    done = _redacted_calls(spark, sf_dir).withColumn("conv_id", _key())
    return audit.detections(redacted_turns(done, "conv_id"), "conv_id")


def audit_string(spark, sf_dir):
    return _redacted_calls(spark, sf_dir).select(
        _key(), audit.audit_string(F.col("redacted")).alias("redacted_entity")
    )


def audit_hashed(spark, sf_dir):
    rules = DEFAULT_RULES.with_(audit_text="hash")
    return _redacted_calls(spark, sf_dir, rules).select(
        _key(), audit.audit_string(F.col("redacted"), rules).alias("redacted_entity")
    )


#: The key of the example; a job takes its own from the configuration.
KEYED_RULES = DEFAULT_RULES.with_(audit_text="keyed", audit_key="an example of a key")


def audit_keyed(spark, sf_dir):
    """Pseudonyms of what was found, and in how many calls each of them comes."""
    done = _redacted_calls(spark, sf_dir).withColumn("conv_id", _key())
    found = audit.detections(redacted_turns(done, "conv_id"), "conv_id", rules=KEYED_RULES)
    return found.groupBy("entity", F.col("matched").alias("pseudonym")).agg(F.countDistinct("conv_id").alias("calls"))


def audit_summary(spark, sf_dir):
    return audit.audit_summary(audit_rows(spark, sf_dir))


def output(spark, sf_dir):
    return output_rows(_redacted_calls(spark, sf_dir)).drop("load_dt")


def append_rerun(spark, sf_dir):
    """Loads that overlap: the calls before 1996, all calls, and all of them again; what the target then holds.

    The calls are redacted once and written; each load reads them there and has a time of its own.
    """
    done = output_rows(_redacted_calls(spark, sf_dir)).withColumn("year", F.year("file_date"))
    staged, target = shared_path(spark, "append_rerun_staged"), shared_path(spark, "append_rerun")
    done.drop("load_dt").write.parquet(staged)
    kept = spark.read.schema(done.drop("load_dt").schema).parquet(staged)
    rows = kept.withColumn("load_dt", F.current_timestamp()).select(*done.columns)
    for load in (rows.where("file_date < date'1996-01-01'"), rows, rows):
        write_rows(load, target, mode="append", partition_by=("year",), skip_loaded=True)
    return spark.read.schema(rows.schema).parquet(target).drop("load_dt")


def counts_on_the_way(spark, sf_dir):
    """Transcripts by status and spans by entity, as seen while calls and messy transcripts are written."""
    columns = "transaction_id", "transcription"
    messy = messy_transcripts(spark, sf_dir).withColumn("transaction_id", F.col("conv_id").cast("string"))
    rows = call_transcripts(spark, sf_dir).select(*columns).unionByName(messy.select(*columns))
    seen = Observation("counts on the way")
    done = observed_counts(redact_transcripts(parse_transcripts(rows, keep_original=None)), seen)
    write_rows(
        done.select("transaction_id", transcript_json(F.col("redacted")).alias("transcription")), shared_path(spark, "counts_on_the_way")
    )
    return spark.createDataFrame([(name, n) for name, n in seen.get.items() if n], "counted string, n long")


def record_count(spark, sf_dir):
    """Records a day, and the length of what is written: a count alone would not need the redaction."""
    rows = output_rows(_redacted_calls(spark, sf_dir))
    return rows.groupBy("file_date").agg(
        F.count("*").alias("records"), F.sum(F.length("transcription_redacted")).alias("characters")
    )


# -- scored calls --------------------------------------------------------------

def scored_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored calls read from the events: type as setting, user as call, value as score."""
    k = F.get_json_object("props", "$.k").cast("int")
    flags = [(k % (i + 2) == 0).alias(name) for i, name in enumerate(analytics.FLAGS)]
    return _table(spark, sf_dir, "events").select(
        F.col("user_id").alias("call_id"), F.col("event_type").alias("setting"),
        F.col("value").alias("model_score"), k.cast("double").alias("sentiment"),
        (k % 10 != 0).alias("reason_agrees"), *flags,
    )


def _rounded(report: DataFrame) -> DataFrame:
    return report.select(*[
        F.round(f.name, 9).alias(f.name) if f.dataType.typeName() == "double" else F.col(f.name)
        for f in report.schema
    ])


def _report(build: Callable[[DataFrame], DataFrame], spark, sf_dir):
    return _rounded(build(scored_calls(spark, sf_dir)))


def queries() -> dict[str, Query]:
    return {
        "scan_where": scan_where,
        "sample_ordered": sample_ordered,
        "sample_all": sample_all,
        "parse_transcripts": parse_status,
        "parse_turns": parse_turns,
        "quarantine": quarantine,
        "non_turns_kept": non_turns_kept,
        "json_bytes": json_bytes,
        "json_roundtrip": json_roundtrip,
        "flatten_transcript": flatten_transcript,
        "turns_with_context": turns_with_context,
        "transcript_context": transcript_context,
        "context_flag_counts": context_flag_counts,
        "conversation_context": conversation_context,
        "context_sparse": context_sparse,
        **{f"detect_{kind}": partial(detect_kind, kind) for kind in SPOKEN},
        "detect_written_email": partial(detect_written, "written_email"),
        "detect_written_card": partial(detect_written, "written_card"),
        "detect_written_iban": detect_written_iban,
        "detect_age_money": detect_age_money,
        "detect_gazetteer_names": detect_gazetteer_names,
        "detect_names_forms": detect_names_forms,
        "filter_lookups": filter_lookups,
        "filter_person_deny": filter_person_deny,
        "filter_score": filter_score,
        "conversational_ratio": conversational_ratio,
        "merge_spans": merge_spans,
        "redact_calls": redact_calls,
        "redact_turns": redact_turn_rows,
        "redact_with_lookups": redact_turns_with_lookups,
        "redact_calls_with_names": redact_calls_with_names,
        "redact_parts": redact_parts,
        "redact_conversations": redact_conversations,
        "redact_documents": redact_documents,
        "audit_rows": audit_rows,
        "audit_string": audit_string,
        "audit_hashed": audit_hashed,
        "audit_keyed": audit_keyed,
        "audit_summary": audit_summary,
        "output_rows": output,
        "append_rerun": append_rerun,
        "counts_on_the_way": counts_on_the_way,
        "record_count": record_count,
        "setting_quality": partial(_report, analytics.setting_quality),
        "setting_flag_rates": partial(_report, analytics.setting_flag_rates),
        "setting_winners": partial(_report, analytics.setting_winners),
        "setting_repeatability": partial(_report, analytics.setting_repeatability),
    }
