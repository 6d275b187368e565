"""Expected results as SQL for another engine.

The calls are a function of the order key, so what must be found in them is
written down in closed form: which spans, where, with which label. None of the
detector patterns appears here.
"""

from __future__ import annotations

from hushline.operators.analytics import FLAGS
from hushline.plans.catalogue import CONVERSATION_RULES, KEYED_RULES
from hushline.rules import DENY_WORDS, KINDS, PLACEHOLDERS, Rules, DEFAULT_RULES
from hushline.sources.calls import DIGIT_WORDS, NAMES, QUESTIONS, SCENARIOS


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _list(words) -> str:
    return "[" + ", ".join(_q(w) for w in words) + "]"


def _words(digits: str) -> str:
    out = digits
    for i, word in enumerate(DIGIT_WORDS):
        out = f"replace({out}, '{i}', '{word} ')"
    return f"trim({out})"


def _case(choices: dict[int, str], other: str = "NULL") -> str:
    whens = " ".join(f"WHEN {i} THEN {sql}" for i, sql in choices.items())
    return f"CASE k % {SCENARIOS} {whens} ELSE {other} END"


_EIGHT = "lpad(CAST(k AS VARCHAR), 8, '0')"
_THREE = "lpad(CAST(k % 1000 AS VARCHAR), 3, '0')"
_NAME = f"list_extract({_list(NAMES)}, CAST((k // {{}}) % 8 AS INTEGER) + 1)"
_GREETER = _NAME.format(3)
_CALLER = _NAME.format(16)
_DOWN = "'IT IS WRITTEN DOWN SOMEWHERE '"

_ANSWERS = {
    0: f"'YES IT''S ' || {_words(_EIGHT)}",
    1: f"'IT IS ' || {_EIGHT}",
    2: "'DOUBLE ' || CAST(k % 10 AS VARCHAR)",
    3: "'IT ENDS ' || lpad(CAST(k % 100 AS VARCHAR), 2, '0')",
    4: _words("lpad(CAST(k % 10000 AS VARCHAR), 4, '0')"),
    5: f"'IT''S ' || {_CALLER} || ' BEESTON'",
    6: "'G R E Y'",
    7: f"'IT''S ' || {_words('CAST(k % 90 + 10 AS VARCHAR)')} || ' MILTON DRIVE'",
    8: "'IT''S ER SEVEN SIX Q T'",
    9: "'DAMIEN O''BRIEN TWENTY MILTON DRIVE F V FIVE EIGHT'",
    10: "'S DOT DAVIES AT J M U DOT AC DOT UK'",
    11: "'IT''S ADRIAN BEESTON THIRTEEN AT GMAIL DOT COM'",
    12: f"{_DOWN} || {_words(_THREE)} || ' C D'",
    13: f"'IS ZERO DOUBLE SEVEN ' || {_words(_EIGHT)}",
    14: f"'MY NUMBER IS 079' || {_EIGHT}",
    15: "'NO THANK YOU THAT IS FINE'",
    16: "'IT ENDS WITH A ' || CAST(k % 10 AS VARCHAR)",
    17: "'IT IS B R K AND THEN AFTER THAT S T'",
    18: "'I AM CALLED MILLICENT BEESTON'",
    19: "'M FOR AT GMAIL DOT COM'",
    20: "'X MARKS 7 ROSES'",
}

#: keys k, their answers, and one row per turn.
CALLS = f"""
keys AS (SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS file_date FROM orders),
said AS (
  SELECT k, file_date, {_GREETER} AS greeter, {_CALLER} AS caller,
    'THANK YOU FOR CALLING MY NAME IS ' || {_GREETER} || ' HOW CAN I HELP' AS t0,
    'YEAH HI I WANT TO CHANGE MY ORDER PLEASE' AS t1,
    {_case({i: _q(q) for i, q in enumerate(QUESTIONS)})} AS t2,
    {_case(_ANSWERS)} AS t3
  FROM keys
),
turns AS (
  SELECT k AS conv_id, CAST(turn AS BIGINT) AS turn,
    CASE WHEN turn % 2 = 0 THEN 'agent' ELSE 'customer' END AS role,
    CASE turn WHEN 0 THEN t0 WHEN 1 THEN t1 WHEN 2 THEN t2 ELSE t3 END AS content,
    CASE turn WHEN 0 THEN NULL WHEN 1 THEN t0 WHEN 2 THEN t1 ELSE t2 END AS before
  FROM said CROSS JOIN (SELECT unnest([0, 1, 2, 3]) AS turn) n
)"""

#: The password run: ONE is a common word, so it ends a run; a run needs two tokens.
_RUN = f"""CASE
  WHEN d1 <> '1' AND d2 <> '1' AND d3 <> '1' THEN w1 || ' ' || w2 || ' ' || w3 || ' C D'
  WHEN d1 <> '1' AND d2 <> '1' THEN w1 || ' ' || w2
  WHEN d2 <> '1' AND d3 <> '1' THEN w2 || ' ' || w3 || ' C D'
  WHEN d3 <> '1' THEN w3 || ' C D'
  ELSE 'C D' END"""

_END = "length(t3)"
#: entity, start, end, detector of the answer's spans, by scenario.
_SPANS = [
    (0, "REFERENCE_NUMBER", "9", _END, "reference_in_words"),
    (1, "REFERENCE_NUMBER", "6", _END, "reference_in_digits"),
    (2, "BANK_ACCOUNT_LAST_DIGITS", "0", _END, "bank_digits"),
    (3, "BANK_ACCOUNT_LAST_DIGITS", "8", _END, "bank_digits"),
    (4, "CREDIT_CARD", "0", _END, "card_four_in_a_row"),
    (5, "PERSON", "CASE WHEN caller = 'WILL' THEN 10 ELSE 5 END", _END, "name_words"),
    (6, "PERSON", "0", _END, "letters_throughout"),
    (7, "LOCATION", "5", _END, "first_to_last_word"),
    (8, "UK_POSTCODE", "5", _END, "letters_and_numbers"),
    (9, "LOCATION", "0", _END, "whole_answer"),
    (9, "UK_POSTCODE", "0", _END, "letters_and_numbers"),
    (10, "EMAIL_ADDRESS", "0", _END, "email_in_words"),
    (11, "LOCATION", "5", _END, "first_to_last_word"),
    (11, "EMAIL_ADDRESS", "length('IT''S ADRIAN BEESTON ')", _END, "email_in_words"),
    (12, "PASSWORD", "run_start", "run_start + length(run)", "password_run"),
    (13, "PHONE_NUMBER", "3", _END, "phone_in_words"),
    (14, "PHONE_NUMBER", "13", _END, "phone_in_digits"),
    (16, "CREDIT_CARD", "15", _END, "card_lone_digit"),
    (17, "PERSON", "6", "11", "letters_in_a_row"),
    (18, "PERSON", "12", _END, "after_name_cue"),
    (19, "EMAIL_ADDRESS", "0", _END, "email_in_words"),
    (19, "EMAIL_ADDRESS", "2", _END, "email_in_words"),
    (20, "PASSWORD", "0", _END, "short_answer_with_digit"),
]
_SPAN_ROWS = "\n  UNION ALL ".join(
    f"SELECT k, 3, 'customer', t3, {_q(e)}, {s}, {n}, {_q(d)} FROM runs WHERE k % {SCENARIOS} = {i}"
    for i, e, s, n, d in _SPANS
)
FOUND = f"""{CALLS},
digits AS (
  SELECT *, substr({_THREE}, 1, 1) AS d1, substr({_THREE}, 2, 1) AS d2, substr({_THREE}, 3, 1) AS d3 FROM said
),
spelled AS (
  SELECT *, {', '.join(f"list_extract({_list(DIGIT_WORDS)}, CAST(d{i} AS INTEGER) + 1) AS w{i}" for i in (1, 2, 3))}
  FROM digits
),
password_runs AS (SELECT *, {_RUN} AS run FROM spelled),
runs AS (
  SELECT *, CASE WHEN k % {SCENARIOS} = 12 THEN length({_DOWN} || w1 || ' ' || w2 || ' ' || w3 || ' C D')
    - CASE WHEN run LIKE '%C D' THEN length(run) ELSE length(w1 || ' ' || w2 || ' ' || w3 || ' C D') END END AS run_start
  FROM password_runs
),
spans(k, turn, role, content, entity, s, e, detector) AS (
  SELECT k, 0, 'agent', t0, 'PERSON', 33, 33 + length(greeter), 'after_my_name_is' FROM runs WHERE greeter <> 'WILL'
  UNION ALL {_SPAN_ROWS}
),
found AS (
  SELECT k AS conv_id, CAST(turn AS BIGINT) AS turn, role, content, entity,
    CAST(s AS INTEGER) AS "start", CAST(e AS INTEGER) AS "end",
    substr(content, CAST(s AS INTEGER) + 1, CAST(e - s AS INTEGER)) AS matched,
    CAST(0.85 AS DOUBLE) AS score, detector
  FROM spans
)"""

_LABEL = "CASE entity " + " ".join(f"WHEN {_q(e)} THEN {_q(p)}" for e, p in PLACEHOLDERS.items()) + " END"

#: The spans of one turn always form one block here; its longest span names it, and
#: LOCATION wins the one tie.
REDACTED = f"""{FOUND},
blocks AS (
  SELECT conv_id, turn, min("start") AS s, max("end") AS e,
    arg_min({_LABEL}, -("end" - "start") * 10 + CASE entity WHEN 'LOCATION' THEN 0 ELSE 1 END) AS label
  FROM found GROUP BY conv_id, turn
),
redacted AS (
  SELECT t.conv_id, t.turn, t.role, t.content,
    CASE WHEN b.s IS NULL THEN t.content
      ELSE substr(t.content, 1, b.s) || b.label || substr(t.content, b.e + 1) END AS redacted
  FROM turns t LEFT JOIN blocks b ON t.conv_id = b.conv_id AND t.turn = b.turn
),
entries AS (
  SELECT conv_id, turn, "start", "end", entity, '[' || role || '] ' || entity || ': ' AS head, matched FROM found
),
whole_calls AS (
  SELECT conv_id, string_agg(redacted, ' ' ORDER BY turn) AS redacted_transcript,
    '[' || string_agg('{{"role":"' || role || '","content":"' || redacted || '"}}', ',' ORDER BY turn) || ']' AS json
  FROM redacted GROUP BY conv_id
)"""


def _hmac(text: str, key: str) -> str:
    """Of a key of at most 64 bytes."""
    inner, outer = (
        "'" + "".join(f"\\x{b ^ pad:02X}" for b in key.encode().ljust(64, b"\0")) + "'::BLOB" for pad in (0x36, 0x5C)
    )
    return f"sha256({outer} || unhex(sha256({inner} || encode({text}))))"


def _audit(matched: str) -> str:
    return (
        f"SELECT conv_id, string_agg(head || {matched} || ' (score: 0.85)', '; ' "
        'ORDER BY turn, "start", "end", entity) AS audit FROM entries GROUP BY conv_id'
    )


def _flags(before: str, rules: Rules) -> str:
    def any_phrase(kind: str) -> str:
        tests = " OR ".join(f"contains(upper({before}), {_q(p)})" for p in rules.indicators[kind])
        return f"coalesce({tests}, FALSE)"

    cols = [f"{any_phrase(k)} AS expects_{k}" for k in KINDS]
    cols.append(f"{any_phrase('address')} AND {any_phrase('postcode')} AS expects_address_with_postcode")
    return ", ".join(cols)


def _flag_query(select: str) -> str:
    return f"WITH {CALLS} SELECT {select} {_flags('before', DEFAULT_RULES)} FROM turns"


_DETECTED = {
    "reference_number": "REFERENCE_NUMBER", "bank_digits": "BANK_ACCOUNT_LAST_DIGITS",
    "card_digits": "CREDIT_CARD", "person": "PERSON", "location": "LOCATION",
    "postcode": "UK_POSTCODE", "email": "EMAIL_ADDRESS", "password": "PASSWORD", "phone": "PHONE_NUMBER",
}

_DETECTION = 'conv_id, turn, role, entity, "start", "end", matched, score, detector'

#: Written forms: matches and the gaps between them, so that offsets follow.
_EMAIL_RE = r"[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
_CARD_RE = (
    r"[0-9]{4}([ -][0-9]{4}){2}[ -][0-9]{1,7}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5}|[0-9]+"
)


def _matches(regex: str) -> str:
    return f"""pieces AS (
  SELECT doc_id, text, regexp_extract_all(text, {_q(regex)}) AS m,
    string_split_regex(text, {_q(regex)}) AS g FROM documents
),
hits AS (
  SELECT doc_id, unnest(m) AS matched, unnest(list_transform(generate_series(1, len(m)), lambda i:
    list_sum(list_transform(g[1:i], lambda x: length(x)))
    + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0))) AS s
  FROM pieces WHERE len(m) > 0
)"""


def _luhn(number: str) -> str:
    bare = f"reverse(regexp_replace({number}, '[^0-9]', '', 'g'))"
    digit = f"CAST(substr({bare}, CAST(i AS BIGINT), 1) AS INTEGER)"
    return (
        f"list_sum(list_transform(generate_series(1, length({bare})), lambda i: CASE WHEN i % 2 = 1 THEN {digit} "
        f"ELSE 2 * {digit} - CASE WHEN {digit} > 4 THEN 9 ELSE 0 END END)) % 10 = 0"
    )


_CARD_OK = (
    "length(regexp_replace(matched, '[^0-9]', '', 'g')) BETWEEN 13 AND 19 AND " + _luhn("matched")
)
_SPAN_OUT = 'doc_id, CAST(s AS INTEGER) AS "start", CAST(s + length(matched) AS INTEGER) AS "end", matched'

_MESSY = """CASE k % 13
  WHEN 0 THEN 'ok' WHEN 1 THEN 'missing' WHEN 2 THEN 'unparsable' WHEN 3 THEN 'not_an_array'
  WHEN 4 THEN 'ok' WHEN 5 THEN 'ok' WHEN 6 THEN 'unparsable' WHEN 7 THEN 'ok' WHEN 12 THEN 'ok' ELSE 'unparsable' END"""

_WORDS = r"regexp_extract_all(upper(text), '[^\s\x1c-\x1f\x{85}\x{a0}\x{2000}-\x{200a}\x{2028}\x{2029}]+')"

_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
_SCORES = (
    "scores AS (SELECT user_id AS call_id, event_type AS setting, value AS model_score, "
    f"CAST({_K} AS DOUBLE) AS sentiment, ({_K} % 10 <> 0) AS reason_agrees, "
    + ", ".join(f"({_K} % {i + 2} = 0) AS {f}" for i, f in enumerate(FLAGS)) + " FROM events)"
)

_GAZETTEER = f"""{CALLS},
names AS (SELECT DISTINCT greeter AS name FROM said WHERE greeter <> 'WILL'),
spoken AS (
  SELECT k, 0 AS turn, 'agent' AS role, greeter AS name, 33 AS s FROM said
  UNION ALL SELECT k, 3, 'customer', caller, 5 FROM said WHERE k % {SCENARIOS} = 5
  UNION ALL SELECT k, 3, 'customer', 'DAMIEN', 0 FROM said WHERE k % {SCENARIOS} = 9
  UNION ALL SELECT k, 3, 'customer', 'ADRIAN', 5 FROM said WHERE k % {SCENARIOS} = 11
)"""


def oracle_sql() -> dict[str, str]:
    detect = {
        f"detect_{kind}": f"WITH {FOUND} SELECT {_DETECTION} FROM found WHERE entity = {_q(entity)}"
        for kind, entity in _DETECTED.items()
    }
    best = "best AS (SELECT call_id, setting, max(model_score) AS score FROM scores GROUP BY ALL)"
    return {
        "scan_where": "SELECT doc_id, lang, n_chars FROM documents WHERE lang = 'en' AND n_chars > 500",
        "sample_ordered": f"""WITH {CALLS} SELECT k AS key, CAST(k AS VARCHAR) AS transaction_id,
            '[{{"role":"agent","content":"' || t0 || '"}},{{"role":"customer","content":"' || t1
            || '"}},{{"role":"agent","content":"' || t2 || '"}},{{"role":"customer","content":"' || t3 || '"}}]'
            AS transcription FROM said WHERE file_date >= DATE '1996-01-01' ORDER BY k LIMIT 100""",
        "sample_all": """SELECT CAST(o_orderkey AS VARCHAR) AS transaction_id, CAST(o_orderdate AS DATE) AS file_date
            FROM orders""",
        "parse_transcripts": f"""SELECT k AS conv_id, {_MESSY} AS status,
            CAST(CASE k % 13 WHEN 0 THEN 2 WHEN 4 THEN 3 WHEN 5 THEN 0 WHEN 7 THEN 2 WHEN 12 THEN 2 ELSE -1 END AS INTEGER) AS elements,
            CAST(CASE k % 13 WHEN 0 THEN 2 WHEN 4 THEN 1 WHEN 5 THEN 0 WHEN 7 THEN 2 WHEN 12 THEN 1 END AS INTEGER) AS turns
            FROM (SELECT o_orderkey AS k FROM orders)""",
        "parse_turns": """WITH keys AS (SELECT o_orderkey AS k FROM orders)
            SELECT k AS conv_id, CAST(0 AS BIGINT) AS turn, 'agent' AS role, 'CALL ' || k AS content FROM keys WHERE k % 13 = 0
            UNION ALL SELECT k, 1, '', 'NO ROLE' FROM keys WHERE k % 13 = 0
            UNION ALL SELECT k, 2, 'agent', 'CALL ' || k FROM keys WHERE k % 13 = 4
            UNION ALL SELECT k, 0, 'agent', NULL FROM keys WHERE k % 13 = 7
            UNION ALL SELECT k, 1, 'customer', CAST(k AS VARCHAR) FROM keys WHERE k % 13 = 7
            UNION ALL SELECT k, 0, 'agent', 'A ] IN "QUOTES" [ ' || k FROM keys WHERE k % 13 = 12""",
        "quarantine": f"""SELECT k AS conv_id, {_MESSY} AS status FROM (SELECT o_orderkey AS k FROM orders)
            WHERE k % 13 IN (1, 2, 3, 6, 8, 9, 10, 11)""",
        "non_turns_kept": """SELECT k AS conv_id, CASE k % 13
            WHEN 0 THEN '[{"role":"agent","content":"CALL ' || k || '"},{"role":"","content":"NO ROLE"}]'
            WHEN 4 THEN '["A BARE STRING",{"note":' || k || '},{"role":"agent","content":"CALL ' || k || '"}]'
            WHEN 5 THEN '[]'
            WHEN 7 THEN '[{"role":"agent","content":null},{"role":"customer","content":"' || k || '"}]'
            WHEN 12 THEN '[{"role":"agent","content":"A ] IN \\"QUOTES\\" [ ' || k || '"},[["]",[]],' || k || ']]'
            END AS transcription FROM (SELECT o_orderkey AS k FROM orders)""",
        "json_bytes": r"""WITH j AS (SELECT c_custkey, '[{"role":"agent","content":"STRASSE Stra\u00dfe ' || c_custkey
              || ' \ud83d\ude00 \u001f\t\"QUOTE\" \\ \\u001F \u007f' || c_name || '"},"\u00c4\u00d6 \ud834\udd1e"]' AS transcription FROM customer)
            SELECT *, sha256(transcription) AS sha256 FROM j""",
        "json_roundtrip": "SELECT conv_id, turn, role, text AS content FROM conversations",
        "flatten_transcript": """SELECT conv_id, CAST(0 AS BIGINT) AS part, CAST(count(*) AS INTEGER) AS turns,
            string_agg(text, ' ' ORDER BY turn) AS redacted_transcript FROM conversations GROUP BY conv_id""",
        "turns_with_context": _flag_query("conv_id, turn, role,"),
        "transcript_context": _flag_query("conv_id, turn,"),
        "context_flag_counts": "SELECT count(*) AS turns, "
        + ", ".join(
            f"count(*) FILTER (WHERE expects_{k}) AS expects_{k}" for k in (*KINDS, "address_with_postcode")
        )
        + f" FROM ({_flag_query('conv_id, turn,')})",
        "conversation_context": f"""WITH t AS (SELECT conv_id, turn, role,
            lag(text) OVER (PARTITION BY conv_id ORDER BY turn) AS before FROM conversations)
            SELECT conv_id, turn, role, {_flags('before', CONVERSATION_RULES)} FROM t""",
        "context_sparse": f"""WITH e AS (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN user_id + 1 ELSE 0 END AS conv_id, ts,
              list_extract({_list(QUESTIONS)}, CAST(event_id % {SCENARIOS} AS INTEGER) + 1) AS content FROM events),
            t AS (SELECT conv_id, ts, string_agg(content, ' | ') AS content FROM e GROUP BY ALL),
            b AS (SELECT conv_id, ts, lag(content) OVER (PARTITION BY conv_id ORDER BY ts) AS before FROM t)
            SELECT CAST(e.conv_id AS BIGINT) AS conv_id, event_id, {_flags('before', DEFAULT_RULES)}
            FROM e JOIN b ON b.conv_id = e.conv_id AND b.ts = e.ts""",
        **detect,
        "detect_written_email": f"WITH {_matches(_EMAIL_RE)} SELECT {_SPAN_OUT} FROM hits",
        "detect_written_card": f"WITH {_matches(_CARD_RE)} SELECT {_SPAN_OUT} FROM hits WHERE {_CARD_OK}",
        "detect_written_iban": """SELECT c_custkey, CAST(7 AS INTEGER) AS "start", CAST(29 AS INTEGER) AS "end",
            CAST(22 AS INTEGER) AS length FROM customer WHERE c_custkey % 2 = 0""",
        "detect_age_money": """WITH c AS (SELECT c_custkey, 'She is ' || (c_custkey % 90) AS a,
              ' years old' AS b, ' and owes ' AS c, '£' || c_custkey || '.50' AS d, ' or ' AS e,
              (c_custkey % 7) || ' pounds' AS f FROM customer)
            SELECT c_custkey, 'AGE' AS entity, CAST(7 AS INTEGER) AS "start", CAST(length(a || b) AS INTEGER) AS "end",
              substr(a || b, 8) AS matched FROM c
            UNION ALL SELECT c_custkey, 'MONEY', CAST(length(a || b || c) AS INTEGER), CAST(length(a || b || c || d) AS INTEGER), d FROM c
            UNION ALL SELECT c_custkey, 'MONEY', CAST(length(a || b || c || d || e) AS INTEGER),
              CAST(length(a || b || c || d || e || f) AS INTEGER), f FROM c""",
        "detect_gazetteer_names": f"""WITH {_GAZETTEER} SELECT k AS conv_id, CAST(turn AS BIGINT) AS turn, role,
            'PERSON' AS entity, CAST(s AS INTEGER) AS "start", CAST(s + length(name) AS INTEGER) AS "end",
            name AS matched, 'gazetteer' AS detector FROM spoken WHERE name IN (SELECT name FROM names)""",
        # Who is named where: a caller's own name is found as an answer and as a name.
        "redact_calls_with_names": f"""WITH {REDACTED} SELECT w.conv_id, redacted_transcript,
              CAST((SELECT count(*) FROM found f WHERE f.conv_id = w.conv_id)
                + CASE WHEN greeter <> 'WILL' THEN 1 ELSE 0 END
                + CASE k % {SCENARIOS} WHEN 5 THEN CASE WHEN caller <> 'WILL' THEN 1 ELSE 0 END WHEN 11 THEN 1 ELSE 0 END AS INTEGER) AS spans
            FROM whole_calls w JOIN said ON k = w.conv_id""",
        "redact_parts": f"""WITH {REDACTED} SELECT conv_id, turn // 3 AS part,
            string_agg(redacted, ' ' ORDER BY turn) AS redacted_transcript FROM redacted GROUP BY ALL""",
        "detect_names_forms": """WITH n AS (
              SELECT c_custkey, translate(CAST(c_custkey AS VARCHAR), '0123456789', 'ABCDEFGHIJ') AS own FROM customer),
            f AS (SELECT c_custkey, CASE c_custkey % 7 WHEN 0 THEN own WHEN 1 THEN 'Zel' || own WHEN 2 THEN 'Jean-' || own
              WHEN 3 THEN 'O' || chr(39) || own WHEN 4 THEN 'Mary ' || own WHEN 5 THEN 'Van  der ' || own
              ELSE 'Q ' || own || ' Third' END AS name FROM n),
            p AS (SELECT *, length(name) AS k FROM f)
            SELECT c_custkey, CAST(8 AS INTEGER) AS "start", CAST(8 + k AS INTEGER) AS "end", name AS matched FROM p
            UNION ALL SELECT c_custkey, CAST(17 + 2 * k AS INTEGER), CAST(17 + 3 * k AS INTEGER), upper(name) FROM p
            UNION ALL SELECT c_custkey, CAST(25 + 3 * k AS INTEGER), CAST(25 + 4 * k AS INTEGER), name FROM p""",
        "filter_lookups": f"""WITH {CALLS},
            hits(k, turn, s, matched) AS (
              SELECT k, 0, 33, greeter FROM said WHERE greeter IN ('DAMIEN', 'GRACE', 'ROSEMARY')
              UNION ALL SELECT k, 3, 5, caller FROM said WHERE k % {SCENARIOS} = 5 AND caller IN ('DAMIEN', 'GRACE', 'ROSEMARY')
              UNION ALL SELECT k, 3, 0, 'DAMIEN' FROM said WHERE k % {SCENARIOS} = 9
              UNION ALL SELECT k, 3, 0, 'IT IS WRITTEN DOWN' FROM said WHERE k % {SCENARIOS} = 12
              UNION ALL SELECT k, 3, 13, 'THAT IS FINE' FROM said WHERE k % {SCENARIOS} = 15
              UNION ALL SELECT k, 3, strpos(t3, 'MILTON') - 1, 'MILTON DRIVE' FROM said WHERE k % {SCENARIOS} IN (7, 9)),
            counted AS (SELECT *, len(string_split(matched, ' ')) AS n,
              len(list_filter(string_split(matched, ' '), lambda x: list_contains({_list(DENY_WORDS)}, x))) AS c FROM hits)
            SELECT k AS conv_id, CAST(turn AS BIGINT) AS turn, CAST(s AS INTEGER) AS "start", matched, c = 0 AS not_denied,
              NOT (k % {SCENARIOS} = 9 AND turn = 3) AS not_in_an_address,
              (k % {SCENARIOS} IN (5, 9) AND turn = 3) OR CASE WHEN n <= 2 THEN c < n ELSE c / n <= 0.5 END AS not_small_talk
            FROM counted""",
        "filter_person_deny": f"""WITH {FOUND}
            SELECT conv_id, turn, "start", "end", matched, TRUE AS kept FROM found WHERE entity = 'PERSON'
            UNION ALL SELECT k, 1, 18, 33, 'CHANGE MY ORDER', FALSE FROM said""",
        "filter_score": f"""WITH {_matches(_EMAIL_RE)}, cards AS (
              SELECT doc_id, unnest(regexp_extract_all(text, {_q(_CARD_RE)})) AS matched FROM documents)
            SELECT 'EMAIL_ADDRESS' AS entity, count(*) AS spans, count(DISTINCT doc_id) AS docs FROM hits
            UNION ALL SELECT 'CREDIT_CARD', count(*), count(DISTINCT doc_id) FROM cards WHERE {_CARD_OK}""",
        "conversational_ratio": f"""WITH w AS (SELECT conv_id, turn, {_WORDS} AS words FROM conversations),
            d AS (SELECT *, len(words) AS n, len(list_filter(words, lambda x: list_contains({_list(DENY_WORDS)}, x))) AS c FROM w)
            SELECT conv_id, turn, round(c / nullif(n, 0), 6) AS share,
              CASE WHEN n <= 2 THEN c = n ELSE c / n > 0.5 END AS conversational FROM d""",
        "merge_spans": """WITH made AS (
              SELECT o_orderkey AS k, i, CAST((o_orderkey * (7 + i) + i * i * 13) % 60 AS INTEGER) AS s,
                CAST((o_orderkey * (3 + i) + i) % 12 + 1 AS INTEGER) AS n,
                list_extract(['PERSON', 'LOCATION', 'EMAIL_ADDRESS', 'OTHER_B', 'OTHER_A', 'PASSWORD'],
                  CAST((o_orderkey + i) % 6 + 1 AS INTEGER)) AS entity,
                CASE WHEN (o_orderkey + i) % 3 = 0 THEN 1.0 ELSE 0.85 END AS score
              FROM orders CROSS JOIN (SELECT unnest([0, 1, 2, 3, 4, 5]) AS i) x),
            reach AS (SELECT *, max(s + n) OVER (PARTITION BY k ORDER BY s, s + n, entity, i
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS far FROM made),
            islands AS (SELECT *, sum(CASE WHEN far IS NULL OR s >= far THEN 1 ELSE 0 END)
                OVER (PARTITION BY k ORDER BY s, s + n, entity, i) AS island FROM reach),
            placed AS (SELECT *, row_number() OVER (PARTITION BY k, island ORDER BY n DESC, score DESC,
                CASE entity WHEN 'LOCATION' THEN 0 WHEN 'PASSWORD' THEN 1 WHEN 'EMAIL_ADDRESS' THEN 6
                  WHEN 'PERSON' THEN 8 ELSE 9 END, entity) AS place FROM islands)
            SELECT k AS conv_id, min(s) AS "start", max(s + n) AS "end",
              max(CASE WHEN place = 1 THEN entity END) AS entity FROM placed GROUP BY k, island""",
        "redact_calls": f"""WITH {REDACTED}, audits AS ({_audit('matched')})
            SELECT w.conv_id, redacted_transcript, coalesce(audit, '') AS redacted_entity
            FROM whole_calls w LEFT JOIN audits a ON w.conv_id = a.conv_id""",
        "redact_turns": f"WITH {REDACTED} SELECT conv_id, turn, role, redacted, 'ok' AS status FROM redacted",
        "redact_with_lookups": f"WITH {REDACTED} SELECT conv_id, turn, redacted FROM redacted",
        # The given conversations hold no personal data the default rules look for: nothing may change.
        "redact_conversations": """SELECT conv_id, turn, role, text AS redacted, CAST(0 AS INTEGER) AS spans
            FROM conversations""",
        "redact_documents": f"""WITH {_matches(_EMAIL_RE)}, no_mail AS (
              SELECT doc_id, regexp_replace(text, {_q(_EMAIL_RE)}, '[REDACTED EMAIL]', 'g') AS text FROM documents),
            cut AS (SELECT doc_id, regexp_extract_all(text, {_q(_CARD_RE)}) AS m,
              string_split_regex(text, {_q(_CARD_RE)}) AS g FROM no_mail),
            cards AS (SELECT doc_id, g, list_transform(m, lambda matched:
              CASE WHEN {_CARD_OK} THEN '[REDACTED CARD]' ELSE matched END) AS m FROM cut)
            SELECT doc_id, array_to_string(list_transform(generate_series(1, len(g)),
              lambda i: g[i] || coalesce(m[i], '')), '') AS redacted FROM cards""",
        "audit_rows": f"WITH {FOUND} SELECT {_DETECTION} FROM found",
        "audit_string": f"""WITH {REDACTED}, audits AS ({_audit('matched')})
            SELECT k AS conv_id, coalesce(audit, '') AS redacted_entity FROM keys LEFT JOIN audits ON k = conv_id""",
        "audit_hashed": f"""WITH {REDACTED}, audits AS ({_audit('sha256(matched)')})
            SELECT k AS conv_id, coalesce(audit, '') AS redacted_entity FROM keys LEFT JOIN audits ON k = conv_id""",
        "audit_keyed": f"""WITH {FOUND} SELECT entity, {_hmac('matched', KEYED_RULES.audit_key)} AS pseudonym,
            count(DISTINCT conv_id) AS calls FROM found GROUP BY ALL""",
        "audit_summary": f"""WITH {FOUND} SELECT role, entity, count(*) AS spans,
            CAST(sum("end" - "start") AS BIGINT) AS characters,
            min(score) AS lowest_score, max(score) AS highest_score FROM found GROUP BY role, entity""",
        "output_rows": f"""WITH {REDACTED}, audits AS ({_audit('matched')})
            SELECT file_date, CAST(k AS VARCHAR) AS transaction_id, 'call-' || k AS transaction_identifier,
              json AS transcription_redacted, coalesce(audit, '') AS redacted_entity
            FROM keys JOIN whole_calls w ON k = w.conv_id LEFT JOIN audits a ON k = a.conv_id""",
        "append_rerun": f"""WITH {REDACTED}, audits AS ({_audit('matched')})
            SELECT file_date, CAST(k AS VARCHAR) AS transaction_id, 'call-' || k AS transaction_identifier,
              json AS transcription_redacted, coalesce(audit, '') AS redacted_entity, CAST(year(file_date) AS INTEGER) AS year
            FROM keys JOIN whole_calls w ON k = w.conv_id LEFT JOIN audits a ON k = a.conv_id""",
        "counts_on_the_way": f"""WITH {FOUND}, statuses AS (
              SELECT 'ok' AS status FROM orders UNION ALL SELECT {_MESSY} FROM (SELECT o_orderkey AS k FROM orders))
            SELECT 'status ' || status AS counted, count(*) AS n FROM statuses GROUP BY ALL
            UNION ALL SELECT 'entity ' || entity, count(*) FROM found GROUP BY ALL
            UNION ALL SELECT 'entities', count(*) FROM found HAVING count(*) > 0""",
        "record_count": f"""WITH {REDACTED} SELECT file_date, count(*) AS records, CAST(sum(length(json)) AS BIGINT) AS characters
            FROM keys JOIN whole_calls w ON k = w.conv_id GROUP BY file_date""",
        "setting_quality": f"""WITH {_SCORES} SELECT setting, round(avg(model_score), 9) AS avg_model_score,
            round(stddev_samp(model_score), 9) AS std_model_score, round(avg(sentiment), 9) AS avg_sentiment,
            round(stddev_samp(sentiment), 9) AS std_sentiment FROM scores GROUP BY setting""",
        "setting_flag_rates": f"""WITH {_SCORES} SELECT setting, count(*) AS records,
            round(avg(CAST(reason_agrees AS INTEGER)), 9) AS reason_agreement_rate, """
        + ", ".join(f"round(avg(CAST({f} AS INTEGER)), 9) AS {f}_flag_rate" for f in FLAGS)
        + " FROM scores GROUP BY setting",
        "setting_winners": f"""WITH {_SCORES}, {best}, ranked AS (SELECT *,
              row_number() OVER w AS place, score - lead(score) OVER w AS margin FROM best
              WINDOW w AS (PARTITION BY call_id ORDER BY score DESC, setting))
            SELECT setting, count(*) AS calls_won, round(avg(score), 9) AS avg_winning_score,
              round(avg(margin), 9) AS avg_margin FROM ranked WHERE place = 1 GROUP BY setting""",
        "setting_repeatability": f"""WITH {_SCORES}, runs AS (SELECT setting, call_id,
              var_samp(model_score) AS variance, count(*) AS n FROM scores GROUP BY ALL)
            SELECT setting, count(*) AS calls, CAST(sum(n) AS BIGINT) AS runs,
              round(avg(variance), 9) AS avg_variance FROM runs GROUP BY setting""",
    }
