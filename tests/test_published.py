"""Published bytes and pseudonyms against the standard library."""

import hashlib
import hmac
import json
import random

import pytest
from pyspark.sql import functions as F

from hushline.functions.text import ascii_json
from hushline.operators.audit import keyed_digest, pseudonym
from hushline.operators.redaction import redact_transcripts, transcript_json
from hushline.rules import DEFAULT_RULES, Rules, RulesError
from hushline.sources.transcripts import parse_transcripts

SIGNS = [*map(chr, range(32)), "\x7f", "\x80", "ß", "é", " ", "퟿", "￿", "😀", "𝄞", "\U0010ffff", "\\", '"', "/", "u001F", "a", " "]


def test_json_is_byte_equal(spark):
    draw = random.Random(5)
    said = ["".join(draw.choice(SIGNS) for _ in range(draw.randrange(0, 40))) for _ in range(400)] + ["\\u001F", "\\\\u001f\x1f", "\x1f\x1f"]
    turns = [[{"role": "agent", "content": t}, {"role": t[:3], "content": "x"}] for t in said]
    texts = [json.dumps(t, ensure_ascii=i % 2 == 0) for i, t in enumerate(turns)]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, transcription string")
    done = redact_transcripts(parse_transcripts(rows, keep_original=None))
    got = {r[0]: r[1] for r in done.select("i", transcript_json(F.col("redacted"))).collect()}
    assert [got[i] for i in range(len(turns))] == [json.dumps(t, separators=(",", ":")) for t in turns]


def test_ascii_json_of_null_and_long_texts(spark):
    long = json.dumps("ß😀 x" * 50_000, ensure_ascii=False)
    got = spark.createDataFrame([(None,), ('""',), (long,)], "t string").select(ascii_json(F.col("t"))).collect()
    assert [r[0] for r in got] == [None, '""', json.dumps("ß😀 x" * 50_000)]


@pytest.mark.parametrize("key", ["k", "ключ", "x" * 64, "y" * 65])
def test_keyed_digest_is_an_hmac(spark, key):
    texts = ["", "SHAUNA", "é😀", "long " * 1000]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(keyed_digest(F.col("t"), key)).collect()
    assert [r[0] for r in got] == [hmac.new(key.encode(), t.encode(), hashlib.sha256).hexdigest() for t in texts]


def test_equal_persons_have_one_pseudonym(spark):
    rules = DEFAULT_RULES.with_(audit_text="keyed", audit_key="k")
    texts = ["Zelda  Smith", " ZELDA SMITH ", "zelda\tsmith", "Zelda Smyth"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in rows.select(pseudonym(F.col("t"), rules)).collect()]
    assert got[0] == got[1] == got[2] != got[3]
    other = rows.select(pseudonym(F.col("t"), rules.with_(audit_key="l"))).first()[0]
    assert other != got[0]
    assert "audit_key" not in repr(rules)


def test_keyed_needs_a_key(tmp_path):
    with pytest.raises(RulesError):
        DEFAULT_RULES.with_(audit_text="keyed")
    path = tmp_path / "job.json"
    path.write_text(json.dumps({"audit": {"text": "keyed", "key": "s"}}))
    assert Rules.from_files(str(path)).audit_key == "s"
