"""The audit trail: what was found, where, and with which score."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, functions as F

from hushline.functions.rows import explode_items
from hushline.functions.text import BLANK, fold, let, pattern
from hushline.rules import DEFAULT_RULES, Rules


def keyed_digest(text: Column, key: str) -> Column:
    """HMAC-SHA256 of the text in hexadecimal, from built-in digests. The key's pads are literals of the plan."""
    secret = key.encode("utf-8")
    secret = (hashlib.sha256(secret).digest() if len(secret) > 64 else secret).ljust(64, b"\0")
    inner, outer = (F.lit(bytes(b ^ pad for b in secret)) for pad in (0x36, 0x5C))
    return F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, text.cast("binary")), 256))), 256)


def pseudonym(matched: Column, rules: Rules) -> Column:
    """The same for equal texts, whatever their case and blanks; not to be found by trying without the key."""
    return let(F.trim(F.regexp_replace(matched, pattern(BLANK + "+"), " ")), lambda text: keyed_digest(fold(text), rules.audit_key))


def shown_text(matched: Column, rules: Rules) -> Column:
    """The matched text as the audit may show it."""
    if rules.audit_text == "clear":
        return matched
    if rules.audit_text == "keyed":
        return pseudonym(matched, rules)
    return F.sha2(matched, 256) if rules.audit_text == "hash" else F.lit("")


def audit_entry(role: Column, span: Column, rules: Rules = DEFAULT_RULES) -> Column:
    return F.format_string(
        "[%s] %s: %s (score: %.2f)", role, span["entity"], shown_text(span["matched"], rules), span["score"]
    )


def audit_string(redacted: Column, rules: Rules = DEFAULT_RULES) -> Column:
    """All entries of a conversation in order of (turn, start, end, entity)."""
    entries = F.flatten(
        F.transform(redacted, lambda e: F.transform(e["spans"], lambda s: audit_entry(e["role"], s, rules)))
    )
    return F.array_join(entries, "; ")


def detections(turns: DataFrame, *keys: str, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """The structured audit: one row per span of a turn table with ``spans``."""
    rows = explode_items(turns, F.col("spans"), *keys, "turn", "role")
    return rows.select(
        *keys, "turn", "role", "_item.entity", "_item.start", "_item.end",
        shown_text(F.col("_item.matched"), rules).alias("matched"), "_item.score", "_item.detector",
    )


def audit_summary(found: DataFrame) -> DataFrame:
    """Spans, turns and characters per role and entity."""
    return found.groupBy("role", "entity").agg(
        F.count("*").alias("spans"),
        F.sum((F.col("end") - F.col("start")).cast("long")).alias("characters"),
        F.min("score").alias("lowest_score"),
        F.max("score").alias("highest_score"),
    )
