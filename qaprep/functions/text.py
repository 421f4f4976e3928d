"""Answer text: trimming, tag extraction, normalisation, comparison."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() removes.
SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
OPEN_TAG = "<answer>"
CLOSE_TAG = "</answer>"
THINK_END = "</think>"


def strip(text: Column) -> Column:
    """Trim every Unicode space on both sides (Spark's ``trim`` drops blanks only)."""
    return F.btrim(text, F.lit(SPACES))


def as_text(value: Column) -> Column:
    """The text a null-carrying value has in an answer column: a null becomes ``None``."""
    return F.coalesce(value.cast("string"), F.lit("None"))


def is_blank(text: Column) -> Column:
    return strip(text) == ""


def norm_colon(text: Column, eos: str | None = None) -> Column:
    """The answer behind the last ``": "``, else the last word without trailing periods."""
    behind = F.substring_index(text, ": ", -1)
    if eos:
        behind = F.substring_index(behind, eos, 1)
    first_word = F.regexp_extract(behind, f"^([^{SPACES}.]*)", 1)

    whole = strip(text)
    if eos:
        cut = F.substring(whole, F.lit(1), F.length(whole) - F.lit(len(eos)))
        whole = F.when(F.endswith(whole, F.lit(eos)), strip(cut)).otherwise(whole)
    last_word = F.rtrim(strip(F.substring_index(whole, " ", -1)), F.lit("."))
    return F.when(F.instr(text, ": ") > 0, first_word).otherwise(last_word)


def norm_tagged(text: Column) -> Column:
    """The body of the last answer tag, one closing period dropped; untagged text is trimmed."""
    tail = F.substring_index(text, OPEN_TAG, -1)
    body = strip(F.substring_index(tail, CLOSE_TAG, 1))
    without_period = strip(F.substring(body, F.lit(1), F.length(body) - 1))
    body = F.when(F.endswith(body, F.lit(".")), without_period).otherwise(body)
    tagged = (F.instr(text, OPEN_TAG) > 0) & (F.instr(tail, CLOSE_TAG) > 0)
    return F.when(tagged, body).otherwise(strip(text))


def tagged_spans(text: Column) -> Column:
    """All answer-tag bodies in order; a body may span lines."""
    return F.regexp_extract_all(text, F.lit("(?s)<answer>(.*?)</answer>"), 1)


def visible_answer(text: Column) -> Column:
    """What follows the last end-of-thinking mark, outer newlines removed."""
    return F.btrim(F.substring_index(text, THINK_END, -1), F.lit("\n"))


def thinking_part(text: Column) -> Column:
    """The text up to and with the last end-of-thinking mark; null when there is none."""
    size = F.length(text) - F.length(F.substring_index(text, THINK_END, -1))
    return F.when(F.instr(text, THINK_END) > 0, F.btrim(F.substring(text, F.lit(1), size), F.lit("\n")))


def json_text(value: Column) -> Column:
    """Canonical JSON text (keys sorted, 1.0 folded into 1); null when it does not parse."""
    return F.to_json(F.try_parse_json(value))


def answers_match(pred: Column, gold: Column, json_aware: bool = True) -> Column:
    """Equality of normalised answers; JSON objects are compared parsed."""
    plain = F.coalesce(pred == gold, F.lit(False))
    if not json_aware:
        return plain
    parsed = F.coalesce(json_text(pred) == json_text(gold), F.lit(False))
    return F.when(F.startswith(gold, F.lit("{")), parsed).otherwise(plain)
