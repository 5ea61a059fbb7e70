"""Parts of the equivalent SQL that several queries share."""

from __future__ import annotations

# blanks at the ends: the class of parlance.functions.text in RE2 spelling
WS = r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def lines(x: str) -> str:
    """Non-blank lines of a text."""
    return f"CAST(len(list_filter(string_split({x}, chr(10)), lambda l: {strip('l')} <> '')) AS BIGINT)"


#: m: messages once; ch, us: the two most frequent speakers; v: valid messages; c: those of ch
MESSAGES = f"""
WITH m AS (
  SELECT DISTINCT msg_id, src, seq, {strip("coalesce(time, '')")} AS ts_raw, {strip("coalesce(sender, '')")} AS sender, coalesce(content, '') AS content
  FROM chat_messages),
counts AS (SELECT sender, count(*) AS n, min({{'a': src, 'b': seq}}) AS p FROM m GROUP BY sender),
ch AS (SELECT sender FROM counts ORDER BY n DESC, p LIMIT 1),
us AS (SELECT sender FROM counts ORDER BY n DESC, p LIMIT 1 OFFSET 1),
v AS (SELECT * FROM m WHERE content <> '' AND NOT starts_with(content, '=====')),
c AS (SELECT * FROM v WHERE sender = (SELECT sender FROM ch))
"""
