r"""Chat formatting in DataFrame expressions only.

A conversation becomes one text. Turns in order, those of one role that follow each other merged:

    ### user: first text</part>second text</turn>
    ### assistant: answer</turn>

Control strings inside texts and roles are escaped, so the text can be read back: a backslash
becomes \s, ``</turn>`` \t, ``</part>`` \p, ``### `` \h and, in roles, a colon \c. Beside the text
stands its loss mask: the text cut into segments, each with a flag that says whether it is learnt.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quakelake.llm.support import pick

OPEN = "### "
AFTER_ROLE = ": "
NEXT_PART = "</part>"
CLOSE = "</turn>\n"
LEARNT_ROLE = "assistant"
# In the order of escaping; reading back goes the other way.
_ESCAPES = (("\\", "\\s"), ("</turn>", "\\t"), (NEXT_PART, "\\p"), (OPEN, "\\h"))
_ROLE_ESCAPES = (*_ESCAPES, (":", "\\c"))


def escaped(text: Column, escapes: tuple = _ESCAPES) -> Column:
    for plain, mark in escapes:
        text = F.replace(text, F.lit(plain), F.lit(mark))
    return text


def unescaped(text: Column, escapes: tuple = _ESCAPES) -> Column:
    for plain, mark in reversed(escapes):
        text = F.replace(text, F.lit(mark), F.lit(plain))
    return text


def _merged(turns: Column) -> Column:
    """Runs of turns of one role as (role, texts): a run starts where the role changes."""
    role_at = lambda i: F.get(turns, i).role
    places = F.sequence(F.lit(0), F.size(turns) - 1)
    starts = F.filter(places, lambda i: (i == 0) | (role_at(i) != role_at(i - 1)))

    def run(start: Column, number: Column) -> Column:
        end = F.coalesce(F.get(starts, number + 1), F.size(turns))
        texts = F.transform(F.slice(turns, start + 1, end - start), lambda turn: turn.text)
        return F.struct(role_at(start).alias("role"), texts.alias("texts"))

    return F.transform(starts, run)


def _segments(merged: Column) -> Column:
    """Segments of all runs: control strings and escaped texts, in order, with the loss flag."""

    def segment(text: Column, learnt: Column) -> Column:
        return F.struct(text.alias("text"), learnt.alias("learnt"))

    def of_run(run: Column) -> Column:
        head = F.concat(F.lit(OPEN), escaped(run.role, _ROLE_ESCAPES), F.lit(AFTER_ROLE))

        def of_text(text: Column, number: Column) -> Column:
            before = F.when(number == 0, head).otherwise(F.lit(NEXT_PART))
            return F.array(segment(before, F.lit(False)), segment(escaped(text), run.role == LEARNT_ROLE))

        parts = F.flatten(F.transform(run.texts, of_text))
        return F.concat(parts, F.array(segment(F.lit(CLOSE), F.lit(False))))

    return F.flatten(F.transform(merged, of_run))


def format_chats(conversations: DataFrame) -> DataFrame:
    """(conv_id, segments, formatted) of each conversation of (conv_id, turn, role, text).

    Turns go by turn, then role and text where turns tie; a null turn comes first. A null text or
    role is empty. Repeated rows are turns of their own. Rows of null conv_id are one conversation.
    An empty table gives no rows. A conversation is one text and so one task's work; all others are
    spread by conv_id.
    """
    rows = pick(conversations, "conv_id", "turn", "role", "text")
    turn = F.struct("turn", *(F.coalesce(name, F.lit("")).alias(name) for name in ("role", "text")))
    chats = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    merged = chats.select("conv_id", _merged(F.col("turns")).alias("merged"))
    cut = merged.select("conv_id", _segments(F.col("merged")).alias("segments"))
    joined = F.array_join(F.transform("segments", lambda part: part.text), "")
    return cut.select("conv_id", "segments", joined.alias("formatted"))


def turns_of(formatted: Column) -> Column:
    """(role, text) of each turn, in order, read back from a formatted conversation."""
    runs = F.split(formatted, CLOSE)
    runs = F.slice(runs, 1, F.size(runs) - 1)

    def of_run(run: Column) -> Column:
        body = F.substring(run, len(OPEN) + 1, F.length(run))
        role = F.substring_index(body, AFTER_ROLE, 1)
        content = F.substring(body, F.length(role) + len(AFTER_ROLE) + 1, F.length(body))
        plain = unescaped(role, _ROLE_ESCAPES)
        return F.transform(
            F.split(content, NEXT_PART), lambda text: F.struct(plain.alias("role"), unescaped(text).alias("text"))
        )

    return F.flatten(F.transform(runs, of_run))


def learnt_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped and joined."""
    learnt = F.filter(segments, lambda part: part.learnt)
    return F.array_join(F.transform(learnt, lambda part: unescaped(part.text)), "")
