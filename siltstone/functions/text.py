"""Trimming, reasoning traces and documents as Column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 25 code points with the Unicode property White_Space.
WHITE_SPACE = "".join(
    map(chr, [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)
# Marks around the thinking part of a model's answer; openers in the order tried, closers by priority.
OPENERS = ("<|think_start|>", " thinking", "<think>")
CLOSERS = ("<|think_end|>", "<｜end▁of▁thinking｜>", "</think>")


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def unicode_trim(c: Column | str) -> Column:
    """Strip every Unicode white-space character from both ends (trim() alone knows only U+0020)."""
    return F.trim(_column(c), F.lit(WHITE_SPACE))


def field_or_blank(c: Column | str) -> Column:
    """A trimmed field; null is the empty string."""
    return F.coalesce(unicode_trim(c), F.lit(""))


def without_opener(c: Column | str) -> Column:
    """The text after one opener, if it begins with one (no opener is the beginning of another)."""
    return F.regexp_replace(_column(c), r"\A(?:" + "|".join(map(re.escape, OPENERS)) + ")", "")


def split_trace(c: Column | str) -> Column:
    """struct(thinking, answer) of an answer: split at the first place of the closer with the highest priority.

    Without a closer everything is thinking and the answer is empty. Null is
    empty. Written with few copies of the text, so that plans stay small.
    """
    text = without_opener(F.coalesce(_column(c), F.lit("")))
    closer = F.coalesce(*[F.when(F.contains(_column(c), F.lit(x)), F.lit(x)) for x in CLOSERS])
    before = F.call_function("substring_index", text, closer, F.lit(1))
    after = F.call_function("substring", text, F.length(before) + F.length(closer) + 1)
    thinking = unicode_trim(F.coalesce(before, text))
    return F.struct(thinking.alias("thinking"), F.coalesce(unicode_trim(after), F.lit("")).alias("answer"))


def format_document(instruction: Column, intent: Column, thinking: Column, response: Column) -> Column:
    """The Markdown document of a record; sections with empty bodies are left out."""

    def section(title: str, body: Column) -> Column:
        return F.when(body != "", F.concat(F.lit(f"### {title}\n\n"), body, F.lit("\n\n"))).otherwise(F.lit(""))

    return F.concat(
        F.lit("### Question\n\n"), instruction, F.lit("\n\n"),
        section("What the user wants", intent), section("Reasoning", thinking), section("Answer", response), F.lit("---\n\n"),
    )


def compact_list(c: Column | str) -> Column:
    """A list without its null elements; a null list is empty."""
    return F.array_compact(F.coalesce(_column(c), F.array()))
