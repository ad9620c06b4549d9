"""Scalar text functions (F5, F6, F7, F9), all built-in JVM expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The social-text cleanup patterns and the script classes.
FIRST_RT = r"^((?s).*?)RT"          # drop the first "RT" anywhere in the text
HANDLE = r"@\p{L}+"                 # "@" followed by letters
HANDLE_WORD = r"@\w+"               # optional: whole handle incl. digits/_
URL = r"https?://\S+\s?"            # URL plus one following blank
HIRAGANA = r"\p{InHiragana}"
HANGUL = r"\p{IsHangul}"
NEWLINES = r"\r|\n"


def clean_social_text(c: Column, whole_handles: bool = False) -> Column:
    """First ``RT`` removed, ``@handle`` letters removed, URLs removed."""
    out = F.regexp_replace(c, FIRST_RT, "$1")
    out = F.regexp_replace(out, HANDLE_WORD if whole_handles else HANDLE, "")
    return F.regexp_replace(out, URL, "")


def strip_newlines(c: Column) -> Column:
    return F.regexp_replace(c, NEWLINES, " ")


def script_flags(text: Column) -> tuple[Column, Column]:
    """(has Hiragana, has Hangul) -- computed where the text is scanned."""
    return text.rlike(HIRAGANA), text.rlike(HANGUL)


def script_override_flags(lang: Column, hiragana: Column, hangul: Column, wrong: str = "lt") -> Column:
    """Fix a wrong guess: Hiragana -> ja, Hangul -> ko (only when lang == wrong)."""
    return (
        F.when((lang == wrong) & hiragana, F.lit("ja"))
        .when((lang == wrong) & hangul, F.lit("ko"))
        .otherwise(lang)
    )


def script_override(lang: Column, text: Column, wrong: str = "lt") -> Column:
    return script_override_flags(lang, *script_flags(text), wrong=wrong)
