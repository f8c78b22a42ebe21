"""Cleaning: encoding repair, Unicode, markup and white space, as Column functions.

Null counts as empty text throughout. Character classes follow Python's: see SPACE and NO_WORD.
"""

from __future__ import annotations

import html
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from textmill.config import Cleaning

#: What counts as white space, and the same without the line feed.
SPACE = r"[\s\x1c-\x1f\x85\p{Z}]"
SPACE_IN_LINE = r"[\t\x0b\x0c\r\x1c-\x1f\x85\p{Z}]"
#: All characters of SPACE.
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
NO_WORD = r"[^a-z0-9\p{L}\p{N}_]+"

# Damaged sequences and what they stand for, in the order of their replacement.
MOJIBAKE = [
    ("Ã§", "ç"),
    ("Ã‡", "Ç"),
    ("ÄŸ", "ğ"),
    ("ÄĞ", "Ğ"),
    ("Ä±", "ı"),
    ("Ä°", "İ"),
    ("Ã¶", "ö"),
    ("Ã–", "Ö"),
    ("ÅŸ", "ş"),
    ("ÅŞ", "Ş"),
    ("Ã¼", "ü"),
    ("ÃÜ", "Ü"),
    ("â€™", "'"),
    ("â€œ", '"'),
    ("â€", '"'),
    ("Â", ""),
    ("�", ""),
]
# Tags that go with what they hold, and tags that break lines.
BLOCK_TAGS = "script|style|svg|noscript|iframe"
LINE_TAGS = "br|p|div|tr|h[1-6]"


def text_of(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def let(c: Column, f) -> Column:
    """f of the value of c, which is computed once however often f uses it."""
    return F.get(F.transform(F.array(c), f), F.lit(0))


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(SPACES))


def words(c: Column) -> Column:
    """Word runs of the lower-cased text."""
    return F.array_remove(F.split(F.lower(text_of(c)), NO_WORD), "")


def tokens(c: Column) -> Column:
    """Runs without white space."""
    return F.array_remove(F.split(text_of(c), rf"{SPACE}+"), "")


def broken_encoding(c: Column) -> Column:
    """A NUL, or more than five replacement characters that make up over 5 % of the raw text."""
    t = text_of(c)
    bad = F.length(t) - F.length(F.replace(t, F.lit("�"), F.lit("")))
    return F.contains(t, F.lit("\x00")) | ((bad > 5) & (bad / F.nullif(F.length(t), F.lit(0)) > 0.05))


def repair_mojibake(c: Column) -> Column:
    t = text_of(c)
    damaged = F.lit(False)
    fixed = t
    for bad, good in MOJIBAKE:
        damaged = damaged | F.contains(t, F.lit(bad))
        fixed = F.replace(fixed, F.lit(bad), F.lit(good))
    narrow = F.when(t.rlike("[ÃÄÅ]") & ~t.rlike("[^\\u0000-\\u00ff]"), t)
    trip = F.try_validate_utf8(F.encode(narrow, "ISO-8859-1").cast("string"))
    return F.when(damaged, fixed).otherwise(F.coalesce(trip, t))


def drop_controls(c: Column) -> Column:
    return F.regexp_replace(text_of(c), r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x9f]", "")


@F.pandas_udf(StringType())
def _normal(text: pd.Series, form: pd.Series) -> pd.Series:
    return pd.Series([unicodedata.normalize(f, t) for t, f in zip(text, form, strict=True)])


def normal_form(c: Column, form: str = "NFC") -> Column:
    """Without one leading byte order mark, in the Unicode form."""
    return _normal(F.regexp_replace(text_of(c), r"\A﻿", ""), F.lit(form))


def strip_html(c: Column) -> Column:
    """Blocks of code and frames go, tags that break lines become line feeds, other tags become a space."""
    t = text_of(c)
    x = F.regexp_replace(t, rf"(?is)<({BLOCK_TAGS})[^>]*>.*?</\1>", " ")
    x = F.regexp_replace(x, rf"(?iu)<({LINE_TAGS})\b[^>]*>", "\n")
    x = F.regexp_replace(x, r"<[^>]+>", " ")
    return F.when(F.contains(t, F.lit("<")) & F.contains(t, F.lit(">")), x).otherwise(t)


@F.pandas_udf(StringType())
def _entities(text: pd.Series) -> pd.Series:
    return text.map(lambda t: html.unescape(t) if "&" in t else t)


def decode_entities(c: Column) -> Column:
    return _entities(text_of(c))


def strip_markdown(c: Column, headers: bool = False) -> Column:
    x = F.regexp_replace(text_of(c), r"\[([^\]]+)\]\([^)]+\)", "$1")
    x = F.regexp_replace(x, r"(\*\*|__|[*_])([^\n]*?)\1", "$2")
    return F.regexp_replace(x, rf"(?m)^{SPACE}{{0,3}}#{{1,6}}{SPACE}+", "") if headers else x


def even_space(c: Column) -> Column:
    """Line feeds only, no space at line ends, single spaces inside, at most one blank line, no outer space."""
    x = F.regexp_replace(text_of(c), r"\r\n?", "\n")
    x = F.regexp_replace(x, r" [ \t]+|\t[ \t]*", " ")
    x = F.regexp_replace(x, rf"{SPACE_IN_LINE}+\n", "\n")  # outer space goes at the end
    x = F.regexp_replace(x, rf"\n{SPACE_IN_LINE}+", "\n")
    return strip(F.regexp_replace(x, r"\n{3,}", "\n\n"))


def clean(c: Column, file_type: Column | str = "txt", cfg: Cleaning = Cleaning()) -> Column:
    """All steps in their order; file_type may differ by row."""
    kind = F.lit(file_type) if isinstance(file_type, str) else file_type
    x = text_of(c)
    if cfg.fix_mojibake:
        x = repair_mojibake(x)
    if cfg.remove_control_characters:
        x = drop_controls(x)
    if cfg.normalize_unicode:
        x = normal_form(x, cfg.unicode_form)
    x = strip_html(x) if cfg.clean_html else F.when(kind == "html", strip_html(x)).otherwise(x)
    if cfg.unescape_html_entities:
        x = decode_entities(x)
    if cfg.clean_markdown_wrapping:
        x = F.when(kind == "markdown", strip_markdown(x)).otherwise(x)
    return even_space(x) if cfg.normalize_whitespace else x


def clean_meta(raw: Column, cleaned: Column) -> Column:
    return F.struct(
        (repair_mojibake(raw) != text_of(raw)).alias("mojibake_fixed"), broken_encoding(raw).alias("unrecoverable_encoding"),
        F.length(text_of(raw)).alias("original_len"), F.length(cleaned).alias("cleaned_len"),
    )
