"""Language signals, junk reasons, ratios, the quality score, token estimates and hashes, as Column functions."""

from __future__ import annotations

import functools
import itertools
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from textmill.config import Quality
from textmill.functions.text import SPACE, let, strip, text_of, tokens, words

# The letters and frequent words of Turkish, and phrases of junk.
LETTERS = "çğıöşüÇĞİÖŞÜ"
COMMON = [
    "bir", "ve", "de", "da", "bu", "için", "ile", "ne", "var", "yok",
    "gibi", "daha", "kadar", "her", "ama", "çok", "o", "ben", "sen",
    "biz", "siz", "onlar", "en", "sonra", "olarak", "olan", "ki", "değil",
    "göre", "kendi", "ise", "diye", "hem", "sadece", "tüm", "şeyi", "şey",
    "gün", "dünya", "yer", "yeni", "zaman", "insan", "büyük", "iyi",
    "bugun", "cok", "guzel", "disari", "cikip", "gezmek", "istiyorum", "hava",
]
ASCII_FORMS = ("cgiosuCGIOSU", "çğıöşüÇĞİÖŞÜ")
JUNK = [
    "bahis", "casino", "poker", "slot", "kaçak iddaa", "bonus veritabanı",
    "kredi kartı borcu", "şans oyunları", "tıkla indir", "whatsapp grubu",
    "canlı maç izle", "bedava izle", "escort", "sohbet hattı",
]
MASH = "asdfghjklñzxcvbnmşiğüöç1234567890"
URL = rf"https?://[^\s\x1c-\x1f\x85\p{{Z}}]+|www\.[^\s\x1c-\x1f\x85\p{{Z}}]+"


@functools.cache
def digits() -> str:
    """The class of digits: decimal ones and those with a digit value. ASCII is decided first, since a class of many
    ranges is slow."""
    extra = [i for i in range(128, 0x110000) if unicodedata.category(chr(i)) == "No" and chr(i).isdigit()]
    runs = [list(g) for _, g in itertools.groupby(extra, key=lambda i, n=itertools.count(): i - next(n))]
    more = "".join(f"\\x{{{r[0]:x}}}-\\x{{{r[-1]:x}}}" for r in runs)
    return rf"[0-9]|(?![\x00-\x7f])[\p{{Nd}}{more}]"


@functools.cache
def ascii_known() -> list[str]:
    """What becomes a frequent word or a letter of Turkish when its ASCII letters take their Turkish forms."""
    back = {ord(t): (a, t) for a, t in zip(*ASCII_FORMS, strict=True)}
    words = [w for w in [*COMMON, *LETTERS] if not set(w) & set(ASCII_FORMS[0])]
    return sorted("".join(x) for w in words for x in itertools.product(*(back.get(ord(c), c) for c in w)))


def share(hits: Column, all_: Column) -> Column:
    """hits / all_, 0 where there is nothing."""
    return F.coalesce(hits.cast("double") / F.nullif(all_, F.lit(0)), F.lit(0.0))


def taken(t: Column, pattern: str) -> Column:
    """Characters in matches of the pattern."""
    return F.length(t) - F.length(F.regexp_replace(t, pattern, ""))


def language(c: Column) -> Column:
    """struct(confidence, code): tr, tr_ascii, tr_low, non_tr or unknown."""
    return let(words(c), lambda w: let(_signals(text_of(c), w), _language))


def _signals(t: Column, w: Column) -> Column:
    """struct of word, letter and hit counts, each taken once."""
    marks = F.when(F.octet_length(t) == F.length(t), 0).otherwise(taken(t, f"[{LETTERS}]+"))  # all of them take two bytes
    known = F.size(F.filter(w, lambda x: x.isin(COMMON)))
    asc = F.size(F.filter(w, lambda x: x.isin(ascii_known())))
    return F.struct(F.size(w).alias("n"), marks.alias("marks"), known.alias("known"), asc.alias("asc"), F.length(t).alias("chars"))


def _language(x: Column) -> Column:
    n, marks, known = x["n"], x["marks"], x["known"]
    mark_ratio, word_ratio, ascii_ratio = share(marks, x["chars"]), share(known, n), share(x["asc"], n)
    out = lambda conf, code: F.struct(conf.alias("confidence"), F.lit(code).alias("code"))
    return (
        F.when(n == 0, out(F.lit(0.0), "unknown"))
        .when((mark_ratio >= 0.005) | ((marks > 0) & (word_ratio >= 0.05)), out(F.least(F.lit(1.0), mark_ratio * 20.0 + word_ratio * 4.0 + 0.5), "tr"))
        .when((word_ratio >= 0.08) | (ascii_ratio >= 0.08), out(F.least(F.lit(0.9), ascii_ratio * 4.0 + 0.5), "tr_ascii"))
        .when(known > 0, out(F.lit(0.35), "tr_low"))
        .otherwise(out(F.lit(0.05), "non_tr"))
    )


def junk_reason(c: Column, max_repeat: int = 8) -> Column:
    """The first reason that holds, or ''."""
    return let(text_of(c), lambda t: let(strip(t), lambda s: _reason(t, s, max_repeat)))


def _reason(t: Column, s: Column, max_repeat: int) -> Column:
    phrases = let(F.lower(t), lambda low: functools.reduce(lambda a, b: a + b, [F.contains(low, F.lit(k)).cast("int") for k in JUNK]))
    two = lambda w: (F.size(w) > 10) & (F.size(F.array_distinct(w)) <= 2)
    begun = let(F.split(F.lower(F.substring(s, 1, 300)), f"{SPACE}+"), lambda w: F.when(F.length(s) > 300, F.slice(w, 1, F.size(w) - 1)).otherwise(w))
    start = F.size(F.array_distinct(begun)) <= 2  # more than two whole words at the start decide it for any text
    return (
        F.when(s == "", "EMPTY")
        .when(t.rlike(rf"([^\n])\1{{{max_repeat},}}"), "REPEATED_CHARACTERS")
        .when((F.length(s) < 50) & s.rlike(rf"(?iu)\A[{MASH}]+\z"), "KEYBOARD_MASH")
        .when(start & let(tokens(F.lower(s)), two), "REPEATED_WORD_SPAM")
        .when(phrases >= 2, "SPAM_KEYWORDS")
        .when((F.length(t) > 10) & ~t.rlike(r"\p{L}"), "NO_ALPHABETIC_CHARACTERS")
        .otherwise("")
    )


def ratios(c: Column) -> Column:
    """struct of alpha, digit, punct and url: their characters over all."""
    return let(text_of(c), lambda t: let(F.length(t), lambda n: F.struct(
        share(F.length(F.regexp_replace(t, r"[^A-Za-z\p{L}]+", "")), n).alias("alpha"), share(taken(t, digits()), n).alias("digit"),
        share(taken(t, r"[^A-Za-z0-9\p{L}\p{N}\s\x1c-\x1f\x85\p{Z}]+"), n).alias("punct"), share(taken(t, URL), n).alias("url"),
    )))


def word_count(c: Column) -> Column:
    return F.size(tokens(c))


def score(length: Column, n_words: Column, confidence: Column, reason: Column, r: Column, cfg: Quality = Quality()) -> Column:
    """0 to 100 from the parts; at most 85 is reached."""
    x = confidence * 35.0
    x = x + F.when(r["alpha"] >= 0.60, F.lit(25.0)).otherwise(r["alpha"] / 0.60 * 25.0)
    x = x + F.when(n_words >= 10, F.lit(15.0)).otherwise(n_words.cast("double") / 10.0 * 15.0)
    x = x + F.when(length.between(50, 100_000), 10.0).otherwise(0.0)
    x = x - F.when(reason != "", 50.0).otherwise(0.0)
    for part, most, loss in (("punct", cfg.max_punctuation_ratio, 20.0), ("digit", cfg.max_digit_ratio, 20.0), ("url", cfg.max_url_ratio, 25.0)):
        x = x - F.when(r[part] > most, loss).otherwise(0.0)
    return F.when(reason == "EMPTY", 0.0).otherwise(F.round(F.greatest(F.lit(0.0), F.least(F.lit(100.0), x)), 2))


def with_quality(df, text: str, cfg: Quality = Quality(), into: str = "quality"):
    """Adds a struct: score, char_count, word_count, lang_confidence, lang_code, is_spam, spam_reason and ratios."""
    t = F.col(text)
    parts = F.struct(language(t).alias("lang"), junk_reason(t, cfg.max_repeated_char_count).alias("reason"), ratios(t).alias("r"), word_count(t).alias("words"), F.length(text_of(t)).alias("chars"))
    some = lambda q, c, none: F.when(q["reason"] == "EMPTY", F.lit(none)).otherwise(c)
    whole = lambda q: F.struct(
        score(q["chars"], q["words"], q["lang"]["confidence"], q["reason"], q["r"], cfg).alias("score"), q["chars"].alias("char_count"), q["words"].alias("word_count"),
        some(q, q["lang"]["confidence"], 0.0).alias("lang_confidence"), some(q, q["lang"]["code"], "unknown").alias("lang_code"),
        some(q, q["reason"] != "", False).alias("is_spam"), some(q, q["reason"], "").alias("spam_reason"),
        *[some(q, q["r"][k], 0.0).alias(f"{k}_ratio") for k in ("alpha", "punct", "digit", "url")],
    )
    return df.withColumn(into, let(parts, whole))


def token_estimate(c: Column) -> Column:
    t = text_of(c)
    x = (F.length(t) / F.lit(4.0) + word_count(t) * F.lit(1.3)) / F.lit(2.0)
    return F.when(t == "", 0).otherwise(F.greatest(F.lit(1), x.cast("int")))


def raw_hash(c: Column) -> Column:
    return F.sha2(text_of(c).cast("binary"), 256)


def normalized_hash(c: Column) -> Column:
    """Never null, and declared so: a join on it needs no filter that takes the hash again at the scan."""
    return F.coalesce(F.sha2(F.regexp_replace(F.lower(strip(text_of(c))), f"{SPACE}+", " ").cast("binary"), 256), F.lit(""))
