import random

import pytest
from pyspark.sql import functions as F

from textmill.functions import quality as Q
from textmill.functions import records
from textmill.functions import text as T


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "t string").select(f(F.col("t")).alias("o")).first()["o"]


@pytest.mark.parametrize(
    ("f", "value", "wanted"),
    [
        (T.even_space, " a \t b \r\n\r\n\r\n\r\nc\r", "a b\n\nc"),
        (T.even_space, None, ""),
        (T.drop_controls, "a\x00b\x7fc\td", "abc\td"),
        (T.repair_mojibake, "Ã§ok gÃ¼zel Â", "çok güzel "),
        (T.repair_mojibake, "Ã¥", "å"),
        (T.repair_mojibake, "Äpfel", "Äpfel"),
        (T.normal_form, "﻿é", "é"),
        (T.strip_html, "x<script>a<b</script>y<p>z</p>", "x y\nz "),
        (T.strip_html, "a < b and c > d", "a   d"),
        (T.decode_entities, "&lt;b&gt; &amp", "<b> &"),
        (T.strip_markdown, "**a** [b](c) snake_case_x", "a b snakecasex"),
        (T.clean, "&lt;b&gt;", "<b>"),
        (T.broken_encoding, "�" * 6 + "a" * 94, True),
        (T.broken_encoding, "�" * 6 + "a" * 194, False),
        (Q.junk_reason, "a" * 8 + " bcd efg", ""),
        (Q.junk_reason, "a" * 9, "REPEATED_CHARACTERS"),
        (Q.junk_reason, "asdfghjklasdfghjkl", "KEYBOARD_MASH"),
        (Q.junk_reason, "a b " * 6, "REPEATED_WORD_SPAM"),
        (Q.junk_reason, "casino ve poker oynamak isteyenler burada", "SPAM_KEYWORDS"),
        (Q.junk_reason, "12345 67890 !!", "NO_ALPHABETIC_CHARACTERS"),
        (Q.junk_reason, " ", "EMPTY"),
        (Q.token_estimate, "", 0),
        (Q.token_estimate, "a", 1),
    ],
)
def test_text(spark, f, value, wanted):
    assert one(spark, value, f) == wanted


def test_language(spark):
    code = lambda t: one(spark, t, Q.language)["code"]
    assert code("Bugün hava çok güzel") == "tr"
    assert code("Bugun hava cok guzel") == "tr_ascii"
    assert code("completely foreign words standing here without any known ones") == "non_tr"
    assert code("...") == "unknown"


def test_record_fields(spark):
    at = lambda j: one(spark, j, records.text_field)
    assert tuple(at('{"title": "t", "content": "c"}')) == ("c", "content")
    assert at('{"question": "q?", "answer": "a"}')["field"] == "question"
    assert at('{"question": null, "answer": null}')["text"] == "Soru: \nCevap:"
    assert at('{"zz": "a string of more than twenty", "aa": "another one of more than twenty"}')["field"] == "zz"
    assert at("[1]") is None and at("{bad") is None


def test_white_space_by_set_and_by_class(spark):
    """The set that strip() takes off has the characters of the class, and even_space() gives what its plain steps give."""
    chars = spark.createDataFrame([(chr(k),) for k in range(1, 0x3100) if not 0xD800 <= k < 0xE000], "c string")
    assert {r["c"] for r in chars.where(F.col("c").rlike(rf"\A{T.SPACE}\z")).collect()} == set(T.SPACES)
    r = random.Random(9)
    rows = spark.createDataFrame([("".join(r.choices(["a", " ", "\t", "\n", "\r", "\xa0", "\x1c", "\u2003", "b c"], k=r.randint(0, 14))),) for _ in range(4000)], "t string")
    x = F.regexp_replace(F.regexp_replace("t", r"\r\n?", "\n"), r"[ \t]+", " ")
    x = F.regexp_replace(F.regexp_replace(x, rf"{T.SPACE_IN_LINE}+(?=\n|\z)", ""), rf"(\A|\n){T.SPACE_IN_LINE}+", "$1")
    x = F.regexp_replace(F.regexp_replace(x, r"\n{3,}", "\n\n"), rf"\A{T.SPACE}+|{T.SPACE}+\z", "")
    assert rows.where(x != T.even_space(F.col("t"))).count() == 0


def test_two_words_again_and_again(spark):
    """Decided from whole words of the start, and from all words where those are two at most."""
    texts = ["ab cd " * 60, "ab cd " * 49 + "ab cdx", "ab cd " * 60 + "ef", "a " * 149 + "abc" * 30, "x" * 400 + " y" * 12, "x" * 290 + " y" * 12, "one two three " * 40, "ab cd " * 5]
    got = [r[0] for r in spark.createDataFrame([(k, x) for k, x in enumerate(texts)], "k int, t string").orderBy("k").select(Q.junk_reason(F.col("t"), 1000)).collect()]
    want = ["REPEATED_WORD_SPAM" if len(x.split()) > 10 and len(set(x.split())) <= 2 else "" for x in texts]
    assert got == want and want.count("") == 4
