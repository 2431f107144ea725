"""Truth tables and properties of the text functions."""

import itertools
import random
import sys
import unicodedata

import pytest
from pyspark.sql import functions as F

from quillstream.functions import bengali, english, text


def u(codes: str) -> str:
    return "".join(chr(int(c, 16)) for c in codes.split())


def test_space_characters_are_those_of_unicode_strip():
    assert set(text.SPACE_CHARS) == {chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace()}


def column(spark, values, f):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").select("i", f(F.col("v")).alias("x")).collect()
    return [r.x for r in sorted(rows, key=lambda r: r.i)]


def test_strip_and_tokens_are_unicode_aware(spark):
    odd = [u("2003 20 61 A0 62 3000"), u("1C 61 85 62"), "", u("20 2009"), u("61 0B 62 1F 63")]
    assert column(spark, odd, text.strip) == [x.strip() for x in odd]
    assert column(spark, odd, text.tokens) == [x.split() for x in odd]


def test_nfc_equals_unicodedata(spark):
    rng = random.Random(4)
    letters = u("0995 09AF 09A1 09A2 09BC 09CD 09FE 09C7 09BE 09CB 09CC 09D7 09DC 09DF 0981 09BE")
    cases = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 6))) for _ in range(3000)] + ["".join(p) for p in itertools.product(u("0995 09BC 09CD 09FE"), repeat=4)]
    assert column(spark, cases, bengali.nfc) == [unicodedata.normalize("NFC", c) for c in cases]


CASES = {
    "বাংলা": (True, False), "বাংলাদেশ": (True, False), "দুঃখ": (True, False), "সুতরাং": (True, False), "চাঁদ": (True, True), "হাঁটা": (True, True), "অংশ": (True, True),
    "জন্য": (True, True), "ছয়": (True, True), "মধযে": (True, True), "াক": (False, False), "অণ্": (False, False), "১২": (False, False), "ক১": (True, False), "কাা": (False, False),
    "ক্্ক": (False, True), "কৄা": (False, True), "abc": (False, False), "ক" * 21: (False, True), "ক" * 26: (False, False), "": (False, False),
}


def test_validators(spark):
    words = list(CASES)
    assert column(spark, words, lambda w: bengali.valid(w, "lexicon")) == [CASES[w][0] for w in words]
    assert column(spark, words, lambda w: bengali.valid(w, "transition")) == [CASES[w][1] for w in words]
    assert column(spark, [u("0995 200C 0996"), u("09BE 0995"), u("09E7 09E8"), u("0995") * 40], lambda w: bengali.valid(w, "profile")) == [True, False, False, True]
    assert column(spark, [None], lambda w: bengali.valid(w, "lexicon")) == [False]


#: As code points: the nukta forms apart and composed, a joiner between, a vowel sign apart, a byte order mark, punctuation.
GIVEN = [u(c) for c in ("09A1 09BC", "09DC", "09A1 200C 09BC", "09C7 09BE", "FEFF 0995", "28 0995 29 2C")]
NORMALISED = {
    "lexicon": [u(c) for c in ("09DC", "09DC", "09DC", "09CB", "FEFF 0995", "0995")],
    "transition": [u(c) for c in ("09DC", "09DC", "09A1 09BC", "09CB", "0995", "28 0995 29 2C")],
    "dictionary": [u(c) for c in ("09DC", "09DC", "09A1 200C 09BC", "09CB", "FEFF 0995", "28 0995 29 2C")],
}


@pytest.mark.parametrize("profile", NORMALISED)
def test_normalisers(spark, profile):
    assert column(spark, GIVEN, lambda x: bengali.normalise(x, profile)) == NORMALISED[profile]


def test_english_tokens(spark):
    given = ['"Hello,"', "Don’t", "a,b", "123", "dont", "lets", "rock'n'roll", "x2y", "it`s", "a" * 26, "-", ""]
    assert column(spark, given, english.clean) == ["hello", "don't", "", "", "don't", "let's", "", "", "it's", "", "", ""]


def test_attributes_and_numbers(spark):
    lines = ["word=a,f=3,f=9", "word=a", "word=a,f=x", "f=1,f=2"]
    assert column(spark, lines, lambda x: text.attribute(x, "f")) == ["9", None, "x", "2"]
    assert column(spark, ["5", "+7", " 8 ", "x", None, "99999999999"], lambda x: text.whole_number(x, 200)) == [5, 7, 8, 200, 200, 200]
    assert column(spark, ["0", "300", "17"], lambda x: text.clamp(x.cast("int"))) == [1, 255, 17]
