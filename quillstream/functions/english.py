"""English sentence delimiters and token cleaning, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import text

#: Sentence delimiters (no comma, apostrophe or hyphen) and contractions written without an apostrophe.
DELIMITERS = r"[\.\?\!\;\:\n\r\t\(\)\[\]\{\}\"—–\/\<\>\=\+\*\#\@\$\%\^\&\_\\\|]+"
CONTRACTIONS = {
    "dont": "don't",
    "cant": "can't",
    "wont": "won't",
    "im": "i'm",
    "youre": "you're",
    "theyre": "they're",
    "weve": "we've",
    "youve": "you've",
    "ive": "i've",
    "isnt": "isn't",
    "arent": "aren't",
    "wasnt": "wasn't",
    "werent": "weren't",
    "hasnt": "hasn't",
    "havent": "haven't",
    "hadnt": "hadn't",
    "doesnt": "doesn't",
    "couldnt": "couldn't",
    "shouldnt": "shouldn't",
    "wouldnt": "wouldn't",
    "didnt": "didn't",
    "thats": "that's",
    "whats": "what's",
    "lets": "let's",
}
WORD = "^[a-z]+('[a-z]+)?$"


def prepared(x: Column) -> Column:
    """Lower case and straight apostrophes; done once on a text rather than on each of its tokens."""
    return F.translate(F.lower(x), "’`", "''")


def clean(token: Column, is_prepared: bool = False) -> Column:
    """The cleaned token; empty if it is no word of 1 to 25 letters."""
    t = F.regexp_replace(token if is_prepared else prepared(text.strip(token)), "^[^a-z]+|[^a-z]+$", "")
    known = F.create_map(*[F.lit(x) for pair in CONTRACTIONS.items() for x in pair])
    t = F.coalesce(F.try_element_at(known, t), t)
    return F.when(t.rlike(WORD) & (F.length(t) <= 25), t).otherwise("")


def words(x: Column, is_prepared: bool = False) -> Column:
    """The valid words of a text; invalid tokens are dropped, so that their neighbours meet."""
    return F.filter(F.transform(text.tokens(x), lambda t: clean(t, is_prepared)), lambda t: t != "")
