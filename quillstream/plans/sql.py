"""Pieces of DuckDB SQL that say what the text functions say, for the oracles."""

from __future__ import annotations

from ..functions import bengali, english, text


def quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def charset(x: str) -> str:
    """A string of any characters, the special ones by number."""
    return " || ".join(quoted(c) if c.isprintable() else f"chr({ord(c)})" for c in x)


#: The white-space class in RE2's notation.
SPACES = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def strip(x: str) -> str:
    return f"trim({x}, {charset(text.SPACE_CHARS)})"


def tokens(x: str) -> str:
    return f"list_filter(string_split_regex({x}, {quoted(SPACES)}), lambda t: t <> '')"


def pieces(x: str, delimiters: str) -> str:
    return f"list_filter(list_transform(string_split_regex({x}, {quoted(delimiters)}), lambda s: {strip('s')}), lambda s: s <> '')"


def prepared(x: str) -> str:
    return f"translate(lower({x}), '’`', '''''')"


_MAP = "MAP {" + ", ".join(f"{quoted(a)}: {quoted(b)}" for a, b in english.CONTRACTIONS.items()) + "}"


def clean(t: str) -> str:
    """The cleaned token of a prepared one, possibly invalid."""
    bare = f"regexp_replace({t}, '^[^a-z]+|[^a-z]+$', '', 'g')"
    return f"coalesce({_MAP}[{bare}], {bare})"


def words(x: str) -> str:
    """The valid English words of a prepared text."""
    return f"list_filter(list_transform({tokens(x)}, lambda t: {clean('t')}), lambda t: regexp_full_match(t, '[a-z]+(''[a-z]+)?') AND length(t) <= 25)"


def sentence_rows(table: str, block: str, condition: str = "TRUE", text_col: str = "text") -> str:
    """(block, s, sentence) of English clauses of more than three characters."""
    p = f"list_filter({pieces(prepared(text_col), english.DELIMITERS)}, lambda s: length(s) > 3)"
    return f"SELECT block, unnest(p) AS sentence, generate_subscripts(p, 1) AS s FROM (SELECT {block} AS block, {p} AS p FROM {table} WHERE {condition})"


def pair_rows(sentences: str, words_of: str, weight: int, source: int) -> str:
    """(w1, w2, cnt, total, fs) of neighbouring words; sentences: (block, s, sentence)."""
    return f"""SELECT w[i] AS w1, w[i + 1] AS w2, {weight} AS cnt, {weight} AS total, {source} * 1000000000000000 + block * 10000000000 + s * 100000 + i AS fs
      FROM (SELECT block, s, w, unnest(range(1, len(w))) AS i FROM (SELECT block, s, {words_of} AS w FROM ({sentences})))"""


def blended(*parts: str) -> str:
    return "SELECT w1, w2, sum(cnt) AS cnt, sum(total) AS total, min(fs) AS fs FROM (" + " UNION ALL ".join(parts) + ") GROUP BY w1, w2"


def ranked(pairs: str, profile) -> str:
    return f"""
    SELECT w1, CAST(rk AS INTEGER) AS rk, w2, CAST(cnt AS BIGINT) AS cnt FROM (
      SELECT *, row_number() OVER (PARTITION BY w1 ORDER BY r) AS rk FROM (
        SELECT *, row_number() OVER (PARTITION BY w1 ORDER BY cnt DESC, fs) AS r FROM (
          SELECT *, sum(total) OVER (PARTITION BY w1) AS tot, count(*) OVER (PARTITION BY w1) AS n FROM ({pairs}))
        WHERE NOT (tot < {profile.least_total} AND n < 2))
      WHERE r <= {profile.first_cut} AND w1 <> w2)
    WHERE rk <= {profile.top}"""


def replace_all(x: str, pairs: dict[str, str]) -> str:
    for a, b in pairs.items():
        x = f"replace({x}, {quoted(a)}, {quoted(b)})"
    return x


def normalise(x: str, profile: str) -> str:
    joiners = f"translate({x}, chr(8204) || chr(8205), '')"
    if profile == "lexicon":
        return f"trim({replace_all(f'nfc_normalize({strip(joiners)})', bengali.NUKTA_LETTERS)}, {charset(bengali.EDGES)})"
    if profile == "transition":
        return f"translate({replace_all(f'nfc_normalize({strip(x)})', bengali.NUKTA_LETTERS)}, chr(8204) || chr(8205) || chr(65279), '')"
    if profile == "dictionary":
        return replace_all(f"nfc_normalize({strip(x)})", bengali.NUKTA_LETTERS)
    return f"nfc_normalize(trim({x}, {charset(bengali.PROFILE_EDGES)}))"


def valid(w: str, profile: str) -> str:
    signs, no_start = bengali.VOWEL_SIGNS, bengali.NO_START
    if profile == "lexicon":
        rules = [r"regexp_full_match({w}, '[\x{980}-\x{9ff}]{1,20}')", "NOT regexp_matches({w}, '^[" + no_start + "]')", "NOT ends_with({w}, '" + bengali.VIRAMA + "')", "NOT regexp_matches({w}, '[" + signs + "]{2}|" + bengali.VIRAMA * 2 + "')", r"NOT regexp_full_match({w}, '[\x{9e6}-\x{9ef}]+')"]
    elif profile == "transition":
        plain = bengali.TRANSITION_SIGNS.replace(bengali.VIRAMA, "")
        rules = [r"regexp_full_match({w}, '[\x{980}-\x{9e5}\x{9f0}-\x{9ff}]{1,25}')", "NOT regexp_matches({w}, '^[" + bengali.TRANSITION_SIGNS + "]')", "NOT ends_with({w}, '" + bengali.VIRAMA + "')", "NOT regexp_matches({w}, '[" + plain + "][" + plain.replace(bengali.CANDRABINDU, "") + "]')"]
    else:
        rules = [r"regexp_full_match({w}, '[\x{980}-\x{9ff}\x{200c}\x{200d}]+')", "NOT regexp_matches({w}, '^[" + no_start + "]')", r"NOT regexp_full_match({w}, '[\x{9e6}-\x{9ef}]+')"]
    return " AND ".join(r.replace("{w}", w) for r in rules)


def values(rows: list[tuple], columns: str) -> str:
    literal = lambda x: "NULL" if x is None else charset(x) if isinstance(x, str) and x else "''" if x == "" else str(x)
    return "(VALUES " + ", ".join("(" + ", ".join(literal(x) for x in r) + ")" for r in rows) + f") AS v({columns})"
