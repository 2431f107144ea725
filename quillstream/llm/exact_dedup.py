"""Operator 6: exact deduplication by skew-safe combining, in DataFrame operations only.

Documents with equal normalised text form a group. Three combining stages: each task combines its own
rows (Spark's partial aggregate), groups of (digest, salt) are merged after the exchange, and the salt
winners are combined over all salts. Every stage groups by the full text beside the digest, so equal
digests of different texts never merge. A hot text is spread over `salts` tasks at each shuffle of rows.

The members meet their group by its digest, length and a second hash, after it is shown that no two groups share these; if two
did, the query would raise rather than merge them. Very long texts are rows like others. Nulls: a null text counts as empty; a null id never wins over another id. Repeated rows (same id, same
text) are members like any other, all of them marked kept if their id is the smallest, since nothing
tells them apart. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed value: a run of the white space U+0020, U+0009-U+000D.
SPACES = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 32) -> DataFrame:
    """One row per document: (id, keep_id, group_size, kept, text_sha256)."""
    text = normalised(F.col(text_col))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("t")).withColumns(
        {"digest": F.sha2(F.col("t").cast("binary"), 256), "salt": F.when(F.col("id").isNull(), F.pmod(F.monotonically_increasing_id(), F.lit(salts))).otherwise(F.pmod(F.hash("id"), F.lit(salts))).cast("int"), "length": F.octet_length("t")}
    )
    salted = rows.groupBy("digest", "salt", "t").agg(F.min("id").alias("id"), F.count("*").alias("n"), F.max(F.col("id").isNull()).alias("no_id"))
    # Rows without an id may have got any salt.
    in_salts = F.when(F.col("no_id"), F.lit(-1).cast("long")).otherwise(F.expr("shiftleft(1L, salt)"))
    merged = salted.groupBy("digest", "t").agg(F.min("id").alias("keep_id"), F.sum("n").alias("group_size"), F.bit_or(in_salts).alias("in_salts"))
    # Groups differ in content. Their keys are shown to differ too, so a member that meets a group's key has its content.
    keyed = merged.select("digest", F.octet_length("t").alias("length"), F.xxhash64("t").alias("check"), "keep_id", "group_size", "in_salts")
    texts = F.count("*").alias("texts")
    single = keyed.groupBy("digest", "length", "check").agg(F.first("keep_id").alias("keep_id"), F.first("group_size").alias("group_size"), F.first("in_salts").alias("in_salts"), texts)
    proven = F.when(F.col("texts") == 1, F.col("group_size")).otherwise(F.raise_error(F.lit("two texts with one SHA-256, length and hash")).cast("long"))
    # One row per salt that holds the text: the join below deals a hot group out over its salts.
    winners = single.select("digest", "length", "check", "keep_id", proven.alias("group_size"), F.explode(F.expr(f"filter(sequence(0, {salts - 1}), x -> shiftright(in_salts, x) & 1L = 1L)")).alias("salt"))
    members = rows.select("id", "digest", "salt", "length", F.xxhash64("t").alias("check"))
    joined = members.join(winners, ["digest", "salt", "length", "check"])
    return joined.select(
        F.col("id").alias(id_col), "keep_id", "group_size", F.coalesce(F.col("id") == F.col("keep_id"), F.col("keep_id").isNull()).alias("kept"), F.col("digest").alias("text_sha256")
    )


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 32) -> DataFrame:
    """The documents that stay, with all their columns."""
    found = exact_dedup(docs, id_col, text_col, salts).where("kept").select(F.col(id_col).alias("_id"), F.col("text_sha256").alias("_sha"))
    same = docs[id_col].eqNullSafe(found["_id"]) & (F.sha2(normalised(docs[text_col]).cast("binary"), 256) == found["_sha"])
    return docs.join(found, same, "left_semi")


ORACLE_SQL = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM n
"""
