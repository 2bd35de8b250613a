"""Texts scrambled by shifting code points, then learned back."""

from __future__ import annotations

from pyspark.sql import functions as F

from hydrolake.operators import extract_glyphs
from hydrolake.plans.registry import query, table, text

# digits 0-9 become ten private code points at a stride of two
_DIGITS, _PUA = "0123456789", "".join(chr(0xE100 + 2 * i) for i in range(10))
# letters become characters of a rare block at a stride of three
_LETTERS = "abcdefghijklmnopqrstuvwxyz"
_RARE = "".join(chr(0x3400 + 3 * i) for i in range(26))


def _numbers(spark, sf):
    scrambled = F.translate(text("o_custkey"), _DIGITS, _PUA)
    return table(spark, sf, "orders").select(
        (F.col("o_orderkey") % 3).alias("run"), "o_orderkey",
        F.concat(F.lit("#f1otltag"), scrambled, F.lit("#FontTag")).alias("rz"))


@query("SELECT r AS run, chr(57600 + CAST(2 * d AS INT)) AS glyph, CAST(d AS VARCHAR) AS digit FROM (SELECT unnest([0, 1, 2]) AS r), (SELECT unnest(range(10)) AS d)")
def infer_digits(spark, sf):
    return extract_glyphs.infer_digits(_numbers(spark, sf), ["run"], ["rz"]).select(
        F.col("run").cast("int").alias("run"), "glyph", "digit")


def _pairs(spark, sf):
    """Part names, scrambled, beside the truth; every ninth row is off by one."""
    return table(spark, sf, "part").select(
        (F.col("p_partkey") % 2).alias("run"), "p_partkey", F.translate("p_name", _LETTERS, _RARE).alias("enc"),
        F.expr("CASE WHEN p_partkey % 9 = 0 THEN concat(substr(p_name, 2), substr(p_name, 1, 1)) ELSE concat(' ', p_name) END").alias("truth"))


@query(f"""WITH c AS (SELECT p_partkey % 2 AS run, p_partkey, translate(p_name, '{_LETTERS}', '{_RARE}') AS enc, trim(CASE WHEN p_partkey % 9 = 0 THEN concat(substr(p_name, 2), substr(p_name, 1, 1)) ELSE concat(' ', p_name) END) AS truth FROM part),
 u AS (SELECT run, p_partkey, pos, substr(enc, pos, 1) AS glyph, substr(truth, pos, 1) AS ch FROM (SELECT *, unnest(range(1, length(enc) + 1)) AS pos FROM c WHERE length(enc) = length(truth))),
 t AS (SELECT run, glyph, ch, count(*) AS votes, min(p_partkey * 1000 + pos) AS seen FROM u WHERE glyph NOT IN ('.', '-', '+', ' ') GROUP BY ALL)
 SELECT run, glyph, arg_min(ch, -votes * 1000000000000 + seen) AS ch, max(votes) AS votes, count(*) AS rivals FROM t GROUP BY run, glyph""")
def train_glyphs(spark, sf):
    return extract_glyphs.train_glyphs(_pairs(spark, sf), ["run"], "enc", "truth", ["p_partkey"])


@query(f"""SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN p_name ELSE replace(translate(translate(p_name, 'z', '{_RARE[25]}'), 'aeiou', '{''.join(_RARE[_LETTERS.index(v)] for v in 'aeiou')}'), ' ', '') END AS decoded,
 CASE WHEN p_partkey % 5 = 0 THEN 0 ELSE length(regexp_replace(p_name, '[^aeiouz]', '', 'g')) END AS unresolved_count FROM part""")
def decode_glyphs(spark, sf):
    # the map knows the consonants only; vowels and z stay unresolved
    learned = extract_glyphs.train_glyphs(_pairs(spark, sf), ["run"], "enc", "truth", ["p_partkey"])
    consonants = learned.where(~F.col("ch").isin(*"aeiouz"))
    tagged = _pairs(spark, sf).select("run", "p_partkey", F.expr(
        "CASE WHEN p_partkey % 5 = 0 THEN trim(CASE WHEN p_partkey % 9 = 0 THEN concat(substr(truth, -1), substr(truth, 1, length(truth) - 1)) ELSE truth END) ELSE concat('#f2otltag', enc, '#FontTag') END").alias("decoded"))
    out = extract_glyphs.decode_glyphs(tagged, consonants, ["run"], ["decoded"])
    return out.select("p_partkey", "decoded", F.col("unresolved_count").cast("bigint").alias("unresolved_count"))
