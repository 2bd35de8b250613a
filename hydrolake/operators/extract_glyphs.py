"""Text whose glyphs were replaced by a scrambled font.

Learning is two aggregations over characters. Maps are kept per run (one font
per run), so decoding is an equi-join with one short map per run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from hydrolake.functions._base import col
from hydrolake.session import scratch_path

TAG = r"(?s)^#([A-Za-z0-9_]+)otltag(.*?)#FontTag$"


def split_tag(c: Column | str) -> Column:
    """``"#font otltag text #FontTag"`` to text and font id (null when plain)."""
    c = col(c).cast("string")
    hit = c.rlike(TAG)
    return F.struct(F.when(hit, F.regexp_extract(c, TAG, 2)).otherwise(F.coalesce(c, F.lit(""))).alias("text"),
                    F.when(hit, F.regexp_extract(c, TAG, 1)).alias("font"))


def code_point(ch: Column) -> Column:
    """Code point of a character (``ascii`` gives the full code point of any character)."""
    return F.ascii(ch)


def char_of(point: Column) -> Column:
    return F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32")


def infer_digits(df: DataFrame, run: list[str], cols: list[str], lowest: int = 128,
                 tagged: bool = True) -> DataFrame:
    """Which glyphs stand for 0-9: ``glyph, digit`` per run.

    Ten code points at a stride of two, all of which occur; of several such
    blocks the one that occurs most (the higher base of equals).
    """
    texts = [split_tag(c) for c in cols]
    if tagged:
        bodies = [F.when(t["font"].isNotNull(), t["text"]).otherwise("") for t in texts]
    else:
        bodies = [F.coalesce(col(c), F.lit("")) for c in cols]
    chars = df.select(*run, F.explode(F.split(F.concat(*bodies), "")).alias("ch")).where("ch != ''")
    points = (chars.groupBy(*run, "ch").agg(F.count(F.lit(1)).alias("n"))
              .withColumn("cp", code_point(F.col("ch"))).where(F.col("cp") >= lowest))
    # every point votes for the ten bases whose block it could belong to
    bases = points.select(*run, "cp", "n", F.explode(F.sequence(F.lit(0), F.lit(9))).alias("i"))
    blocks = (bases.groupBy(*run, (F.col("cp") - 2 * F.col("i")).alias("base"))
              .agg(F.count(F.lit(1)).alias("filled"), F.sum("n").alias("score")).where("filled = 10"))
    best = blocks.groupBy(*run).agg(F.max(F.struct("score", "base")).alias("b"))
    return best.select(*run, F.explode(F.sequence(F.lit(0), F.lit(9))).alias("digit"), "b.base").select(
        *run, char_of(F.col("base") + 2 * F.col("digit")).alias("glyph"), F.col("digit").cast("string"))


def train_glyphs(pairs: DataFrame, run: list[str], encoded: str, truth: str, order: list[str],
                 skip: DataFrame | None = None) -> DataFrame:
    """Most voted real character per glyph: ``glyph, ch, votes, rivals``.

    ``pairs`` holds row-aligned encoded and true texts; only equal lengths vote.
    Equal votes go to the character seen first in ``order``. ``skip`` lists
    glyphs already known (digits); signs and blanks never vote. ``rivals``
    counts the characters that got a vote. With one whole number as ``order`` every character goes
    straight to a hash table; other orders are sorted before they are tallied.
    """
    enc, tru = F.col(encoded), F.trim(truth)
    usable = pairs.where((F.length(enc) == F.length(tru)) & (enc != ""))
    zipped = F.arrays_zip(F.split(enc, "").alias("glyph"), F.split(tru, "").alias("ch"))
    votes = usable.select(*run, *order, F.posexplode(zipped).alias("pos", "z")).select(
        *run, *order, "pos", "z.glyph", "z.ch").where(~F.col("glyph").rlike(r"[.\-+\s]"))
    if skip is not None:
        votes = votes.join(skip.select(*run, "glyph"), [*run, "glyph"], "left_anti")
    tally = votes.groupBy(*run, "glyph", "ch").agg(
        F.count(F.lit(1)).alias("votes"), F.min(_sighting(order, dict(votes.dtypes))).alias("seen"))
    # most votes first, then the earliest sighting
    ranked = F.min(F.struct((-F.col("votes")).alias("v"), "seen", "ch"))
    top = tally.groupBy(*run, "glyph").agg(ranked.alias("top"), F.count(F.lit(1)).alias("rivals"))
    return top.select(*run, "glyph", (-F.col("top.v")).alias("votes"), "rivals", F.col("top.ch").alias("ch"))


def _sighting(order: list[str], types: dict[str, str]) -> Column:
    """Where a character stands, as a value whose least is the earliest (null orders first). One whole
    number and the place make one decimal, since Spark sorts all rows for the least of a struct."""
    if len(order) > 1 or types[order[0]] not in ("tinyint", "smallint", "int", "bigint"):
        return F.struct(*order, "pos")
    whole = F.coalesce(F.col(order[0]).cast("decimal(20,0)"), F.lit(f"-{10**19}").cast("decimal(20,0)"))
    return whole * F.lit(2**31).cast("decimal(10,0)") + F.col("pos").cast("decimal(10,0)")


def glyph_maps(maps: DataFrame, run: list[str]) -> DataFrame:
    """One map per run as two strings of equal length, bounded by the characters of one font; entries
    that are not one character each way stay in a map of their own."""
    single = (F.length("glyph") == 1) & (F.length("ch") == 1)
    entries = F.array_sort(F.collect_list(F.when(single, F.struct("glyph", "ch"))))
    return maps.groupBy(*run).agg(
        F.array_join(entries["glyph"], "").alias("glyphs"), F.array_join(entries["ch"], "").alias("chars"),
        F.map_from_entries(F.collect_list(F.when(~single, F.struct("glyph", "ch")))).alias("others"))


def decode_glyphs(df: DataFrame, maps: DataFrame, run: list[str], cols: list[str],
                  unresolved: str = r"[\x{3400}-\x{4dbf}]") -> DataFrame:
    """Decoded columns and, per row, what stayed unresolved.

    Blanks inside encoded text disappear, glyphs without an entry stay. Characters
    of the ``unresolved`` class in the result are counted and listed. A cell is one
    ``translate`` with its run's two strings. The maps, which come from an
    aggregation, are written first: Spark then knows how small they are and need
    not shuffle the rows by their run, of which there are few.
    """
    path = scratch_path(df.sparkSession, "glyphs")
    glyph_maps(maps, run).write.parquet(path)
    out = df.join(df.sparkSession.read.parquet(path), run, "left")

    def decode(c: str) -> Column:
        parts = split_tag(c)
        bare = F.regexp_replace(parts["text"], r"\s+", "")
        plain = F.call_function("translate", bare, F.coalesce("glyphs", F.lit("")), F.coalesce("chars", F.lit("")))
        each = F.array_join(F.transform(F.split(bare, ""), lambda ch: F.coalesce(
            F.try_element_at("others", ch), F.call_function("translate", ch, F.col("glyphs"), F.col("chars")))), "")
        return F.when(parts["font"].isNull(), parts["text"]).when(F.size("others") > 0, each).otherwise(plain)

    for c in cols:
        out = out.withColumn(c, decode(c))
    left = F.regexp_extract_all(F.concat_ws("", *cols), F.lit(f"({unresolved})"), F.lit(1))
    return (out.withColumn("unresolved_count", F.size(left))
            .withColumn("unresolved_chars", F.array_join(F.array_sort(F.array_distinct(left)), ""))
            .drop("glyphs", "chars", "others"))
