"""License notices in texts: fixed phrases, and an exact set-similarity join with templates."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, functions as F

# Phrases and labels of the base scan, and notices of well-known licenses.
PHRASES = {"mit": "under the mit license", "apache-2": "apache license version 2", "cc-by-nc": "cc by nc"}
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy at apache org"),
    ("gpl-3", "licensed under the gnu general public license version 3"),
    ("gpl-3", "under the terms of the gnu general public license version 3 as published by the free software foundation"),
    ("gpl-2", "licensed under the gnu general public license version 2"),
    ("lgpl", "under the terms of the gnu lesser general public license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial license"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike license"),
    ("mpl-2", "subject to the terms of the mozilla public license v 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided"),
]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"

#: Words of a block, and from one block to the next; a span of up to 17 words lies in one. Longer
#: templates get both doubled until ROOM times their words lie in one block: room for inserted words.
BLOCK, STEP, ROOM = 32, 16, 1.5


def _lits(values: list) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def _frequencies(words: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """In how many documents each template word stands: one row per word comes back."""
    found = words.select(F.explode(F.array_intersect(F.transform("w", F.lower), _lits(vocabulary))).alias("t"))
    return dict(found.groupBy("t").count().collect())


def _places(w: Column, phrase: str) -> Column:
    """Starts (from 0) of the words of a phrase in a row."""
    parts = phrase.split()
    last = F.size(w) - len(parts)

    def here(i: Column) -> Column:
        hit = F.get(w, i) == parts[0]
        for k, p in enumerate(parts[1:], 1):
            hit = hit & (F.get(w, i + k) == p)
        return hit

    none = F.array().cast("array<int>")
    return F.when(last >= 0, F.filter(F.sequence(F.lit(0), last), here)).otherwise(none)


def grid(template: str) -> tuple[int, int]:
    """Words of the blocks that a template is sought in, and from one block to the next."""
    block, step = BLOCK, STEP
    while block - step + 1 < ROOM * len(template.split()):
        block, step = 2 * block, 2 * step
    return block, step


def scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, least: float = 0.9, doc_id: str = "doc_id",
         text: str = "text") -> DataFrame:
    """Of every row: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``,
    ``notices`` (start word and words of the block, number of the template, label, containment) and
    ``blocks`` (start word, label, containment).

    Base labels: the words of a phrase stand in a row. Further labels: blocks that hold at least
    ``least`` of the distinct words of a template. Blocks have 32 words, one every 16, and for
    templates of more than 11 words both numbers are doubled until a span of half again the
    template's words lies in one block wherever it starts (``grid``); any template can match.
    ``notices`` has every such pair of block and template, and all their labels count; ``blocks``
    names of each block of 32 words only the template contained most, or of two the longer. The
    join is exact:

    * tokens are ordered by how many documents hold them, rarest first;
    * *prefix*: a block that reaches the threshold holds one of a template's first
      ``size - need + 1`` tokens, so templates are looked up by these in an inverted index;
    * *length* and *position*: a block with too few template words, or with too few left from the
      matched token on, is dropped before its overlap is counted.

    The index is a constant of the plan (templates are a parameter, some dozens). A row is scanned
    where it lies: no shuffle, no pairs, no hot key; only DataFrame functions run. Documents without
    any prefix token, nearly all, end after one regular expression and the word count.

    Null text: no words. An empty table gives no rows. Repeated rows and null ids are kept.
    """
    raw = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), raw.alias("t"),
                       F.regexp_extract_all(raw, F.lit(_WORD + "+"), F.lit(0)).alias("w"))
    sets = [(label, sorted(set(t.split()))) for label, t in templates]
    vocabulary = sorted({x for _, s in sets for x in s})
    often = _frequencies(rows.select("w"), vocabulary) if vocabulary else {}
    order = sorted(vocabulary, key=lambda x: (often.get(x, 0), x))
    rank = {x: i for i, x in enumerate(order)}
    sets = [(label, sorted(s, key=rank.get)) for label, s in sets]
    needs = [ceil(least * len(s) - 1e-9) for _, s in sets]
    grids = [grid(t) for _, t in templates]

    def indexed(numbers: list[int]) -> dict[str, list[tuple[int, int]]]:
        """Per prefix token the templates (of these numbers) that have it, and its place."""
        index: dict[str, list[tuple[int, int]]] = {}
        for i in numbers:
            for p, token in enumerate(sets[i][1][:len(sets[i][1]) - needs[i] + 1]):
                index.setdefault(token, []).append((i, p))
        return index

    # words that every base phrase or every matching block must hold one of
    whole = indexed(list(range(len(sets))))
    tokens = sorted({*whole, *(min(p.split(), key=lambda x: (rank.get(x, 0), x)) for p in PHRASES.values())})
    likely = F.col("t").rlike(f"(?i)(?<!{_WORD})(?:{'|'.join(tokens)})(?!{_WORD})")
    none = F.array().cast("array<string>")
    rows = rows.withColumn("l", F.when(likely, F.transform("w", lambda x: F.translate(x, _UPPER, _LOWER))).otherwise(none))
    rows = rows.select("doc_id", F.size("w").cast("long").alias("n_words"), "l",
                       *[_places(F.col("l"), p).alias(f"p{i}") for i, p in enumerate(PHRASES.values())])

    tops = F.array(*[F.struct(F.lit(label).alias("label"), _lits(s).alias("s"), F.lit(n).alias("need")) for (label, s), n in zip(sets, needs)])

    def matches(block: Column, index: dict[str, list[tuple[int, int]]]) -> Column:
        """All verified templates of a block (start, v), v its template words in order."""
        v = block["v"]
        postings = F.create_map(*[x for t, e in index.items() for x in (
            F.lit(t), F.array(*[F.struct(F.lit(i).alias("i"), F.lit(p).alias("p")) for i, p in e]))])
        found = F.flatten(F.transform(F.array_intersect(_lits(list(index)), v), lambda t: F.transform(
            postings[t], lambda e: F.struct(e["i"].alias("i"), e["p"].alias("p"), (F.array_position(v, t) - 1).alias("q")))))

        def possible(c: Column) -> Column:
            top = F.get(tops, c["i"])
            reach = F.least(c["p"], c["q"]) + F.least(F.size(top["s"]) - c["p"], F.size(v) - c["q"])
            return (F.size(v) >= top["need"]) & (reach >= top["need"])

        ids = F.array_distinct(F.transform(F.filter(found, possible), lambda c: c["i"]))

        def verified(i: Column) -> Column:
            top = F.get(tops, i)
            share = F.size(F.array_intersect(top["s"], v))
            return F.struct((share / F.size(top["s"])).alias("share"), share.alias("n"), (share >= top["need"]).alias("ok"),
                            top["label"].alias("label"), block["start"].alias("start"), i.alias("template"))

        return F.filter(F.transform(ids, verified), lambda m: m["ok"])

    def shown(m: Column, *names: str) -> Column:
        return F.struct(*[m[x].alias(x) for x in names])

    def found(numbers: list[int], block: int, step: int, name: str) -> Column:
        """Of each block that holds any of these templates: all that it holds."""
        nonlocal rows
        index = indexed(numbers)
        starts = F.when(F.size("l") > 0, F.sequence(F.lit(0), F.greatest(F.size("l") - 1, F.lit(0)), F.lit(step))).otherwise(F.array().cast("array<int>"))
        blocks = F.transform(starts, lambda s: F.struct(s.alias("start"), F.array_intersect(_lits(order), F.slice("l", s + 1, block)).alias("v")))
        rows = rows.withColumn(f"b{name}", F.filter(blocks, lambda b: F.arrays_overlap(b["v"], _lits(list(index)))))
        rows = rows.withColumn(f"m{name}", F.filter(F.transform(f"b{name}", lambda b: matches(b, index)), lambda m: F.size(m) > 0))
        return F.col(f"m{name}")

    def with_words(block: int):
        return lambda m: F.struct(m["start"].alias("start"), F.lit(block).alias("words"), *[m[x].alias(x) for x in ("template", "label", "share")])

    if whole:
        parts = []
        for k, (block, step) in enumerate(sorted({g for g, (_, s) in zip(grids, sets) if s})):
            of_grid = found([i for i, g in enumerate(grids) if g == (block, step)], block, step, str(k))
            parts.append(F.transform(F.flatten(of_grid), with_words(block)))
        of_block = found(list(range(len(sets))), BLOCK, STEP, "")
        rows = rows.withColumn("notices", F.concat(*parts))
        rows = rows.withColumn("blocks", F.transform(of_block, lambda m: shown(F.array_max(m), "start", "label", "share")))
    else:
        rows = rows.withColumn("notices", F.array().cast("array<struct<start:int,words:int,template:int,label:string,share:double>>"))
        rows = rows.withColumn("blocks", F.array().cast("array<struct<start:int,label:string,share:double>>"))
    at = F.concat(*[F.col(f"p{i}") for i in range(len(PHRASES))])
    base = F.filter(F.array(*[F.when(F.size(f"p{i}") > 0, F.lit(x)) for i, x in enumerate(PHRASES)]), lambda x: x.isNotNull())
    every = F.array_union(base, F.transform("notices", lambda m: m["label"]))
    return rows.select(
        "doc_id", "n_words", F.size(at).cast("long").alias("n_base"), F.array_min(at).cast("long").alias("first_word"),
        F.array_max(at).cast("long").alias("last_word"), F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(every), ",").alias("labels"),
        F.when(F.size(at) > 0, 1.0).otherwise(F.coalesce(F.array_max(F.transform("notices", lambda m: m["share"])), F.lit(0.0))).alias("score"),
        "notices", "blocks")
