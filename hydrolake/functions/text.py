"""White space, accents, markup."""

from __future__ import annotations

import html.entities
import unicodedata

from pyspark.sql import Column, functions as F

from hydrolake.functions._base import col, let
from hydrolake.functions.fixed import WHITE_SPACE as WS


def strip(c: Column | str) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.regexp_replace(col(c), f"^{WS}+|{WS}+$", "")


def clean_text(c: Column | str) -> Column:
    """Collapse white space (no-break spaces included) to single blanks."""
    return F.trim(F.regexp_replace(col(c), f"{WS}+", " "))


def norm_lower(c: Column | str) -> Column:
    return F.lower(clean_text(c))


def drop_bidi_marks(c: Column | str) -> Column:
    """Remove direction marks that right-to-left documents carry."""
    return F.regexp_replace(col(c), r"[\x{202A}-\x{202E}\x{200E}\x{200F}]", "")


def _accent_table() -> tuple[str, str]:
    """Letters whose canonical decomposition is one base letter plus marks.

    Built from the Unicode tables; bare combining marks come last, without a
    partner, so that ``translate`` deletes them.
    """
    letters, bases, marks = [], [], []
    for point in range(0x00C0, 0x2000):
        ch = chr(point)
        if unicodedata.category(ch) == "Mn":
            marks.append(ch)
            continue
        bare = [x for x in unicodedata.normalize("NFD", ch) if unicodedata.category(x) != "Mn"]
        if len(bare) == 1 and bare[0] != ch:
            letters.append(ch)
            bases.append(bare[0])
    return "".join(letters + marks), "".join(bases)


_ACCENTED, _BARE = _accent_table()


def strip_accents(c: Column | str) -> Column:
    return F.translate(col(c), _ACCENTED, _BARE)


def _entity_map() -> Column:
    """Named character references; frequent names first, as look-up is linear."""
    frequent = ["amp;", "nbsp;", "lt;", "gt;", "quot;", "apos;", "copy;", "middot;", "eacute;",
                "egrave;", "agrave;", "ccedil;", "euro;", "deg;", "ndash;", "mdash;", "rsquo;"]
    table = html.entities.html5
    names = frequent + sorted(n for n in table if n.endswith(";") and n not in frequent
                              and ord(table[n][0]) < 0x2100 and len(table[n]) == 1)
    return F.map_from_arrays(F.array(*[F.lit(n[:-1]) for n in names]),
                             F.array(*[F.lit(table[n]) for n in names]))


def _code_point(n: Column) -> Column:
    """Character of a code point; out-of-range references become U+FFFD."""
    valid = n.between(1, 0x10FFFF) & ~n.between(0xD800, 0xDFFF)
    safe = F.when(valid, n).otherwise(F.lit(0xFFFD))
    return F.decode(F.unhex(F.lpad(F.hex(safe), 8, "0")), "UTF-32")


def html_unescape(c: Column | str) -> Column:
    """Decode character references in one pass (``&amp;lt;`` stays ``&lt;``)."""
    names = _entity_map()
    pattern = r"^&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);"

    def piece(p: Column) -> Column:
        ref = F.regexp_extract(p, pattern, 1)
        rest = F.substring(p, F.length(ref) + 3, F.length(p))
        number = F.when(ref.rlike("^#[0-9]"), F.substring(ref, F.lit(2), F.length(ref)).try_cast("bigint")) \
            .when(ref.rlike("^#[xX]"), F.conv(F.substring(ref, F.lit(3), F.length(ref)), 16, 10).try_cast("bigint"))
        named = names[ref]
        return F.when(ref == "", p) \
            .when(ref.startswith("#"), F.concat(_code_point(number), rest)) \
            .when(named.isNotNull(), F.concat(named, rest)) \
            .otherwise(p)

    return let(col(c), lambda t: F.when(
        F.instr(t, "&") > 0, F.array_join(F.transform(F.split(t, "(?=&)"), piece), "")).otherwise(t))


_DROP_BLOCKS = r"(?s)<script.*?</script>|<style.*?</style>"


def html_to_text(c: Column | str) -> Column:
    """Page text on one line: scripts and styles out, tags to blanks."""
    bare = F.regexp_replace(F.regexp_replace(col(c), _DROP_BLOCKS, " "), r"<[^>]+>", " ")
    return F.regexp_replace(html_unescape(bare), f"{WS}+", " ")


def html_to_lines(c: Column | str) -> Column:
    """Page text as an array of non-empty trimmed lines, one per tag boundary."""
    bare = F.regexp_replace(F.regexp_replace(col(c), _DROP_BLOCKS, " "), r"<[^>]+>", "\n")
    lines = F.split(F.regexp_replace(html_unescape(bare), "[ \t]+", " "), "\n")
    return F.filter(F.transform(lines, strip), lambda x: x != "")
