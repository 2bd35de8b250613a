"""P1-P29 and F1-F5 on cells derived from the given tables.

Raw cells are built by one SQL expression that both engines run.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from hydrolake import functions as P
from hydrolake.functions import fixed
from hydrolake.operators import filters
from hydrolake.plans.registry import query, r4, table, text
from hydrolake.session import local_table

MONTH3 = "substr('JanFebMarAprMayJunJulAugSepOctNovDec', CAST((month({d}) - 1) * 3 + 1 AS INT), 3)"
K = "(l_orderkey * 7 + l_linenumber)"


def S(x: str) -> str:
    return f"CAST({x} AS STRING)"


RAW_MARKERS = f"""CASE {K} % 9 WHEN 0 THEN '-' WHEN 1 THEN ' -- ' WHEN 2 THEN 'null' WHEN 3 THEN ''
 WHEN 4 THEN 'None' WHEN 5 THEN concat('  ', {S('l_partkey')}, ' ') WHEN 6 THEN 'n/a'
 WHEN 7 THEN '- 5' ELSE concat({S('l_suppkey')}, '.5') END"""


def _cells(spark, sf, raw):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.expr(raw).alias("raw"))


def _cells_sql(raw, out):
    return f"SELECT l_orderkey, l_linenumber, {out} FROM (SELECT l_orderkey, l_linenumber, {raw} AS raw FROM lineitem)"


_CLEAN = "CASE WHEN trim(raw) IN ('','-','--','null','None') THEN NULL ELSE trim(raw) END"


@query(_cells_sql(RAW_MARKERS, f"{_CLEAN} AS cell"))
def clean_cell(spark, sf):
    return _cells(spark, sf, RAW_MARKERS).select("l_orderkey", "l_linenumber", P.clean_cell("raw").alias("cell"))


RAW_THOUSANDS = f"""CASE {K} % 6 WHEN 0 THEN concat({S('l_partkey')}, ',', lpad({S('l_orderkey % 1000')}, 3, '0'), '.', {S('l_linenumber')})
 WHEN 1 THEN '--' WHEN 2 THEN 'dry' WHEN 3 THEN ' 12,5 ' WHEN 4 THEN concat({S('l_suppkey')}, '.0') ELSE concat('-', {S('l_suppkey')}) END"""


@query(_cells_sql(RAW_THOUSANDS, f"TRY_CAST(replace({_CLEAN}, ',', '') AS DOUBLE) AS value, raw"))
def num_thousands(spark, sf):
    return _cells(spark, sf, RAW_THOUSANDS).select(
        "l_orderkey", "l_linenumber", P.num_thousands("raw").alias("value"), "raw")


@query(_cells_sql(RAW_THOUSANDS, f"""TRY_CAST(replace({_CLEAN}, ',', '') AS DOUBLE) AS value,
 coalesce(TRY_CAST(replace({_CLEAN}, ',', '') AS DOUBLE) = floor(TRY_CAST(replace({_CLEAN}, ',', '') AS DOUBLE)), false) AS is_int"""))
def num_int_or_float(spark, sf):
    value = P.num_int_or_float("raw")
    return _cells(spark, sf, RAW_THOUSANDS).select(
        "l_orderkey", "l_linenumber", value.alias("value"),
        F.coalesce(P.is_integer(value), F.lit(False)).alias("is_int"))


RAW_FIRST = f"""CASE {K} % 5 WHEN 0 THEN concat('RL +', {S('l_partkey')}, ',', lpad({S('l_orderkey % 1000')}, 3, '0'), '.', {S('l_linenumber')}, ' m')
 WHEN 1 THEN '—' WHEN 2 THEN 'no number' WHEN 3 THEN concat('-', {S('l_suppkey')}, '.25 (est.)') ELSE concat('a', {S('l_partkey')}, 'b', {S('l_suppkey')}) END"""


@query(_cells_sql(RAW_FIRST, r"""TRY_CAST(ltrim(replace(regexp_extract(raw, '[-+]?\d[\d,]*(?:\.\d+)?'), ',', ''), '+') AS DOUBLE) AS value"""))
def num_first(spark, sf):
    return _cells(spark, sf, RAW_FIRST).select("l_orderkey", "l_linenumber", P.num_first("raw").alias("value"))


RAW_LEADING = f"""CASE {K} % 5 WHEN 0 THEN concat({S('l_partkey')}, '.', {S('l_linenumber')}, 'm') WHEN 1 THEN '1,234'
 WHEN 2 THEN concat(' -', {S('l_suppkey')}, ' ft') WHEN 3 THEN 'm 12' ELSE {S('l_suppkey')} END"""


@query(_cells_sql(RAW_LEADING, r"TRY_CAST(regexp_extract(trim(raw), '^-?\d+(\.\d+)?') AS DOUBLE) AS value"))
def num_leading(spark, sf):
    return _cells(spark, sf, RAW_LEADING).select("l_orderkey", "l_linenumber", P.num_leading("raw").alias("value"))


RAW_COMMA = f"""CASE {K} % 5 WHEN 0 THEN concat({S('l_partkey')}, ',', {S('l_linenumber')}) WHEN 1 THEN '1,234.5'
 WHEN 2 THEN concat(' 1 ', {S('l_suppkey')}, ',5 m3') WHEN 3 THEN 'vide' ELSE concat('-', {S('l_suppkey')}) END"""


@query(_cells_sql(RAW_COMMA, r"TRY_CAST(regexp_extract(replace(replace(raw, ' ', ''), ',', '.'), '-?\d+(?:\.\d+)?') AS DOUBLE) AS value"))
def num_decimal_comma(spark, sf):
    return _cells(spark, sf, RAW_COMMA).select("l_orderkey", "l_linenumber", P.num_decimal_comma("raw").alias("value"))


RAW_SPACE = f"""CASE {K} % 6 WHEN 0 THEN concat({S('l_partkey')}, ' ', lpad({S('l_orderkey % 1000')}, 3, '0'), ',', {S('l_linenumber')})
 WHEN 1 THEN 'P,E.T' WHEN 2 THEN '*' WHEN 3 THEN concat({S('l_suppkey')}, chr(10), '5') WHEN 4 THEN '' ELSE concat(' ', {S('l_suppkey')}, ' ') END"""


@query(_cells_sql(RAW_SPACE, r"""CASE WHEN contains(trim(raw), chr(10)) OR trim(raw) IN ('','-','--','*','P,E.T') THEN NULL
 ELSE TRY_CAST(replace(replace(raw, ' ', ''), ',', '.') AS DOUBLE) END AS value"""))
def num_space_thousands(spark, sf):
    return _cells(spark, sf, RAW_SPACE).select("l_orderkey", "l_linenumber", P.num_space_thousands("raw").alias("value"))


RAW_STRIP = f"""CASE {K} % 5 WHEN 0 THEN concat('# ', {S('l_partkey')}, '.', {S('l_linenumber')}) WHEN 1 THEN '#'
 WHEN 2 THEN concat('ca. ', {S('l_suppkey')}, ' %') WHEN 3 THEN '-' ELSE concat({S('l_partkey')}, ',', {S('l_suppkey')}, ' Ml') END"""


@query(_cells_sql(RAW_STRIP, r"""TRY_CAST(regexp_replace(raw, '[^\d.\-]', '', 'g') AS DOUBLE) AS stripped,
 TRY_CAST(regexp_replace(trim(raw), '^#\s*', '') AS DOUBLE) AS unhashed"""))
def num_strip(spark, sf):
    return _cells(spark, sf, RAW_STRIP).select(
        "l_orderkey", "l_linenumber", P.num_strip("raw").alias("stripped"), P.num_hash("raw").alias("unhashed"))


_FMT_N = "(l_partkey * 37 + l_linenumber * 250)"


@query(f"""SELECT l_orderkey, l_linenumber, rtrim(rtrim(concat(h // 100, '.', lpad(CAST(h % 100 AS VARCHAR), 2, '0')), '0'), '.') AS printed, whole
 FROM (SELECT l_orderkey, l_linenumber, ({_FMT_N} + 5) // 10 AS h, CAST(CAST(round_even({_FMT_N} / 1000.0, 0) AS BIGINT) AS VARCHAR) AS whole FROM lineitem)""")
def fmt_number(spark, sf):
    v = F.expr(f"{_FMT_N} / 1000D")
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", P.fmt_number(v, 2).alias("printed"), P.fmt_number(v, 0).alias("whole"))


@query(r"""SELECT doc_id, md5(t) AS digest, length(t) AS n, md5(lower(t)) AS lower_digest
 FROM (SELECT doc_id, trim(regexp_replace(text, '[\s\x0B\x1c-\x1f\x85\xA0\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+', ' ', 'g')) AS t FROM documents)""")
def clean_text(spark, sf):
    t = P.clean_text("text")
    return table(spark, sf, "documents").select(
        "doc_id", F.md5(t).alias("digest"), F.length(t).cast("bigint").alias("n"),
        F.md5(P.norm_lower("text")).alias("lower_digest"))


@query("SELECT doc_id, md5(strip_accents(text)) AS digest, length(strip_accents(text)) AS n FROM documents")
def strip_accents(spark, sf):
    t = P.strip_accents("text")
    return table(spark, sf, "documents").select("doc_id", F.md5(t).alias("digest"), F.length(t).cast("bigint").alias("n"))


def _unescape_sql(x: str) -> str:
    for name, ch in (("nbsp", " "), ("lt", "<"), ("gt", ">"), ("quot", '"'), ("copy", "©"), ("middot", "·"),
                     ("eacute", "é"), ("mdash", "—"), ("#39", "''"), ("amp", "&")):
        ch = "chr(160)" if name == "nbsp" else f"'{ch}'"
        x = f"replace({x}, '&{name};', {ch})"
    return x


_NO_BLOCKS = r"regexp_replace(html, '(?s)<script.*?</script>|<style.*?</style>', ' ', 'g')"
PAGE_TEXT_SQL = r"regexp_replace(" + _unescape_sql(f"regexp_replace({_NO_BLOCKS}, '<[^>]+>', ' ', 'g')") + r", '[\s\xA0]+', ' ', 'g')"
PAGE_LINES_SQL = ("list_filter(list_transform(string_split(regexp_replace("
                  + _unescape_sql(f"regexp_replace({_NO_BLOCKS}, '<[^>]+>', chr(10), 'g')")
                  + r", '[ \t]+', ' ', 'g'), chr(10)), lambda x: trim(x)), lambda x: x <> '')")


@query(f"SELECT page_id, md5(t) AS digest, length(t) AS n FROM (SELECT page_id, {PAGE_TEXT_SQL} AS t FROM pages)")
def html_to_text(spark, sf):
    t = P.html_to_text("html")
    return table(spark, sf, "pages").select("page_id", F.md5(t).alias("digest"), F.length(t).cast("bigint").alias("n"))


@query(f"SELECT page_id, len(a) AS n_lines, md5(array_to_string(a, '|')) AS digest FROM (SELECT page_id, {PAGE_LINES_SQL} AS a FROM pages)")
def html_to_lines(spark, sf):
    a = P.html_to_lines("html")
    return table(spark, sf, "pages").select("page_id", F.size(a).cast("bigint").alias("n_lines"),
                                            F.md5(F.array_join(a, "|")).alias("digest"))


@query(r"""SELECT p_partkey, concat('PT_', lower(trim(regexp_replace(p_name, '[^A-Za-z0-9]+', '_', 'g'), '_')), '_', substr(md5(CAST(p_partkey AS VARCHAR)), 1, 8)) AS long_id,
 concat('PT_', trim(regexp_replace(upper(trim(p_name)), '[^A-Z0-9]+', '_', 'g'), '_')) AS short_id FROM part""")
def make_id(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", P.make_id("PT", "p_name", F.md5(text("p_partkey"))).alias("long_id"),
        P.make_id("PT", "p_name", upper=True).alias("short_id"))


@query("""SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN concat('ID_', c_nationkey) WHEN c_acctbal > 0 THEN concat('STN_', c_custkey)
 ELSE concat('NAME_', replace(c_name, ' ', '_')) END AS id FROM customer""")
def id_fallback(spark, sf):
    rules = [(F.col("c_custkey") % 3 == 0, F.concat(F.lit("ID_"), text("c_nationkey"))),
             (F.col("c_acctbal") > 0, F.concat(F.lit("STN_"), text("c_custkey"))),
             (F.lit(True), F.concat(F.lit("NAME_"), F.replace("c_name", F.lit(" "), F.lit("_"))))]
    return table(spark, sf, "customer").select("c_custkey", P.id_fallback(*rules).alias("id"))


@query("""WITH a AS (SELECT DISTINCT upper(p_name) AS alias, concat('THE ', upper(p_name)) AS canonical FROM part WHERE length(p_name) % 2 = 0)
 SELECT p_partkey, coalesce(canonical, upper(p_name)) AS canonical FROM part LEFT JOIN a ON upper(p_name) = alias""")
def canon_name(spark, sf):
    part = table(spark, sf, "part")
    aliases = part.where(F.length("p_name") % 2 == 0).select(
        F.upper("p_name").alias("alias"), F.concat(F.lit("THE "), F.upper("p_name")).alias("canonical")).distinct()
    named = part.withColumn("p_name", F.concat(F.lit(" "), F.replace("p_name", F.lit(" "), F.lit("  &amp; ")), F.lit("!")))
    return P.canon_name(named, "p_name", aliases).select("p_partkey", "canonical")


@query(r"""SELECT doc_id, md5(k) AS digest, length(k) AS n FROM (SELECT doc_id,
 regexp_replace(regexp_replace(regexp_replace(lower(strip_accents(concat(text, ' Dam'))), '[^\x00-\x7f]', '', 'g'), '\b(dam|reservoir)\b', '', 'g'), '[^a-z0-9]', '', 'g') AS k FROM documents)""")
def match_key(spark, sf):
    k = P.match_key(F.concat("text", F.lit(" Dam")))
    return table(spark, sf, "documents").select("doc_id", F.md5(k).alias("digest"), F.length(k).cast("bigint").alias("n"))


_D, _M, _Y = (S(f"{p}(o_orderdate)") for p in ("day", "month", "year"))
_M3 = MONTH3.format(d="o_orderdate")
RAW_DATE = f"""CASE o_orderkey % 7 WHEN 0 THEN concat({_D}, '/', {_M}, '/', {_Y}) WHEN 1 THEN concat({_D}, '-', {_M}, '-', {_Y})
 WHEN 2 THEN concat({_D}, ' ', {_M3}, ' ', {_Y}) WHEN 3 THEN concat({_M3}, ' ', {_D}, ', ', {_Y}) WHEN 4 THEN concat({_D}, '-', {_M3}, '-', {_Y})
 WHEN 5 THEN concat({_D}, '/', {_M}, '/', substr({_Y}, 3, 2)) ELSE 'n/a' END"""


@query(f"""SELECT o_orderkey, strftime(try_strptime(regexp_replace(replace(CASE WHEN regexp_matches(raw, '[A-Za-z]') THEN replace(raw, '-', ' ') ELSE raw END, ',', ' '), '\\s+', ' ', 'g'),
 ['%d/%m/%y', '%d/%m/%Y', '%d-%m-%y', '%d-%m-%Y', '%d %B %Y', '%d %b %Y', '%B %d %Y', '%b %d %Y']), '%Y-%m-%d') AS d
 FROM (SELECT o_orderkey, {RAW_DATE} AS raw FROM orders)""")
def parse_date_any(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", text(P.parse_date_any(F.expr(RAW_DATE))).alias("d"))


RAW_DMY = f"""CASE o_orderkey % 5 WHEN 0 THEN concat({_D}, '-', {_M}, '-', {_Y}) WHEN 1 THEN concat({_D}, '-', {_M}, '-', {S('year(o_orderdate) % 100')})
 WHEN 2 THEN concat('31-', {_M}, '-', {_Y}) WHEN 3 THEN concat({_D}, '-13-', {_Y}) ELSE concat(' ', lpad({_D}, 2, '0'), '-', lpad({_M}, 2, '0'), '-', {_Y}, ' ') END"""


@query(rf"""SELECT o_orderkey, CASE WHEN regexp_matches(t, '^\d{{1,2}}-\d{{1,2}}-\d{{2,4}}$') AND CAST(y AS INT) IS NOT NULL THEN
 strftime(TRY_CAST(concat(CASE WHEN CAST(y AS INT) < 100 THEN CAST(y AS INT) + 2000 ELSE CAST(y AS INT) END, '-', m, '-', d) AS DATE), '%Y-%m-%d') END AS d
 FROM (SELECT o_orderkey, t, split_part(t, '-', 1) AS d, split_part(t, '-', 2) AS m, split_part(t, '-', 3) AS y FROM (SELECT o_orderkey, trim({RAW_DMY}) AS t FROM orders))""")
def parse_dmy(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", text(P.parse_dmy(F.expr(RAW_DMY))).alias("d"))


_PT = "CASE month(o_orderdate) WHEN 1 THEN 'Janeiro' WHEN 2 THEN 'fevereiro' WHEN 3 THEN 'Março' WHEN 4 THEN 'abril' WHEN 5 THEN 'maio' WHEN 6 THEN 'junho' WHEN 7 THEN 'julho' WHEN 8 THEN 'agosto' WHEN 9 THEN 'setembro' WHEN 10 THEN 'outubro' WHEN 11 THEN 'novembro' ELSE 'mes' END"
RAW_PT = f"concat('Boletim de ', {_D}, ' de ', {_PT}, ' de ', {_Y}, '.')"


@query("SELECT o_orderkey, CASE WHEN month(o_orderdate) < 12 AND year(o_orderdate) >= 2000 THEN strftime(o_orderdate, '%Y-%m-%d') END AS d FROM orders")
def parse_text_date(spark, sf):
    d = P.parse_text_date(F.expr(RAW_PT), fixed.MONTHS_PT, joiner=r"\s+de\s+")
    return table(spark, sf, "orders").select("o_orderkey", text(d).alias("d"))


_PG_DAY, _PG_MON, _PG_YEAR = "(page_id % 28 + 1)", "(page_id % 12 + 1)", "(2000 + page_id % 25)"
_PG_M3 = f"substr('JanFebMarAprMayJunJulAugSepOctNovDec', CAST(({_PG_MON} - 1) * 3 + 1 AS INT), 3)"
RAW_PAGE = f"""concat(html, CASE page_id % 4 WHEN 0 THEN concat('<p>Dam Levels as at: ', {S(_PG_DAY)}, '/', {S(_PG_MON)}, '/', {S(_PG_YEAR)}, '</p>')
 WHEN 1 THEN concat(' Official 99 Foo 2020 as at ', {S(_PG_DAY)}, ' ', {_PG_M3}, ', ', {S(_PG_YEAR)}) WHEN 2 THEN concat(' Platform | ', {S(_PG_DAY)}, ' ', {_PG_M3}, ' ', {S(_PG_YEAR)}) ELSE ' as at soon' END)"""


@query(f"SELECT page_id, CASE WHEN page_id % 4 < 3 THEN strftime(make_date({_PG_YEAR}, {_PG_MON}, {_PG_DAY}), '%Y-%m-%d') END AS d FROM pages")
def printed_date(spark, sf):
    return table(spark, sf, "pages").select("page_id", text(P.printed_date(F.expr(RAW_PAGE))).alias("d"))


RAW_CELL_DATE = f"""CASE o_orderkey % 4 WHEN 0 THEN concat('at ', {S('year(o_orderdate) + 20')}, '-', lpad({_M}, 2, '0'), '-', lpad({_D}, 2, '0'), 'T08:00')
 WHEN 1 THEN concat({S('year(o_orderdate) + 20')}, lpad({_M}, 2, '0'), lpad({_D}, 2, '0')) WHEN 2 THEN concat('x', {S('year(o_orderdate) + 20')}, lpad({_M}, 2, '0'), lpad({_D}, 2, '0')) ELSE 'week 12' END"""


@query(f"""SELECT o_orderkey, CASE WHEN regexp_matches(raw, '20\\d{{2}}-\\d{{2}}-\\d{{2}}') THEN regexp_extract(raw, '20\\d{{2}}-\\d{{2}}-\\d{{2}}')
 WHEN regexp_matches(raw, '\\b20\\d{{2}}(0[1-9]|1[0-2])(0[1-9]|[12]\\d|3[01])\\b') THEN regexp_replace(regexp_extract(raw, '\\b(20\\d{{2}}(0[1-9]|1[0-2])(0[1-9]|[12]\\d|3[01]))\\b', 1), '(....)(..)(..)', '\\1-\\2-\\3') END AS d
 FROM (SELECT o_orderkey, {RAW_CELL_DATE} AS raw FROM orders)""")
def cell_date(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", P.cell_date(F.expr(RAW_CELL_DATE)).alias("d"))


def _resolve_sql(tol):
    return f"""strftime(CASE WHEN date_diff('day', DATE '1998-06-15', this) > {tol} THEN last ELSE this END, '%Y-%m-%d')"""


@query(f"""SELECT o_orderkey, {_resolve_sql(0)} AS strict, {_resolve_sql(7)} AS lenient FROM (SELECT o_orderkey,
 TRY_CAST(concat('1998-', lpad({_M}, 2, '0'), '-', lpad({_D}, 2, '0')) AS DATE) AS this, TRY_CAST(concat('1997-', lpad({_M}, 2, '0'), '-', lpad({_D}, 2, '0')) AS DATE) AS last FROM orders)""")
def resolve_year(spark, sf):
    raw = F.expr(f"concat({_M3}, '-', {_D})")
    num = F.expr(f"concat(lpad({_M}, 2, '0'), '-', lpad({_D}, 2, '0'))")
    anchor = F.lit("1998-06-15").cast("date")
    return table(spark, sf, "orders").select(
        "o_orderkey", text(P.resolve_year(raw, anchor, 0)).alias("strict"),
        text(P.resolve_year(num, anchor, 7, "MM-dd")).alias("lenient"))


@query("""SELECT event_id, strftime(make_timestamp(epoch_us(ts) // 1000 * 1000), '%Y-%m-%d') AS utc_day,
 strftime(make_timestamp(epoch_us(ts) // 1000 * 1000) + INTERVAL 8 HOUR, '%Y-%m-%d') AS local_day FROM events""")
def epoch_ms_to_date(spark, sf):
    ms = F.unix_millis("ts")
    return table(spark, sf, "events").select("event_id", text(P.epoch_ms_to_date(ms)).alias("utc_day"),
                                             text(P.epoch_ms_to_date(ms, "Asia/Shanghai")).alias("local_day"))


@query("""SELECT o_orderkey, strftime(date_trunc('week', o_orderdate), '%Y-%m-%d') AS monday,
 strftime(CAST(o_orderdate AS DATE) - 7, '%Y-%m-%d') AS week_before FROM orders""")
def week_anchor(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", text(P.monday_of("o_orderdate")).alias("monday"),
                                             text(P.date_shift("o_orderdate", -7)).alias("week_before"))


RAW_PERIOD = f"""CASE WHEN o_orderkey % 5 = 0 THEN 'unknown' ELSE concat({_Y}, '-', lpad({_M}, 2, '0'), '-', lpad({_D}, 2, '0'), ' 〜 2026-01-31 (', {S('o_orderkey % 9 + 1')}, ',', lpad({S('o_orderkey % 1000')}, 3, '0'), ' days)') END"""


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 5 > 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS s,
 CASE WHEN o_orderkey % 5 > 0 THEN '2026-01-31' END AS e,
 CAST(CASE WHEN o_orderkey % 5 > 0 THEN (o_orderkey % 9 + 1) * 1000 + o_orderkey % 1000 END AS DOUBLE) AS days FROM orders""")
def parse_period(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", P.parse_period(F.expr(RAW_PERIOD)).alias("p")).select(
        "o_orderkey", text("p.start").alias("s"), text("p.end").alias("e"), F.col("p.days").cast("double").alias("days"))


RAW_PAIR = "CASE p_partkey % 4 WHEN 0 THEN p_brand WHEN 1 THEN concat(' - / ', p_name) ELSE concat(p_brand, ' /  ', p_name, ' / x') END"
RAW_SUFFIX = "concat(p_name, '-', CASE p_partkey % 3 WHEN 0 THEN 'Combine' WHEN 1 THEN 'Water' ELSE 'Other' END)"


@query(f"""SELECT p_partkey, CASE WHEN trim(split_part(raw, '/', 1)) = '-' THEN '' ELSE trim(split_part(raw, '/', 1)) END AS first, trim(split_part(raw, '/', 2)) AS second,
 regexp_replace({RAW_SUFFIX}, '-(Combine|Rainfall|Water|IG)$', '') AS base FROM (SELECT *, {RAW_PAIR} AS raw FROM part)""")
def split_pair(spark, sf):
    pair = P.split_pair(F.expr(RAW_PAIR))
    return table(spark, sf, "part").select(
        "p_partkey", pair["first"].alias("first"), pair["second"].alias("second"),
        P.drop_suffix(F.expr(RAW_SUFFIX), ["Combine", "Rainfall", "Water", "IG"]).alias("base"))


RAW_HEADER = """CASE p_partkey % 5 WHEN 0 THEN concat(p_name, ' (water level, m)') WHEN 1 THEN concat(p_name, ' (cusec)')
 WHEN 2 THEN concat(p_name, ' (water level)') WHEN 3 THEN concat(p_name, ' (storage) (10^6 m^3)') ELSE p_name END"""


@query("""SELECT p_partkey, p_name AS name, CASE p_partkey % 5 WHEN 0 THEN 'water level' WHEN 2 THEN 'water level' WHEN 3 THEN 'storage' ELSE '' END AS gloss,
 CASE p_partkey % 5 WHEN 0 THEN 'm' WHEN 1 THEN 'cusec' WHEN 3 THEN '10^6 m^3' ELSE '' END AS unit FROM part""")
def parse_header(spark, sf):
    return table(spark, sf, "part").select("p_partkey", P.parse_header(F.expr(RAW_HEADER)).alias("h")).select("p_partkey", "h.*")


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity - 10 > 0 THEN round(l_linenumber / (l_quantity - 10) * 100, 4) END AS pct,
 round(l_quantity * l_linenumber / 100, 4) AS volume FROM lineitem""")
def derived_measures(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", r4(P.pct_full("l_linenumber", F.col("l_quantity") - 10)).alias("pct"),
        r4(P.volume_from_pct("l_quantity", "l_linenumber")).alias("volume"))


@query("SELECT o_orderkey, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month FROM orders")
def pad_month(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", text(P.pad_month("o_orderdate")).alias("month"))


# ---- filters

@query("""SELECT l_orderkey, l_linenumber, variable, value FROM (SELECT l_orderkey, l_linenumber,
 CASE l_linenumber % 3 WHEN 0 THEN 'storage_pct' WHEN 1 THEN 'water_level_m' ELSE 'other' END AS variable, l_quantity * 4 AS value FROM lineitem)
 WHERE variable = 'other' OR (variable = 'storage_pct' AND value BETWEEN 0 AND 150) OR (variable = 'water_level_m' AND value BETWEEN 5 AND 3000)""")
def gate(spark, sf):
    bounds = local_table(spark, [(k, *v) for k, v in fixed.BOUNDS.items()], "variable string, lo double, hi double")
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.expr("CASE l_linenumber % 3 WHEN 0 THEN 'storage_pct' WHEN 1 THEN 'water_level_m' ELSE 'other' END").alias("variable"),
        (F.col("l_quantity") * 4).alias("value"))
    return filters.gate(rows, bounds)


_AGG_NAME = "CASE p_partkey % 5 WHEN 0 THEN concat('TOTAL ', upper(p_name)) WHEN 1 THEN 'ab' ELSE upper(p_name) END"


@query(f"SELECT p_partkey, name FROM (SELECT p_partkey, {_AGG_NAME} AS name FROM part) WHERE length(name) >= 3 AND NOT regexp_matches(name, 'TOTAL|CATCHMENT|NATIONAL|AVERAGE|DAM NAME|DAM LEVEL|SUMMARY|PROVINCE')")
def drop_aggregate_rows(spark, sf):
    names = table(spark, sf, "part").select("p_partkey", F.expr(_AGG_NAME).alias("name"))
    return filters.drop_aggregate_rows(names, "name")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderdate >= DATE '1997-01-01' AND o_orderdate < DATE '1998-01-01'")
def within_dates(spark, sf):
    orders = table(spark, sf, "orders")
    lo, hi = (F.lit(d).cast("date") for d in ("1997-01-01", "1997-12-31"))
    return filters.within_dates(orders, "o_orderdate", lo, hi).select("o_orderkey", "o_custkey")


@query("SELECT event_id FROM (SELECT event_id, CASE event_id % 3 WHEN 0 THEN true WHEN 1 THEN false END AS simulated FROM events) WHERE simulated = false")
def keep_explicit_false(spark, sf):
    events = table(spark, sf, "events").withColumn(
        "simulated", F.expr("CASE event_id % 3 WHEN 0 THEN true WHEN 1 THEN false END"))
    return filters.keep_explicit_false(events, "simulated").select("event_id")


_CONF = {
    "basin": "CASE WHEN o_orderkey % 11 = 0 THEN ' ' ELSE 'B' END", "province": "o_orderstatus",
    "river": "o_orderpriority", "reservoir": S("o_custkey"),
    "time": f"concat(lpad({_M}, 2, '0'), '-', lpad({_D}, 2, '0'), ' 08:00')",
    "level": f"CASE WHEN o_orderkey % 7 = 0 THEN 'x' ELSE concat({S('o_custkey')}, '.5') END",
    "change": "CASE o_orderkey % 4 WHEN 0 THEN '' WHEN 1 THEN '--' WHEN 2 THEN '0.12' ELSE 'up' END",
}


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 11 <> 0 AND o_orderkey % 7 <> 0 AND o_orderkey % 4 < 3 AND strftime(o_orderdate, '%m-%d') IN ('06-14', '06-15', '06-16')")
def confident_rows(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", *[F.expr(e).alias(n) for n, e in _CONF.items()])
    return filters.confident_rows(rows, F.lit("2026-06-15").cast("date"),
                                  ["basin", "province", "river", "reservoir"], "time", "level", "change").select("o_orderkey")
