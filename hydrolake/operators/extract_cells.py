"""Tables of cells or lines to observations.

The windows here run inside one document (one landed payload), except X14,
whose series may be long and which therefore works in slices.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from hydrolake.functions import fixed
from hydrolake.functions._base import let
from hydrolake.functions.dates import resolve_year
from hydrolake.functions.text import clean_text
from hydrolake.operators.ordered import descents_over_slices


def carry_rowspan(rows: DataFrame, doc: list[str], row: str, cells: str, anchor: Column,
                  parent_width: int = 13, child_width: int = 9,
                  heading: str = "Dam Name") -> DataFrame:
    """A status table whose dates stand on rows of their own.

    A parent row opens a dam (name, time, level ...), a narrower child row
    repeats it for the day before, and one-cell rows carry the dates: the first
    date after a parent belongs to the parent, a later date to the latest child
    row that no other date has taken yet.
    """
    c = F.col(cells)
    n, first = F.size(c), F.get(c, F.lit(0))
    kind = (F.when((n == parent_width) & (first != "") & (first != heading), "parent")
            .when(n == child_width, "child").when((n == 1) & (first != ""), "date"))
    marked = rows.select(*doc, F.struct(F.col(row).alias("row"), kind.alias("kind"), c.alias("cells")).alias("__r")).where("__r.kind is not null")
    docs = marked.groupBy(*doc).agg(F.array_sort(F.collect_list("__r")).alias("__rows"))
    r = F.col("__rows")
    opens = F.filter(F.sequence(F.lit(0), F.size(r) - 1), lambda i: F.get(r, i)["kind"] == "parent")
    blocks = let(opens, lambda at: F.transform(at, lambda i, k: F.slice(r, i + 1, F.coalesce(F.get(at, k + 1), F.size(r)) - i)))
    found = docs.select(*doc, F.inline(F.flatten(F.transform(blocks, lambda b: _dated(b, dict(rows.dtypes)[row])))))

    def field(in_parent: int, in_child: int | None) -> Column:
        child = F.lit(None).cast("string") if in_child is None else F.get("source", F.lit(in_child))
        return F.when(F.col("from_parent"), F.get("source", F.lit(in_parent))).otherwise(child)

    # unnesting a one-element array keeps the filter below from resolving each date a second time
    dated = found.select("*", F.explode(F.array(resolve_year(F.col("text"), anchor, 0, "MMM-d"))).alias("date"))
    return (dated.where("date is not null")
            .select(*doc, F.col("row").alias(row), F.get("parent", F.lit(0)).alias("dam"), "date",
                    field(1, 0).alias("observation_time"), field(2, 1).alias("water_level"),
                    field(4, None).alias("level_change"),
                    F.get("parent", F.lit(5)).alias("normal_high_level"),
                    field(6, 2).alias("normal_level_deviation"), field(7, 3).alias("rule_curve"),
                    field(8, 4).alias("rule_curve_deviation"), field(9, 5).alias("gates_open"),
                    field(10, 6).alias("gate_opening_m"), field(11, 7).alias("inflow"),
                    field(12, 8).alias("outflow")))


def _dated(block: Column, row_type: str) -> Column:
    """The dates of one block, a parent's row and all up to the next parent, with the cells each
    belongs to: the state is how many dates came, and the child row that still waits for one."""
    parent = F.get(block, F.lit(0))["cells"]
    out = f"array<struct<row:{row_type},text:string,from_parent:boolean,source:array<string>,parent:array<string>>>"
    start = F.struct(F.lit(0).alias("dates"), F.lit(None).cast("array<string>").alias("child"), F.array().cast(out).alias("out"))

    def step(state: Column, x: Column) -> Column:
        is_date, is_first = x["kind"] == "date", state["dates"] == 0
        source = F.when(is_first, parent).otherwise(state["child"])
        entry = F.array(F.struct(x["row"].alias("row"), F.get(x["cells"], F.lit(0)).alias("text"), is_first.alias("from_parent"),
                                 source.alias("source"), parent.alias("parent")))
        child = F.when(~is_date, x["cells"]).when(is_first, state["child"])
        return F.struct((state["dates"] + is_date.cast("int")).alias("dates"), child.alias("child"),
                        F.when(is_date & source.isNotNull(), F.concat(state["out"], entry)).otherwise(state["out"]).alias("out"))

    return F.aggregate(F.slice(block, 2, F.size(block)), start, step, lambda state: state["out"])


def segment_blocks(df: DataFrame, keys: list[str], order: list[str], date: str, name: str,
                   slice_by: Column) -> DataFrame:
    """A date that does not increase opens the next reservoir's block.

    Input rows are lines that carry a date with numbers, or only a name; lines with
    neither count for nothing. A name
    belongs to the block open at that line; the last one in the block wins, and
    blocks without a name are dropped.
    """
    blocks = descents_over_slices(df, keys, order, date, "block", slice_by)
    named = [F.col(k).alias(f"__n{i}") for i, k in enumerate([*keys, "block"])]
    names = (blocks.where(F.col(name).isNotNull()).groupBy(*named)
             .agg(F.max_by(name, F.struct(*order)).alias("block_name")))
    same = [F.col(k).eqNullSafe(F.col(f"__n{i}")) for i, k in enumerate([*keys, "block"])]
    return (blocks.where(F.col(date).isNotNull()).join(names, same)
            .drop(*[f"__n{i}" for i in range(len(same))]))


# fixed values: wording of a bulletin's header cells, folded to lower case; the first that fits counts
HEADER_RULES = (
    ("station_id", r"^station$"), ("reservoir", r"^reservoir$"), ("river", r"^river$"), ("wss", r"^wss$"),
    ("district_mun", r"(?=.*distr)(?=.*mun)"),
    ("wma", r"^wma(?:/|$)|(?=.*wma)(?=.*count)"), ("prov", r"^prov(?:/|$)|(?=.*prov)(?=.*count)"),
    ("fsc_mcm", r"full supply capacity"), ("water_mcm", r"water in dam"),
    ("pct_last_year", r"(?=.*% ?full)(?=.*last (?:year|yr))"), ("pct_last_week", r"(?=.*% ?full)(?=.*(?:last week|prev))"),
    ("pct_full", r"% ?full"),
)


_HEADER_DATE = r"(20\d{2})\s*[-/ ]?\s*(\d{2})\s*[-/ ]?\s*(\d{2})"


def header_columns(header: Column, as_of: Column, rules: tuple = HEADER_RULES) -> Column:
    """Column of each label in a header row: map ``label -> col_no``.

    ``rules``: ``(label, pattern)`` pairs; a cell gets the first label that fits.
    Of several "% full" columns today's comes before the one dated as the
    bulletin, and that one before any other; of equals the rightmost counts.
    """
    stamp = F.date_format(as_of, "yyyyMMdd")
    folded = F.transform(header, lambda c: F.struct(
        F.lower(clean_text(F.coalesce(c["text"], F.lit("")))).alias("t"), c["col_no"].alias("col_no")))

    def score(text: Column) -> Column:
        dated = F.regexp_replace(F.regexp_extract(text, _HEADER_DATE, 0), r"\D", "")
        return F.when(text.contains("today"), 100).when(dated == stamp, 90).otherwise(10)

    described = F.filter(F.transform(folded, lambda c: F.struct(
        F.coalesce(*[F.when(c["t"].rlike(p), n) for n, p in rules]).alias("label"), score(c["t"]).alias("score"), c["col_no"].alias("col_no"))),
        lambda x: x["label"].isNotNull())

    def best(columns: Column, label: str) -> Column:
        return F.array_max(F.transform(F.filter(columns, lambda x: x["label"] == label),
                                       lambda x: F.struct(x["score"], x["col_no"])))["col_no"]

    return let(described, lambda d: F.map_from_arrays(
        F.array(*[F.lit(n) for n, _ in rules]), F.array(*[best(d, n) for n, _ in rules])))


def map_header(cells: DataFrame, doc: list[str], as_of: Column, header_rows: int | None = None,
               rules: tuple = HEADER_RULES, nested: str | None = None) -> DataFrame:
    """Bulletin cells ``(doc, table_no, row_no, col_no, text)`` to one row per station.

    The header is the first row that names both station and reservoir (of the
    first ``header_rows``, for sources whose later rows may do so too); it is read
    once per table. A document's cells are gathered in one shuffle, and all else
    happens on its own row, without a window or sort of unnested cells; a task holds
    one document at a time. ``nested``: column of one row per document that has its
    cells together as an array of the four fields, as landed; then nothing shuffles.
    """
    four = F.struct("table_no", "row_no", "col_no", "text")
    docs = (cells.select(*doc, F.col(nested).alias("__cells")) if nested
            else cells.groupBy(*doc).agg(F.collect_list(four).alias("__cells")))
    station = r"^([A-Z]\d[A-Z]\d{3})"
    ordered = F.sort_array(F.filter("__cells", lambda c: c["row_no"].isNotNull()))
    rest = [n for n, _ in rules if n != "station_id"]

    def value(row: Column, columns: Column, label: str) -> Column:
        place = F.array_position(row["col_no"], columns[label])
        return F.replace(F.trim(F.get(row["text"], place.cast("int") - 1)), F.lit("\n"), F.lit(""))

    def stations(rows: Column) -> Column:
        return let(_headers(rows, as_of, header_rows, rules), lambda heads: F.array_compact(F.transform(rows, lambda r: below(r, heads))))

    def below(row: Column, heads: Column) -> Column:
        """The row, its station and its header's columns, if it stands below its table's header."""
        at, text = F.get(row, F.lit(0)), _row_text(row)

        def found(head: Column) -> Column:
            name = value(row, head["columns"], "station_id")
            return F.when((at["row_no"] > head["row_no"]) & ~text.rlike("subtotal|grand total") & name.rlike(station), F.struct(
                F.regexp_extract(name, station, 1).alias("station_id"), at["table_no"].alias("table_no"), at["row_no"].alias("row_no"),
                row.alias("__row"), head["columns"].alias("__columns")))

        return let(F.get(F.filter(heads, lambda h: h["table_no"].eqNullSafe(at["table_no"])), F.lit(0)), found)

    def first_of_each(found: Column) -> Column:
        return F.filter(found, lambda x, i: (i == 0) | (F.get(found, i - 1)["station_id"] != x["station_id"]))

    kept = let(let(let(ordered, _rows), stations), lambda found: let(F.sort_array(found), first_of_each))
    wide = docs.select(*doc, F.inline(kept))
    return wide.select(*doc, "station_id", "table_no", "row_no", *[value(F.col("__row"), F.col("__columns"), n).alias(n) for n in rest])


def _rows(cells: Column) -> Column:
    """Ordered cells of a document cut into rows, each an array of its cells."""
    def opens(c: Column, i: Column) -> Column:
        before = F.get(cells, i - 1)
        return (i == 0) | ~c["table_no"].eqNullSafe(before["table_no"]) | (c["row_no"] != before["row_no"])

    starts = F.array_compact(F.transform(cells, lambda c, i: F.when(opens(c, i), i)))
    return let(starts, lambda at: F.transform(at, lambda i, k: F.slice(cells, i + 1, F.coalesce(F.get(at, k + 1), F.size(cells)) - i)))


def _row_text(row: Column) -> Column:
    return F.lower(F.array_join(row["text"], " | "))


def _headers(rows: Column, as_of: Column, header_rows: int | None, rules: tuple) -> Column:
    """``table_no, row_no, columns`` of each table's header row; tables without one are left out."""
    def names_both(row: Column) -> Column:
        both = let(_row_text(row), lambda t: t.contains("station") & t.contains("reservoir"))
        return both if header_rows is None else (F.get(row, F.lit(0))["row_no"] < header_rows) & both

    def header(row: Column) -> Column:
        at = F.get(row, F.lit(0))
        columns = let(header_columns(row, as_of, rules), lambda m: F.struct(*[m[n].alias(n) for n, _ in rules]))
        return F.struct(at["table_no"].alias("table_no"), at["row_no"].alias("row_no"), columns.alias("columns"))

    def table_of(row: Column) -> Column:
        return F.get(row, F.lit(0))["table_no"]

    return let(F.filter(rows, names_both), lambda named: F.transform(F.filter(
        named, lambda r, i: (i == 0) | ~table_of(r).eqNullSafe(table_of(F.get(named, i - 1)))), header))


def layout_by_width(cells: DataFrame, table: list[str], kind: str | None = None,
                    layouts: dict[str, tuple] = fixed.LAYOUTS) -> DataFrame:
    """Name the columns of a table by its kind and how many columns it has.

    ``kind`` is the column that says which of ``layouts`` a table may use (flow
    bulletin or situation page); without it every table is a flow bulletin.
    ``layouts``: kind to ``(min_width, max_width or None, col_no, variable)``.

    The width is a window over the table's own cells, which are shuffled once; a join would let
    Spark broadcast one side by the size of what the cells were unnested from.
    """
    entries = [(k, *e) for k, entry in layouts.items() for e in entry]
    heads, named = F.col("row_no") == 0, F.col("col_no").isin(*sorted({c for _, _, _, c, _ in entries}))
    held = cells.where(heads | named).dropna(subset=table)
    whole = Window.partitionBy(*table)
    of = F.max(F.when(heads, F.col(kind))).over(whole) if kind else F.lit(next(iter(layouts)))
    sized = held.withColumns({"width": F.max(F.when(heads, F.col("col_no"))).over(whole) + 1, "__kind": of}).where(named)
    width = F.col("width")
    fitting = F.array_compact(F.array(*[F.when(
        (F.col("__kind") == k) & (width >= lo) & (F.lit(True) if hi is None else width <= hi) & (F.col("col_no") == c), v)
        for k, lo, hi, c, v in entries]))
    rest = [c for c in cells.columns if c not in (*table, "col_no")]
    return sized.select(*table, "col_no", *rest, "width", F.explode(fitting).alias("variable"))


def name_word_columns(cells: DataFrame, line: list[str], width: int = 13, min_cells: int = 7) -> DataFrame:
    """Cells of a word-box bulletin (``line, col_index, value, flag``) to named variables.

    ``width`` chooses the layout of 13 or 15 columns; columns that are only
    derived from others have no variable and are dropped, as are lines with fewer
    than ``min_cells`` cells and cells without a value.
    """
    names = {13: fixed.LAYOUT_13, 15: fixed.LAYOUT_15}[width]
    variable = F.create_map(*[F.lit(x) for i, n in enumerate(names) if n in fixed.VARIABLES_BULLETIN
                              for x in (i, fixed.VARIABLES_BULLETIN[n])])
    inside = F.count(F.when((F.col("col_index") >= 0) & (F.col("col_index") < width), 1)).over(Window.partitionBy(*line))
    return (cells.withColumn("__n", inside).where(F.col("__n") >= min_cells)
            .withColumn("variable", F.try_element_at(variable, F.col("col_index").cast("int")))
            .where("variable is not null and value is not null")
            .select(*line, "variable", "value", "flag"))
