"""Column functions: cells, numbers, text, dates, names, measures."""

from hydrolake.functions.cells import clean_cell
from hydrolake.functions.dates import (
    cell_date, date_shift, epoch_ms_to_date, month_day_candidates, monday_of, pad_month,
    parse_date_any, parse_dmy, parse_period, parse_text_date, parse_ymd_loose,
    printed_date, resolve_year,
)
from hydrolake.functions.measures import fmt_number, pct_full, volume_from_pct
from hydrolake.functions.names import (
    best_name, canon_name, canon_text, drop_suffix, id_fallback, make_id, match_key,
    parse_header, slug_lower, slug_upper, split_pair,
)
from hydrolake.functions.numbers import (
    is_integer, num_decimal_comma, num_first, num_hash, num_int_or_float, num_leading,
    num_space_thousands, num_strip, num_thousands, to_double,
)
from hydrolake.functions.text import (
    clean_text, drop_bidi_marks, html_to_lines, html_to_text, html_unescape, norm_lower,
    strip, strip_accents,
)

__all__ = [n for n in dir() if not n.startswith("_")]
