"""Fixed values.

Everything here is data that sources define (markers, month names, header
words, layouts, bounds, statuses); results depend on these values being exactly
what the sources use. They are parameters of the operators, not logic.
"""

# --- fixed values: one white space character as Python's str.strip() understands it
WHITE_SPACE = r"(?U:[\s\x1c-\x1f])"

# --- fixed values: missing markers by family of sources
MARKERS_NULL_WORDS = ("", "-", "--", "null", "None")
MARKERS_DASHES = ("", "-", "−", "—", "–")
MARKERS_HYPHEN = ("", "-")
MARKERS_BULLETIN = ("", "-", "--", "*", "P,E.T")
MARKERS_EMPTY_DAM = ("empty", "dry", "n/a", "-")
MARKERS_NULL_ONLY = ("", "null")

# --- fixed values: month names
MONTHS_EN = {"january": 1, "february": 2, "march": 3, "april": 4, "may": 5, "june": 6,
             "july": 7, "august": 8, "september": 9, "october": 10, "november": 11,
             "december": 12}
MONTHS_PT = {"janeiro": 1, "fevereiro": 2, "marco": 3, "abril": 4, "maio": 5, "junho": 6,
             "julho": 7, "agosto": 8, "setembro": 9, "outubro": 10, "novembro": 11,
             "dezembro": 12}

# --- fixed values: day-first date formats tried in this order (Java letters)
DATE_FORMATS_DAY_FIRST = ("d/M/yyyy", "d/M/yy", "d-M-yyyy", "d-M-yy", "d MMMM yyyy",
                          "d MMM yyyy", "MMMM d yyyy", "MMM d yyyy")
DATE_FORMATS_ISO = ("yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "yyyy-MM-dd'T'HH:mm:ssXXX",
                    "yyyy-MM-dd HH:mm:ssXXX", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss",
                    "yyyy-MM-dd'T'HHmmssX", "yyyy-MM-dd")

# --- fixed values: patterns of the "as at" date printed on a page, in order of trust
AS_AT_PATTERNS = (
    r"Dam\s+Levels?\s+as\s+at:?\s*([0-9]{1,2}[/-][0-9]{1,2}[/-][0-9]{2,4})",
    r"Dam\s+Levels?\s+as\s+at:?\s*([0-9]{1,2}[\s-][A-Za-z]+,?[\s-][0-9]{4})",
    r"Dam\s+Levels?\s+as\s+at:?\s*([A-Za-z]+\s+[0-9]{1,2},?\s+[0-9]{4})",
    r"Dam\s+Levels?\s+of\s+([A-Za-z]+\s+[0-9]{1,2},?\s+[0-9]{4})",
    r"Dam\s+Levels?\s+of\s+([0-9]{1,2}\s+[A-Za-z]+,?\s+[0-9]{4})",
    r"as\s+at:?\s*([0-9]{1,2}[/-][0-9]{1,2}[/-][0-9]{2,4})",
    r"as\s+at:?\s*([0-9]{1,2}[\s-][A-Za-z]+,?[\s-][0-9]{4})",
    r"as\s+at:?\s*([A-Za-z]+\s+[0-9]{1,2},?\s+[0-9]{4})",
    r"Official\s+([0-9]{1,2}\s+[A-Za-z]+\s+[0-9]{4})",
    r"Platform\s*\|\s*([0-9]{1,2}\s+[A-Za-z]+\s+[0-9]{4})",
)

# --- fixed values: row captions that are aggregates, not dams
AGGREGATE_TOKENS_EN = ("TOTAL", "CATCHMENT", "NATIONAL", "AVERAGE", "DAM NAME", "DAM LEVEL",
                       "SUMMARY", "PROVINCE")
AGGREGATE_TOKENS_FR = ("TOTAL", "NORD", "CENTRE", "CAP-BON", "CAP BON", "DONT", "BARRAGES",
                       "MOYENNE", "ENSEMBLE")
AGGREGATE_TOKENS_BULLETIN = ("BULLETIN", "TOTAL", "SYSTEM", "NAME", "SUPPLY", "AMSL")

# --- fixed values: aliases of dam names
DAM_ALIASES = {
    "TOKWE MUKORSI": "TUGWI MUKOSI", "TUGWI-MUKOSI": "TUGWI MUKOSI",
    "TUGWI MUKOSI": "TUGWI MUKOSI", "LAKE MUTIRIKWI": "MUTIRIKWI", "MUTIRIKWI": "MUTIRIKWI",
    "LAKE KARIBA": "KARIBA", "MANYAME (DARWENDALE)": "MANYAME", "DARWENDALE": "MANYAME",
    "LAKE CHIVERO": "CHIVERO", "EXCHANGE": "EXCHANGE",
}
DAM_NAMES_PROSE = {
    "CAHORA BASSA": "CAHORA BASSA", "CHICAMBA": "CHICAMBA", "CHICAMBA REAL": "CHICAMBA",
    "MUDA": "MUDA", "MAVUZI": "MAVUZI", "PEQUENOS LIBOMBOS": "PEQUENOS LIBOMBOS",
}

# --- fixed values: plausible bounds by variable (inclusive)
BOUNDS = {
    "storage_pct": (0.0, 150.0), "storage_pct_dashboard": (0.0, 130.0),
    "storage_pct_bulletin": (0.0, 200.0), "water_level_m": (5.0, 3000.0),
}

# --- fixed values: column layouts of word-box bulletins (13 and 15 columns)
LAYOUT_13 = ("fsl_masl", "fsc_mcm", "lal_masl", "lac_mcm", "stage_masl", "volume_mcm",
             "pct_full", "change_mcm", "volume_1wk_mcm", "pct_1wk", "volume_last_season_mcm",
             "pct_last_season", "rainfall_week_mm")
LAYOUT_15 = ("fsl_masl", "fsc_mcm", "irrigation_level_masl", "irrigation_capacity_mcm",
             "lal_masl", "lac_mcm", "stage_masl", "volume_mcm", "pct_full", "change_mcm",
             "volume_1wk_mcm", "pct_1wk", "volume_last_season_mcm", "pct_last_season",
             "rainfall_week_mm")
VARIABLES_BULLETIN = {
    "stage_masl": "water_level_masl", "volume_mcm": "storage_mcm", "pct_full": "storage_pct",
    "change_mcm": "change_since_last_mcm", "rainfall_week_mm": "rainfall_week_mm",
    "fsl_masl": "full_supply_level_masl", "fsc_mcm": "full_supply_capacity_mcm",
    "lal_masl": "lowest_abstraction_level_masl", "lac_mcm": "lowest_abstraction_capacity_mcm",
    "irrigation_level_masl": "irrigation_level_masl",
    "irrigation_capacity_mcm": "irrigation_capacity_mcm",
}

# --- fixed values: table layouts chosen by column count (min, max or open, column, variable)
LAYOUT_BY_WIDTH = (
    (17, None, 1, "inflow_day_mcm"), (17, None, 8, "outflow_day_mcm"),
    (17, None, 13, "storage_pct"), (17, None, 14, "storage_p1_mcm"),
    (12, 16, 1, "inflow_day_mcm"), (12, 16, 8, "outflow_day_mcm"),
    (12, 16, 13, "storage_p1_mcm"),
)
LAYOUT_SITUATION = (
    (26, None, 18, "water_level_m"), (26, None, 19, "storage_mcm"), (26, None, 20, "storage_useful_mcm"),
    (26, None, 21, "withdrawal_day_mcm"), (26, None, 24, "precipitation_mm"), (26, None, 25, "salinity_gl"),
)
LAYOUTS = {"flows": LAYOUT_BY_WIDTH, "situation": LAYOUT_SITUATION}

# --- fixed values: which day a bulletin's variable belongs to (days back)
DAYS_BACK_BY_VARIABLE = {"inflow_day_mcm": 1, "outflow_day_mcm": 1,
                         "storage_pct": 0, "storage_p1_mcm": 0}

# --- fixed values: known basins and provinces used to repair shifted rows
KNOWN_BASINS = (
    "珠江", "长江", "黄河", "淮河", "海河", "辽河", "松花江", "黑龙江", "闽江", "内陆河",
    "太湖", "三亚河", "粤东沿海诸河", "粤西沿海诸河", "浙闽台河流", "浙东沿海诸河",
    "浙西沿海诸河", "海南",
)
KNOWN_PROVINCES = (
    "北京", "天津", "河北", "山西", "内蒙古", "辽宁", "吉林", "黑龙江", "上海", "江苏", "浙江",
    "安徽", "福建", "江西", "山东", "河南", "湖北", "湖南", "广东", "广西", "海南", "重庆",
    "四川", "贵州", "云南", "西藏", "陕西", "甘肃", "青海", "宁夏", "新疆", "台湾", "香港", "澳门",
)
CHANGE_PLACEHOLDERS = ("--", "——", "—", "一", "-", "--.")

# --- fixed values: metadata contract
REQUIRED_METADATA = ("reservoir_id", "reservoir_name", "country", "lat", "lon",
                     "source_agency", "source_url", "data_type", "last_updated")
DATA_TYPES = ("in_situ", "remote_sensing", "mixed", "model")

# --- fixed values: source registry contract
REGISTRY_REQUIRED = (
    "source_id", "country", "retention_class", "retention_window_hours",
    "publication_cadence_hours", "timezone", "cron", "max_schedule_gap_hours",
    "minimum_capture_opportunities", "overlap_strategy", "schedule_rationale", "workflow",
    "scraper", "data_path", "deployment_status", "licence_gate",
)
WINDOWED_CLASSES = ("rolling_window", "current_snapshot", "overwrite_prone")
REGISTRY_TEXT_FIELDS = ("timezone", "overlap_strategy", "schedule_rationale", "licence_gate")
REGISTRY_PATH_FIELDS = ("workflow", "scraper", "data_path")
WORKFLOW_TOKENS = {
    "schedule": "schedule:", "manual recovery": "workflow_dispatch",
    "write permission": "contents: write", "concurrency protection": "concurrency:",
    "persistent commit": "git push",
}

# --- fixed values: freshness rule
STALE_CADENCE_FACTOR = 3.0
DEFAULT_CADENCE_HOURS = 24.0
DATE_COLUMN_PATTERN = r"(?i)date|day|time"
CAPTURE_COLUMN_PATTERN = r"(?i)fetched|post_date|retrieved|updated"

# --- fixed values: licence statuses that allow an unconditional release
PUBLISHABLE = ("open_attribution", "open_no_attribution")

# --- fixed values: factors to SI-based standard units (Mm3, m3/s, m, km2)
UNIT_FACTORS = {
    "TMC": 28.316846592, "cusec": 0.028316846592, "10^4 m^3": 0.01, "千m^3": 0.001,
    "million m^3": 1.0, "million m^3/day": 11.5740741, "mld": 0.0115740741, "Ml": 0.001,
    "ft": 0.3048, "亿立方米": 100.0, "hectare": 0.01, "m": 1.0, "m^3/s": 1.0, "cms": 1.0,
    "mcm": 1.0, "%": 1.0, "mm": 1.0,
}

# --- fixed values: words that mark a bracket group in a column header as a unit
UNIT_PATTERN = (r"^(?:%.*|m|mm|cm|km|ft|masl|m NN|metres|meters|cusec|cumecs|cms|mcm|MCM|TMC"
                r"|Ml|ML|mld|hectare|ha|sq\.km|千m\^3|亿立方米|百万立方米|.*\^.*|.*/.*|.* = .*"
                r"|million m\^3)$")
