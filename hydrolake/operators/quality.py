"""Q1-Q10: quality, governance, monitoring.

Checks return issue rows instead of failing a job; a caller that must stop
counts them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from hydrolake.functions import fixed
from hydrolake.functions._base import col
from hydrolake.operators.select import recent_runs


def _blank(c: Column | str) -> Column:
    return F.trim(F.coalesce(col(c).cast("string"), F.lit(""))) == ""


def _issues(*rules: tuple[Column, Column | str]) -> Column:
    """Array of the messages whose condition holds."""
    found = [F.when(F.coalesce(cond, F.lit(False)), msg if isinstance(msg, Column) else F.lit(msg))
             for cond, msg in rules]
    return F.filter(F.array(*found), lambda x: x.isNotNull())


def check_metadata(df: DataFrame, required: tuple[str, ...] = fixed.REQUIRED_METADATA) -> DataFrame:
    """Q1: one row per broken rule: blank required field, bad enum, bad coordinate, repeated id."""
    rules = [(_blank(c), f"missing {c}") for c in required]
    if "data_type" in df.columns:
        rules.append((~_blank("data_type") & ~F.col("data_type").isin(*fixed.DATA_TYPES), "invalid data_type"))
    for c, bound in (("lat", 90), ("lon", 180)):
        number = F.col(c).try_cast("double")
        rules.append((~_blank(c) & (number.isNull() | ~number.between(-bound, bound)), f"{c} out of range"))
    rows = df.select("reservoir_id", F.explode(_issues(*rules)).alias("issue"))
    repeated = (df.groupBy("reservoir_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                .select("reservoir_id", F.lit("duplicate reservoir_id").alias("issue")))
    return rows.unionByName(repeated)


def check_cells(df: DataFrame, ids: list[str], cols: list[str],
                markers: tuple[str, ...] = ("NA", "--", "-", "null", "None", "-999", "n/a")) -> DataFrame:
    """Q2: cells that still hold a missing marker or carry a unit behind the number."""
    cells = df.select(*ids, F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("cell")) for c in cols])))
    issue = F.when(F.trim("cell").isin(*markers), "leftover marker") \
        .when(F.col("cell").rlike(r"^\s*[-+]?\d[\d,]*(\.\d+)?\s*[A-Za-z%³]+[\w^/%³]*\s*$"), "unit in cell")
    return cells.withColumn("issue", issue).where("issue is not null")


def check_fk(obs: DataFrame, meta: DataFrame, key: str) -> DataFrame:
    """Q3: ids of the time series that the metadata does not know, with row counts."""
    used = obs.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return used.join(meta.select(key).distinct(), key, "left_anti")


def check_contract(df: DataFrame, columns: list[str] | None = None, min_rows: int = 1,
                   constants: dict[str, str] | None = None) -> DataFrame:
    """Q4: contract of a source as rows ``(rule, ok, detail)``.

    Header equality, minimum number of rows, and columns that must hold one
    value throughout (station number, unit).
    """
    constants = constants or {}
    counts = df.agg(F.count(F.lit(1)).alias("n"), *[
        F.count(F.when(~F.col(c).eqNullSafe(F.lit(v)), 1)).alias(f"bad_{c}") for c, v in constants.items()])
    header_ok = columns is None or list(columns) == list(df.columns)
    checks = [F.struct(F.lit("header").alias("rule"), F.lit(header_ok).alias("ok"),
                       F.lit(",".join(df.columns)).alias("detail")),
              F.struct(F.lit("min_rows").alias("rule"), (F.col("n") >= min_rows).alias("ok"),
                       F.col("n").cast("string").alias("detail"))]
    checks += [F.struct(F.lit(f"constant {c}").alias("rule"), (F.col(f"bad_{c}") == 0).alias("ok"),
                        F.col(f"bad_{c}").cast("string").alias("detail")) for c in constants]
    return counts.select(F.inline(F.array(*checks)))


def audit_registry(registry: DataFrame, files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Q5: issues of the source registry and a one-row report.

    ``registry`` has the 16 contract columns (``cron`` an array of strings);
    ``files`` is ``(path, text)``, text null for folders.
    """
    sid = F.coalesce("source_id", F.lit("<missing source_id>"))
    missing = F.filter(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in sorted(fixed.REGISTRY_REQUIRED)]),
                       lambda x: x.isNotNull())
    base = registry.withColumn("__missing", missing).withColumn("__sid", sid)
    whole = base.where(F.size("__missing") == 0)
    lacking = base.where(F.size("__missing") > 0).select(
        F.col("__sid").alias("source_id"),
        F.concat(F.lit("missing registry fields: "), F.array_join("__missing", ", ")).alias("issue"))

    bad_cron = (F.size("cron") == 0) | F.exists("cron", lambda x: F.trim(F.coalesce(x, F.lit(""))) == "")
    rules = [
        (~F.col("retention_class").isin(*fixed.WINDOWED_CLASSES),
         F.concat(F.lit("invalid retention_class '"), "retention_class", F.lit("'"))),
        (bad_cron, "cron must contain at least one schedule"),
        (F.col("minimum_capture_opportunities") < 2, "minimum_capture_opportunities must be at least 2"),
        *[(_blank(c), f"{c} must be documented") for c in fixed.REGISTRY_TEXT_FIELDS],
    ]
    field_issues = whole.select(F.col("__sid").alias("source_id"), F.explode(_issues(*rules)).alias("issue"))

    active = whole.where(F.col("deployment_status") == "active")
    # paths are looked up by an equi-join; folders match with a null text
    found = files.select("path", "text", F.lit(True).alias("__exists"))
    paths = active.select(F.col("__sid").alias("source_id"), "cron", F.col("data_path").alias("__data_path"),
                          F.inline(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("path"))
                                             for c in fixed.REGISTRY_PATH_FIELDS])))
    looked_up = paths.join(found, "path", "left")
    path_issues = looked_up.select("source_id", F.explode(_issues(
        (F.col("path") == "", F.concat(F.lit("active deployment requires "), "field")),
        ((F.col("path") != "") & F.col("__exists").isNull(),
         F.concat("field", F.lit(" does not exist: "), "path")))).alias("issue"))
    workflow = looked_up.where((F.col("field") == "workflow") & F.col("text").isNotNull())
    token_rules = [(~F.contains("text", F.lit(token)), f"workflow missing {label} ({token})")
                   for label, token in fixed.WORKFLOW_TOKENS.items()]
    crons = F.transform(F.filter("cron", lambda x: ~F.contains(F.col("text"), x)),
                        lambda x: F.concat(F.lit("registered cron not found in workflow: "), x))
    unreferenced = _issues((~F.contains("text", F.col("__data_path")),
                            F.concat(F.lit("workflow does not reference registered data_path "), "__data_path")))
    workflow_issues = workflow.select("source_id", F.explode(
        F.concat(_issues(*token_rules), crons, unreferenced)).alias("issue"))

    repeated = (base.groupBy("source_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                .select("source_id", F.when(F.col("n") == 2, "duplicate source_id").otherwise(
                    F.concat(F.lit("duplicate source_id ("), "n", F.lit(" rows)"))).alias("issue")))
    issues = reduce(lambda a, b: a.unionByName(b),
                    [lacking, field_issues, path_issues, workflow_issues, repeated])

    is_active = F.coalesce(F.col("deployment_status") == "active", F.lit(False))
    report = registry.agg(F.count(F.lit(1)).alias("sources_registered"),
                          F.count(F.when(is_active, 1)).alias("active_deployments"),
                          F.count(F.when(~is_active, 1)).alias("pending_or_blocked"))
    n_issues = issues.agg(F.count(F.lit(1)).alias("n_issues"))
    report = (report.withColumn("__k", F.lit(1)).join(n_issues.withColumn("__k", F.lit(1)), "__k").drop("__k")
              .withColumn("status", F.when(F.col("n_issues") == 0, "PASS").otherwise("FAIL")))
    return issues, report


def freshness(registry: DataFrame, runs: DataFrame, observations: DataFrame, now: Column,
              held: DataFrame | None = None, excused: dict[str, str] | None = None, n: int = 10) -> DataFrame:
    """Q6: state of every registered source, with its last ``n`` runs.

    ``runs``: ``source_id, run_ts, run_file, status``; ``observations``:
    ``source_id, latest_observation`` (ISO text); ``held``: ``source_id`` of
    sources that have a data folder (all of them if not given).
    A source is stale only if its newest observation is older than
    ``3 * cadence + schedule gap``; cadence defaults to 24 h, the gap to the cadence.
    """
    latest = recent_runs(runs, ["source_id"], ["run_file"], "status", n)
    newest_ts = runs.groupBy("source_id").agg(F.max_by("run_ts", "run_file").alias("latest_run_ts"))
    df = (registry.join(latest, "source_id", "left").join(newest_ts, "source_id", "left")
          .join(observations, "source_id", "left"))
    if held is not None:
        df = df.join(held.select("source_id").distinct().withColumn("__held", F.lit(True)), "source_id", "left")
    else:
        df = df.withColumn("__held", F.lit(True))
    cadence = F.col("publication_cadence_hours").cast("double")
    cadence = F.when(cadence.isNull() | (cadence == 0), fixed.DEFAULT_CADENCE_HOURS).otherwise(cadence)
    gap = F.col("max_schedule_gap_hours").cast("double")
    gap = F.when(gap.isNull() | (gap == 0), cadence).otherwise(gap)
    budget = cadence * fixed.STALE_CADENCE_FACTOR + gap

    def age(instant: Column) -> Column:
        return (F.unix_micros(now) - F.unix_micros(instant)) / 3.6e9

    obs_age = age(F.try_to_timestamp("latest_observation", F.lit("yyyy-MM-dd")))
    state = F.when(~F.coalesce(F.col("deployment_status") == "active", F.lit(False)), "not_active") \
        .when(F.col("__held").isNull(), "no_data_dir") \
        .when(obs_age.isNull(), "no_observation_date") \
        .when(obs_age > budget, "stale").otherwise("fresh")
    excused = excused or {}
    note = reduce(lambda acc, kv: F.when(F.col("source_id") == kv[0], F.lit(kv[1])).otherwise(acc),
                  excused.items(), F.lit(None).cast("string"))
    out = df.select(
        "source_id", state.alias("state"), "latest_observation",
        F.round(obs_age, 1).alias("observation_age_hours"), F.round(budget, 1).alias("stale_after_hours"),
        F.col("latest_status").alias("latest_run_status"),
        F.round(age(F.col("latest_run_ts")), 1).alias("latest_run_age_hours"),
        F.col("recent_statuses").alias("recent_run_statuses"), note.alias("excused"))
    problem = F.col("state").isin("stale", "no_observation_date", "no_data_dir") & F.col("excused").isNull()
    return out.withColumn("is_problem", problem)


def assert_lag(df: DataFrame, date: str, today: Column, max_days: int,
               keys: list[str] | None = None) -> DataFrame:
    """Q7: newest day per source, its lag, and whether the lag is acceptable."""
    newest = df.groupBy(*(keys or [])).agg(F.max(date).alias("latest_date"))
    lag = F.datediff(today, F.col("latest_date"))
    return newest.withColumn("lag_days", lag).withColumn("ok", F.coalesce(lag <= max_days, F.lit(False)))


def classify_run(df: DataFrame) -> DataFrame:
    """Q8: outcome of a run from its counters.

    Columns: ``expected, fetched, skipped, unavailable, rows, new_items, failures``.
    """
    status = (
        F.when((F.col("fetched") == 0) & (F.col("unavailable") > 0), "source_unavailable")
        .when((F.col("fetched") == 0) & (F.col("skipped") != F.col("expected")), "error")
        .when((F.col("new_items") > 0) & (F.col("rows") == 0), "error")
        .when(F.col("unavailable") > 0, "partial")
        .when(F.col("failures") > 0, "ok_with_warnings")
        .when(F.col("new_items") == 0, "no_new")
        .otherwise("ok"))
    return df.withColumn("status", status)


def release_view(df: DataFrame, licences: DataFrame, source: str) -> tuple[DataFrame, DataFrame]:
    """Q9: rows of publishable sources with their attribution, and what is held back.

    A source without a licence row is held back too.
    """
    table = licences.select(F.col("path").alias(source), "reuse_status", "attribution")
    open_only = table.where(F.col("reuse_status").isin(*fixed.PUBLISHABLE))
    rows = df.join(open_only, source)
    withheld = (df.groupBy(source).agg(F.count(F.lit(1)).alias("n")).join(table, source, "left")
                .where(~F.coalesce(F.col("reuse_status").isin(*fixed.PUBLISHABLE), F.lit(False)))
                .select(source, "reuse_status", "n"))
    return rows, withheld


def gaps(obs: DataFrame, keys: list[str], date: str, step_days: int = 1) -> DataFrame:
    """Q10: days a series should have, from its first to its last, and has not.

    The calendar is generated per series from two numbers, then anti-joined.
    """
    days = obs.select(*keys, F.to_date(date).alias("date")).distinct()
    span = days.groupBy(*keys).agg(F.min("date").alias("__lo"), F.max("date").alias("__hi"))
    expected = span.select(*keys, F.explode(F.sequence(
        "__lo", "__hi", F.make_interval(days=F.lit(step_days)))).alias("date"))
    return expected.join(days, [*keys, "date"], "left_anti")
