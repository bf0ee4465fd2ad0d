"""The visit marketing mart (the whole visit job, J9, J10, P34-P40).

Data path::

    visit_events + visit_actions (window) --first_by--> first touch --J1 visits-->
    carts --last_by--> latest carts --J2 first touch--> donors
    first touch x goals x order items x donors --G1--> repairs
    first touch <-J7 repairs --distinct--> end data --P22-P30--> f_data
    visit_orders <-J8 profit report--> sales
    visits (window) <- f_data <- sales --P35..P40--> mart

The original full-joins f_data with sales (J9), then full-joins the result with
the visit master and filters on the master's date (J10), which makes the
second join a right outer join. ``visits LEFT JOIN f_data LEFT JOIN sales``
yields exactly the same rows (for a visit with n f_data rows and m sales rows:
n*m, or n, or m, or one bare visit row). Both joins are keyed by the visit
master's ``visit_id`` (and, if there are visits with very many orders, by a
bucket number), so the master is shuffled once and the second join reuses the
first one's partitioning; a master stored by ``visit_id``
(:func:`store_visits`) is not shuffled at all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from functools import lru_cache

from pyspark.sql import Column

from visitlens.config import ChannelRules, VisitMartConfig
from visitlens.functions.channels import channel_id, channel_label, is_google_display_ad
from visitlens.functions.lookback import trailing_days
from visitlens.functions.params import url_param_columns
from visitlens.contract import (CONSTANTS, FROM_VISIT_ROWS, MART_COLUMNS, MART_TYPES,
                               MASTER_RENAMES)
from visitlens.operators.joins import SplitKeys
from visitlens.operators.repair import END_DATA_COLUMNS, apply_repair, attribution_repair
from visitlens.operators.sales import visit_sales
from visitlens.operators.touch import (VISIT_ATTRIBUTES, donor_carts, first_touch,
                                       latest_carts, window_logs)
from visitlens.session import scratch_path
from visitlens.sinks import store_bucketed
from visitlens.sources.tables import Tables

# --- steps ----------------------------------------------------------------

def store_visits(t: Tables, table: str, buckets: int, path: str | None = None) -> Tables:
    """The visit master stored by ``visit_id`` (``table``, ``buckets`` files or, if it is
    large, a multiple), for all that follows.

    First touch joins its attributes and the mart joins its full rows by ``visit_id``;
    both read the stored copy without an exchange of the master. Worth it where the
    copy serves both joins at full width or several runs.
    """
    return t.with_table("visits", store_bucketed(
        t["visits"], table, "visit_id", buckets, path))


def visit_touches(t: Tables, cfg: VisitMartConfig) -> DataFrame:
    logs = window_logs(t["visit_events"], t["visit_actions"], cfg.as_of, cfg.days)
    return first_touch(logs, t["visits"], cfg.site_rules)


def shared_touches(t: Tables, cfg: VisitMartConfig) -> DataFrame:
    """First touch, computed once for its three consumers.

    First touch feeds the donor carts (J2), the repair (J3) and the final rows
    (J7). Left to the optimizer, each consumer prunes it differently and the
    whole log is scanned and shuffled again per consumer. First touch has one
    row per visit - far smaller than the logs - so it is written as Parquet to
    the shared folder: computed once under adaptive execution, lineage cut, safe
    against executor loss, and each consumer reads only its columns.
    ``cfg.materialize_touches=False`` keeps it lazy.
    """
    touches = visit_touches(t, cfg)
    if not cfg.materialize_touches:
        return touches
    path = scratch_path(touches.sparkSession, "first-touch")
    touches.write.parquet(path)
    return touches.sparkSession.read.schema(touches.schema).parquet(path)


def end_data(t: Tables, cfg: VisitMartConfig, touches: DataFrame | None = None) -> DataFrame:
    """First touch with repaired attribution."""
    touches = touches if touches is not None else shared_touches(t, cfg)
    donors = donor_carts(latest_carts(t["carts"]), touches, with_attributes=True)
    repairs = attribution_repair(touches, t["goals"], t["order_items"], donors, cfg.max_goal_visits)
    return apply_repair(touches, repairs)


def with_url_params(df: DataFrame, null_on_miss: bool = False) -> DataFrame:
    """P22-P30 on ``url`` (the original's ``f_data``)."""
    return df.select(*END_DATA_COLUMNS[:4], "url", *url_param_columns("url", null_on_miss),
                     *VISIT_ATTRIBUTES)


@lru_cache(maxsize=16)
def _channel_exprs(rules: ChannelRules) -> tuple[Column, Column, Column]:
    """Resolved channel id, display flag and label over the f_data column names.

    Built once per rule set: the expressions are unresolved, so one instance
    serves every DataFrame (building ~150 Column objects per plan is driver time).
    """
    cid = channel_id("mms_channel_id", "campaign_source", "campaign_medium", "ad_provider_id",
                     "referrer_type", "referrer_name", "url", "utm_source", rules)
    return cid, is_google_display_ad("campaign_source", rules), channel_label("mms_channel_id", rules)


def with_channel(df: DataFrame, cfg: VisitMartConfig) -> DataFrame:
    """P35 (channel id replaces the URL channel id), P36, P39."""
    cid, display, label = _channel_exprs(cfg.channel_rules)
    return (df.withColumns({"mms_channel_id": cid, "is_google_display_ad": display})
              .withColumn("channel", label))


def join_sales(f_data: DataFrame, sales: DataFrame) -> DataFrame:
    """J9 + P34 as written in the original: full outer join on ``visit_id``."""
    f = f_data.withColumnRenamed("visit_id", "_f_visit_id")
    s = sales.withColumnRenamed("visit_id", "_s_visit_id")
    j = f.join(s, F.col("_f_visit_id") == F.col("_s_visit_id"), "full")
    rest = [c for c in f_data.columns + sales.columns
            if c not in ("visit_id", "datetime_est", "report_datetime")]
    return j.select(
        F.coalesce("datetime_est", "report_datetime").alias("report_datetime"),
        F.coalesce("_s_visit_id", "_f_visit_id").alias("visit_id"), *rest)


def attach_to_visits(visits_window: DataFrame, f_data: DataFrame, sales: DataFrame,
                     orders: DataFrame | None = None,
                     rows_per_task: int = 100_000) -> DataFrame:
    """J9 + J10 as two left joins from the visit master (see module docstring).

    Output: the master's pass-through columns under their mart names (its
    ``visit_id`` as ``_av_visit_id``) plus
    ``date_est``, ``visit_id`` (NULL for visits with neither f_data nor sales
    rows, as in the original) and all f_data / sales columns. With ``orders``,
    the ``visit_id`` column that ``sales`` has its rows from, visits with more
    than ``rows_per_task`` of them have their sales dealt to several buckets and
    their (few) visit rows copied into each
    (:class:`~visitlens.operators.joins.SplitKeys`); both joins are then keyed by
    visit and bucket, so the master still is exchanged once.
    """
    wanted = set(MART_COLUMNS) - FROM_VISIT_ROWS - CONSTANTS
    master_cols = [F.col(c).alias(MASTER_RENAMES.get(c, c)) for c in visits_window.columns
                   if MASTER_RENAMES.get(c, c) in wanted]
    v = visits_window.select(F.col("visit_id").alias("_av_visit_id"), *master_cols)
    f = f_data.select(F.col("visit_id").alias("_f_visit_id"),
                      *[c for c in f_data.columns if c not in ("visit_id", "visitor_ip")])
    s = sales.select(F.col("visit_id").alias("_s_visit_id"),
                     *[c for c in sales.columns if c != "visit_id"])
    own, split = F.col("_av_visit_id"), SplitKeys(orders, rows_per_task) if orders is not None else None
    if split is None or not split.any:
        j = (v.join(f, own == F.col("_f_visit_id"), "left")
             .join(s, own == F.col("_s_visit_id"), "left"))
    else:
        v = split.copied(v, "_av_visit_id", "_bucket", "_split")
        f = split.copied(f, "_f_visit_id", "_f_bucket")
        s = split.dealt(s.where("_s_visit_id IS NOT NULL"), "_s_visit_id", "_s_bucket")
        bucket = F.col("_bucket")
        j = (v.join(f, (own == F.col("_f_visit_id")) & (bucket == F.col("_f_bucket")), "left")
             .join(s, (own == F.col("_s_visit_id")) & (bucket == F.col("_s_bucket")), "left"))
        # a split visit has sales: its copies that met none in their bucket go
        j = j.where(~F.col("_split") | F.col("_s_visit_id").isNotNull()).drop(
            "_bucket", "_f_bucket", "_s_bucket", "_split")
    return j.withColumns({"date_est": F.coalesce("datetime_est", "report_datetime"),
                          "visit_id": F.coalesce("_s_visit_id", "_f_visit_id")})


def project_mart(df: DataFrame, cfg: VisitMartConfig) -> DataFrame:
    """P37 + P40: constants and the fixed column order (P38 renames happen on
    the master side in :func:`attach_to_visits`)."""
    constants = {"sub_store_id": F.lit(cfg.store_id), "store_id": F.lit(cfg.store_id),
                 "site_url": F.lit("")}
    cols = []
    missing = []
    for c in MART_COLUMNS:
        if c in constants:
            cols.append(constants[c].alias(c))
        elif c in df.columns:
            cols.append(F.col(c))
        elif cfg.missing_columns == "null":
            cols.append(F.lit(None).cast(MART_TYPES.get(c, "string")).alias(c))
        else:
            missing.append(c)
    if missing:
        raise ValueError(f"visit master lacks mart columns: {missing}")
    return df.select(*cols)


def build_visit_mart(t: Tables, cfg: VisitMartConfig) -> DataFrame:
    """The full visit mart for the trailing ``cfg.days`` days up to ``cfg.as_of``."""
    f_data = with_url_params(end_data(t, cfg), cfg.product_id_null_on_miss)
    sales = visit_sales(t["visit_orders"], t["profit_loss"], cfg.as_of, cfg.days,
                        allow_missing=cfg.missing_columns == "null")
    visits_window = t["visits"].where(
        trailing_days("first_action_datetime_est", cfg.as_of, cfg.days))
    orders = (t["visit_orders"].where(trailing_days("datetime_est", cfg.as_of, cfg.days))
              .select("visit_id"))
    return (attach_to_visits(visits_window, f_data, sales, orders, cfg.sales_rows_per_task)
            .transform(with_channel, cfg)
            .transform(project_mart, cfg))
