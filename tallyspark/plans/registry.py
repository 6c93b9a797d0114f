"""Every runnable query by name.

``QUERIES[name](spark, folder)`` reads the order tables of ``folder`` through
``sources.orders_feed``; ``run_query(name, Tables(transactions, profiles))`` runs the
same query over any tables of the two schemas.  Results are shown with plain types
(decimals as DOUBLE, dates and timestamps as ISO text), so that any client compares
them alike.
"""

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.functions import derive
from tallyspark.functions.measures import rows
from tallyspark.operators import (
    clean, filters, joins, quality, quantiles, star, timeintel, users, usersets,
)
from tallyspark.operators.aggregate import Report, run
from tallyspark.plans import dashboard_reports, eda_reports, semantic, sql_reports, workbook_reports
from tallyspark.sources import orders_feed, readers, writers

AS_OF = "2001-01-01 00:00:00"
SELECTION = {
    "date_from": "1996-01-01", "date_to": "1999-12-31",
    "methods": ["UPI", "Credit Card", "Net Banking"], "statuses": [],
    "categories": ["Shopping", "Travel", "Transfers", "Groceries"],
}


class Tables:
    """Raw transactions and profiles, and the tables every query starts from."""

    def __init__(self, raw: DataFrame, profiles: DataFrame):
        self.raw, self.profiles, self.spark = raw, profiles, raw.sparkSession

    @property
    def dirty(self) -> DataFrame:
        return self.raw

    @property
    def cleaned(self) -> DataFrame:
        return clean.clean(self.raw)

    @property
    def stripped(self) -> DataFrame:
        return clean.strip_text(self.raw)

    @property
    def featured(self) -> DataFrame:
        return derive.add_row_features(self.stripped)

    @property
    def behaviour(self) -> DataFrame:
        return users.user_behaviour(self.stripped)

    @property
    def enriched(self) -> DataFrame:
        stored = writers.stored(users.user_table(self.stripped, self.profiles, self.behaviour), "users")
        return users.enrich(self.raw, self.profiles, users=stored)

    @property
    def star(self) -> star.Star:
        return star.build_star(self.featured, self.profiles)

    def folder_for(self, purpose: str) -> str:
        return writers.shared_folder(self.spark, purpose)


class FeedTables(Tables):
    """The same tables derived from order tables; ``city`` looks the city column up."""

    def __init__(self, spark: SparkSession, folder: str, city=False):
        super().__init__(orders_feed.transactions(spark, folder, city),
                         orders_feed.user_profiles(spark, folder, city))
        self.folder = folder

    @property
    def dirty(self) -> DataFrame:
        return orders_feed.with_faults(self.raw)

    @property
    def behaviour(self) -> DataFrame:
        # Behaviour does not need the looked-up city.
        return users.user_behaviour(
            clean.strip_text(orders_feed.transactions(self.spark, self.folder)))


def plain(df: DataFrame) -> DataFrame:
    """Decimals, dates and timestamps in the form results are compared in."""
    casts = {}
    for name, kind in df.dtypes:
        quoted = F.col(f"`{name}`")
        if kind.startswith("decimal"):
            casts[name] = quoted.cast("double")
        elif kind == "date":
            casts[name] = quoted.cast("string")
        elif kind.startswith("timestamp"):
            casts[name] = F.date_format(quoted, "yyyy-MM-dd HH:mm:ss")
    return df.withColumns(casts) if casts else df


BUILDERS = {}
QUERIES = {}


def query(name, city=False):
    def add(build):
        BUILDERS[name] = build
        QUERIES[name] = lambda spark, folder: plain(build(FeedTables(spark, folder, city)))
        return build
    return add


def run_query(name: str, tables: Tables) -> DataFrame:
    """A registered query over any transactions and profiles."""
    return plain(BUILDERS[name](tables))


def _all(prefix, names, build, city=()):
    for name, label in names.items():
        query(f"{prefix}_{name}_{label}", name in city)(lambda i, n=name: build(i, n))


# ---------------------------------------------------------------------------
# Sources and sinks: write what was derived, read it back, return the rows read
# ---------------------------------------------------------------------------
@query("src_1_users_csv", city=True)
def _(i):
    path = i.folder_for("users")
    writers.write_csv(i.profiles, path)
    return readers.read_user_profiles(i.spark, path)


@query("src_2_transactions_csv", city=True)
def _(i):
    path = i.folder_for("transactions")
    writers.write_csv(i.cleaned, path)
    return readers.read_transactions(i.spark, path)


@query("src_3_raw_pair_methods_by_tier", city=True)
def _(i):
    folder = i.folder_for("pair")
    writers.write_csv(i.raw, f"{folder}/t")
    writers.write_csv(i.profiles, f"{folder}/u")
    t, u = readers.read_raw_pair(i.spark, f"{folder}/t", f"{folder}/u")
    return run(Report(("customer_tier", "payment_method"), (rows("n"),)),
               clean.strip_text(t), [eda_reports.users_of(u)])


@query("src_4_enriched_csv_reread", city=True)
def _(i):
    path = i.folder_for("enriched-csv")
    writers.write_enriched(i.enriched, path, "csv")
    e = readers.read_enriched_csv(i.spark, path)
    return e.select("transaction_id", "date", "failure_reason", "fraud_reason", "net_amount",
                    "savings_pct", "is_flagged", "user_total_spend", "user_failure_rate_pct",
                    readers.year_month_label().alias("year_month_label"))


@query("src_5_star_csv_load", city=True)
def _(i):
    folder = i.folder_for("star-csv")
    writers.write_star(i.star, folder, "csv")
    return semantic.visual("31", readers.load_star(i.spark, folder))


@query("snk_1_enriched_parquet", city=True)
def _(i):
    path = i.folder_for("enriched")
    writers.write_enriched(i.enriched, path)
    return readers.read_enriched(i.spark, path).drop("txn_month")


@query("snk_2_star_parquet", city=True)
def _(i):
    folder = i.folder_for("star")
    writers.write_star(i.star, folder)
    tables = readers.load_star(i.spark, folder, "parquet")
    counts = [t.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(name).alias("table_name"), "row_count") for name, t in tables.items()]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


@query("snk_3_findings_json")
def _(i):
    path = i.folder_for("findings")
    found = eda_reports.findings(i.stripped, i.profiles)
    writers.write_findings(found, path)
    return i.spark.read.schema(found.schema).json(path)


@query("snk_4_raw_export", city=True)
def _(i):
    path = i.folder_for("raw-export")
    writers.write_raw_export(i.raw, path)
    shown = writers.read_raw_export(i.spark, path, writers.raw_export(i.raw).schema)
    return shown.withColumn("DateTime", F.date_format("DateTime", "yyyy-MM-dd HH:mm:ss"))


# ---------------------------------------------------------------------------
# Typing and cleaning
# ---------------------------------------------------------------------------
@query("cln_1_3_typing")
def _(i):
    text = i.raw.select(*[F.col(c).cast("string").alias(c) for c in i.raw.columns])
    spoiled = text.withColumn(
        "amount", F.when(F.col("failure_reason") == "Server Timeout", F.lit("n/a"))
        .otherwise(F.col("amount"))
    ).withColumn("is_flagged", F.initcap("is_flagged"))
    return clean.coerce_types(spoiled).select(
        "transaction_id", "transaction_datetime", *clean.NUMERIC, "is_flagged", "is_refunded",
        "is_weekend",
    )


@query("cln_4_reasons_filled")
def _(i):
    return clean.fill_reasons(i.raw).select("transaction_id", *clean.REASONS)


@query("cln_5_strip_white_space", city=True)
def _(i):
    tabbed = i.raw.withColumn("merchant", F.concat(F.lit("\t"), "merchant", F.lit(" \n")))
    return clean.strip_text(tabbed).select("transaction_id", "category", "merchant", "status",
                                           "city")


@query("cln_6_missing_reason_unknown")
def _(i):
    return i.cleaned.filter("failure_reason = 'Unknown'").select(
        "transaction_id", "status", "failure_reason")


@query("cln_7_success_reason_cleared")
def _(i):
    return i.cleaned.filter("status = 'Success'").select("transaction_id", "failure_reason")


@query("cln_8_fraud_reason_cleared")
def _(i):
    return i.cleaned.select("transaction_id", "is_flagged", "fraud_reason")


@query("cln_9_refund_withdrawn")
def _(i):
    return i.cleaned.filter("status != 'Success'").select(
        "transaction_id", "is_refunded", "refund_amount")


@query("cln_10_refund_capped")
def _(i):
    return i.cleaned.filter("is_refunded").select("transaction_id", "amount", "refund_amount")


@query("cln_11_trim_transactions", city=True)
def _(i):
    return i.cleaned.select("transaction_id", *clean.SQL_TRIM)


@query("cln_12_trim_profiles", city=True)
def _(i):
    padded = i.profiles.withColumns({
        c: F.concat(F.lit(" "), c, F.lit("  ")) for c in clean.PROFILE_TRIM
    })
    return clean.clean_profiles(padded)


@query("cln_all_cleaned_rows", city=True)
def _(i):
    return i.cleaned


# ---------------------------------------------------------------------------
# Derived columns
# ---------------------------------------------------------------------------
def _columns(name, base="cleaned", city=False, **built):
    query(name, city)(lambda i: getattr(i, base).select(
        "transaction_id", *[make().alias(alias) for alias, make in built.items()]
    ))


_HOUR = "hour(transaction_datetime)"

query("drv_1_date_parts")(lambda i: derive.add_generated_columns(i.cleaned).select(
    "transaction_id", "txn_date", "txn_hour", "txn_day_of_week", "txn_month", "txn_quarter"))
_columns("drv_2_amount_bucket", amount_bucket=derive.amount_bucket)
_columns("drv_2w_amount_bucket_workbook",
         amount_bucket=lambda: derive.amount_bucket(rule="workbook"))
_columns("drv_3_time_slots", **{
    f"slot_{rule}": (lambda r=rule: derive.time_slot(F.expr(_HOUR), r))
    for rule in derive.TIME_SLOTS
})
_columns("drv_4_net_amount", base="dirty", net_amount=derive.net_amount)
_columns("drv_5_total_savings", total_savings=derive.total_savings)
_columns("drv_6_festival_season", is_festival_season=derive.is_festival_season)
_columns("drv_7_processing_speed", processing_speed=derive.processing_speed)
query("drv_8_9_calendar")(lambda i: i.featured.select(
    "transaction_id", "date", "year", "month", "month_name", "day", "day_of_week", "day_name",
    "hour", "week_number", "quarter", "quarter_label"))
query("drv_10_month_edges")(lambda i: i.featured.select(
    "transaction_id", "is_month_end", "is_month_start"))
_columns("drv_11_savings_pct", savings_pct=derive.savings_pct)
_columns("drv_12_season_type", season_type=derive.season_type)
_columns("drv_13_savings_tier", savings_tier=derive.savings_tier)
query("drv_14_user_segment")(lambda i: users.user_activity(i.cleaned).select(
    "user_id", "txn_count", derive.user_segment().alias("user_segment")))
query("drv_15_user_spending_tier")(lambda i: users.user_behaviour(i.stripped).select(
    "user_id", "user_total_spend", "user_spending_tier"))
_columns("drv_16_day_type", day_type=derive.day_type)
_columns("drv_17_date_key", date_key=lambda: derive.date_key("transaction_datetime"),
         month_year=lambda: F.date_format("transaction_datetime", "MMM yyyy"))
query("drv_18_status_flags")(lambda i: i.featured.select(
    "transaction_id", *[c.alias(n) for n, c in derive.status_flags().items()]))
_columns("drv_19_year_month_label", year_month_label=readers.year_month_label)
query("drv_20_refund_type")(lambda i: i.raw.filter("is_refunded").select(
    "transaction_id", derive.refund_type("tolerant").alias("refund_type"),
    derive.is_full_refund("exact").alias("is_exact_full")))
_columns("drv_21_flag_label", flag_label=derive.flag_label)
_columns("drv_22_clipped_amount", clipped_amount=derive.clipped_amount)


@query("drv_23_status_bands")
def _(i):
    rates = eda_reports.report("6b", i.stripped)
    return rates.withColumns({
        rule: derive.status_band(F.lit(100.0) - F.col("failure_rate")
                                 if "success" in rule else F.col("failure_rate"), rule)
        for rule in derive.STATUS_BANDS
    })


@query("drv_24_unit_scaling")
def _(i):
    return workbook_reports.report("9", i.raw).select(
        "payment_method",
        *[derive.in_units("lost_revenue", u).alias(f"lost_{u}") for u in derive.UNITS],
        *[derive.unit_text("lost_revenue", u, "₹").alias(f"text_{u}") for u in derive.UNITS],
    )


query("drv_25_home_city", city=True)(lambda i: joins.profile_columns(i.profiles))
query("drv_26_screening_rules")(lambda i: derive.add_screening(i.raw).select(
    "transaction_id", "rule_flag", "rule_reason"))

# ---------------------------------------------------------------------------
# Filters
# ---------------------------------------------------------------------------
_FILTERS = {
    "flt_1_equality": "status = 'Failed' OR (is_flagged AND is_refunded)",
    "flt_2_in_list": "device_type IN ('Android', 'iOS')",
    "flt_3_between_hours": "hour(transaction_datetime) BETWEEN 17 AND 21",
    "flt_4_null_or_empty": "failure_reason IS NULL OR failure_reason = ''",
    "flt_5_column_to_column": "refund_amount < amount AND refund_amount > 0",
    "flt_6_not_equal": "status != 'Failed'",
    "flt_8_positive_values": "cashback_earned > 0 OR discount_applied > 0",
}
for _name, _where in _FILTERS.items():
    query(_name)(lambda i, w=_where: i.raw.filter(w).select("transaction_id", "user_id"))
query("flt_7_later_than")(lambda i: i.raw.filter(
    F.col("transaction_datetime") > F.lit(AS_OF).cast("timestamp_ntz")).select("transaction_id"))


def _dates(selection):
    return {k: date.fromisoformat(v) if k.startswith("date") else v
            for k, v in selection.items()}


query("flt_9_slicer")(lambda i: filters.apply_filters(
    i.stripped, **_dates(SELECTION)).select("transaction_id", "payment_method", "category"))
query("flt_9_slicer_inverted_dates")(lambda i: dashboard_reports.report("1", filters.apply_filters(
    i.stripped, **{**_dates(SELECTION), **_dates({"date_from": "1999-12-31",
                                                  "date_to": "1996-01-01"})})))
query("flt_10_preset_all")(lambda i: dashboard_reports.report(
    "1", filters.apply_filters(i.stripped, **filters.preset("All"))))
query("flt_10_presets")(lambda i: filters.preset_counts(i.stripped, {
    "1999": ("1999-01-01", "1999-12-31"), "2000": ("2000-01-01", "2000-12-31"),
    "6M": ("2000-07-01", None), "All": (None, None)}))
query("flt_11_option_lists", city=True)(lambda i: filters.option_lists(i.stripped))
query("flt_11_date_bounds")(lambda i: filters.date_bounds(i.stripped))
query("flt_12_coverage")(lambda i: filters.coverage(i.stripped, **_dates(SELECTION)))
query("flt_13_dimension_slicers")(lambda i: semantic.visual_query(
    i.star, ("payment_method",), ("total_transactions", "total_revenue", "unique_users"),
    filters={"dim_users.customer_tier": ["Premium", "VIP"], "dim_platform.channel": ["Mobile"],
             "dim_users.age_group": ["25-34", "35-44"],
             "dim_payment_method.payment_type": ["Card", "Digital Wallet"],
             "dim_date.date": ("1996-01-01", "1999-12-31")}))
query("flt_14_having")(lambda i: quality.duplicate_ids(i.dirty))

# ---------------------------------------------------------------------------
# Joins
# ---------------------------------------------------------------------------
query("jn_1_inner_profile")(lambda i: joins.with_profiles(i.dirty, i.profiles, "inner").select(
    "transaction_id", "user_id", "age_group", "customer_tier"))
query("jn_2_left_profile")(lambda i: joins.with_profiles(i.dirty, i.profiles, "left").select(
    "transaction_id", "user_id", "age_group", "customer_tier"))
query("jn_3_orphan_rows")(lambda i: joins.orphan_rows(i.dirty, i.profiles).select(
    "transaction_id", "user_id"))
query("jn_4_orphan_ids")(lambda i: quality.orphan_id_count(i.dirty, i.profiles))
query("jn_5_user_features_attached")(lambda i: i.enriched.select(
    "transaction_id", "user_total_txns", "user_total_spend", "user_avg_txn_amount",
    "user_failure_rate_pct", "user_spending_tier"))
query("jn_6_tier_merge_filled")(lambda i: dashboard_reports.report(
    "16", i.stripped.filter("status != 'Success'"), i.profiles))
query("jn_7_star_join")(lambda i: semantic.visual_query(
    i.star, ("dim_date.quarter_label", "dim_payment_method.payment_type",
             "dim_category.category_group", "dim_platform.channel", "dim_users.customer_tier"),
    ("total_transactions", "total_revenue"), limit=None))
query("jn_8_period_self_join")(lambda i: timeintel.day_shift(
    timeintel.daily(i.stripped), 1, "pm"))

# ---------------------------------------------------------------------------
# Data quality
# ---------------------------------------------------------------------------
query("dq_1_row_counts")(lambda i: quality.row_counts(i.raw, i.profiles))
query("dq_2_critical_nulls")(lambda i: quality.critical_nulls(i.raw))
query("dq_3_orphan_transactions")(lambda i: quality.orphan_count(i.dirty, i.profiles))
query("dq_4_duplicate_ids")(lambda i: quality.duplicate_ids(i.dirty))
query("dq_4b_duplicate_rows")(lambda i: quality.duplicate_rows(i.dirty))
query("dq_5_statuses")(lambda i: quality.statuses(i.raw))
_FAULT_QUERIES = {
    "dq_6_invalid_amounts": ("invalid_amounts",),
    "dq_8_missing_reasons": ("missing_reasons",),
    "dq_9_incorrect_reasons": ("incorrect_reasons",),
    "dq_10_negative_promotions": ("negative_cashback", "negative_discount"),
    "dq_11_invalid_refunds": ("invalid_refunds",),
    "dq_12_over_refunds": ("over_refunds",),
    "dq_13_invalid_fraud_reasons": ("invalid_fraud_reasons",),
}
for _name, _faults in _FAULT_QUERIES.items():
    query(_name)(lambda i, f=_faults: quality.fault_counts(i.dirty, *f))
query("dq_7_future_dated")(lambda i: quality.future_dated(i.dirty, AS_OF))
query("dq_14_device_platforms")(lambda i: quality.device_platforms(i.raw))
query("dq_15_weekend_by_day")(lambda i: quality.weekend_by_day(i.raw))
query("dq_16_scorecard_cleaned")(lambda i: quality.scorecard(i.cleaned))
query("dq_16_scorecard_dirty")(lambda i: quality.scorecard(i.dirty))
query("dq_17_null_profile", city=True)(lambda i: quality.null_profile(i.raw))
query("dq_18_check_rules")(lambda i: quality.check_rules(i.dirty, i.profiles))
query("dq_19_key_rules", city=True)(lambda i: quality.key_rules(i.dirty, i.profiles))
query("dq_20_amount_profile")(lambda i: quantiles.numeric_profile(i.raw, "amount"))
query("dq_21_value_counts")(lambda i: quality.value_counts(
    i.raw.withColumn("month", F.month("transaction_datetime")),
    ["status", "payment_method", "category", "month"]))
query("dq_21_user_value_counts")(lambda i: quality.value_counts(
    i.profiles, ["age_group", "customer_tier", "spending_persona"]))
query("dq_22_ranges")(lambda i: quality.ranges(i.raw))
query("dq_23_flag_refund_promotion")(lambda i: quality.promotion_and_flag_profile(i.raw))
query("dq_24_feature_distributions")(lambda i: quality.feature_distributions(
    derive.add_row_features(i.stripped, ["time_bucket", "amount_bucket", "processing_speed"]),
    users.user_behaviour(i.stripped)))
query("dq_25_savings_summary")(lambda i: quality.savings_summary(derive.add_row_features(
    i.stripped, ["total_savings", "savings_pct"])))
query("dq_26_status_distribution")(lambda i: quality.distribution(i.raw, "status"))
query("dq_26_method_distribution")(lambda i: quality.distribution(i.raw, "payment_method"))
query("dq_27_category_distribution")(lambda i: quality.distribution(i.raw, "category", False))
query("dq_28_profile_combinations")(lambda i: quality.profile_combinations(i.profiles))

# ---------------------------------------------------------------------------
# SQL catalogue
# ---------------------------------------------------------------------------
_all("sql", {
    "1a": "overall_success", "1b": "success_by_method", "1c": "success_by_month",
    "1d": "success_by_city", "1e": "success_by_device", "1f": "weekend_weekday",
    "2a": "hourly", "2b": "day_of_week", "2c": "method_hour_heatmap", "2d": "monthly_seasons",
    "2e": "category_quarter", "3a": "failure_reasons", "3b": "method_reason",
    "3c": "worst_hours", "3d": "lost_revenue", "3e": "failure_by_category",
    "3f": "failure_by_platform_device", "4a": "user_segments", "4b": "top_users",
    "4c": "age_method", "4d": "monthly_active_users", "4e": "tier_performance",
    "4f": "persona_spend", "5a": "cashback_by_method", "5b": "discount_by_category",
    "5c": "savings_tiers", "6a": "flag_overview", "6b": "fraud_reasons", "6c": "flags_by_slot",
    "6d": "flags_by_tier", "7a": "refund_summary", "7b": "refunds_by_category",
    "7c": "refund_rate_by_method", "8a": "platforms", "8b": "devices", "8c": "android_ios",
    "v1": "executive_summary", "v2": "kpi_snapshot",
}, lambda i, n: sql_reports.report(n, i.cleaned, i.profiles), city=("1d", "v1"))
query("sql_v3_clean_transactions", city=True)(
    lambda i: sql_reports.clean_view(i.cleaned, i.profiles))

# ---------------------------------------------------------------------------
# User behaviour
# ---------------------------------------------------------------------------
_all("uf", {"1": "total_txns", "2": "total_spend", "3": "avg_txn_amount",
            "4": "failure_rate_pct", "5": "spending_tier"},
     lambda i, n: users.user_behaviour(i.stripped).select("user_id", {
         "1": "user_total_txns", "2": "user_total_spend", "3": "user_avg_txn_amount",
         "4": "user_failure_rate_pct", "5": "user_spending_tier"}[n]))
query("uf_6_enriched_table", city=True)(lambda i: i.enriched)

# ---------------------------------------------------------------------------
# Exploratory aggregates
# ---------------------------------------------------------------------------
_all("ed", {
    "1": "kpis", "2": "monthly_folded", "3": "methods", "4": "day_hour_heatmap",
    "5": "categories", "6a": "top_reasons", "6b": "failure_by_method", "7": "lost_by_method",
    "8": "age_groups", "9": "tiers", "10": "personas", "11": "cities", "12a": "platforms",
    "12b": "devices", "13a": "fraud_reasons", "14a": "cashback", "14b": "discounts",
    "15a": "refunds_by_category", "15b": "refund_types", "16": "weekend",
    "17a": "processing_by_method", "17b": "speed_levels",
}, lambda i, n: eda_reports.report(n, i.stripped, i.profiles), city=("11",))
query("ed_13b_box_by_flag")(lambda i: quantiles.box_stats(
    i.stripped.withColumn("clipped", derive.clipped_amount()), "clipped", "is_flagged"))
query("ed_18_findings")(lambda i: eda_reports.findings(i.stripped, i.profiles))

# ---------------------------------------------------------------------------
# Dashboard
# ---------------------------------------------------------------------------
_all("ap", {
    "1": "overview", "2": "monthly", "3": "methods", "4": "category_revenue", "5": "cities",
    "6": "day_hour_matrix", "7": "time_buckets", "8": "weekend", "9": "method_performance",
    "10": "failure_kpis", "11": "top_reasons", "12": "failed_by_method", "13": "hourly_failures",
    "15": "age_groups", "16": "tiers", "17": "personas", "18": "genders",
    "19": "monthly_active_users", "20": "fraud_kpis", "21": "fraud_reasons",
    "23": "refund_kpis", "24": "refunds_by_category", "25": "refunds_by_method",
    "26": "platforms", "27": "devices", "29": "cashback", "30": "discounts",
}, lambda i, n: dashboard_reports.report(n, i.stripped, i.profiles), city=("5",))
query("ap_2b_festival_periods")(lambda i: dashboard_reports.festival_periods(i.stripped))
query("ap_14_method_reason_crosstab")(lambda i: dashboard_reports.failure_crosstab(
    i.stripped, orders_feed.FEED_REASONS))
query("ap_14_method_reason_counts")(lambda i: dashboard_reports.failure_counts(i.stripped))
query("ap_22_box_with_mean")(lambda i: quantiles.box_stats(
    i.stripped.withColumn("clipped", derive.clipped_amount()), "clipped", "is_flagged",
    with_mean=True))
query("ap_28_android_ios")(lambda i: dashboard_reports.mobile_comparison(i.stripped))

# ---------------------------------------------------------------------------
# Spreadsheet report
# ---------------------------------------------------------------------------
_all("wb", {
    "1": "kpis", "2": "methods", "3": "months", "4": "cities", "5": "hours", "6": "weekdays",
    "7": "time_slots", "8": "failure_reasons", "9": "failed_by_method", "10": "lost_revenue",
    "11": "segments", "12": "monthly_active_users", "13": "top_users",
}, lambda i, n: workbook_reports.report(n, i.raw), city=("4",))

# ---------------------------------------------------------------------------
# Star schema
# ---------------------------------------------------------------------------
_all("st", {"1": "dim_date", "2": "dim_users", "6": "fact_transactions"},
     lambda i, n: i.star[{"1": "dim_date", "2": "dim_users", "6": "fact_transactions"}[n]],
     city=("2", "6"))


def _label_check(name, key, where):
    """A literal dimension with how many transactions use each of its rows."""
    query(f"st_{where}_{name}")(lambda i: i.star[name].join(
        run(Report((key,), (rows("n_txn"),)), i.stripped), key, "left"))


_label_check("dim_payment_method", "payment_method", "3")
_label_check("dim_category", "category", "4")
_label_check("dim_platform", "platform", "5")
query("st_7_relationship_check")(lambda i: star.relationship_check(
    star.build_star(derive.add_row_features(clean.strip_text(i.dirty)), i.profiles)))

# ---------------------------------------------------------------------------
# Semantic layer
# ---------------------------------------------------------------------------
_GROUPS = {
    "m_1_4_volume": ["total_transactions", "successful_transactions", "failed_transactions",
                     "pending_transactions"],
    "m_5_7_rates": ["success_rate_pct", "failure_rate_pct", "pending_rate_pct"],
    "m_8_10_revenue": ["total_revenue", "avg_transaction_amount", "total_net_revenue"],
    "m_11_13_promotions": ["total_cashback", "total_discounts", "total_savings"],
    "m_14_lost_revenue": ["lost_revenue"],
    "m_15_17_users": ["unique_users", "avg_transactions_per_user", "avg_revenue_per_user"],
    "m_18_21_fraud": ["flagged_transactions", "fraud_rate_pct", "avg_flagged_amount",
                      "total_flagged_volume"],
    "m_22_25_refunds": ["total_refunds", "refund_rate_pct", "total_refund_value",
                        "avg_refund_amount"],
    "m_26_27_processing": ["avg_processing_time", "avg_failed_processing_time"],
}
for _name, _measures in _GROUPS.items():
    query(_name)(lambda i, m=_measures: semantic.measure_table(i.star, m, ["category"]))


def _levels(sets, keys, periods):
    """User figures of several periods under each other, from one stored table."""
    out = None
    for period in periods:
        part = sets.figures(period, keys).withColumn("grain", F.lit(period or "all"))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


query("m_15_17_user_sets_by_period")(lambda i: _levels(
    usersets.user_sets(i.stripped, ["payment_method"]), [], ["month", "quarter", "year", None]))
query("m_15_17_user_sets_by_method")(lambda i: _levels(
    usersets.user_sets(i.stripped, ["payment_method", "platform"]), ["payment_method"], ["quarter", "year", None]))
query("m_all_global")(lambda i: semantic.measure_table(i.star, list(semantic.MEASURES)))
query("m_28_29_status_bands")(lambda i: semantic.status_bands(i.star, ["payment_method"]))
query("m_30_period_label")(lambda i: timeintel.period_label(i.stripped))
query("m_31_32_revenue_text")(lambda i: semantic.revenue_texts(i.star, ["payment_method"]))

query("ti_1_4_month_over_month")(lambda i: timeintel.month_shift(
    timeintel.monthly(i.stripped), 1, "pm", "mom_pct"))
query("ti_1_4_month_over_month_by_method")(lambda i: timeintel.month_shift(
    timeintel.monthly(i.stripped, ["payment_method"]), 1, "pm", "mom_pct", ["payment_method"]))
query("ti_5_8_year_over_year")(lambda i: timeintel.month_shift(
    timeintel.monthly(i.stripped), 12, "py", "yoy_pct"))
query("ti_9_12_to_date_by_day")(lambda i: timeintel.to_date_totals(i.stripped).select(
    "date", "revenue_ytd", "transactions_ytd", "revenue_qtd", "revenue_mtd"))
query("ti_9_10_year_to_date_by_month")(lambda i: timeintel.month_to_date_totals(i.stripped))
query("ti_9_14_by_month_and_method")(lambda i: timeintel.month_to_date_totals(
    i.stripped.filter("status = 'Success' AND amount > 200"), ["payment_method"]))
query("ti_13_14_cumulative_by_day")(lambda i: timeintel.to_date_totals(i.stripped).select(
    "date", "cumulative_revenue", "cumulative_transactions"))
query("ti_9_14_by_day_and_platform")(lambda i: timeintel.to_date_totals(
    i.stripped, ["platform"]))

# Period measures under slicers: (dimensions, measures, filters).
PERIOD_VISUALS = {
    "ti_1_14_visual_month_in_range": (
        ("dim_date.month_year",),
        ("total_revenue", "total_transactions", "success_rate_pct", "revenue_pm", "revenue_mom_growth_pct",
         "transactions_pm", "transactions_mom_growth_pct", "revenue_ytd", "cumulative_revenue"),
        {"dim_date.date": ("1998-03-10", "1998-08-20"),
         "dim_payment_method.payment_method": ["UPI", "Credit Card", "Net Banking"]}),
    "ti_5_14_visual_method_in_year": (
        ("payment_method",),
        ("revenue_py", "revenue_yoy_growth_pct", "transactions_py", "transactions_yoy_growth_pct",
         "transactions_ytd", "cumulative_transactions"),
        {"dim_date.year": [1998], "dim_users.customer_tier": ["Premium", "VIP"]}),
    "ti_1_14_visual_quarter_by_tier": (
        ("dim_users.customer_tier", "dim_date.quarter_label"),
        ("total_revenue", "revenue_pm", "revenue_py", "revenue_ytd", "revenue_qtd", "revenue_mtd",
         "cumulative_transactions"),
        {"dim_date.year": [1997], "dim_users.age_group": ["25-34", "35-44"],
         "dim_platform.channel": ["Mobile"]}),
    "ti_1_14_visual_days_over_month_ends": (
        ("dim_date.date",),
        ("total_transactions", "revenue_pm", "transactions_pm", "revenue_py", "revenue_mtd", "revenue_qtd",
         "transactions_ytd", "cumulative_revenue"),
        {"dim_date.date": ("1996-02-25", "1996-04-03"), "dim_category.category_group": ["Lifestyle"]}),
    "ti_5_14_visual_day_name_and_platform": (
        ("dim_date.day_name", "platform"),
        ("total_transactions", "transactions_pm", "transactions_py", "transactions_yoy_growth_pct",
         "transactions_ytd", "revenue_qtd"),
        {"dim_date.year": [1999], "dim_date.month": [2, 5]}),
}
for _name, _visual in PERIOD_VISUALS.items():
    query(_name)(lambda i, v=_visual: semantic.visual_query(i.star, v[0], v[1], filters=v[2]))

for _name, (_dims, _measures) in semantic.VISUALS.items():
    _label = f"{_measures[0]}_by_{'_'.join(d.split('.')[-1] for d in _dims)}" if _dims \
        else f"{_measures[0]}_cards"
    query(f"vz_{_name}_{_label}", city="city" in _dims)(
        lambda i, n=_name: semantic.visual(n, i.star,
                                           where="device_type IN ('Android', 'iOS')"
                                           if n == "36d" else None))
# Matrices with subtotals: (dimensions, measures, margins, filters).
MATRICES = {
    "vz_6_matrix_with_totals": (
        ("dim_date.day_name", "hour"), ("total_transactions", "success_rate_pct", "unique_users", "total_revenue"),
        (("dim_date.day_name",), ("hour",), ()), None),
    "vz_15_matrix_with_totals": (
        ("payment_method", "failure_reason"), ("failed_transactions", "lost_revenue", "avg_failed_amount"),
        (("payment_method",), ("failure_reason",), ()), None),
    "vz_17_matrix_tier_by_channel": (
        ("dim_users.customer_tier", "dim_platform.channel"),
        ("total_transactions", "unique_users", "avg_transactions_per_user", "fraud_rate_pct"),
        (("dim_users.customer_tier",), ("dim_platform.channel",), ()), {"dim_date.year": [1997, 1998]}),
    "vz_21_months_with_total": (
        ("dim_date.month_year",), ("unique_users", "avg_transactions_per_user", "total_transactions"), ((),), None),
}
for _name, _matrix in MATRICES.items():
    query(_name)(lambda i, m=_matrix: semantic.visual_query(i.star, m[0], m[1], filters=m[3], margins=m[2]))
query("vz_36e_amount_by_flag")(lambda i: quantiles.box_stats(i.stripped, "amount", "is_flagged"))
query("vz_37_platform_shares")(lambda i: semantic.platform_shares(i.stripped))
query("vz_37_top_reasons_others")(lambda i: semantic.top_reasons(i.stripped, 3))

# ---------------------------------------------------------------------------
# Sorts and limits that are not part of another report
# ---------------------------------------------------------------------------
query("tk_6_time_ordered_export")(lambda i: writers.ordered_by_time(i.raw).select(
    "transaction_id", "transaction_datetime"))
