"""One query per operator and per step of the run."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txclean.catalogue import derived
from txclean.functions import parse_mixed_timestamp
from txclean.operators import (
    AuditLedger,
    KeyIndex,
    apply_constraints,
    check_in_set,
    check_length,
    check_not_null,
    check_unique,
    classify_by_table,
    classify_keywords,
    correct_from_dictionary,
    correction_map,
    count_factors,
    date_order,
    deduplicate,
    dictionary_matches,
    duplicates,
    enrich,
    expand_factors,
    fill_from,
    fix_precision,
    functional_dependency,
    inclusion_dependencies,
    inject_copies,
    label_profile,
    number_entries,
    parse_by_evidence,
    relabel_when,
    rule_use,
    rules_table,
    sample_rows,
    standardise_text,
    summarise_audit,
    unmatched,
)
from txclean.plans import presets
from txclean.plans.pipeline import CleaningResult, bank_transactions, clean, dictionary_from
from txclean.plans.rerun import Rerun, rerun
from txclean.shared import scratch as _scratch
from txclean.shared import shared_table
from txclean.sources import conform, read_transactions, write_relations

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _run(spark: SparkSession, sf_dir: str) -> CleaningResult:
    return clean(derived.raw_transactions(spark, sf_dir), derived.config(spark))


def _trimmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standardise_text(
        derived.raw_transactions(spark, sf_dir),
        trim=["merchant_name", "category"],
        titlecase=["merchant_name"],
    )


# Sources


@query
def raw_transactions(spark, sf_dir):
    return derived.raw_transactions(spark, sf_dir)


@query
def conform_columns(spark, sf_dir):
    return conform(
        _table(spark, sf_dir, "orders"),
        {
            "o_orderkey": ("transaction_number", "int"),
            "o_orderdate": ("booking_datetime", "timestamp_ntz"),
            "o_totalprice": ("instructed_amount", "decimal(12,2)"),
            "o_orderstatus": ("status", "string"),
        },
    )


@query
def csv_ingest(spark, sf_dir):
    """The raw rows written as CSV and read with types and declared lengths."""
    raw = derived.raw_transactions(spark, sf_dir)
    path = _scratch(spark, "csv")
    (
        raw.write.option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return read_transactions(
        spark, path, raw.schema, lengths={"account_id": 4, "currency": 3, "merchant_name": 50}
    )


@query
def relations_written(spark, sf_dir):
    """Accounts and merchants as relations of their own, read back and joined."""
    raw = derived.raw_transactions(spark, sf_dir)
    path = _scratch(spark, "relations")
    write_relations(
        {
            "accounts": raw.groupBy("account_id").agg(F.count(F.lit(1)).alias("rows")),
            "merchants": raw.groupBy("account_id", "merchant_name").agg(
                F.count(F.lit(1)).alias("merchant_rows")
            ),
        },
        path,
    )
    return enrich(
        spark.read.parquet(f"{path}/merchants"),
        spark.read.parquet(f"{path}/accounts"),
        "account_id",
    )


# Text, precision, categories


@query
def trim_initcap_merchant(spark, sf_dir):
    return _trimmed(spark, sf_dir).select("transaction_id", "merchant_name", "category")


@query
def initcap_documents(spark, sf_dir):
    return standardise_text(
        _table(spark, sf_dir, "documents").select("doc_id", "text"), titlecase=["text"]
    ).select("doc_id", F.md5("text").alias("title_md5"))


@query
def fix_precision_lineitem(spark, sf_dir):
    return fix_precision(
        _table(spark, sf_dir, "lineitem").select(
            "l_orderkey", "l_linenumber", "l_extendedprice", "l_discount"
        ),
        {"l_extendedprice": "decimal(12,2)", "l_discount": "decimal(12,1)"},
    )


@query
def classify_category(spark, sf_dir):
    return (
        classify_keywords(
            _trimmed(spark, sf_dir), "category", presets.CATEGORY_RULES, out="label"
        )
        .groupBy("category", "label")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


@query
def classify_category_by_table(spark, sf_dir):
    """The same with the keywords as rows of a table."""
    rules = rules_table(spark, presets.CATEGORY_RULES)
    return (
        classify_by_table(_trimmed(spark, sf_dir), "category", rules, out="label")
        .groupBy("category", "label")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


@query
def category_rules_in_use(spark, sf_dir):
    """How many rows each keyword is found in, and how many it labels."""
    return rule_use(
        _trimmed(spark, sf_dir), "category", rules_table(spark, presets.CATEGORY_RULES)
    )


# Merchant correction


@query
def merchant_fuzzy_blocked(spark, sf_dir):
    return dictionary_matches(
        _trimmed(spark, sf_dir), "merchant_name", derived.config(spark).dictionary
    )


@query
def merchant_fuzzy_two_edits(spark, sf_dir):
    """All pairs of a distinct name and an entry within two edits."""
    config = derived.config(spark)
    return dictionary_matches(
        _trimmed(spark, sf_dir), "merchant_name", config.dictionary, distance=2
    ).drop("clean_name")


@query
def merchant_fuzzy_match(spark, sf_dir):
    return correction_map(
        _trimmed(spark, sf_dir), "merchant_name", derived.config(spark).dictionary
    )


@query
def merchant_corrected(spark, sf_dir):
    return correct_from_dictionary(
        _trimmed(spark, sf_dir), "merchant_name", derived.config(spark).dictionary
    ).select("transaction_id", "merchant_name")


@query
def merchant_known_spellings(spark, sf_dir):
    return (
        correct_from_dictionary(
            _trimmed(spark, sf_dir),
            "merchant_name",
            dictionary_from(spark, presets.MERCHANT_SPELLINGS),
        )
        .groupBy("merchant_name")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


# Duplicates


@query
def row_numbers(spark, sf_dir):
    return _run(spark, sf_dir).numbered()


@query
def duplicates_listed(spark, sf_dir):
    return _run(spark, sf_dir).duplicates()


@query
def deduplicated(spark, sf_dir):
    return _run(spark, sf_dir).deduped


@query
def documents_dedup(spark, sf_dir):
    return deduplicate(_table(spark, sf_dir, "documents"), ["text"], ["doc_id"]).select(
        "doc_id", "lang", "source", "n_chars"
    )


@query
def documents_copies(spark, sf_dir):
    return duplicates(
        _table(spark, sf_dir, "documents").select("text", "doc_id"), ["text"], ["doc_id"]
    ).select("doc_id", "row_num")


@query
def stage_row_counts(spark, sf_dir):
    return _run(spark, sf_dir).row_counts()


# Repair


@query
def null_fill_amount(spark, sf_dir):
    run = _run(spark, sf_dir)
    return fill_from(run.deduped, "transaction_amount", "instructed_amount").select(
        "transaction_id", "instructed_amount", "transaction_amount"
    )


@query
def income_reversal(spark, sf_dir):
    run = _run(spark, sf_dir)
    return (
        relabel_when(
            run.deduped,
            "category",
            (F.col("instructed_amount") < 0) & (F.col("category") == presets.INCOME),
            presets.INCOME_REVERSAL,
        )
        .groupBy("category")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


@query
def cleaned_data(spark, sf_dir):
    return _run(spark, sf_dir).final


# Constraints


def _violations(name: str) -> Query:
    def violations(spark, sf_dir):
        run = _run(spark, sf_dir)
        rule = next(c for c in run.config.constraints if c.name == name)
        return rule.violations(run.final)

    return violations


@query
def check_primary_key(spark, sf_dir):
    return _run(spark, sf_dir).repeated_ids()


_QUERIES["check_not_null_key"] = _violations("not_null(transaction_id)")
_QUERIES["check_booking_date"] = _violations("valid_booking_date")
_QUERIES["check_value_date"] = _violations("valid_value_date")
_QUERIES["check_zero_amount"] = _violations("nonzero_amount")
_QUERIES["check_exchange_rate"] = _violations("exchange_rate_logic")


@query
def check_length_merchant(spark, sf_dir):
    return (
        check_length("merchant_name", 12)
        .violations(_run(spark, sf_dir).staging)
        .select("transaction_id", "merchant_name")
    )


@query
def check_currency_codes(spark, sf_dir):
    return (
        check_in_set("currency", ["GBP", "EUR"])
        .violations(_run(spark, sf_dir).final)
        .select("transaction_id", "currency")
    )


@query
def constraint_report(spark, sf_dir):
    return _run(spark, sf_dir).violation_counts()


def _joined_rules(df: DataFrame) -> DataFrame:
    return df.select("*", F.array_join("failed_rules", ";").alias("failed")).drop(
        "failed_rules"
    )


@query
def constraints_quarantine(spark, sf_dir):
    return _joined_rules(_run(spark, sf_dir).enforce("quarantine").quarantined)


@query
def constraints_valid(spark, sf_dir):
    return _run(spark, sf_dir).enforce("drop").valid


@query
def constraints_flag(spark, sf_dir):
    return _joined_rules(_run(spark, sf_dir).enforce("flag").valid).select(
        "transaction_id", "merchant_name", "failed"
    )


@query
def constraints_later_load_indexed(spark, sf_dir):
    """The same by an index of the earlier rows' ids, kept in ranges."""
    run = _run(spark, sf_dir)
    late = F.col("booking_datetime") >= F.lit("2000-01-01").cast("timestamp_ntz")
    ids = KeyIndex(spark, _scratch(spark, "ids"), ["transaction_id"], rows_per_range=100_000)
    ids.merge(run.final.where(~late), "earlier")
    return _joined_rules(
        apply_constraints(
            run.final.where(late), run.config.constraints, "quarantine", existing=ids
        ).quarantined
    )


@query
def constraints_later_load(spark, sf_dir):
    """Rows booked from 2000 on, loaded after the others."""
    run = _run(spark, sf_dir)
    late = F.col("booking_datetime") >= F.lit("2000-01-01").cast("timestamp_ntz")
    return _joined_rules(
        apply_constraints(
            run.final.where(late),
            run.config.constraints,
            "quarantine",
            existing=run.final.where(~late),
        ).quarantined
    )


@query
def lineitem_key_violations(spark, sf_dir):
    return check_unique(["l_orderkey", "l_linenumber"]).violations(
        _table(spark, sf_dir, "lineitem")
    )


@query
def merchant_null_violations(spark, sf_dir):
    return (
        check_not_null(["merchant_name"])
        .violations(_run(spark, sf_dir).final)
        .select("transaction_id", "merchant_name")
    )


# Audit


@query
def audit_merchant(spark, sf_dir):
    return _run(spark, sf_dir).audit_merchant()


@query
def audit_category(spark, sf_dir):
    return _run(spark, sf_dir).audit_category()


@query
def audit_null_fix(spark, sf_dir):
    return _run(spark, sf_dir).audit_fills()


@query
def audit_duplicates(spark, sf_dir):
    return _run(spark, sf_dir).audit_duplicates()


@query
def audit_exchange_rate(spark, sf_dir):
    return _run(spark, sf_dir).audit_rates()


@query
def audit_future_dates(spark, sf_dir):
    return _run(spark, sf_dir).audit_dates()


@query
def audit_log(spark, sf_dir):
    return _run(spark, sf_dir).audit_log()


@query
def audit_log_ids(spark, sf_dir):
    """Number of different entries, of their ids, and the first and last id."""
    log = number_entries(_run(spark, sf_dir).audit_log())
    return log.agg(
        F.count(F.lit(1)).alias("rows"),
        F.countDistinct("log_id").alias("ids"),
        F.min("log_id").alias("first_id"),
        F.max(F.col("log_id") + F.col("entries") - 1).cast("decimal(38,0)").alias("last_id"),
    )


@query
def audit_log_appended(spark, sf_dir):
    """The log added in three batches, the second one twice, as one log."""
    log = shared_table(_run(spark, sf_dir).audit_log(), "log")
    ledger = AuditLedger(spark, _scratch(spark, "ledger"))
    batches = {
        "names": [presets.MERCHANT_NOTE, presets.CATEGORY_NOTE],
        "rows": [presets.FILL_NOTE, presets.DUPLICATE_NOTE],
        "rules": [presets.RATE_NOTE, presets.DATE_NOTE],
    }
    for name in (*batches, "rows"):
        ledger.append(log.where(F.col("change_stage").isin([n.stage for n in batches[name]])), name)
    return ledger.read().drop("changed_at")


@query
def audit_factors(spark, sf_dir):
    return _run(spark, sf_dir).audit_factors()


@query
def full_audit_factors(spark, sf_dir):
    """Over the table in which one id is shared by many rows."""
    return _full_run(spark, sf_dir).audit_factors()


@query
def audit_factors_expanded(spark, sf_dir):
    return expand_factors(_full_run(spark, sf_dir).audit_factors())


@query
def audit_factors_counted(spark, sf_dir):
    return count_factors(_full_run(spark, sf_dir).audit_factors())


@query
def audit_lineage(spark, sf_dir):
    return _run(spark, sf_dir).audit_lineage()


@query
def audit_summary_of_log(spark, sf_dir):
    return summarise_audit(_run(spark, sf_dir).audit_log())


@query
def audit_summary_of_lineage(spark, sf_dir):
    return summarise_audit(_run(spark, sf_dir).audit_lineage())


@query
def cleaning_summary(spark, sf_dir):
    return _run(spark, sf_dir).summary()


@query
def cleaning_report(spark, sf_dir):
    return _run(spark, sf_dir).report()


# A second run, after some rows have changed, gone or been repeated


def _rerun(spark: SparkSession, sf_dir: str) -> Rerun:
    before = _run(spark, sf_dir)
    number = F.substring("transaction_id", 2, 9).cast("long")
    changed = before.raw.where(number % 211 != 0).withColumn(
        "merchant_name", F.when(number % 101 == 0, F.lit("Tseco")).otherwise(F.col("merchant_name"))
    )
    raw = changed.unionByName(before.raw.where(number % 307 == 0))
    return rerun(before.raw, before.final, before.summary(), raw, before.config)


@query
def rerun_after_change(spark, sf_dir):
    return _rerun(spark, sf_dir).final


@query
def rerun_summary(spark, sf_dir):
    return _rerun(spark, sf_dir).summary


# The 22-column transaction table, read back through its views


def _full_run(spark: SparkSession, sf_dir: str) -> CleaningResult:
    return clean(
        derived.full_transactions(spark, sf_dir),
        bank_transactions(dictionary_from(spark, presets.MERCHANT_SPELLINGS), derived.CUTOFF),
    )


@query
def cleaned_transactions_full(spark, sf_dir):
    _full_run(spark, sf_dir).publish("cleaned_transactions")
    return spark.table("cleaned_transactions")


@query
def report_view(spark, sf_dir):
    _full_run(spark, sf_dir).publish("cleaned_transactions", "cleaning_report")
    return spark.table("cleaning_report")


@query
def full_audit_log(spark, sf_dir):
    return _full_run(spark, sf_dir).audit_log()


@query
def full_audit_lineage(spark, sf_dir):
    return _full_run(spark, sf_dir).audit_lineage()


@query
def full_duplicates_listed(spark, sf_dir):
    return (
        _full_run(spark, sf_dir)
        .duplicates()
        .select("TransactionId", "merchant_name", "category", "row_num")
    )


@query
def full_not_null_key(spark, sf_dir):
    return (
        check_not_null(["TransactionId"])
        .violations(_full_run(spark, sf_dir).final)
        .select("BookingDateTime", "merchant_name")
    )


# Dates, labels, samples, look-ups


def _mixed_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    layouts = [
        "yyyy-MM-dd HH:mm:ss",
        "dd/MM/yyyy HH:mm",
        "yyyy/MM/dd HH:mm:ss",
        "dd-MM-yyyy HH:mm:ss",
        "MMM dd, yyyy hh:mm a",
    ]
    kind = F.col("event_id") % 7
    text = F.when(kind == 5, F.lit("junk"))
    for number, layout in enumerate(layouts):
        text = text.when(kind == number, F.date_format("ts", layout))
    return _table(spark, sf_dir, "events").select("event_id", text.alias("raw_date"))


@query
def parse_mixed_dates(spark, sf_dir):
    return _mixed_dates(spark, sf_dir).withColumn(
        "parsed", parse_mixed_timestamp(F.col("raw_date"))
    )


def _dates_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three sources: one writes the day first, one the month, and of the third's
    numeric dates none has a day beyond the twelfth."""
    kind, day = F.col("event_id") % 3, F.dayofmonth("ts")
    text = (
        F.when(kind == 0, F.date_format("ts", "dd/MM/yyyy HH:mm"))
        .when(kind == 1, F.date_format("ts", "MM/dd/yyyy HH:mm"))
        .when(day <= 12, F.date_format("ts", "dd/MM/yyyy HH:mm"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    )
    return _table(spark, sf_dir, "events").select(
        "event_id", F.concat(F.lit("source "), kind.cast("string")).alias("source"), text.alias("raw_date")
    )


@query
def date_order_of_sources(spark, sf_dir):
    return date_order(_dates_by_source(spark, sf_dir), "source", "raw_date", "1990-01-01", "2040-01-01")


@query
def dates_by_evidence(spark, sf_dir):
    return parse_by_evidence(
        _dates_by_source(spark, sf_dir), "source", "raw_date", "1990-01-01", "2040-01-01"
    )


def _label_profile(spark, sf_dir):
    raw = derived.raw_transactions(spark, sf_dir)
    labelled = raw.select(
        "transaction_id",
        F.concat_ws(
            ";",
            F.when(F.col("transaction_amount").isNull(), "missing_amount"),
            F.when(F.col("instructed_amount") == 0, "zero_amount"),
            F.when(F.col("currency").isNull(), "missing_currency"),
        ).alias("errors"),
    )
    return label_profile(labelled, "errors")


_QUERIES["label_profile"] = _label_profile


@query
def sample_orders(spark, sf_dir):
    return sample_rows(_table(spark, sf_dir, "orders"), 0.05, by=["o_orderkey"]).select(
        "o_orderkey", "o_custkey", "o_orderstatus"
    )


@query
def inject_order_copies(spark, sf_dir):
    return (
        inject_copies(_table(spark, sf_dir, "orders"), 0.05, by=["o_orderkey"])
        .groupBy("o_orderkey")
        .agg(F.count(F.lit(1)).alias("copies"))
    )


@query
def enrich_nation(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("c_custkey")
    )
    customers = _table(spark, sf_dir, "customer").select(
        "c_custkey", "c_mktsegment", F.col("c_nationkey").alias("n_nationkey")
    )
    nations = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return enrich(enrich(orders, customers, "c_custkey"), nations, "n_nationkey").select(
        "o_orderkey", "c_mktsegment", "n_name"
    )


@query
def mcc_dependency(spark, sf_dir):
    """Category codes with more than one category."""
    found = functional_dependency(
        _full_run(spark, sf_dir).final, ["MerchantCategoryCode"], ["category"]
    )
    return found.select(
        "MerchantCategoryCode", "values", "rows",
        F.col("least.category").alias("least"), F.col("greatest.category").alias("greatest"),
    )


@query
def inclusions_found(spark, sf_dir):
    """Which key columns hold all the values of which others."""
    columns = {
        col: (_table(spark, sf_dir, table), col)
        for table, cols in {
            "region": ["r_regionkey"],
            "nation": ["n_nationkey", "n_regionkey"],
            "customer": ["c_custkey", "c_nationkey"],
            "supplier": ["s_suppkey", "s_nationkey"],
            "part": ["p_partkey"],
            "orders": ["o_orderkey", "o_custkey"],
            "lineitem": ["l_orderkey", "l_partkey", "l_suppkey"],
        }.items()
        for col in cols
    }
    return inclusion_dependencies(columns)


@query
def enrich_first_of_repeated(spark, sf_dir):
    """Nations with the least customer of each, from a reference with repeated keys."""
    nations = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    customers = _table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("n_nationkey"), "c_custkey", "c_mktsegment"
    )
    return enrich(nations, customers, "n_nationkey", repeated="first")


@query
def unmatched_lines(spark, sf_dir):
    """Line items whose (part, supplier) pair no line with a discount has."""
    lines = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_discount"
    )
    return unmatched(
        lines.drop("l_discount"),
        lines.where("l_discount > 0"),
        ["l_partkey", "l_suppkey"],
    )
