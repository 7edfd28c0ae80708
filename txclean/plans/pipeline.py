"""A cleaning run over one transaction table, and the audit of it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txclean.operators import audit, dedup, quality
from txclean.operators.correct import correct_from_dictionary
from txclean.operators.key_index import KeyIndex
from txclean.operators.repair import fill_from, fix_precision
from txclean.operators.rules import Rules, classify_keywords, relabel_when
from txclean.operators.standardise import standardise_text
from txclean.plans import presets
from txclean.sources.files import write_relations


@dataclass(frozen=True)
class CleaningConfig:
    """Columns, rules and reference data of a run.

    Rows equal on `keys` are copies of each other. Merchant and category, which
    cleaning changes before copies are removed, are not among the keys; the other
    columns the audit reads are.
    """

    keys: Sequence[str]
    dictionary: DataFrame
    cutoff: str = presets.DATE_CUTOFF
    rules: Rules = tuple(presets.CATEGORY_RULES)
    id: str = "TransactionId"
    booking: str = "BookingDateTime"
    value: str = "ValueDateTime"
    instructed: str = "InstructedAmount"
    amount: str = "TransactionAmount"
    currency: str = "Currency"
    original_currency: str = "OriginalCurrency"
    rate: str = "ExchangeRate"
    merchant: str = "merchant_name"
    category: str = "category"
    precision: Mapping[str, str] = field(default_factory=dict)
    redundant: Sequence[str] = ()

    def __post_init__(self) -> None:
        read = {
            self.id,
            self.booking,
            self.instructed,
            self.amount,
            self.currency,
            self.original_currency,
            self.rate,
        }
        if missing := read - set(self.keys):
            raise ValueError(f"keys lack {sorted(missing)}")
        if cleaned := {self.merchant, self.category} & set(self.keys):
            raise ValueError(f"keys contain {sorted(cleaned)}")

    @property
    def tiebreak(self) -> list[str]:
        return [self.id, self.merchant, self.category]

    @property
    def rate_rule(self) -> Column:
        """A rate is given exactly if the currencies differ."""
        currency, original = F.col(self.currency), F.col(self.original_currency)
        rate = F.col(self.rate)
        return ((currency == original) & rate.isNull()) | (
            (currency != original) & rate.isNotNull()
        )

    def before_cutoff(self, col: str) -> Column:
        return F.col(col) < F.lit(self.cutoff).cast("timestamp_ntz")

    @property
    def constraints(self) -> list[quality.Constraint]:
        return [
            *quality.primary_key([self.id]),
            quality.check("valid_booking_date", self.before_cutoff(self.booking)),
            quality.check("valid_value_date", self.before_cutoff(self.value)),
            quality.check("nonzero_amount", F.col(self.instructed) != 0),
            quality.check("exchange_rate_logic", self.rate_rule),
        ]


def bank_transactions(
    dictionary: DataFrame, cutoff: str = presets.DATE_CUTOFF
) -> CleaningConfig:
    """Configuration for the 22-column table of `txclean.sources.schemas`."""
    from txclean.sources.schemas import TRANSACTION_SCHEMA

    return CleaningConfig(
        keys=[
            name
            for name in TRANSACTION_SCHEMA.names
            if name not in ("merchant_name", "category")
        ],
        dictionary=dictionary,
        cutoff=cutoff,
        precision={
            "InstructedAmount": "decimal(12,2)",
            "TransactionAmount": "decimal(12,2)",
            "Balance": "decimal(12,2)",
        },
        redundant=["RawDateString"],
    )


def dictionary_from(
    spark: SparkSession, spellings: Mapping[str, Sequence[str]]
) -> DataFrame:
    """Dictionary (id, clean_name, dirty_name) from {clean name: misspellings}."""
    pairs = [(clean, dirty) for clean, dirties in spellings.items() for dirty in dirties]
    return spark.createDataFrame(
        pa.table(
            {
                "id": pa.array(range(1, len(pairs) + 1), pa.int64()),
                "clean_name": pa.array([clean for clean, _ in pairs], pa.string()),
                "dirty_name": pa.array([dirty for _, dirty in pairs], pa.string()),
            }
        )
    )


def standardise(raw: DataFrame, config: CleaningConfig) -> DataFrame:
    """Raw rows to staging rows, one for one; all but the dictionary is row-wise."""
    df = fix_precision(raw, config.precision)
    df = standardise_text(
        df, trim=[config.merchant, config.category], titlecase=[config.merchant]
    )
    df = classify_keywords(df, config.category, config.rules)
    # Names are few beside rows, so each is put in shape once for the matching.
    names = standardise_text(
        raw.select(config.merchant).distinct(),
        trim=[config.merchant],
        titlecase=[config.merchant],
    )
    return correct_from_dictionary(df, config.merchant, config.dictionary, names=names)


def finish(deduped: DataFrame, config: CleaningConfig) -> DataFrame:
    """Surviving staging rows to final rows, one for one."""
    df = deduped.drop(*config.redundant)
    df = fill_from(df, config.amount, config.instructed)
    # After classification: the keyword "income" would claim the new label.
    negative_income = (F.col(config.instructed) < 0) & (
        F.col(config.category) == presets.INCOME
    )
    return relabel_when(df, config.category, negative_income, presets.INCOME_REVERSAL)


def clean(raw: DataFrame, config: CleaningConfig) -> CleaningResult:
    """Run the stages. Building the name corrections reads the merchant column
    once; all else is lazy."""
    traced = standardise(
        raw.withColumns(
            {
                f"__before_{name}": F.col(name)
                for name in (config.merchant, config.category)
            }
        ),
        config,
    )
    staging = traced.select(*raw.columns)
    deduped = dedup.deduplicate(staging, config.keys, config.tiebreak)
    return CleaningResult(
        raw=raw,
        traced=traced,
        keyed=fix_precision(raw, config.precision),
        staging=staging,
        deduped=deduped,
        final=finish(deduped, config),
        config=config,
    )


@dataclass(frozen=True)
class CleaningResult:
    """The stages of a run.

    `traced` is staging with its raw merchants and categories. `keyed` has the key
    columns of staging and is read where nothing else is needed, which spares the
    name matching.
    """

    raw: DataFrame
    traced: DataFrame
    keyed: DataFrame
    staging: DataFrame
    deduped: DataFrame
    final: DataFrame
    config: CleaningConfig

    def materialise(self, path: str) -> CleaningResult:
        """Write the stages as parquet and go on from there, so that audits read
        tables instead of cleaning again."""
        spark = self.raw.sparkSession
        base = path.rstrip("/")
        write_relations({"traced": self.traced}, base)
        traced = spark.read.parquet(f"{base}/traced")
        staging = traced.select(*self.raw.columns)
        deduped = dedup.deduplicate(staging, self.config.keys, self.config.tiebreak)
        write_relations({"deduped": deduped}, base)
        deduped = spark.read.parquet(f"{base}/deduped")
        final = finish(deduped, self.config)
        write_relations({"final": final}, base)
        return replace(
            self,
            traced=traced,
            keyed=staging,
            staging=staging,
            deduped=deduped,
            final=spark.read.parquet(f"{base}/final"),
        )

    def publish(self, view: str = "cleaned_data", report_view: str | None = None) -> None:
        """The final table, and the report if it is given a name, as views."""
        self.final.createOrReplaceTempView(view)
        if report_view is not None:
            self.report().createOrReplaceTempView(report_view)

    def numbered(self) -> DataFrame:
        c = self.config
        return dedup.with_row_num(self.staging, c.keys, c.tiebreak, key_rows=self.keyed)

    def duplicates(self) -> DataFrame:
        c = self.config
        return dedup.duplicates(self.staging, c.keys, c.tiebreak, key_rows=self.keyed)

    def row_counts(self) -> DataFrame:
        """Rows of each stage, from the keys alone: staging has the rows of raw, and
        after it there is one for each group of copies."""
        rows = F.array(
            *(
                F.struct(F.lit(stage).alias("stage"), F.col(count).alias("rows"))
                for stage, count in (
                    ("raw", "all"), ("staging", "all"), ("deduped", "kept"), ("final", "kept")
                )
            )
        )
        counts = audit.row_groups(self.keyed, self.config.keys).agg(
            F.coalesce(F.sum("copies"), F.lit(0)).cast("long").alias("all"),
            F.count(F.lit(1)).alias("kept"),
        )
        return counts.select(F.inline(rows))

    def violation_counts(self) -> DataFrame:
        """Violations of each rule, which all read key columns only."""
        return quality.violation_counts(self._survivors(), self.config.constraints)

    def repeated_ids(self) -> DataFrame:
        return quality.check_unique([self.config.id]).violations(self._survivors())

    def enforce(
        self, policy: str = "quarantine", existing: DataFrame | KeyIndex | None = None
    ) -> quality.Enforced:
        return quality.apply_constraints(
            self.final,
            self.config.constraints,
            policy,
            existing,
            key_rows=self._survivors(),
        )

    # Log branches, stages compared through the transaction id.

    def audit_merchant(self) -> DataFrame:
        return self._audit_text(0)

    def audit_category(self) -> DataFrame:
        return self._audit_text(1)

    def _audit_text(self, *wanted: int) -> DataFrame:
        changes = [self._text_changes()[i] for i in wanted]
        return audit.audit_changes_within(
            self.traced, self.config.id, changes, key_rows=self.keyed
        )

    def audit_factors(self) -> DataFrame:
        """The changes of merchants and categories by their factors: linear in the rows,
        however many share an id."""
        return audit.audit_factors(
            self.traced, self.config.id, self._text_changes(), key_rows=self.keyed
        )

    def _survivors(self) -> DataFrame:
        """Key columns of the final rows, for which it does not matter which of the
        copies has survived."""
        c = self.config
        return fill_from(self.keyed.select(*c.keys).distinct(), c.amount, c.instructed)

    def audit_fills(self) -> DataFrame:
        c = self.config
        return audit.audit_fills(
            self.keyed, self._survivors(), c.id, c.amount, presets.FILL_NOTE
        )

    def audit_duplicates(self) -> DataFrame:
        c = self.config
        return audit.audit_duplicates(
            self.keyed, c.keys, c.id, presets.DUPLICATE_OLD, presets.DUPLICATE_NEW, presets.DUPLICATE_NOTE
        )

    def audit_rates(self) -> DataFrame:
        """Logs the rows which keep the rule, as the log has always done; the rows
        which break it are the violations of the `exchange_rate_logic` check."""
        c = self.config
        return audit.audit_predicate(
            self._survivors(), c.rate_rule, c.id, F.lit(None), F.col(c.rate), presets.RATE_NOTE
        )

    def audit_dates(self) -> DataFrame:
        c = self.config
        return audit.audit_predicate(
            self._survivors(), ~c.before_cutoff(c.booking), c.id, F.col(c.booking), F.lit(None), presets.DATE_NOTE
        )

    def audit_log(self) -> DataFrame:
        c = self.config
        groups = self._groups()
        return audit.audit_log(
            self._audit_text(0, 1),
            audit.audit_fills_within(
                groups, c.id, "__before", c.amount, "copies", presets.FILL_NOTE
            ),
            audit.audit_told(groups, c.id, self._told()),
        )

    def _groups(self) -> DataFrame:
        """The groups of copies, one for each final row, with the amount before filling.

        All counts and entries below read this one frame and filter above it, so that
        Spark groups the rows once.
        """
        c = self.config
        return fill_from(
            audit.row_groups(self.keyed, c.keys).withColumn("__before", F.col(c.amount)),
            c.amount,
            c.instructed,
        )

    def _told(self) -> list[audit.Told]:
        """Entries for copies, rates and dates, told by each group of copies itself."""
        c = self.config
        nothing, one = F.lit(None), F.lit(1)
        return [
            audit.Told(
                presets.DUPLICATE_NOTE, F.lit(True), F.lit(presets.DUPLICATE_OLD),
                F.lit(presets.DUPLICATE_NEW), F.col("copies") - 1,
            ),
            audit.Told(presets.RATE_NOTE, c.rate_rule, nothing, F.col(c.rate), one),
            audit.Told(
                presets.DATE_NOTE, ~c.before_cutoff(c.booking), F.col(c.booking), nothing, one
            ),
        ]

    # The same log with one entry per row which changed.

    def _text_changes(self) -> audit.Changes:
        c = self.config
        return [
            (f"__before_{c.merchant}", c.merchant, presets.MERCHANT_NOTE),
            (f"__before_{c.category}", c.category, presets.CATEGORY_NOTE),
        ]

    def row_changes(self) -> DataFrame:
        """Merchants and categories, in one scan without a shuffle."""
        return audit.audit_row_changes(self.traced, self.config.id, self._text_changes())

    def row_fills(self) -> DataFrame:
        c = self.config
        before = self.keyed.select(*c.keys, F.col(c.amount).alias("__before")).distinct()
        filled = fill_from(before, c.amount, c.instructed)
        return audit.audit_row_changes(
            filled, c.id, [("__before", c.amount, presets.FILL_NOTE)]
        )

    def audit_lineage(self) -> DataFrame:
        c = self.config
        filled = F.col("__before").isNull() & F.col(c.amount).isNotNull()
        fill = audit.Told(presets.FILL_NOTE, filled, F.lit(None), F.col(c.amount), F.lit(1))
        return audit.audit_log(
            self.row_changes(), audit.audit_told(self._groups(), c.id, [fill, *self._told()])
        )

    # Summary of the log, counted without building it.

    def summary(self) -> DataFrame:
        c = self.config
        groups = self._groups()
        return audit.audit_log(
            audit.count_changes_within(
                self.traced, c.id, self._text_changes(), key_rows=self.keyed
            ),
            audit.count_fills_within(
                groups, c.id, "__before", c.amount, "copies", presets.FILL_NOTE
            ),
            audit.count_totals(
                groups,
                [
                    (F.sum(F.col("copies") - 1), presets.DUPLICATE_NOTE),
                    (F.count_if(c.rate_rule), presets.RATE_NOTE),
                    (F.count_if(~c.before_cutoff(c.booking)), presets.DATE_NOTE),
                ],
            ),
        )

    def report(self) -> DataFrame:
        return audit.cleaning_report(self.summary())
