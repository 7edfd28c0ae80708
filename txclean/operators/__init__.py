"""DataFrame operators. Column names are always parameters."""

from txclean.operators.audit import (
    audit_changes,
    audit_changes_within,
    audit_duplicates,
    audit_factors,
    audit_fills,
    audit_log,
    audit_predicate,
    audit_row_changes,
    cleaning_report,
    count_changes,
    count_changes_within,
    count_duplicates,
    count_factors,
    count_fills,
    count_fills_within,
    count_totals,
    expand_factors,
    number_entries,
    row_groups,
    summarise_audit,
)
from txclean.operators.correct import (
    correct_from_dictionary,
    correction_map,
    dictionary_matches,
)
from txclean.operators.dates import date_order, parse_by_evidence
from txclean.operators.dedup import deduplicate, duplicates, repeat_rows, with_row_num
from txclean.operators.key_index import KeyIndex
from txclean.operators.ledger import AuditLedger
from txclean.operators.profile import (
    enrich,
    explode_labels,
    functional_dependency,
    inclusion_dependencies,
    inject_copies,
    label_profile,
    row_counts,
    sample_rows,
    unmatched,
)
from txclean.operators.quality import (
    ConstraintViolation,
    apply_constraints,
    check,
    check_in_set,
    check_length,
    check_not_null,
    check_unique,
    primary_key,
    violation_counts,
)
from txclean.operators.repair import fill_from, fix_precision
from txclean.operators.rules import (
    classify_by_table,
    classify_keywords,
    keyword_matches,
    relabel_when,
    rule_use,
    rules_table,
)
from txclean.operators.standardise import standardise_text

__all__ = [
    "AuditLedger",
    "ConstraintViolation",
    "KeyIndex",
    "apply_constraints",
    "audit_changes",
    "audit_changes_within",
    "audit_duplicates",
    "audit_factors",
    "audit_fills",
    "audit_log",
    "audit_predicate",
    "audit_row_changes",
    "check",
    "check_in_set",
    "check_length",
    "check_not_null",
    "check_unique",
    "classify_by_table",
    "classify_keywords",
    "cleaning_report",
    "correct_from_dictionary",
    "correction_map",
    "count_changes",
    "count_changes_within",
    "count_duplicates",
    "count_factors",
    "count_fills",
    "count_fills_within",
    "count_totals",
    "date_order",
    "deduplicate",
    "dictionary_matches",
    "duplicates",
    "enrich",
    "expand_factors",
    "explode_labels",
    "fill_from",
    "fix_precision",
    "functional_dependency",
    "inclusion_dependencies",
    "inject_copies",
    "keyword_matches",
    "label_profile",
    "number_entries",
    "parse_by_evidence",
    "primary_key",
    "relabel_when",
    "repeat_rows",
    "row_counts",
    "row_groups",
    "rule_use",
    "rules_table",
    "sample_rows",
    "standardise_text",
    "summarise_audit",
    "unmatched",
    "violation_counts",
    "with_row_num",
]
