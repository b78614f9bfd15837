"""Review tables: issue ids, suggested actions, and merging with what reviewers wrote before."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.config import DEFAULT_ACTION, SUGGESTED_ACTIONS

EDITED_SCHEMA = ("silver_table_name", "allow_no_primary_key", "column_name", "datatype", "nullable", "is_pk", "pk_order", "is_fk", "fk_reference")
EDITED_DECISION = ("decision", "action", "reason")


def with_issue_ids(issues: DataFrame) -> DataFrame:
    """issue_id: 12 hex digits of SHA-1 over what names an issue, not over its counts."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    detail = F.when(F.col("issue_type") == "TEXT_VARIANT", text("detail")).otherwise("")
    key = F.concat_ws("\x1f", text("table_name"), text("column_name"), text("issue_type"), detail)
    return issues.withColumn("issue_id", F.substring(F.sha1(key), 1, 12))


def decision_review(issues: DataFrame) -> DataFrame:
    """Issues with a suggested action and blank fields for the reviewer."""
    pairs = [F.lit(x) for pair in SUGGESTED_ACTIONS.items() for x in pair]
    action = F.coalesce(F.try_element_at(F.create_map(*pairs), F.col("issue_type")), F.lit(DEFAULT_ACTION))
    blank = F.lit("")
    return with_issue_ids(issues).select(
        "issue_id", "table_name", "column_name", "issue_type", "issue_count", "example", "detail",
        action.alias("suggested_action"), *[blank.alias(c) for c in EDITED_DECISION],
    )


def merge_schema(proposal: DataFrame, old: DataFrame) -> DataFrame:
    """A proposal with the reviewer's edits: old values that are neither null nor empty win."""
    edited = [c for c in EDITED_SCHEMA if c in proposal.columns and c in old.columns]
    key = ["table_name", "source_column"]
    before = old.select(*key, *[F.col(c).alias(f"__{c}") for c in edited])
    values = [F.coalesce(F.nullif(F.col(f"__{c}"), F.lit("")), F.col(c)).alias(c) if c in edited else F.col(c) for c in proposal.columns]
    return proposal.join(before, key, "left").select(*values)


def merge_decisions(review: DataFrame, old: DataFrame) -> DataFrame:
    """A review with earlier decisions by issue id: old values win unless null, empty ones too."""
    before = old.select("issue_id", *[F.col(c).alias(f"__{c}") for c in EDITED_DECISION])
    values = [F.coalesce(F.col(f"__{c}"), F.col(c)).alias(c) if c in EDITED_DECISION else F.col(c) for c in review.columns]
    return review.join(before, "issue_id", "left").select(*values)
