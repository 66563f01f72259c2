"""Source policy: substring ban list over lower(id + ' ' + title + ' ' + description).

The pattern list is short and fixed, so it is folded into the row expression
(an OR of ``contains`` for the filter, a ``filter`` over the literal pattern
array for the audit). No join, no shuffle: the filter runs inside the scan's
codegen stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagesieve import constants as K


def policy_text(cols) -> Column:
    """lower(concat of the fields with a blank); absent fields count as empty."""
    return F.lower(F.concat_ws(" ", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]))


def is_banned(text: Column, patterns=K.BANNED_PATTERNS) -> Column:
    cond = F.lit(False)
    for p in patterns:
        cond = cond | F.contains(text, F.lit(p))
    return cond


def matched_patterns(text: Column, patterns=K.BANNED_PATTERNS) -> Column:
    """Sorted array of every pattern that occurs (``apollo-io`` shows even
    though ``apollo`` already bans)."""
    return F.array_sort(F.filter(F.array(*[F.lit(p) for p in patterns]), lambda p: F.contains(text, p)))


def _present(df: DataFrame, cols) -> list[str]:
    return [c for c in cols if c in df.columns]


def apply_policy(df: DataFrame, cols=("id", "title", "description"), patterns=K.BANNED_PATTERNS) -> DataFrame:
    """Rows whose policy text contains no banned pattern; order preserved."""
    return df.filter(~is_banned(policy_text(_present(df, cols)), patterns))


def policy_audit(df: DataFrame, cols=("id", "title", "description"), patterns=K.BANNED_PATTERNS) -> DataFrame:
    """Banned rows with the patterns that hit them (comma-joined)."""
    text = policy_text(_present(df, cols))
    return (df.withColumn("_hits", matched_patterns(text, patterns))
            .filter(F.size("_hits") > 0)
            .withColumn("patterns", F.array_join("_hits", ","))
            .drop("_hits"))


def policy_counts(df: DataFrame, cols=("id", "title", "description"), patterns=K.BANNED_PATTERNS) -> DataFrame:
    """One row: banned, allowed (a global two-counter aggregate)."""
    banned = is_banned(policy_text(_present(df, cols)), patterns)
    return df.agg(F.count_if(banned).alias("banned"), F.count_if(~banned).alias("allowed"))
