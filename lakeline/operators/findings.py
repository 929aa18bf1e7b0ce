"""Selection of reports with remarks, and what follows from their findings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Enforcement measures from least to most, and kinds of finding.
ENFORCE = ("none", "guidance", "injunction", "order", "ban", "fine", "police")
CATEGORIES = ("hygiene", "pest", "labeling", "temperature", "self_control", "approval", "traceability", "maintenance", "other")
REMARK_FLAGS = ("has_pest", "has_indskaerpelse", "has_paabud", "has_forbud", "has_gebyr", "has_politianmeldelse", "has_boede")


def has_remarks() -> Column:
    """A report with one of seven flags, or whose text says that something was found."""
    any_flag = F.lit(False)
    for f in REMARK_FLAGS:
        any_flag = any_flag | F.coalesce(F.col(f), F.lit(False))
    return (F.col("doc_type") == "report") & (any_flag | F.coalesce(F.col("text").ilike("%konstateret%"), F.lit(False)))


def actual(findings: Column) -> Column:
    """Findings that are real and not yet settled."""
    return F.filter(findings, lambda f: F.coalesce(f["is_actual_finding"], F.lit(False)) & ~F.coalesce(f["resolved"], F.lit(False)))


def max_enforcement(findings: Column) -> Column:
    """The strongest measure; unknown ones count as none."""
    order = F.array(*map(F.lit, ENFORCE))
    rank = F.array_max(F.transform(findings, lambda f: F.coalesce(F.array_position(order, f["enforcement"]), F.lit(0))))
    return F.element_at(order, F.greatest(F.lit(1), F.coalesce(rank, F.lit(1))).cast("int"))


def severity(findings: Column) -> Column:
    """From the findings alone, whatever label came with them."""
    real = actual(findings)
    most = max_enforcement(real)
    return (
        F.when(F.size(real) <= 0, "no_remarks").when(most.isin("fine", "police", "ban"), "serious")
        .when(most.isin("injunction", "order"), "remarks").otherwise("minor")
    )


def derive(df: DataFrame, findings: str = "findings") -> DataFrame:
    """Adds severity, counts, actual_pest and max_enforcement from the findings; null findings count as none."""
    f = F.coalesce(F.col(findings), F.array().cast(df.schema[findings].dataType))
    return df.withColumns({
        "severity": severity(f), "n_findings": F.size(f).cast("long"), "n_actual_findings": F.size(actual(f)).cast("long"),
        "actual_pest": F.exists(actual(f), lambda x: F.coalesce(x["category"] == "pest", F.lit(False))), "max_enforcement": max_enforcement(actual(f)),
    })


def prompt_text(text: Column, most: int = 6000) -> Column:
    """What of a report is given to a model with a bounded context."""
    return F.substring(text, 1, most)
