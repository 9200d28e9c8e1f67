"""Entry A: dirty source -> contract -> clean -> business-key dedup -> DQ metric
table -> gates -> publish -> read-back validation.

The source is read and cleaned once: the cleaned rows, with the source's text
beside them, are written as a columnar staging table in the shared checkpoint
folder.  Dedup and DQ metrics read the columns they need from it, the gates
take the cast failures from the metric table, and a failed gate stops the job
before anything is published.  The target is published in two phases: a new
version is written and checked before the target's name is switched to it.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep import constants as K
from tabprep.operators import dedup as D
from tabprep.operators import quality as Q
from tabprep.operators import schema as S
from tabprep.plans.clean import clean
from tabprep.operators.partitioning import materialize
from tabprep.sources import io


@dataclass
class CurateResult:
    curated: DataFrame
    dq_metrics: DataFrame
    gates: DataFrame
    published_rows: int | None


def _curated(cleaned: DataFrame, profile: str, tie_break, now) -> DataFrame:
    audit = profile == "audit"
    keys = [("income_label" if k == "income" else k) for k in K.BUSINESS_KEY] if audit else K.BUSINESS_KEY
    survivors = D.dedup_by_key(cleaned, keys, tie_break=list(tie_break))
    return S.with_lineage(S.curated_projection(survivors, audit=audit), now=now,
                          pipeline_version="v1" if audit else None)


def curate(raw: DataFrame, profile: str = "core", tie_break=(), now: datetime | str | None = None) -> DataFrame:
    """clean (one Project) -> dedup by business key -> publish projection + lineage (lazy)."""
    return _curated(clean(raw, profile, keep=list(tie_break)), profile, tie_break, now)


def run_curate(raw: DataFrame, target_table: str | None = None, dq_table: str | None = None,
               profile: str = "core", tie_break=(), source_path: str = "", now=None,
               enforce_gates: bool | list[str] = True, fmt: str | None = None) -> CurateResult:
    """The whole batch job.  ``raw`` may carry messy headers (standardised
    here) and extra columns (kept only when named in ``tie_break``).

    ``enforce_gates``: every gate (the default), the named ones, or none
    (``False``).  The metric table is written even if a gate fails, so that the
    failure can be looked into; the target is not."""
    std = S.standardize_columns(raw)
    missing, _ = S.contract_diff(std.columns)
    S.enforce_contract(std)
    src = std.select(*tie_break, *K.CONTRACT_COLUMNS)
    staged = materialize(Q.dq_frame(src, profile, keep=list(tie_break)))
    names = [c for c in staged.columns if c != "_err" and not c.startswith(Q.RAW_PREFIX)]
    curated = materialize(_curated(staged.select(*names), profile, tie_break, now))
    dq = materialize(Q.dq_metrics(None, curated, profile, source_path, now, cleaned=staged)).orderBy("metric_name")
    label = "income_label" if profile == "audit" else "income"
    gates = Q.gate_report(curated, label=label, missing_columns=missing,
                          numeric_failures=dq.where(F.col("metric_name") == "numeric_cast_failure_count"))
    if dq_table:
        io.publish(dq, dq_table, fmt)
    if enforce_gates:
        Q.enforce(gates, gates=None if enforce_gates is True else enforce_gates)
    published = None
    if target_table:
        published = io.publish_version(curated, target_table, fmt)
    return CurateResult(curated, dq, gates, published)
