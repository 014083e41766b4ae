"""All stages one after another: land, compact, structure, merge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tidemark.plans.compact import compact
from tidemark.plans.merge import current_table, run_merge
from tidemark.plans.structure import run_structure
from tidemark.sources.ledger import Ledger
from tidemark.specs import EntitySpec
from tidemark.streaming.ingest import ingest


def run_pipeline(
    stream: DataFrame,
    base: str,
    specs: Sequence[EntitySpec],
    *,
    mode: str = "replay",
    buckets: int | None = None,
    prune: bool = False,
    **ingest_options,
) -> dict[str, DataFrame]:
    """Land what the stream holds now and bring stage and current tables up to date below ``base``."""
    spark = stream.sparkSession
    ledger = Ledger(spark, f"{base}/ledger")
    bronze, silver = f"{base}/bronze", f"{base}/silver"
    run = ingest(
        stream, bronze, ledger, checkpoint=f"{base}/checkpoint", available_now=True, **ingest_options
    )
    status = run.finish()
    if status != "SUCCESS":
        raise RuntimeError(f"ingest run {run.run_id} ended {status}: {ledger.get_run(run.run_id).details}")
    compact(spark, bronze, ledger, prune=prune)
    run_structure(spark, bronze, silver, ledger, specs)
    for spec in specs:
        run_merge(spark, silver, ledger, spec, mode=mode, buckets=buckets)
    return {spec.table: current_table(spark, silver, ledger, spec) for spec in specs}
