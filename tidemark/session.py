"""Session settings the engine relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings that decide results. All of them can be changed on a running session.
REQUIRED_CONF = {
    # ISO texts and dates are UTC.
    "spark.sql.session.timeZone": "UTC",
    # A repeated JSON key keeps its last value instead of rejecting the event.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # A value of an unexpected JSON type makes that part null, not the whole event.
    "spark.sql.json.enablePartialResults": "true",
    # event_date, run_id and batch stay strings when read from folder names.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings above to a session and return it."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    return spark


def check(spark: SparkSession) -> None:
    """Raise if a setting above is not in force: jobs would give other results."""
    wrong = {k: spark.conf.get(k, None) for k, v in REQUIRED_CONF.items() if (spark.conf.get(k, None) or "").lower() != v.lower()}
    if wrong:
        raise RuntimeError(f"call tidemark.configure(spark) first; the session has {wrong}")


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, for written intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``. Only where that is unset and the master is local
    (tests, a laptop) is a temporary folder used.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return tempfile.mkdtemp(prefix="tidemark-")
