"""Quality rules with thresholds that adapt to language and source.

Every text gives a few measures. Their distributions are kept as quantile sketches: counts of logarithmic buckets,
which merge by adding and give each quantile within a fixed relative error. A sketch is made per language and
source from the texts that pass the base rules; sketches of small sources give way to the merged one of their
language, and those of small languages to the merged one of all texts. Thresholds are fences around the quartiles.
"""

from __future__ import annotations

from collections import Counter
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import as_bytes, bound_batches, thrifty, written

SYMBOLS = b"#*$%&|<>"
WHITE = b" \t\n\x0b\x0c\r"
BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long"
# Relative error of a quantile, and the least value that isn't taken as nought.
ERROR, LEAST = 0.01, 1e-6
# Groups with fewer texts use the sketch of the level above.
GROUP = 200
# How far outside the quartiles a text may lie, in quartile distances.
REACH = 4.0
# Measures: least quartile distance, whether low values are rejected as well.
MEASURES = {
    "word_length": (0.6, True),
    "symbol_share": (0.03, False),
    "dup_line_share": (0.15, False),
    "repeat_share": (0.1, False),
}


def _repeated(words: list[bytes]) -> int:
    """Words inside three-word windows that are found twice or more."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    counts, covered = Counter(windows), bytearray(len(words))
    for i, window in enumerate(windows):
        if counts[window] > 1:
            covered[i : i + 3] = b"\1\1\1"
    return sum(covered)


def measure(column: pa.Array) -> list:
    rows = []
    for data in as_bytes(column):
        words = data.split()
        lines = [line for line in data.split(b"\n") if line.strip()]
        rows.append(
            (
                len(words),
                len(data.decode()) - (len(data) - len(data.translate(None, WHITE))),
                len(data) - len(data.translate(None, SYMBOLS)),
                len(lines) - len(set(lines)),
                _repeated(words),
                len(lines),
            )
        )
    return list(zip(*rows, strict=True))


def measures(docs: DataFrame, carry: dict[str, str | F.Column], text: str = "text") -> DataFrame:
    """The counts of BASE of each whole text, beside columns of docs under new names; a null text has no words."""
    bound_batches(docs.sparkSession)
    source = docs.select(*[(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in carry.items()], F.col(text).cast("string"))
    n = len(carry)
    schema = T.StructType([*source.schema.fields[:n], *T.StructType.fromDDL(BASE).fields])

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                counts = [pa.array(c, pa.int64()) for c in measure(batch.column(n))]
                yield pa.RecordBatch.from_arrays([*batch.columns[:n], *counts], schema.names)

    return source.mapInArrow(thrifty(run, n), schema)


def with_shares(counts: DataFrame) -> DataFrame:
    """Base verdict and the measures that thresholds are learned for."""
    words, lines = F.greatest("n_words", F.lit(1)), F.greatest("n_lines", F.lit(1))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return counts.withColumns(
        {
            "base_failed": failed,
            "word_length": F.col("word_chars") / words,
            "symbol_share": F.col("n_symbols") / words,
            "dup_line_share": F.col("n_dup_lines") / lines,
            "repeat_share": F.col("n_repeat_words") / words,
        }
    )


def _bucket(value: Column) -> Column:
    gamma = (1 + ERROR) / (1 - ERROR)
    return F.when(value <= LEAST, F.lit(None)).otherwise(F.ceil(F.log(value) / F.log(F.lit(gamma)))).cast("int")


def _value(bucket: Column) -> Column:
    gamma = (1 + ERROR) / (1 - ERROR)
    return F.when(bucket.isNull(), 0.0).otherwise(2 * F.pow(F.lit(gamma), bucket) / (gamma + 1))


def sketch(rows: DataFrame, group: list[str]) -> DataFrame:
    """group, measure, bucket, n: the sketch of each measure in each group."""
    long = rows.select(
        *group, F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), _bucket(F.col(m)).alias("bucket")) for m in MEASURES]))
    )
    return long.select(*group, "col.*").groupBy(*group, "measure", "bucket").agg(F.count(F.lit(1)).alias("n"))


def merge(sketches: DataFrame, group: list[str]) -> DataFrame:
    """Add up sketches of finer groups."""
    return sketches.groupBy(*group, "measure", "bucket").agg(F.sum("n").alias("n"))


def quartiles(sketches: DataFrame, group: list[str]) -> DataFrame:
    """group, measure, total, q25, q75. A group has at most as many rows as a sketch has buckets."""
    every = Window.partitionBy(*group, "measure")
    running = every.orderBy(F.asc_nulls_first("bucket")).rowsBetween(Window.unboundedPreceding, 0)
    up_to = sketches.withColumns({"total": F.sum("n").over(every), "upto": F.sum("n").over(running)})
    at = {q: F.min(F.when(F.col("upto") >= q * F.col("total"), _value(F.col("bucket")))) for q in (0.25, 0.75)}
    return up_to.groupBy(*group, "measure").agg(
        F.first("total").alias("total"), at[0.25].alias("q25"), at[0.75].alias("q75")
    )


def thresholds(rows: DataFrame) -> DataFrame:
    """_lang, _source, and the lowest and highest value allowed of each measure.

    Learned from the rows that passed the base rules; a language or source can be null, which is a value like others.
    """
    group = ["_lang", "_source"]
    fine = written(sketch(rows.where(~F.col("base_failed")).select(*group, *MEASURES), group), "sketches")
    levels = [group, group[:1], []]
    found = [quartiles(fine if i == 0 else merge(fine, g), g) for i, g in enumerate(levels)]
    named = [
        q.select(*g, "measure", F.struct("total", "q25", "q75").alias(f"level{i}")) for i, (g, q) in enumerate(zip(levels, found, strict=True))
    ]
    joined = named[0]
    for g, q in list(zip(levels, named, strict=True))[1:]:
        q = q.withColumnsRenamed({c: f"of_{c}" for c in [*g, "measure"]})
        same = [joined[c].eqNullSafe(q[f"of_{c}"]) for c in [*g, "measure"]]
        joined = joined.join(q, reduce(lambda a, b: a & b, same)).drop(*[f"of_{c}" for c in [*g, "measure"]])
    use = F.when(F.col("level0.total") >= GROUP, F.col("level0")).when(F.col("level1.total") >= GROUP, F.col("level1"))
    joined = joined.withColumn("use", use.otherwise(F.col("level2")))
    least = F.create_map(*[F.lit(x) for m, (least, _) in MEASURES.items() for x in (m, least)])[F.col("measure")]
    reach = REACH * F.greatest(F.col("use.q75") - F.col("use.q25"), least)
    fences = joined.select(*group, "measure", (F.col("use.q25") - reach).alias("low"), (F.col("use.q75") + reach).alias("high"))
    aggregates = [
        F.max(F.when(F.col("measure") == m, F.col(end))).alias(f"{m}_{end}") for m in MEASURES for end in ("low", "high")
    ]
    return fences.groupBy(*group).agg(*aggregates)


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """Per row of docs: _key, _lang, _source, _row (a struct of all columns of docs), the counts of BASE, base_failed,
    the measures, kept.

    kept is false if a base rule fails or a measure lies outside the fences of the row's language and source. Rows
    of a language and source that have no passing text have failed the base rules themselves. Repeated rows and null
    keys, languages or sources give a row each, an empty table none.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return _judge(docs, {"_key": key, "_lang": lang, "_source": source, "_row": whole}, text)


def _judge(docs: DataFrame, carry: dict[str, str | F.Column], text: str) -> DataFrame:
    # the counts are read twice and need a pass over all texts, so they are written
    rows = written(with_shares(measures(docs, carry, text)), "measures")
    # written, so that Spark knows its size and broadcasts it only where that is small
    limits = written(thresholds(rows), "thresholds").withColumnsRenamed({"_lang": "of_lang", "_source": "of_source"})
    joined = rows.join(limits, F.col("_lang").eqNullSafe(F.col("of_lang")) & F.col("_source").eqNullSafe(F.col("of_source")), "left")
    fits = [
        (F.col(m) <= F.col(f"{m}_high")) & ((F.col(m) >= F.col(f"{m}_low")) if low else F.lit(True))
        for m, (_, low) in MEASURES.items()
    ]
    kept = ~F.col("base_failed") & F.coalesce(reduce(lambda a, b: a & b, fits), F.lit(False))
    return joined.withColumn("kept", kept).select(*rows.columns, "kept")


def rate(docs: DataFrame) -> DataFrame:
    """The counts and verdict of each document."""
    rows = _judge(docs, {"_key": "doc_id", "_lang": "lang", "_source": "source"}, "text")
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return rows.select(F.col("_key").alias("doc_id"), *counts)


def keep_good(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs that are kept, with all their columns."""
    good = judge(docs, key, text).where("kept")
    return good.select(*[F.col(f"_row.`{c}`").alias(c) for c in docs.columns])
