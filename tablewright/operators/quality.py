"""Data checks. Each gives rows of (table_name, check_name, passed, detail), computed when read."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tablewright.operators.rollup import numbered_counts, row_counts


#: rows of a table, counted while it was written, from which a whole number as its key is checked in blocks of keys
NUMBERED_ROWS = 5_000_000


def _result(table: str, check: str, passed: Column, *detail: Column | str) -> list[Column]:
    text = [part.cast("string") if isinstance(part, Column) else F.lit(part) for part in detail]
    return [
        F.lit(table).alias("table_name"),
        F.lit(check).alias("check_name"),
        passed.alias("passed"),
        F.concat(*text).alias("detail"),
    ]


def check_non_empty(df: DataFrame, name: str) -> DataFrame:
    """The table has at least one row. The count needs no column, so Parquet answers it from file footers."""
    return df.agg(F.count("*").alias("n")).select(*_result(name, "non_empty", F.col("n") > 0, F.col("n"), " rows"))


def check_unique(df: DataFrame, name: str, key: Sequence[str] = ()) -> DataFrame:
    """No two rows are equal. ``key`` may name columns that are grouped along."""
    return row_counts(df, key).select(
        *_result(name, "unique_rows", F.col("n") == F.col("n_distinct"), F.col("n"), " rows, ", F.col("n_distinct"), " distinct")
    )


def _check_keyed(df: DataFrame, key: Sequence[str], name: str, rows: int = 0) -> DataFrame:
    """``check_unique`` and ``check_key`` from the same grouping; ``rows`` says how many there are, where that is known."""
    numbered = rows >= NUMBERED_ROWS and len(key) == 1 and df.schema[key[0]].dataType.simpleString() in ("int", "bigint")
    n, distinct, repeated = F.col("n"), F.col("n_distinct"), F.col("n_repeated")
    results = [
        _result(name, "unique_rows", n == distinct, n, " rows, ", distinct, " distinct"),
        _result(name, f"unique_key({', '.join(key)})", repeated == 0, repeated, " repeated keys"),
    ]
    counts = numbered_counts(df, key[0]) if numbered else row_counts(df, key)
    return counts.select(F.inline(F.array(*[F.struct(*row) for row in results])))


def _one_pass(df: DataFrame, faults: Mapping[str, tuple[Column, str]], name: str, non_empty: bool = False) -> DataFrame:
    """Count the rows each condition holds for, and with ``non_empty`` all rows, in one scan; one row per condition."""
    n = F.count("*").alias("n")
    counts = df.agg(n, *[F.count_if(condition).alias(f"c{i}") for i, (condition, _) in enumerate(faults.values())])
    rows = [
        _result(name, check, F.col(f"c{i}") == 0, F.col(f"c{i}"), f" {noun}")
        for i, (check, (_, noun)) in enumerate(faults.items())
    ]
    if non_empty:
        rows.insert(0, _result(name, "non_empty", F.col("n") > 0, F.col("n"), " rows"))
    return counts.select(F.inline(F.array(*[F.struct(*row) for row in rows])))


def _null_faults(columns: Sequence[str]) -> dict[str, tuple[Column, str]]:
    return {f"not_null({c})": (F.col(c).isNull(), "null") for c in columns}


def _length_faults(limits: Mapping[str, int]) -> dict[str, tuple[Column, str]]:
    return {f"length({c}<={n})": (F.coalesce(F.length(c) > n, F.lit(False)), "too long") for c, n in limits.items()}


def table_faults(not_null: Sequence[str] = (), limits: Mapping[str, int] | None = None) -> dict[str, tuple[Column, str]]:
    """Conditions that no row may meet, by check name, each with what its rows are called."""
    return _null_faults(not_null) | _length_faults(limits or {})


def observe_faults(df: DataFrame, faults: Mapping[str, tuple[Column, str]]) -> tuple[DataFrame, Observation]:
    """``df`` to be written, and what is counted while it is: all rows as ``n`` and those of each fault. The table need not be scanned for it.

    Observe the frame just before it is written, above every shuffle: tasks of the last stage count once, however often executors are lost.
    """
    seen = Observation()
    counts = [F.count_if(condition).alias(check) for check, (condition, _) in faults.items()]
    return df.observe(seen, F.count("*").alias("n"), *counts), seen


def observed_checks(spark: SparkSession, counts: Mapping[str, int], faults: Mapping[str, tuple[Column, str]], name: str) -> DataFrame:
    """The rows that ``run_checks`` gives for non-empty tables, NULLs and lengths, from counts that are known already."""
    rows = [_result(name, "non_empty", F.lit(counts["n"] > 0), f"{counts['n']} rows")]
    rows += [_result(name, check, F.lit(counts[check] == 0), f"{counts[check]} {noun}") for check, (_, noun) in faults.items()]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*[F.struct(*row) for row in rows])))


def check_not_null(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """None of the columns holds a NULL."""
    return _one_pass(df, _null_faults(columns), name)


def check_rejects(rejects: DataFrame, name: str, most: int = 0) -> DataFrame:
    """No more than ``most`` records of a source were rejected."""
    return rejects.agg(F.count("*").alias("n")).select(*_result(name, f"rejects(<={most})", F.col("n") <= most, F.col("n"), " rejected"))


def check_length(df: DataFrame, limits: Mapping[str, int], name: str) -> DataFrame:
    """No text is longer than its declared limit."""
    return _one_pass(df, _length_faults(limits), name)


def duplicate_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with ``cnt``."""
    return df.groupBy(*columns).agg(F.count("*").alias("cnt")).filter(F.col("cnt") > 1)


def check_key(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """No key occurs twice."""
    return duplicate_keys(df, columns).agg(F.count("*").alias("n")).select(
        *_result(name, f"unique_key({', '.join(columns)})", F.col("n") == 0, F.col("n"), " repeated keys")
    )


def check_sql(spark: SparkSession, checks: Sequence[tuple[str, object]], name: str = "sql") -> DataFrame:
    """The first value of each query equals the expected value; no row counts as NULL."""
    results = []
    for sql, expected in checks:
        answer = spark.sql(sql)
        first = answer.toDF(*[f"c{i}" for i in range(len(answer.columns))]).limit(1).agg(F.first("c0").alias("actual"))
        shown = F.coalesce(F.col("actual").cast("string"), F.lit("NULL"))
        results.append(
            first.select(*_result(name, sql, F.col("actual").eqNullSafe(F.lit(expected)), shown, f", expected {expected}"))
        )
    return reduce(DataFrame.unionAll, results)


def run_checks(
    spark: SparkSession,
    base: str,
    tables: Sequence[str],
    keys: Mapping[str, Sequence[str]] | None = None,
    not_null: Mapping[str, Sequence[str]] | None = None,
    limits: Mapping[str, Mapping[str, int]] | None = None,
    extra: Sequence[Callable[[DataFrame, str], DataFrame]] = (),
    counts: Mapping[str, Mapping[str, int]] | None = None,
) -> DataFrame:
    """Check written tables ``base/<table>`` and report one row per check.

    Each table must be non-empty and without repeated rows; ``extra`` checks are run on each as well.
    ``keys``, ``not_null`` and ``limits`` (text lengths) add checks for the tables they name.
    A table is scanned twice: once for counts, NULLs and lengths, once for repeated rows and keys. Tables in ``counts``, counted while
    they were written (``observe_faults``), are scanned for repeated rows and keys only, and where they are known to have many rows
    under a whole number as key, that number is read alone (``numbered_counts``), the rest only if it repeats.
    """
    results = []
    for table in tables:
        df = spark.read.parquet(f"{base.rstrip('/')}/{table}")
        key = list((keys or {}).get(table, ()))
        faults = table_faults((not_null or {}).get(table, ()), (limits or {}).get(table, {}))
        known = (counts or {}).get(table)
        counted = _one_pass(df, faults, table, non_empty=True) if known is None else observed_checks(spark, known, faults, table)
        rows = known["n"] if known else 0
        results += [counted, _check_keyed(df, key, table, rows) if key else check_unique(df, table)]
        results += [check(df, table) for check in extra]
    return reduce(DataFrame.unionAll, results)


def raise_on_failure(report: DataFrame) -> None:
    """One error that names all failed checks of a report."""
    failed = report.filter(~F.col("passed")).collect()
    if failed:
        lines = [f"{row.table_name}: {row.check_name} ({row.detail})" for row in failed]
        raise ValueError("data checks failed\n" + "\n".join(lines))
