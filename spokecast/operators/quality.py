"""Data-quality checks (L1-L16) and the quality monitor.

A check is data; ``run_suite`` turns all column checks of a table into one aggregate.  Only
uniqueness needs its own grouping, which reads just the key columns.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Freshness limits in days.
FRESHNESS_WARN_DAYS = 10
FRESHNESS_ERROR_DAYS = 15

RESULT_SCHEMA = "run_id string, run_timestamp timestamp_ntz, test_type string, test_name string, status string, failure_message string, source_name string"


@dataclass(frozen=True)
class Check:
    """One expectation on one table.

    ``kind`` is one of ``not_null``, ``unique``, ``between``, ``in_set``, ``pair_greater``,
    ``row_count``, ``expression``, ``unique_combination`` and ``relationship``.
    """

    kind: str
    column: str | None = None
    low: float | None = None
    high: float | None = None
    values: tuple = ()
    other: str | None = None
    or_equal: bool = False
    mostly: float = 1.0
    expression: str | None = None
    columns: tuple[str, ...] = ()
    parent: str | None = None
    severity: str = "error"

    @property
    def label(self) -> str:
        if self.kind == "pair_greater":
            return f"{self.column},{self.other}"
        return self.column or ",".join(self.columns) or "table"

    @property
    def needs(self) -> tuple[str, ...]:
        return tuple(c for c in (self.column, self.other, *self.columns) if c)


def _evaluated_and_bad(check: Check) -> tuple[Column, Column]:
    """Which rows a row-wise check looks at, and which of them break it."""
    c = F.col(check.column) if check.column else None
    if check.kind == "not_null":
        return F.lit(True), c.isNull()
    if check.kind == "between":
        low = F.lit(False) if check.low is None else c < check.low
        high = F.lit(False) if check.high is None else c > check.high
        return c.isNotNull(), low | high
    if check.kind == "in_set":
        return c.isNotNull(), ~c.isin(*check.values)
    if check.kind == "pair_greater":
        other = F.col(check.other)
        holds = c >= other if check.or_equal else c > other
        return c.isNotNull() | other.isNotNull(), ~F.coalesce(holds, F.lit(False))
    if check.kind == "expression":
        # A null outcome is not a failure, as in a test that selects rows where NOT (expression).
        return F.lit(True), ~F.coalesce(F.expr(check.expression), F.lit(True))
    raise ValueError(check.kind)


def _record(source: str, number: int, check: Check, evaluated: Column, unexpected: Column, success: Column) -> Column:
    return F.struct(
        F.lit(source).alias("source_name"),
        F.lit(number).alias("check_no"),
        F.lit(check.kind).alias("check_type"),
        F.lit(check.label).alias("column_name"),
        evaluated.cast("bigint").alias("evaluated"),
        unexpected.cast("bigint").alias("unexpected"),
        success.alias("success"),
        F.lit(check.severity).alias("severity"),
    )


def _share_ok(evaluated: Column, unexpected: Column, mostly: float) -> Column:
    if mostly >= 1.0:
        return unexpected == 0
    good = (evaluated - unexpected) / F.nullif(evaluated, F.lit(0))
    return F.coalesce(good >= mostly, F.lit(True))


def _key_counts(df: DataFrame, checks: list[tuple[int, Check]]) -> DataFrame:
    """One row with, for each key check, the rows evaluated and those whose key is not unique.

    The key sets of all checks are grouped in one scan and one shuffle (grouping sets).  A single key ignores
    nulls (L2); a combination compares them like values (L9).
    """
    columns = list(dict.fromkeys(c for _, check in checks for c in check.needs))
    sets = list(dict.fromkeys(tuple(sorted(check.needs, key=columns.index)) for _, check in checks))
    if len(sets) == 1:
        grouped = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).withColumn("set", F.lit(0))
    else:
        # A bit for each column that a set leaves out, the first column's highest.
        numbers = {k: sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in k) for k in sets}
        grouped = df.groupingSets([[F.col(c) for c in k] for k in sets], *[F.col(c) for c in columns]).agg(
            F.count(F.lit(1)).alias("n"), F.grouping_id().alias("set")
        )
    measures = []
    for number, check in checks:
        key = tuple(sorted(check.needs, key=columns.index))
        own = F.col("set") == (0 if len(sets) == 1 else numbers[key])
        if len(key) == 1:
            own = own & F.col(key[0]).isNotNull()
        measures.append(F.coalesce(F.sum(F.when(own, F.col("n"))), F.lit(0)).alias(f"e{number}"))
        measures.append(F.coalesce(F.sum(F.when(own & (F.col("n") > 1), F.col("n"))), F.lit(0)).alias(f"u{number}"))
    return grouped.agg(*measures)


def run_suite(
    df: DataFrame, suite: tuple[Check, ...], source: str, parents: dict[str, DataFrame] | None = None
) -> DataFrame:
    """One result row per check: rows evaluated, rows unexpected, success.

    A check on a column the table lacks fails with nothing evaluated.
    """
    in_pass: list[tuple[int, Check]] = []
    keyed: list[tuple[int, Check]] = []
    pieces: list[DataFrame] = []
    missing: list[Column] = []
    for number, check in enumerate(suite, 1):
        if any(c not in df.columns for c in check.needs):
            missing.append(_record(source, number, check, F.lit(0), F.lit(0), F.lit(False)))
        elif check.kind in ("unique", "unique_combination"):
            keyed.append((number, check))
        elif check.kind == "relationship":
            key, table = check.column, (parents or {})[check.parent]
            orphan = (
                df.filter(F.col(key).isNotNull())
                .groupBy(key)
                .agg(F.count(F.lit(1)).alias("n"))
                .join(table.select(F.col(check.other or key).alias(key), F.lit(True).alias("found")).distinct(), key, "left")
                .agg(
                    F.coalesce(F.sum("n"), F.lit(0)).alias("evaluated"),
                    F.coalesce(F.sum(F.when(F.col("found").isNull(), F.col("n"))), F.lit(0)).alias("unexpected"),
                )
            )
            pieces.append(
                orphan.select(
                    _record(
                        source, number, check, F.col("evaluated"), F.col("unexpected"), F.col("unexpected") == 0
                    ).alias("r")
                )
            )
        else:
            in_pass.append((number, check))
    if keyed:
        records = []
        for number, check in keyed:
            evaluated, unexpected = F.col(f"e{number}"), F.col(f"u{number}")
            records.append(
                _record(source, number, check, evaluated, unexpected, _share_ok(evaluated, unexpected, check.mostly))
            )
        pieces.append(_key_counts(df, keyed).select(F.explode(F.array(*records)).alias("r")))
    if in_pass or missing:
        measures = [F.count(F.lit(1)).alias("rows")]
        records = list(missing)
        for number, check in in_pass:
            if check.kind == "row_count":
                enough = F.col("rows") >= (check.low or 0)
                if check.high is not None:
                    enough = enough & (F.col("rows") <= check.high)
                records.append(
                    _record(source, number, check, F.col("rows"), F.when(enough, 0).otherwise(1), enough)
                )
                continue
            seen, bad = _evaluated_and_bad(check)
            measures.append(F.count(F.when(seen, 1)).alias(f"e{number}"))
            measures.append(F.count(F.when(seen & bad, 1)).alias(f"u{number}"))
            evaluated, unexpected = F.col(f"e{number}"), F.col(f"u{number}")
            records.append(
                _record(source, number, check, evaluated, unexpected, _share_ok(evaluated, unexpected, check.mostly))
            )
        pieces.insert(0, df.agg(*measures).select(F.explode(F.array(*records)).alias("r")))
    return reduce(DataFrame.unionByName, pieces).select("r.*")


def run_suites(tables: dict[str, DataFrame], suites: dict[str, tuple[Check, ...]]) -> DataFrame:
    """All suites over their tables; tables may be parents of each other's checks."""
    return reduce(
        DataFrame.unionByName,
        [run_suite(tables[name], suite, name, tables) for name, suite in suites.items() if name in tables],
    )


def with_status(results: DataFrame) -> DataFrame:
    """``pass``, ``warn`` (a failed check of severity warn) or ``fail``."""
    status = F.when(F.col("success"), "pass").when(F.col("severity") == "warn", "warn").otherwise("fail")
    return results.withColumn("status", status)


def source_records(results: DataFrame, test_type: str = "gx") -> DataFrame:
    """One record per source: pass or fail, and how many checks failed."""
    failed = F.count(F.when(~F.col("success") & (F.col("severity") != "warn"), 1))
    return results.groupBy("source_name").agg(failed.alias("failed")).select(
        F.lit(test_type).alias("test_type"),
        F.concat(F.lit(f"{test_type}_"), F.col("source_name"), F.lit("_validation")).alias("test_name"),
        F.when(F.col("failed") == 0, "pass").otherwise("fail").alias("status"),
        F.when(
            F.col("failed") > 0, F.concat(F.lit("Failed "), F.col("failed").cast("string"), F.lit(" expectations"))
        ).alias("failure_message"),
        "source_name",
    )


def model_record(results: DataFrame, test_type: str = "dbt") -> DataFrame:
    """One record for all model tests together."""
    failed = F.count(F.when(~F.col("success") & (F.col("severity") != "warn"), 1))
    return results.agg(failed.alias("failed")).select(
        F.lit(test_type).alias("test_type"),
        F.lit(f"{test_type}_test_suite").alias("test_name"),
        F.when(F.col("failed") == 0, "pass").otherwise("fail").alias("status"),
        F.when(
            F.col("failed") > 0, F.concat(F.lit("Failed "), F.col("failed").cast("string"), F.lit(" tests"))
        ).alias("failure_message"),
        F.lit("all").alias("source_name"),
    )


def stamp_run(records: DataFrame, run_id: str | None = None, run_timestamp: str | None = None) -> DataFrame:
    """Records of one run in the layout of the result table."""
    at = F.lit(run_timestamp).cast("timestamp_ntz") if run_timestamp else F.localtimestamp()
    return records.select(
        F.lit(run_id or str(uuid.uuid4())).alias("run_id"),
        at.alias("run_timestamp"),
        "test_type",
        "test_name",
        "status",
        "failure_message",
        "source_name",
    )


def append_results(records: DataFrame, path: str) -> None:
    """Append stamped records to the result table."""
    records.write.mode("append").parquet(path)


def stored_results(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RESULT_SCHEMA).parquet(path)


def latest_run(results: DataFrame) -> DataFrame:
    """Records of the newest run; its time enters as a scalar subquery."""
    newest = results.agg(F.max("run_timestamp")).scalar()
    return results.filter(F.col("run_timestamp") == newest)


def run_kpis(results: DataFrame) -> DataFrame:
    """Tests, passes, failures and pass rate."""
    passed = F.count(F.when(F.col("status") == "pass", 1))
    total = F.count(F.lit(1))
    return results.agg(
        total.alias("total_tests"),
        passed.alias("passed"),
        (total - passed).alias("failed"),
        F.coalesce(passed / F.nullif(total, F.lit(0)) * 100, F.lit(0.0)).alias("pass_rate"),
    )


def failed_tests(results: DataFrame) -> DataFrame:
    """Failed records with their message."""
    return results.filter("status = 'fail'").select(
        "test_name",
        "test_type",
        "source_name",
        F.coalesce("failure_message", F.lit("No additional details available")).alias("details"),
    )


def last_dates(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Newest date per source: ``{source: (table, date column)}``."""
    return reduce(
        DataFrame.unionByName,
        [
            df.agg(F.max(F.to_date(F.col(c))).alias("last_date")).select(F.lit(name).alias("source"), "last_date")
            for name, (df, c) in tables.items()
        ],
    )


def freshness(tables: dict[str, tuple[DataFrame, str]], as_of: str | None = None) -> DataFrame:
    """Age of each source and its status: OK, WARN, STALE or NO DATA.

    ``check_status`` is the source-freshness check on the same limits.
    """
    today = F.lit(as_of).cast("date") if as_of else F.current_date()
    age = F.col("days_old")
    shown = F.concat(F.lit(" ("), age.cast("string"), F.lit("d)"))
    return (
        last_dates(tables)
        .withColumn("days_old", F.datediff(today, "last_date").cast("bigint"))
        .withColumn(
            "status",
            F.when(F.col("last_date").isNull(), "NO DATA")
            .when(age > FRESHNESS_ERROR_DAYS, F.concat(F.lit("STALE"), shown))
            .when(age > FRESHNESS_WARN_DAYS, F.concat(F.lit("WARN"), shown))
            .otherwise(F.concat(F.lit("OK"), shown)),
        )
        .withColumn(
            "check_status",
            F.when(age.isNull() | (age > FRESHNESS_ERROR_DAYS), "error")
            .when(age > FRESHNESS_WARN_DAYS, "warn")
            .otherwise("pass"),
        )
    )


def row_loss(raw: DataFrame, staged: DataFrame, key: str, tolerance: float = 0.01) -> DataFrame:
    """Rows staging dropped, and whether that is within tolerance.

    Both counts are summed from one union, so the two single rows need no join.
    """
    counts = (
        raw.filter(F.col(key).isNotNull())
        .agg(F.count(F.lit(1)).alias("raw_count"), F.lit(0).cast("bigint").alias("staged_count"))
        .unionByName(
            staged.agg(F.lit(0).cast("bigint").alias("raw_count"), F.count(F.lit(1)).alias("staged_count"))
        )
        .agg(F.sum("raw_count").alias("raw_count"), F.sum("staged_count").alias("staged_count"))
    )
    lost = F.col("raw_count") - F.col("staged_count")
    return counts.select(
        "raw_count", "staged_count", lost.alias("records_lost"), (lost <= F.col("raw_count") * tolerance).alias("success")
    )
