"""Processing statistics, the success-rate gate and lake validation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from rollcall.operators.processor import ERROR, RULE, check, storage_spec

SAMPLE_ERRORS = 3
STATS_ROW = "total bigint, successful bigint, failed bigint, success_rate double, sample_errors array<string>"
MINIMUM_RATE = 50.0


class SuccessRateTooLow(RuntimeError):
    """Raised when fewer rows pass than the gate asks for."""


@dataclass(frozen=True)
class ProcessingStats:
    total: int
    successful: int
    failed: int
    sample_errors: tuple[str, ...] = ()

    @property
    def success_rate(self) -> float:
        return 0.0 if self.total == 0 else self.successful / self.total * 100

    @classmethod
    def observed(cls, observation: Observation, sample_errors: tuple[str, ...] = ()):
        counts = observation.get
        return cls(counts["total"], counts["successful"], counts["failed"], sample_errors)

    def require(self, minimum: float = MINIMUM_RATE) -> ProcessingStats:
        if self.success_rate < minimum:
            raise SuccessRateTooLow(f"success rate {self.success_rate:.2f}% is below {minimum}%")
        return self


def outcome_counts() -> list[Column]:
    error = F.col(ERROR)
    return [
        F.count(F.lit(1)).alias("total"),
        F.count_if(error.isNull()).alias("successful"),
        F.count_if(error.isNotNull()).alias("failed"),
    ]


def success_rate(successful: Column, total: Column) -> Column:
    return F.when(total == 0, F.lit(0.0)).otherwise(successful / total * 100)


def sample_errors(checked: DataFrame, *order_by: str) -> DataFrame:
    """The first few errors in the given order: a top-k per task, then of those."""
    return (
        checked.filter(F.col(ERROR).isNotNull())
        .select(*order_by, ERROR)
        .orderBy(*order_by, ERROR)
        .limit(SAMPLE_ERRORS)
    )


def processing_stats(checked: DataFrame, *order_by: str) -> DataFrame:
    """One row: total, successful, failed, success_rate and the first errors.

    The rows are read and checked once, when this is called: what is counted on the way is
    taken with the few first errors.  All errors stay available as rows of `rejected`.
    """
    seen = Observation()
    counted = checked.observe(seen, *outcome_counts())
    errors = tuple(row[ERROR] for row in sample_errors(counted, *order_by).collect())
    stats = ProcessingStats.observed(seen, errors)
    return checked.sparkSession.createDataFrame(
        [(stats.total, stats.successful, stats.failed, stats.success_rate, list(stats.sample_errors))], STATS_ROW
    )


def validate_lake(records: DataFrame) -> DataFrame:
    """One row over storage rows: how many are readable, valid, invalid and dropped.

    Readable rows pass the record rules.  Of those, valid ones have a non-empty
    name (blanks count as a name here) and an age of zero or more.
    """
    checked = check(records, storage_spec())
    readable = F.col(ERROR).isNull()
    valid = readable & (F.col("name") != "") & (F.col("age") >= 0)
    return checked.agg(
        F.count_if(readable).alias("records_read"),
        F.count_if(valid).alias("valid"),
        (F.count_if(readable) - F.count_if(valid)).alias("invalid"),
        F.count_if(~readable).alias("dropped"),
        F.count_if(readable & F.col("name").rlike(r"\A[\x00-\x20]+\z")).alias("blank_names"),
    )


def rejects_by_rule(checked: DataFrame) -> DataFrame:
    """Rejected rows per failing rule."""
    return (
        checked.filter(F.col(ERROR).isNotNull())
        .groupBy(F.col(RULE).alias("rule"))
        .agg(F.count(F.lit(1)).alias("rejected"))
    )
