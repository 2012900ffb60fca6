"""Loan statistics kept up from run to run by mergeable daily partial aggregates.

``days`` holds one row per copy and day of loan, partitioned by month: the number of loans and the latest check-in and due
dates among them.  ``totals`` holds one row per copy over all days before the run date.  Both are written per run, so a run can be repeated.

A run reads the loans of the months that are new or touched since the last run, and of no others:

* counts and latest dates of new days are merged into the totals;
* old days of those months are folded anew; the copies whose partial aggregate differs there from the stored one get their
  totals from their stored days, since a latest date can also move back;
* monthly and annual counts are sums over the stored days of the last year.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfstream.operators.circulation import all_circulations
from shelfstream.session import materialize

_PARTIAL = ("loans", "last_checkin", "last_due")
DAYS_SCHEMA = "ac_id bigint, day date, loans bigint, last_checkin date, last_due date, month string"
TOTALS_SCHEMA = "ac_id bigint, all_circs bigint, last_checkin date, last_due date, last_circ date"


def _loans(circulation: DataFrame, aged_circulation: DataFrame) -> DataFrame:
    columns = ("id", "target_copy", "xact_start", "due_date", "checkin_time")
    return all_circulations(*[df.select(*columns) for df in (circulation, aged_circulation)])


def _month(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def fold_days(loans: DataFrame) -> DataFrame:
    """(ac_id, day, loans, last_checkin, last_due) of the loans; those without a start belong to no day."""
    return (
        loans.filter("xact_start IS NOT NULL").groupBy(F.col("target_copy").alias("ac_id"), F.to_date("xact_start").alias("day"))
        .agg(F.count("id").alias("loans"), F.max(F.to_date("checkin_time")).alias("last_checkin"), F.max(F.to_date("due_date")).alias("last_due"))
    )


def fold_totals(days: DataFrame) -> DataFrame:
    return days.groupBy("ac_id").agg(
        F.sum("loans").alias("all_circs"), F.max("last_checkin").alias("last_checkin"), F.max("last_due").alias("last_due"),
        F.max("day").alias("last_circ"),
    )


@dataclass(frozen=True)
class LoanDays:
    """State of the runs below ``path``: ``days``, which all runs share, and ``totals/run=D``."""

    spark: SparkSession
    path: str

    @property
    def days(self) -> DataFrame:
        return self.spark.read.schema(DAYS_SCHEMA).parquet(f"{self.path}/days")

    def totals(self, run_date: str) -> DataFrame:
        return self.spark.read.schema(TOTALS_SCHEMA).parquet(f"{self.path}/totals/run={run_date}")

    def _put_days(self, folded: DataFrame) -> None:
        """Replace the stored rows of the months that occur in ``folded``, each as a whole."""
        rows = folded.select("ac_id", "day", *_PARTIAL, _month(F.col("day")).alias("month")).hint("rebalance", "month")
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(f"{self.path}/days")

    def start(self, circulation: DataFrame, aged_circulation: DataFrame, run_date: str) -> None:
        """First run: all loans are folded once."""
        self._put_days(fold_days(_loans(circulation, aged_circulation)))
        fold_totals(self.days.filter(F.col("day") < F.lit(run_date).cast("date"))).write.mode("overwrite").parquet(f"{self.path}/totals/run={run_date}")

    def advance(self, circulation: DataFrame, aged_circulation: DataFrame, last_run: str, run_date: str, touched: list[str]) -> None:
        """Next run, at ``run_date`` after ``last_run``.

        ``touched`` names the days before ``last_run`` on which a loan came in, was changed or was taken away since then;
        later days are read in any case.  A loan that moves to another day touches both.
        """
        first, until, start = F.lit(last_run).cast("date"), F.lit(run_date).cast("date"), F.to_date("xact_start")
        months = sorted({d[:7] for d in touched if d < last_run})

        def again(day):
            return (day >= F.trunc(first, "month")) | (_month(day).isin(months) if months else F.lit(False))

        folded = materialize(fold_days(_loans(circulation, aged_circulation).filter(again(start))), "new-days")
        reread = self.days.filter((F.col("month") >= last_run[:7]) | (F.col("month").isin(months) if months else F.lit(False)))
        both = folded.filter(F.col("day") < first).select("ac_id", "day", F.struct(*_PARTIAL).alias("new")).join(
            reread.filter((F.col("day") < first) & F.col("ac_id").isNotNull()).select("ac_id", "day", F.struct(*_PARTIAL).alias("held")),
            ["ac_id", "day"], "full_outer",
        )
        # Noted before the days are replaced, and added to by a repeated run, which finds them replaced.
        noted = f"{self.path}/changed/run={run_date}"
        both.filter(~F.col("new").eqNullSafe(F.col("held"))).select("ac_id").distinct().write.mode("append").parquet(noted)
        changed = self.spark.read.schema("ac_id bigint").parquet(noted).distinct()
        # A month that lost all its loans has no rows that would replace its partition: one without a copy stands for them.
        left = folded.select(_month(F.col("day")).alias("month")).distinct()
        empty = reread.select("month").distinct().join(left, "month", "left_anti").select(
            F.lit(None).cast("bigint").alias("ac_id"), F.to_date(F.concat("month", F.lit("-01"))).alias("day"), F.lit(0).cast("bigint").alias("loans"),
            *[F.lit(None).cast("date").alias(c) for c in ("last_checkin", "last_due")],
        )
        empty = materialize(empty, "empty-months")
        self._put_days(folded.unionByName(empty))
        new = fold_totals(folded.filter((F.col("day") >= first) & (F.col("day") < until)))
        same = [t.join(changed, "ac_id", "left_anti") for t in (self.totals(last_run), new)]
        anew = fold_totals(self.days.filter(F.col("day") < until).join(changed, "ac_id", "left_semi"))
        _merged(*same).unionByName(anew).write.mode("overwrite").parquet(f"{self.path}/totals/run={run_date}")

    def stats(self, run_date: str) -> DataFrame:
        """The columns of :func:`circulation.circ_stats` for the run, from its totals and the days of the last year."""
        day = F.lit(run_date).cast("date")
        since = F.date_format(F.add_months(day, -12), "yyyy-MM")  # prunes the partitions
        recent = self.days.filter((F.col("month") >= since) & (F.col("day") > F.add_months(day, -12)) & F.col("ac_id").isNotNull()).groupBy("ac_id").agg(
            F.sum(F.when(F.col("day") > F.add_months(day, -1), F.col("loans"))).alias("monthly_circs"),
            F.sum("loans").alias("annual_circs"),
        )
        return self.totals(run_date).filter("all_circs > 0").join(recent, "ac_id", "left").select(
            "ac_id", "all_circs", "monthly_circs", "annual_circs", "last_checkin", "last_due", "last_circ"
        )


def _merged(held: DataFrame, new: DataFrame) -> DataFrame:
    return held.unionByName(new).groupBy("ac_id").agg(
        F.sum("all_circs").alias("all_circs"), F.max("last_checkin").alias("last_checkin"), F.max("last_due").alias("last_due"),
        F.max("last_circ").alias("last_circ"),
    )
