"""What became of every row that a build has read.

:class:`Reconciliation` watches the inputs of a build while they are read for
its tables (``observe``: the counts are gathered in the same pass, without a
scan of their own). Each row is kept, set aside in quarantine, or left out by
one named rule, the first that it meets. A build whose counts don't add up
fails.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

READ, KEPT, QUARANTINED = "read", "kept", "quarantined"


class DoesNotAddUp(RuntimeError):
    pass


@dataclass
class Reconciliation:
    """The watched inputs of one build."""

    seen: dict[str, tuple[list[str], Observation]] = field(default_factory=dict)

    def watch(self, name: str, rows: DataFrame, rules: dict[str, Column]) -> DataFrame:
        """``rows`` that are not left out by any rule; what each rule takes is counted when they are read.

        ``rules``: for each outcome the rows it takes, in order; a NULL condition
        takes nothing. The result should be read by one action of the build, and
        not by one that looks at its input twice (a range exchange samples it).
        Tasks that run again after a lost executor count again: the outcomes
        still add up then, but to more than the input."""
        outcome = F.lit(KEPT)
        for label, takes in reversed(rules.items()):
            outcome = F.when(takes, F.lit(label)).otherwise(outcome)
        told = rows.withColumn("_outcome", outcome)
        labels = [KEPT, *rules]
        counts = [F.count_if(F.col("_outcome") == label).alias(f"n{i}") for i, label in enumerate(labels)]
        noted = Observation()
        self.seen[name] = (labels, noted)
        return told.observe(noted, F.count(F.lit(1)).alias("n_read"), *counts).filter(F.col("_outcome") == KEPT).drop("_outcome")

    def counts(self) -> list[tuple[str, str, int]]:
        """(input, outcome, rows) of all watched inputs, after they were read; raises if they don't add up."""
        out = []
        for name, (labels, noted) in self.seen.items():
            try:
                got = noted.get
            except Py4JJavaError:
                got = {}  # an input known to be empty is never read
            n = [int(got.get(f"n{i}") or 0) for i in range(len(labels))]
            read = int(got.get("n_read") or 0)
            if sum(n) != read:
                raise DoesNotAddUp(f"{name}: {read} rows read, but {dict(zip(labels, n))}")
            out += [(name, READ, read), *[(name, label, k) for label, k in zip(labels, n)]]
        return out


def as_table(spark: SparkSession, counts: list[tuple[str, str, int]]) -> DataFrame:
    """One row for each input and outcome: ``input``, ``outcome``, ``n_rows``."""
    return spark.createDataFrame(counts, "input string, outcome string, n_rows long")
