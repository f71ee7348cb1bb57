"""Checks on keys, schemas and rows."""

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key combinations held by more than one row, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).filter(F.col("count") > 1)


def assert_unique(df: DataFrame, keys: list[str]) -> None:
    example = duplicate_keys(df, keys).head(1)
    if example:
        raise ValueError(f"duplicate key {example[0].asDict()} for {keys}")


def schema_problems(df: DataFrame, expected: T.StructType) -> list[str]:
    """Missing columns and columns of another type; empty when ``df`` fits."""
    actual = {field.name: field.dataType for field in df.schema}
    problems = []
    for field in expected:
        if field.name not in actual:
            problems.append(f"{field.name}: missing")
        elif actual[field.name] != field.dataType:
            problems.append(
                f"{field.name}: {actual[field.name].simpleString()}"
                f" instead of {field.dataType.simpleString()}"
            )
    return problems


def assert_schema(df: DataFrame, expected: T.StructType) -> None:
    problems = schema_problems(df, expected)
    if problems:
        raise ValueError("; ".join(problems))


REPORT = "check string, kind string, rows bigint, violations bigint"


@dataclass(frozen=True)
class Checks:
    """Declared checks of a table, evaluated together.

    ``rows``: conditions that every row must meet (NULL does not) by name; all of them are counted in
    one `observe` while the table is written. ``unique``: keys that no two rows may share, by name; each is a grouping.
    ``schema``: columns that must be there with these types, told from the schema alone.
    """

    rows: dict[str, Column] = field(default_factory=dict)
    unique: dict[str, list[str]] = field(default_factory=dict)
    schema: T.StructType = field(default_factory=T.StructType)

    def __post_init__(self):
        if set(self.rows) & set(self.unique):
            raise ValueError("a name stands for one check")

    def observed(self, df: DataFrame) -> tuple[DataFrame, Observation]:
        """``df`` that counts its rows and violations when it is next written."""
        seen = Observation()
        failed = [
            F.count_if(~F.coalesce(holds, F.lit(False))).alias(f"failed_{k}")
            for k, holds in enumerate(self.rows.values())
        ]
        return df.observe(seen, F.count(F.lit(1)).alias("rows"), *failed), seen

    def report(self, written: DataFrame, seen: Observation) -> DataFrame:
        """check, kind, rows, violations, from the counts and the table as written.

        A duplicate key counts once for every row beyond its first; a schema check has one row per expected column.
        """
        counts = seen.get
        total = counts["rows"] or 0
        lines = [(name, "row", total, counts[f"failed_{k}"] or 0) for k, name in enumerate(self.rows)]
        for name, keys in self.unique.items():
            surplus = duplicate_keys(written, keys).agg(F.sum(F.col("count") - 1)).first()[0]
            lines.append((name, "unique", total, surplus or 0))
        bad = {problem.split(":")[0] for problem in schema_problems(written, self.schema)}
        lines += [(f.name, "column", total, int(f.name in bad)) for f in self.schema]
        return written.sparkSession.createDataFrame(lines, REPORT)


def assert_report(report: DataFrame) -> None:
    """Raise with the first violated checks of a report, if there are any."""
    failed = [f"{r['check']} ({r['kind']}): {r['violations']}" for r in report.filter("violations > 0").head(20)]
    if failed:
        raise ValueError("; ".join(failed))
