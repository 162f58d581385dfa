"""Stand-in raw tables: one column list, two dialects (Spark and DuckDB)."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

def d8(col: str) -> tuple[str, str]:
    """``yyyyMMdd`` text of a timestamp column, in both dialects."""
    return (f"date_format({col}, 'yyyyMMdd')", f"strftime({col}, '%Y%m%d')")


@dataclass
class Standin:
    table: str
    cols: list[tuple]          # (name, expr) or (name, (spark_expr, duck_expr))
    where: str | None = None
    extra: dict = field(default_factory=dict)

    def _exprs(self, dialect: int) -> list[str]:
        out = []
        for name, expr in self.cols:
            e = expr[dialect] if isinstance(expr, tuple) else expr
            out.append(f"{e} AS {name}")
        return out

    def names(self) -> list[str]:
        return [n for n, _ in self.cols]

    def df(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        base = table(spark, sf_dir, self.table)
        if self.where:
            base = base.where(self.where)
        return base.selectExpr(*self._exprs(0))

    def sql(self) -> str:
        w = f" WHERE {self.where}" if self.where else ""
        return f"SELECT {', '.join(self._exprs(1))} FROM {self.table}{w}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
