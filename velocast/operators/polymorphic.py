"""I1, polymorphic: a table function whose output columns follow from the table it is given.

``analyze`` reads the input's schema and the names of the key and order columns, and answers
with the output schema, the partitioning and the ordering, so a call names neither.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.functions import udtf
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult, OrderingColumn, PartitioningColumn


@dataclass
class Plan(AnalyzeResult):
    key: str = ""
    order: str = ""
    values: list = field(default_factory=list)


class SeriesProfile:
    """One row per key: N, the first and last value of the order column, and for every numeric
    column c of the table FIRST_c, LAST_c and STEP_c, the largest change from one row to the next.

    Rows come in the order of the order column; null values are passed over.  Only running values
    are held, however many rows a key has.
    """

    @staticmethod
    def analyze(rows: AnalyzeArgument, key: AnalyzeArgument, order: AnalyzeArgument) -> AnalyzeResult:
        if not rows.isTable:
            raise ValueError("the first argument must be a table")
        for name in (key.value, order.value):
            if name not in rows.dataType.names:
                raise ValueError(f"the table has no column {name!r}; it has {', '.join(rows.dataType.names)}")
        by, at = rows.dataType[key.value], rows.dataType[order.value]
        values = [f.name for f in rows.dataType if isinstance(f.dataType, T.NumericType) and f.name not in (key.value, order.value)]
        out = T.StructType([T.StructField(by.name, by.dataType), T.StructField("N", T.LongType()),
                            T.StructField(f"FIRST_{at.name}", at.dataType), T.StructField(f"LAST_{at.name}", at.dataType)])
        for c in values:
            for x in ("FIRST", "LAST", "STEP"):
                out = out.add(f"{x}_{c}", T.DoubleType())
        return Plan(schema=out, partitionBy=[PartitioningColumn(f"`{by.name}`")], orderBy=[OrderingColumn(f"`{at.name}`")],
                    key=by.name, order=at.name, values=values)

    def __init__(self, plan: Plan):
        self.plan = plan
        self.n, self.key, self.first, self.last = 0, None, None, None
        self.held = {c: [None, None, None] for c in plan.values}

    def eval(self, row, key, order):
        self.key = row[self.plan.key]
        at = row[self.plan.order]
        self.first, self.last, self.n = at if self.n == 0 else self.first, at, self.n + 1
        for c, h in self.held.items():
            if row[c] is not None:
                v = float(row[c])
                if h[0] is None:
                    h[0] = v
                else:
                    step = abs(v - h[1])
                    h[2] = step if h[2] is None else max(h[2], step)
                h[1] = v

    def terminate(self):
        if self.n:
            yield (self.key, self.n, self.first, self.last, *[v for h in self.held.values() for v in h])


def register_series_profile(spark: SparkSession, name: str = "series_profile") -> str:
    spark.udtf.register(name, udtf(SeriesProfile))
    return name


def series_profile(df: DataFrame, key: str, order: str) -> DataFrame:
    """:class:`SeriesProfile` of any table."""
    spark = df.sparkSession
    name = register_series_profile(spark)
    return spark.sql(f"SELECT * FROM {name}(TABLE({{df}}), {{key}}, {{order}})", df=df, key=key, order=order)
