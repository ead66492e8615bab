"""G16, G17, H17 with an open schema: result documents as VARIANT.

PRED_DATA is stored as VARIANT in Parquet, not as text: a field is read without parsing the
document again, and documents may have fields that no reader knows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import LAGS
from .evaluate import flat_rows, pack_predictions, pred_columns
from .relational import STATION


def pack_variant(history: DataFrame, forecast: DataFrame, lags=LAGS) -> DataFrame:
    """(station, PRED_DATA): the two JSON arrays of the PRED table as one VARIANT array."""
    p = pack_predictions(history, forecast, lags)
    part = lambda i: F.coalesce(F.col("PRED_DATA")[i], F.lit("[]"))
    return p.select(STATION, F.parse_json(F.concat(F.lit("["), part(0), F.lit(","), part(1), F.lit("]"))).alias("PRED_DATA"))


def explode_documents(docs: DataFrame, col: str, path: str = "$", keep: tuple[str, ...] = (STATION,)) -> DataFrame:
    """``keep``, POS and DOC: a row for each element of the array at ``path``, by the lateral table
    function of VARIANT; rows without the path, or with an empty array, give none."""
    at = F.variant_get(F.col(col), path, "variant")
    held = docs.select(*keep, at.alias("_V")).where(F.col("_V").isNotNull())
    exploded = held.lateralJoin(held.sparkSession.tvf.variant_explode(F.col("_V").outer()))
    return exploded.select(*keep, F.col("pos").alias("POS"), F.col("value").alias("DOC"))


def flatten_variant(pred: DataFrame, index: int, lags=LAGS) -> DataFrame:
    """H17 from VARIANT documents: the typed rows of PRED_DATA[index]."""
    docs = explode_documents(pred, "PRED_DATA", f"$[{int(index)}]")
    cols = pred_columns(lags)
    kind = lambda c: "string" if c == "DATE" else "double"
    return flat_rows(docs.select(STATION, *[F.try_variant_get("DOC", f"$.{c}", kind(c)).alias(c) for c in cols]), lags)


def fields_of(docs: DataFrame, col: str = "DOC", keep: tuple[str, ...] = (STATION,)) -> DataFrame:
    """``keep``, FIELD, KIND and N_DOCS: the fields that a group's documents have, known or not."""
    x = docs.select(*keep, F.col(col).alias("_V"))
    x = x.lateralJoin(x.sparkSession.tvf.variant_explode(F.col("_V").outer())).where(F.col("key").isNotNull())
    return x.groupBy(*keep, F.col("key").alias("FIELD"), F.schema_of_variant("value").alias("KIND")).agg(F.count(F.lit(1)).alias("N_DOCS"))


def schema_of_documents(docs: DataFrame, col: str = "DOC") -> DataFrame:
    """One row: the schema that holds every document."""
    return docs.agg(F.schema_of_variant_agg(col).alias("SCHEMA"))
