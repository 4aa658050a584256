"""The severity score as Python UDFs, only to compare them with the native
expression (the native one is what the pipeline uses). The plain UDF comes twice: with
pickled rows, and Arrow-batched (``useArrow``), still a per-value Python function. The
pandas and Arrow UDFs handle a batch at a time."""

from __future__ import annotations

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from strata.functions.expressions import SEVERITY_SCORE


@F.udf("int", useArrow=True)
def severity_score_udf(grav):
    return SEVERITY_SCORE.get(grav)


@F.pandas_udf("int")
def severity_score_pandas(grav: pd.Series) -> pd.Series:
    return grav.map(SEVERITY_SCORE).astype("Int32")


@F.udf("int", useArrow=False)
def severity_score_pickled(grav):
    return SEVERITY_SCORE.get(grav)


@F.arrow_udf("int")
def severity_score_arrow(grav: pa.Array) -> pa.Array:
    at = pc.index_in(grav, value_set=pa.array(list(SEVERITY_SCORE), grav.type))
    return pa.array(list(SEVERITY_SCORE.values()), pa.int32()).take(at)


WAYS = {"udf": severity_score_udf, "udf_pickled": severity_score_pickled, "pandas": severity_score_pandas, "arrow": severity_score_arrow}
