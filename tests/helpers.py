"""Small helpers for hand-made rows."""

import math


def rows(df, *order):
    """All rows as tuples, NaN as the text ``nan``, sorted."""
    picked = df.select(*order) if order else df
    out = [tuple("nan" if isinstance(v, float) and math.isnan(v) else v for v in r) for r in picked.collect()]
    return sorted(out, key=repr)


def value(spark, column, **inputs):
    """One column over one row of literals."""
    from pyspark.sql import functions as F

    df = spark.range(1)
    for name, v in inputs.items():
        df = df.withColumn(name, v if hasattr(v, "alias") else F.lit(v))
    return df.select(column.alias("v")).first()["v"]
