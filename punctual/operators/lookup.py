"""Code-to-name lookups against a dimension table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F


def with_names(
    df: DataFrame,
    dim: DataFrame,
    code: str,
    *,
    dim_code: str = "code",
    names: Mapping[str, str] | None = None,
    fallback: bool = True,
) -> DataFrame:
    """Left-join the dimension and add its name columns; the name of an unknown code is the code.

    ``names`` maps result columns to dimension columns. With ``fallback`` the first of them is the name; the others
    (a city, a state) are null for an unknown code. Of several rows of a code the smallest value counts.
    Apply it to an aggregated table where possible. No join strategy is forced: Spark broadcasts the dimension when
    its measured size is under the session's threshold and otherwise shuffles both sides.
    """
    names = dict(names or {f"{code}_Name": "name"})
    columns = [F.col(dim_code).alias("_code"), *[F.col(s).alias(f"_{t}") for t, s in names.items()]]
    side = dim.select(*columns).groupBy("_code").agg(*[F.min(f"_{t}").alias(f"_{t}") for t in names])
    joined = df.join(side, df[code] == side["_code"], "left")
    kept = [df[c] for c in df.columns if c not in names]
    found = [side[f"_{t}"].alias(t) for t in names]
    if fallback:
        name = next(iter(names))
        found[0] = F.coalesce(side[f"_{name}"], df[code].cast("string")).alias(name)
    return joined.select(*kept, *found)
