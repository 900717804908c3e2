"""Queries for flags and rolling features."""

from __future__ import annotations


from txpipe import schema as S
from txpipe.operators import features as FT
from txpipe.plans import oracle as O
from txpipe.plans.common import labelled, transactions
from txpipe.plans.registry import query

FEATURE_OUT = ", ".join(S.FEATURE_TABLE)


@query("w13_features", O.with_(O.TX, O.PICKS, O.LAB, O.features_cte()) + f"SELECT {FEATURE_OUT} FROM feat")
def w13(spark, sf):
    """Full feature table over the labelled transactions."""
    return FT.build_features(labelled(spark, sf))


@query(
    "w13_features_hot_customer_split",
    O.with_(O.TX, O.PICKS, O.LAB, O.features_cte()) + f"SELECT {FEATURE_OUT} FROM feat",
)
def w13_hot(spark, sf):
    """W13 with the skew split forced on (every customer with more than 10
    rows counts as hot, about one row per block): the block plan must give
    the same table as the plain windows."""
    skew = FT.SkewConfig(min_rows=10, rows_per_block=1)
    return FT.build_features(labelled(spark, sf), skew=skew)


@query(
    "s15_features_via_sql_view",
    O.with_(O.TX, O.PICKS, O.LAB, O.features_cte()) + f"SELECT {FEATURE_OUT} FROM feat",
)
def s15(spark, sf):
    """Temp view + SQL text for the windows."""
    return FT.build_features_sql(labelled(spark, sf)).select(*S.FEATURE_TABLE)


def _rolling_query(i: int, spec: S.RollingSpec):
    key = f"w{i:02d}_{spec.name.lower()}"
    sql = O.with_(O.TX) + f"SELECT TRANSACTION_ID, {O.rolling_sql(spec)} AS {spec.name} FROM tx"

    @query(key, sql)
    def run(spark, sf):
        return FT.add_rolling_skew_safe(transactions(spark, sf), specs=[spec]).select("TRANSACTION_ID", spec.name)

    return run


for _i, _spec in enumerate(S.ROLLING, start=1):
    _rolling_query(_i, _spec)
