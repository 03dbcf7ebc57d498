"""The retraining query does the whole job: both models are fitted with the rounds and depth that the lifecycle uses by default."""

import datetime

from riskweave.functions import fixed
from riskweave.operators import models
from riskweave.plans import catalog


def loans(spark, folder):
    orders = [(i, i % 40, "OF"[i % 2], 1000.0 + 37 * (i * i % 101), ("1-URGENT", "5-LOW")[i % 3 > 0]) for i in range(1, 241)]
    lines = [
        (i, n, i % 17, i % 5, float(1 + (i * n) % 50), 100.0 + 13 * ((i + n) % 89), datetime.datetime(1997 + i % 2, 3, 1), "ARN"[n % 3], "OF"[i % 2])
        for i in range(1, 241) for n in (1, 2)
    ]
    customers = [(i, 500.0 + 11 * i, "AUTO") for i in range(40)]
    names = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_shipdate timestamp_ntz, l_returnflag string, l_linestatus string"
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderpriority string").write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame(lines, names).write.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame(customers, "c_custkey long, c_acctbal double, c_mktsegment string").write.parquet(f"{folder}/customer.parquet")
    return str(folder)


def test_both_models_are_fitted_in_full(spark, tmp_path, monkeypatch):
    """The fits asked for are recorded, and made with fewer rounds here."""
    asked, fit = [], models.fit

    def recorded(kind, train, features, label, params=None):
        asked.append({**fixed.BOOSTING_PARAMS, **(params or {})})
        return fit(kind, train, features, label, {"maxIter": 2, "maxDepth": 2})

    monkeypatch.setattr(models, "fit", recorded)
    outcome = catalog.retrain_loop(spark, loans(spark, tmp_path)).collect()
    assert len(outcome) == 1 and outcome[0]["active_version"] in (1, 2)
    assert asked == [fixed.BOOSTING_PARAMS] * 2
