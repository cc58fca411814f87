import numpy as np
import pandas as pd

from riskloom.operators import binning


def test_few_values(spark, monkeypatch):
    counted = []
    monkeypatch.setattr(binning.F, "count_distinct", lambda c, _f=binning.F.count_distinct: counted.append(c) or _f(c))
    df = spark.createDataFrame(pd.DataFrame({"many": np.arange(500.0), "ten": np.arange(500.0) % 10, "eleven": np.arange(500.0) % 11, "one": 1.0}))
    assert binning.few_values(df, ["many", "ten", "eleven", "one"], 10) == ["ten", "one"]
    assert "many" not in counted
