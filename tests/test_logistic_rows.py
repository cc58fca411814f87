from tests.test_large_tables import _frame


def test_logistic_trains_on_distinct_rows(spark, monkeypatch):
    from riskloom.operators import models
    from riskloom.operators.encoder import WoeEncoder

    df = _frame(spark)
    seen = []
    real = models.LogisticRegression.fit
    monkeypatch.setattr(models.LogisticRegression, "fit", lambda self, rows, *a: seen.append(rows.count()) or real(self, rows, *a))
    models.fit_logistic(df, WoeEncoder.fit(df, ("w",)), ["w"])
    assert len(seen) == 1 and seen[0] <= 10
