"""What the registered model queries ask for."""

import pytest

from ledgerlens.plans import catalog, models


class Asked(Exception):
    pass


@pytest.mark.parametrize("name", ["rf_code", "dense_rf", "dense_linear", "svm_code"])
def test_registered_models_are_whole(spark, monkeypatch, name):
    """All trees at full depth, all penalties, all iterations, vectors of full size."""
    def stop(*given):
        raise Asked(given[-1])

    monkeypatch.setattr(catalog, "train_code_classifier", stop)
    monkeypatch.setattr(catalog, "fit_dense_linear", stop)
    monkeypatch.setattr(catalog, "section_rows", lambda *_: None)
    monkeypatch.setattr(catalog.sampling, "stratified_split", lambda *_: spark.range(1).selectExpr(
        "true as is_test"))
    with pytest.raises(Asked) as asked:
        catalog.QUERIES[name](spark, "")
    assert asked.value.args[0] == models.ModelOptions()
