"""Tree models with the library's own settings, fitted once for each session and folder."""

from __future__ import annotations

from rainpanel.operators import features, models
from rainpanel.plans import star

TEST_YEAR = 2000
_FITTED: dict = {}


def fitted(kind, spark, sf):
    """The model of the rows before the test year, and the rows from it on."""
    (model,), test = fitted_together((kind,), spark, sf)
    return model, test


def fitted_together(kinds, spark, sf):
    """Models of several kinds, those not known yet from one reading, and the test rows."""
    train, test = features.split_by_year(star.panel(spark, sf), TEST_YEAR)
    names = {kind: (kind, sf, spark.sparkContext.applicationId) for kind in kinds}
    missing = [kind for kind in kinds if names[kind] not in _FITTED]
    if missing:
        _FITTED.update({names[kind]: model for kind, model in models.fit_models(missing, train).items()})
    return [_FITTED[names[kind]] for kind in kinds], test
