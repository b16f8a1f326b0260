"""skuflow: retail demand analytics (sales facts, top sellers, discount
features, per-category forecasts) as Spark DataFrame operators."""

import sys as _sys

__version__ = "0.1.0"


def _ship_by_value() -> None:
    """Pickle this package's functions by value, so that the few functions
    run in Python workers (``mapInPandas`` / ``applyInPandas``) work on
    executors that do not have the package installed."""
    try:
        from pyspark import cloudpickle
        cloudpickle.register_pickle_by_value(_sys.modules[__name__])
    except (ImportError, AttributeError, ValueError):  # pragma: no cover
        pass


_ship_by_value()
