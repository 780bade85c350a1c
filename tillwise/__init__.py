"""tillwise: retail and billing analytics on Spark.

Entry points:

* ``plans.abt.build_abt`` / ``abt_daily``: daily feature table with the same-store cohort.
* ``plans.billing``: priced usage, daily sums, and the roll-up.
* ``plans.models``: additive forecaster, GBT forecasts, and the cost/retail jobs.
* ``plans.text`` / ``operators.text_model``: TF-IDF, classifiers, and the threshold sweep.
* ``plans.flyer`` / ``operators.flyer``: the flyer feed.
* ``registry.QUERIES`` / ``ORACLES``: every registered job with its DuckDB twin.
"""

__version__ = "0.1.0"
