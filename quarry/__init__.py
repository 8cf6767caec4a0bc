"""quarry: predictive-analytics building blocks expressed as Spark DataFrame plans.

Subpackages
-----------
sources    CSV/Parquet scans with multi-token null handling, CSV sinks, model/parameter bundles.
functions  Column-expression helpers (parsing, recoding, moments) and driver-side distribution tails.
operators  Table operators: selection, transforms, imputation, exploration, importance, sampling,
           ranking, evaluation, trees, logistic regression, forests, networks, clustering, baskets.
plans      Derived fixture views and the catalogue of registered queries with their SQL oracles.
streaming  Stateless scoring applied to a streaming source.
"""

__version__ = "0.1.0"
