"""medallion: PySpark-native data preparation for fraud-transaction medallion layers.

Subpackages:
  functions  - column expressions (coercion, rules, log grammar)
  operators  - DataFrame -> DataFrame operators (profile, cleaning, impute,
               outliers, text, rules, keys, unify, snapshots, encode, model)
  sources    - schema-first readers and sinks
  plans      - cleaning flows and the registered queries over the driver tables
  streaming  - the stateless log flow on a stream
"""
__version__ = "0.1.0"
