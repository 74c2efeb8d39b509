"""PySpark-native analytics for semi-structured requirement documents.

The core packages (``functions``, ``operators``, ``sources``, ``plans``,
``streaming``) hold the dataflow operators; the optional subpackage ``llm``
holds the operators for training-data preparation and is imported by nothing
else here.
"""
