"""basketry: customer analytics for e-commerce order data, built on Spark DataFrames.

Layers: raw CSV sources -> cleaned tables (with data-quality gates) -> marts
(customer 360, enriched order fact, sales by state/category/month, RFM segments),
stored as versioned Parquet tables. Every transform is a lazy DataFrame -> DataFrame
function made of built-in Spark expressions.
"""

__version__ = "0.1.0"
