"""Sources: raw CSV files, the registry of raw sources, reference data, and
adapters that present the driver's star-schema tables as raw e-commerce tables."""
