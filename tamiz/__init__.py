"""Data-quality and premium analytics over one wide fact table, as Spark plans."""
