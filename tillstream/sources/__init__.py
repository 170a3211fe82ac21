"""Readers of topics, relational tables, CSV files and legacy XML batches."""
