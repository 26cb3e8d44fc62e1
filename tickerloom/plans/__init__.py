"""The pipeline's tables, views and analytical queries."""
