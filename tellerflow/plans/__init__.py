"""Customer marts, serving tables, data quality and the daily pipeline as DataFrame plans."""
