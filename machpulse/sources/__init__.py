"""Readers and writers: landed CSV, messages, streams and the Parquet tables behind them."""
