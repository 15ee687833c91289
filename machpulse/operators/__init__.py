"""Transforms from DataFrame to DataFrame, shared by batch, backfill and streaming runs."""
