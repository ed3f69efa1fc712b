"""Scans: message streams, partitioned history, scored tables, small fixtures."""
