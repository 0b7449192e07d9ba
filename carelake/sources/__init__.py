"""Readers and writers: JDBC tables, daily snapshots, documents, collections."""
