"""Readers and writers: files and JDBC tables."""
