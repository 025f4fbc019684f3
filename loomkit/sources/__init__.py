"""Readers and writers: files, JDBC / connectors, image folders."""
