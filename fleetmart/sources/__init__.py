"""Readers, table contracts and the adapter from star-schema test tables to bronze."""
