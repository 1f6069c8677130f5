"""Readers: files, part sets, JDBC tables, CSV folders and OData services."""
