"""Readers: driver tables as banking feeds, layered files and JDBC options."""
