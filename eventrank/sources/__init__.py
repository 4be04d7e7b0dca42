"""Readers, writers and the session settings they rely on."""
