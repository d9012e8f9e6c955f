"""Readers: landed payloads, stored tables and the symbol universe."""
