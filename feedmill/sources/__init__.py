"""Readers: tables, text files, objects, notifications, generated rows."""
