"""Readers, writers and stand-in input builders."""
