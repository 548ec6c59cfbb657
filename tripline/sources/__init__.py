"""Readers, writers, landing of monthly files, shared scratch space."""
