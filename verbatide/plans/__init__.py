"""Whole analyses: prepare, explore, cluster, classify."""
