"""Scoring of arriving requests and refresh of features on arriving files."""
