"""Delivery jobs on live streams."""
