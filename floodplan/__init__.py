"""Flood evacuation planning and live arrival tracking on Spark."""
