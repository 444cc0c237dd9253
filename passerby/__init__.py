"""Footfall analytics on Spark: sightings of devices in, visits and visitor reports out."""
