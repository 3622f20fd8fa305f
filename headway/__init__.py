"""Headway: travel-time reliability analytics written as Spark jobs."""
