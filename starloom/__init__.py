"""Ratings analytics and recommendations as Spark DataFrame jobs."""
