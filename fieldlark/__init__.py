"""Parcel monitoring and corpus preparation as Spark DataFrame programs."""
