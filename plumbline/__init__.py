"""Spark-native retail warehouse quality, modelling and KPI library."""
