"""Spokecast: demand marts for shared-mobility trips, written as Spark DataFrame operators."""
