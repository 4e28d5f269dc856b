"""A PySpark-native analytics engine for materials-property data."""
