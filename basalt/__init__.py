"""A PySpark-native engine that turns semi-structured pages into a clean, typed, auditable catalogue."""
