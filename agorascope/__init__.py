"""Community analytics as DataFrame -> DataFrame operators on Spark."""
