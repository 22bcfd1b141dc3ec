"""creelgrid: trip-survey analytics as lazy Spark DataFrame plans."""
