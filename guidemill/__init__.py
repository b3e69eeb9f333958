"""Channel resolution, guide building and table queries on Apache Spark."""
