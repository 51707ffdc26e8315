"""Document-layout and corpus analytics on Spark."""
