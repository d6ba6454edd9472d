"""Document-layout and text-quality analytics on Spark."""
