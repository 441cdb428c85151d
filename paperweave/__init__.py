"""paperweave: record linkage and metadata fusion for scholarly records on Spark."""
