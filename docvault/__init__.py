"""docvault: find, mask and record personal data in document collections with Spark."""
