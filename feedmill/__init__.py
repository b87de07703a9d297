"""Feed curation as Spark jobs: plain functions from DataFrame to DataFrame."""
