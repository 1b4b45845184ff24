"""MLlib jobs: collaborative filtering (ALS) and churn classification."""
