"""The pipeline: staging, star, sales dataset, reports and checks."""
