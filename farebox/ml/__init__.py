"""Feature vectors, regressors, tuning and model checks on MLlib."""
