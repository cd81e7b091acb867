"""Point-in-time user-value labels, features, training and scoring on Spark."""
