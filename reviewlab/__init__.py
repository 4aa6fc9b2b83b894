"""Review analytics as Spark jobs: cleaning, word and score reports, features, models."""
