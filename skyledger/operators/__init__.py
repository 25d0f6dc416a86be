"""Table operators: quality, marts, profile, features, models, ranking."""
