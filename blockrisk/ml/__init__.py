"""Year splits, model pipelines, importance selection, grid search and learning curves."""
