"""Table operators: weekly aggregate, panels, features, quality, baselines,
evaluation, delivery forecast and the learned model."""
