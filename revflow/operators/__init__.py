"""DataFrame operators: dedup, keyed merge, replay, facts, snapshots, control folds."""
