"""Tables written by the jobs: keyed snapshots, feature tables, predictions, published tables."""
