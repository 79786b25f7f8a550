"""Table operators: profile, row sets, frequencies, dictionaries, features, models, metrics."""
