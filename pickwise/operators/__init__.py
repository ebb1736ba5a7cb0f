"""DataFrame operators: preparation, combine, split, regret, summaries, serving."""
