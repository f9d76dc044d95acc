"""Distance operators: points, pairs, answers, checks, versions, publish."""
