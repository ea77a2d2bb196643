"""Training-data operators: web archives, extraction, joins, search, classifiers, mixing."""
