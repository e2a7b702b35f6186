"""Table-to-table operators: cleaning, alignment, comparison, models, events."""
