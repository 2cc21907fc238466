"""From source tables to answers: extract, clean, model, views, slices."""
