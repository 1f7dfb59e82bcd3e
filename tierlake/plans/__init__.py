"""Table jobs and end-to-end layer jobs built from the operators."""
