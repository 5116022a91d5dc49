"""Model catalogue, gold models, check catalogue and the pipeline."""
