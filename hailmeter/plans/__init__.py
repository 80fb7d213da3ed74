"""Reports, analyses, checks and the end-to-end pipeline."""
