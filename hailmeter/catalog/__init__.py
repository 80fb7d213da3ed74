"""The given tables reshaped as trip and weather sources, and named queries on them."""
