"""The models: staging views, dimensions, facts, analyses, and the daily run over them."""
