from tastegraph.sources.readers import (
    MOVIES,
    RATINGS,
    SAMPLES,
    read_movies,
    read_ratings,
    read_samples,
    read_samples_with_rejects,
    read_user_item_records,
    typed_user_item_records,
)
from tastegraph.sources.writers import embedding_lines, write_embeddings, write_samples

__all__ = [
    "MOVIES", "RATINGS", "SAMPLES", "read_movies", "read_ratings", "read_samples",
    "read_samples_with_rejects", "read_user_item_records", "typed_user_item_records", "embedding_lines", "write_embeddings", "write_samples",
]
