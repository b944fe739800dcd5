"""Training-data operators: chat text, near copies, quality, token files, HTML, repeats, URLs, leaks, embeddings."""
