"""DataFrame -> DataFrame operators; most run on batches and streams alike."""
