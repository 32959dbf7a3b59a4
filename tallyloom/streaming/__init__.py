"""Daily batches as a stream."""
