"""DataFrame to DataFrame transforms; batch and streaming inputs alike unless noted."""
