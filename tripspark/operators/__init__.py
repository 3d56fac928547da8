"""DataFrame operators. Each returns a lazy DataFrame (or a small plan object computed by
one aggregate job); nothing here collects a frame whose size grows with the data."""
