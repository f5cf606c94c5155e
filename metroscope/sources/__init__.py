"""Reading raw archives, the lake on disk, and the per-feed jobs between the two."""
