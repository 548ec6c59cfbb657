"""The two stream-shaped jobs. Both are stateless, so neither needs a watermark."""
