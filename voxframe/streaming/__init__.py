"""streaming of the segmentation side."""
