"""sources of the segmentation side."""
