"""operators of the segmentation side."""
