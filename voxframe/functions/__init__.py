"""functions of the segmentation side."""
