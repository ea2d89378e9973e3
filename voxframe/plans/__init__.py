"""plans of the segmentation side."""
