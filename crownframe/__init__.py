"""Detections, masks, tiles and ground truth as Spark DataFrames."""
