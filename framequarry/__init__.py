"""A Spark-native engine for frame series, detections, sampling plans, prompts and answers."""
