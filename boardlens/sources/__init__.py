"""Readers and writers for frames, labels, detections and board documents."""
