"""Recognition-output analytics on Spark: manifests, layout, decoding, gating, correction and evaluation as DataFrame operators."""
