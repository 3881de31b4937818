"""clientele.streaming - applying the batch scoring operator to arriving files.

The analysis itself has no streaming semantics (no watermark, window or
state): RFM quintiles and medians are properties of the whole customer table.
What does carry over to a stream is scoring with a frozen model: the encoding
lives inside the fitted ``PipelineModel``, so each micro-batch of new customer
rows can be scored exactly like a batch (see ``score_files``).
"""
