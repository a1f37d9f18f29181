"""feedlake: self-media feed increments, catalogue jobs, follower-graph
expansion and text enrichment, expressed as Spark DataFrame / SQL /
Structured Streaming plans."""

__version__ = "0.1.0"
