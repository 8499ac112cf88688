"""tessera: star-schema market analytics, data-quality checks and a classifier
workflow, written as Spark DataFrame / SQL / MLlib jobs."""

__version__ = "0.1.0"
