"""loadkit: load planning and forecast checking as Spark DataFrame pipelines."""

__version__ = "0.1.0"
