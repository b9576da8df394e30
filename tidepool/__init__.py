"""tidepool: table-change, query-composition, page, raster and scoring jobs
expressed as Spark DataFrame plans."""

__version__ = "0.1.0"
