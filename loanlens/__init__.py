"""loanlens: credit-risk analytics as Spark DataFrame / SQL / ML / streaming jobs."""

__version__ = "0.1.0"
